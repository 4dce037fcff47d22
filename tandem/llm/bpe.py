"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string exactly one token can be the last one of the
prefix's BPE encoding.  Storing that token per prefix gives the encoding by
walking back, an exact append (only new prefixes are computed) and cheap
re-encoding near an edit (only prefixes from the edit on are computed, until
they agree again with the stored ones).

A token t may follow the last token s of the shorter prefix only if BPE would
not have merged across their border; `Vocabulary.fits` decides that by undoing
the merges of s and t from the youngest on.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Memo, vector_udf

FIELDS = {
    "n_tokens": T.LongType(),
    "ids": T.ArrayType(T.IntegerType()),
    "ids_sha256": T.StringType(),
    "decoded": T.BinaryType(),
    "decoded_sha256": T.StringType(),
}


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Vocabulary:
    """Ranks plus, for each token, the two tokens that its last merge joined."""

    def __init__(self, ranks: dict[bytes, int], splits: list[tuple[int, int]] | None = None):
        self.ranks = ranks
        self.tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.splits = splits or [self._split(t) for t in self.tokens]
        self._fits = Memo(lambda pair: self._border(*pair), 400_000)
        # which lengths the tokens have that end in three given bytes: bounds the search below
        ends: dict[bytes, set[int]] = {}
        for token in ranks:
            if len(token) > 2:
                ends.setdefault(token[-3:], set()).add(len(token))
        self.lengths = {end: tuple(sorted(sizes, reverse=True)) for end, sizes in ends.items()}
        self.longest = max(map(len, ranks))

    def _split(self, token: bytes) -> tuple[int, int]:
        """The two tokens left before the last merge of ``token`` (itself twice for a byte)."""
        own = self.ranks.get(token, -1)
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 60))
            if self.ranks.get(parts[best] + parts[best + 1], 1 << 60) >= own:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        if len(parts) != 2:
            return own, own
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def _border(self, left: int, right: int) -> bool:
        ranks, tokens, splits = self.ranks, self.tokens, self.splits
        limit = 1 << 60  # a merge across the border of this rank or more came too late
        while True:
            if ranks.get(tokens[left] + tokens[right], limit) < limit:
                return False
            undo_left = left > right
            if undo_left and splits[left][1] == left or not undo_left and splits[right][0] == right:
                undo_left = not undo_left  # a single byte has no merge to undo
            if undo_left:
                limit, left = left, splits[left][1]
                if left == limit:
                    return True
            else:
                # of two equal ranks the one on the left merges first
                limit, right = right + 1, splits[right][0]
                if right + 1 == limit:
                    return True

    def extend(self, data: bytes, last: list[int], until: int | None = None) -> list[int]:
        """Adds to ``last`` the last token of each prefix of ``data`` up to length ``until``."""
        ranks, fits, lengths = self.ranks, self._fits, self.lengths
        for end in range(len(last) + 1, (len(data) if until is None else until) + 1):
            for size in lengths.get(data[end - 3:end], ()) if end > 2 else ():
                start = end - size
                if start > 0:
                    token = ranks.get(data[start:end])
                    if token is not None and fits[last[start - 1], token]:
                        break
                elif start == 0 and (token := ranks.get(data[:end])) is not None:
                    break
            else:
                token = ranks.get(data[end - 2:end]) if end > 1 else None
                if token is None or end > 2 and not fits[last[end - 3], token]:
                    token = ranks[data[end - 1:end]]
            last.append(token)
        return last

    def encode_many(self, pieces: Iterable[bytes]) -> dict[bytes, tuple[int, ...]]:
        """The encoding of each piece.  In sorted order a piece keeps the stored prefixes that
        it shares with the one before, and only appends."""
        out, last, before = {}, [], b""
        for data in sorted(pieces):
            whole = self.ranks.get(data)
            if whole is not None:
                out[data] = (whole,)
                continue
            same = 0
            for x, y in zip(before, data):
                if x != y:
                    break
                same += 1
            del last[same:]
            out[data] = tuple(self.walk_back(self.extend(data, last)))
            before = data
        return out

    def walk_back(self, last: list[int]) -> list[int]:
        ids, end, tokens = [], len(last), self.tokens
        while end:
            ids.append(last[end - 1])
            end -= len(tokens[last[end - 1]])
        return ids[::-1]

    def encode(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        return [whole] if whole is not None else self.walk_back(self.extend(data, []))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class PrefixEncoding:
    """The encoding of one piece of bytes that can grow and be edited."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data = vocabulary, data
        self.last = vocabulary.extend(data, [])

    def ids(self) -> list[int]:
        return self.vocabulary.walk_back(self.last)

    def append(self, more: bytes) -> None:
        """Exact: the stored prefixes stay as they are."""
        self.data += more
        self.vocabulary.extend(self.data, self.last)

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Puts ``new`` in place of data[start:end]; returns how many prefixes were computed.
        Once as many prefixes in a row agree with the stored ones as the longest token
        has bytes, all later ones do."""
        tail = self.last[end:]
        self.data = self.data[:start] + new + self.data[end:]
        last, shift = self.last[:start], start + len(new)
        window = self.vocabulary.longest
        agree = 0
        while len(last) < len(self.data):
            self.vocabulary.extend(self.data, last, len(last) + 1)
            at = len(last) - 1 - shift
            agree = agree + 1 if at >= 0 and last[-1] == tail[at] and len(self.vocabulary.tokens[last[-1]]) <= at + 1 else 0
            if agree > window:
                computed = len(last) - start
                last += tail[at + 1:]
                self.last = last
                return computed
        self.last = last
        return len(last) - start


class TextCodec:
    """Encodes whole texts: the pattern's matches one by one.

    A single space between two characters that are not white space begins a match
    whatever stands around it, so texts are cut there and each different chunk is
    encoded once."""

    cut = staticmethod(re.compile(r"(?<=\S) (?=\S)").split)
    odd = staticmethod(re.compile(r" \s|\s ").search)

    def __init__(self, vocabulary: Vocabulary, pattern: str, cache: int = 150_000):
        self.vocabulary = vocabulary
        self.matches = regex.compile(pattern).findall
        self.names = [str(i) for i in range(len(vocabulary.tokens))]
        self.chunks = Memo(lambda c: self._encoded([c])[c], cache)  # each with a space before it

    def _pieces(self, chunk: str) -> list[bytes]:
        if chunk.isascii():  # a word, or a word and a full stop or comma, needs no pattern
            if chunk.isalpha():
                return [b" " + chunk.encode()]
            if chunk[-1:] in (".", ",") and chunk[:-1].isalpha():
                return [b" " + chunk[:-1].encode(), chunk[-1:].encode()]
        return [m.encode() for m in self.matches(" " + chunk)]

    def _encoded(self, chunks: Iterable[str]) -> dict[str, tuple[int, ...]]:
        pieces = {c: self._pieces(c) for c in chunks}
        ids = self.vocabulary.encode_many({p for some in pieces.values() for p in some})
        return {c: ids[some[0]] if len(some) == 1 else tuple(chain.from_iterable(map(ids.__getitem__, some)))
                for c, some in pieces.items()}

    def encode_all(self, texts: list[str]) -> Iterator[list[int]]:
        """The ids of each text.  Chunks not yet known are encoded together."""
        parts = [self.cut(t) if self.odd(t) or t[:1] == " " or t[-1:] == " " else t.split(" ") for t in texts]
        known, new = self.chunks, set()
        for p in parts:
            new.update(p[1:])
        new.difference_update(known)
        here = self._encoded([c for c in new if c not in known.older])
        known.learn(here)
        for p in parts:
            first = chain.from_iterable(self.vocabulary.encode(m.encode()) for m in self.matches(p[0]))
            yield [*first, *chain.from_iterable(map(known.__getitem__, p[1:]))]
            p.clear()

    def encode(self, text: str) -> list[int]:
        return next(self.encode_all([text]))


def _groups(texts: Iterable[str | None], size: int = 3_000_000) -> Iterator[list[str]]:
    """The texts in groups of about ``size`` characters; null is empty."""
    group, chars = [], 0
    for text in texts:
        group.append(text or "")
        chars += len(group[-1])
        if chars >= size:
            yield group
            group, chars = [], 0
    yield group


class _Shared:
    """The broadcast vocabulary.  A worker's codec with its caches hangs on it, so both are
    dropped together when the worker's next task has another broadcast; kept by the module,
    the codecs of earlier runs would stay for as long as the worker lives."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cache: int):
        self.ranks, self.splits = ranks, Vocabulary(ranks).splits
        self.pattern, self.cache, self._codec = pattern, cache, None

    def codec(self) -> TextCodec:
        if self._codec is None:
            self._codec = TextCodec(Vocabulary(self.ranks, self.splits), self.pattern, self.cache)
        return self._codec


def encoded(text: Column, spark, path: str | None = None, pattern: str | None = None,
            fields: tuple[str, ...] = ("n_tokens", "ids"), cache: int = 150_000) -> Column:
    """A struct of ``fields`` (of `FIELDS`) for each text.

    The vocabulary (one file of fixed size) is read on the driver, its splits are
    worked out once, and both are broadcast.  Null and empty texts have no tokens;
    ids and decoded bytes are then empty.  A worker keeps the encoding of twice ``cache``
    chunks at most (some 200 bytes each).  Rows are independent of each other, so
    ties, repeated rows and other columns do not matter; an empty table gives none.
    """
    ranks = read_ranks(path or public_tokenizers.path("byte_bpe_50k.tiktoken"))
    shared = spark.sparkContext.broadcast(_Shared(ranks, pattern or public_tokenizers.PATTERN, cache))
    kind = T.StructType([T.StructField(f, FIELDS[f]) for f in fields])

    @vector_udf(kind)
    def run(texts: pd.Series) -> pd.DataFrame:
        codec = shared.value.codec()
        decode, name = codec.vocabulary.decode, codec.names.__getitem__
        make = {
            "n_tokens": len,
            "ids": lambda ids: ids,
            "ids_sha256": lambda ids: hashlib.sha256(" ".join(map(name, ids)).encode()).hexdigest(),
            "decoded": decode,
            "decoded_sha256": lambda ids: hashlib.sha256(decode(ids)).hexdigest(),
        }
        rows = []
        for group in _groups(texts):
            rows += ([make[f](ids) for f in fields] for ids in codec.encode_all(group))
        return pd.DataFrame(rows, columns=list(fields))

    return run(text)


def op2(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded bytes of every document."""
    got = encoded(F.col("text"), docs.sparkSession, path, fields=("n_tokens", "ids_sha256", "decoded_sha256"), cache=400_000)
    return docs.select("doc_id", got.alias("bpe")).select("doc_id", "bpe.*")
