"""Quality rules with tokeniser fertility.

Plain word and line rules come first.  Two public vocabularies, one with byte fallback
and a byte-level one for many languages, then measure each text: characters per token,
the share of tokens of a single byte, and the entropy of its tokens over the most that
so many tokens could have.  For each script, histograms over all documents that pass the
plain rules give a band around the median of each measure, as wide as its tails ask for,
and the documents outside one are rejected.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterable
from functools import lru_cache, reduce
from operator import and_

import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import TextCodec, Vocabulary, read_ranks
from .common import stored, vector_udf

SEPARATORS = "\t\n\x0b\x0c\r "  # words are runs of other code points; `bytes.split` cuts at just these
SYMBOLS = "#*$%&|<>"

#: The vocabulary with byte fallback, then (``_multi``) the byte-level one.
PLAIN_MEASURES = ("chars_per_token", "byte_share", "entropy")
MEASURES = (*PLAIN_MEASURES, *(f"{m}_multi" for m in PLAIN_MEASURES))
#: A band reaches from the script's median `REACH` times as far as the quantiles `TAIL` and
#: 1 - `TAIL`, but `LEAST` at least (for characters per token: that part of the median).
TAIL, REACH = 0.1, 4.0
LEAST = {"chars_per_token": 0.25, "byte_share": 0.1, "entropy": 0.1}
#: Rejected in any case: under a part of the script's median, over a multiple of it, or (for
#: the byte share) this much above it.
BANDS = {"chars_per_token": (0.4, 2.5), "byte_share": 0.25, "entropy": 0.5}
BIN = 1 / 200  # width of the histograms' bins; the quantiles are exact to one bin
LONG = 4_096  # words of more characters go through the prefix encoder, whose time grows with their length only

#: First and last letters of each script's blocks.
SCRIPTS = {
    "latin": ("az", "AZ", "Àɏ"), "greek": ("Ͱ\u03ff",), "cyrillic": ("Ѐӿ",), "hebrew": ("\u0590\u05ff",),
    "arabic": ("\u0600ۿ",), "indic": ("\u0900\u0dff",), "thai": ("\u0e00\u0e7f",), "kana": ("\u3040ヿ",),
    "han": ("㐀\u9fff",), "hangul": ("가\ud7af",),
}
SYMBOL, SEPARATOR = len(SCRIPTS) + 1, len(SCRIPTS) + 2
#: Of each code point: 0, or the place of its script counted from 1, or SYMBOL, or SEPARATOR.
KIND = np.zeros(0x110000, np.uint8)
for _place, _blocks in enumerate(SCRIPTS.values(), 1):
    for _first, _last in _blocks:
        KIND[ord(_first):ord(_last) + 1] = _place
KIND[[ord(x) for x in SYMBOLS]] = SYMBOL
KIND[[ord(x) for x in SEPARATORS]] = SEPARATOR


def repeated_words(ids: np.ndarray, width: int = 5) -> int:
    """Words in windows of ``width`` words that occur twice or more; ``ids`` number the words.

    Windows with a hash of their own are unique; the others are compared exactly."""
    n = len(ids) - width + 1
    if n < 2:
        return 0
    ids = ids.astype(np.int64)
    hashed = ids[:n].copy()
    for k in range(1, width):
        hashed *= np.int64(6364136223846793005)
        hashed += ids[k:k + n]
    ordered = np.sort(hashed)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(hashed, twice))
    window = ids[at]
    for k in range(1, width):  # each pair (window so far, next word) gets a number of its own
        step = np.unique(ids[at + k], return_inverse=True)[1]
        window = np.unique(window, return_inverse=True)[1] * np.int64(len(at) + 1) + step
    window = np.unique(window, return_inverse=True)[1]
    at = at[np.bincount(window)[window] > 1]
    edge = np.zeros(len(ids) + 1, np.int64)
    edge[at] += 1  # no place occurs twice in ``at``
    edge[at + width] -= 1
    return int((np.cumsum(edge)[:-1] > 0).sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(SEPARATORS)]
    return len(lines) - len(set(lines))


class Numbers(dict):
    """Numbers words in the order they are first asked for; ``new`` holds those not encoded yet."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self)
        self.new.append(word)
        return at


class Tokens:
    """A vocabulary's tokens of numbered words, kept end to end in one array.  ``encode``
    gives the tokens of each word of a list; ``of_byte`` tells the tokens of a single byte."""

    def __init__(self, encode: Callable[[list[bytes]], Iterable[list[int]]], of_byte: np.ndarray):
        self.encode, self.of_byte, self.size = encode, of_byte, len(of_byte)
        self.forget()

    def forget(self) -> None:
        self.tokens, self.ends = array("i"), array("q", [0])

    def learn(self, words: list[bytes]) -> None:
        end = len(self.tokens)
        for ids in self.encode(words):
            self.tokens.extend(ids)
            end += len(ids)
            self.ends.append(end)

    def measures(self, words: np.ndarray, times: np.ndarray, chars: int) -> tuple:
        """The number of tokens and `PLAIN_MEASURES` of a text that has each of ``words`` so many times."""
        ends = np.frombuffer(self.ends, np.int64)
        start, size = ends[words], ends[words + 1] - ends[words]
        before = np.cumsum(size) - size
        at = np.repeat(start - before, size) + np.arange(size.sum())
        per_token = np.bincount(np.frombuffer(self.tokens, np.intc)[at], np.repeat(times, size), self.size)
        n_tokens = int(per_token.sum())
        p = per_token[per_token > 0] / n_tokens
        most = np.log(min(n_tokens, self.size)) if n_tokens > 1 else 1.0
        return (n_tokens, chars / n_tokens, float(per_token[self.of_byte].sum() / n_tokens),
                float(-(p * np.log(p)).sum() / most) if n_tokens > 1 else 0.0)


def fallback_tokens(model: bytes) -> Tokens:
    own = sentencepiece.SentencePieceProcessor(model_proto=model)
    return Tokens(lambda words: own.encode(words, num_threads=1), np.array([own.is_byte(i) for i in range(own.vocab_size())]))


def byte_level_tokens(ranks: dict[bytes, int] | str) -> Tokens:
    """Each word as after a space, by ranks or a file of them.  Both encoders give the same
    tokens for any word."""
    ranks = read_ranks(ranks) if isinstance(ranks, str) else ranks
    of_byte = np.zeros(max(ranks.values()) + 1, bool)
    of_byte[[rank for token, rank in ranks.items() if len(token) == 1]] = True
    encode = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    @lru_cache(1)
    def for_long_words() -> TextCodec:
        return TextCodec(Vocabulary(ranks), public_tokenizers.PATTERN)

    def one(word: bytes) -> list[int]:
        text = f" {word.decode()}"
        return encode(text) if len(text) <= LONG else for_long_words().encode(text)

    return Tokens(lambda words: map(one, words), of_byte)


class Measure:
    """Measures texts.  The tokens of words seen before are kept; at ``max_words`` words
    they are forgotten.  Only speed depends on that, no result."""

    def __init__(self, model: bytes, ranks: dict[bytes, int], max_words: int = 1_000_000):
        self.vocabularies = (fallback_tokens(model), byte_level_tokens(ranks))
        self.max_words = max_words
        self.number = Numbers()

    def _forget(self) -> None:
        self.number = Numbers()
        for v in self.vocabularies:
            v.forget()

    def _learn(self) -> None:
        for v in self.vocabularies:
            v.learn(self.number.new)
        self.number.new = []

    def row(self, text: str) -> tuple:
        words = text.encode().split()
        kinds = np.bincount(KIND[np.frombuffer(text.encode("utf-32-le"), np.uint32)], minlength=SEPARATOR + 1)
        n, symbols, lines = len(words), int(kinds[SYMBOL]), duplicate_lines(text)
        if not n:
            return (0, 0, symbols, lines, 0, "none", 0, *[0.0] * len(MEASURES))
        if len(self.number) >= self.max_words:
            self._forget()
        ids = np.fromiter(map(self.number.__getitem__, words), np.int64, n)
        if self.number.new:
            self._learn()
        letters = kinds[1:SYMBOL]
        script = [*SCRIPTS][int(letters.argmax())] if letters.any() else "none"
        chars = len(text) - int(kinds[SEPARATOR])
        distinct, times = np.unique(ids, return_counts=True)
        (n_tokens, *plain), (_, *multi) = (v.measures(distinct, times, chars) for v in self.vocabularies)
        return (n, chars, symbols, lines, repeated_words(ids), script, n_tokens, *plain, *multi)


SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "script string, n_tokens long, " + ", ".join(f"{m} double" for m in MEASURES))


@lru_cache(maxsize=2)
def _measure(shared) -> Measure:
    return Measure(*shared.value)


def vocabularies(path: str | None = None) -> tuple[bytes, dict[bytes, int]]:
    """The two public vocabularies, files of fixed size, as read on the driver."""
    with open(path or public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        model = file.read()
    return model, read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def measured(text: Column, path: str | None = None) -> Column:
    """A struct of `SCHEMA` for each text; null and empty texts have zeros and script 'none'.
    The vocabularies are broadcast; texts and words of any length are read whole."""
    shared = SparkSession.active().sparkContext.broadcast(vocabularies(path))

    @vector_udf(SCHEMA)
    def run(texts: pd.Series) -> pd.DataFrame:
        row = _measure(shared).row
        return pd.DataFrame([row(t or "") for t in texts], columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return run(text)


def bands(rows: DataFrame) -> DataFrame:
    """script and the ends of each measure's band, ``<measure>_low`` and ``<measure>_high``.

    The quantiles are exact to one bin of width `BIN`.  Counts per bin are summed before
    any sort, so a script with most rows is no hot group: its histogram has as many rows
    as bins."""
    bins = rows.select("script", F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.floor(F.col(m) / BIN).alias("bin")) for m in MEASURES])).alias("x")
    ).groupBy("script", "x.measure", "x.bin").count()
    w = Window.partitionBy("script", "measure")
    bins = bins.withColumns({"below": F.sum("count").over(w.orderBy("bin")), "total": F.sum("count").over(w)})
    quantile = lambda q: F.min(F.when(F.col("below") >= q * F.col("total"), F.col("bin"))) * BIN + BIN / 2
    ends = bins.groupBy("script", "measure").agg(quantile(TAIL).alias("q_low"), quantile(0.5).alias("median"), quantile(1 - TAIL).alias("q_high"))
    base, median = F.regexp_replace("measure", "_multi$", ""), F.col("median")
    of = lambda **values: F.coalesce(*[F.when(base == m, v) for m, v in values.items()])
    least = of(**{m: v * median if m == "chars_per_token" else F.lit(v) for m, v in LEAST.items()})
    low, high = BANDS["chars_per_token"]
    outer_low = of(chars_per_token=low * median, byte_share=F.lit(0.0), entropy=BANDS["entropy"] * median)
    outer_high = of(chars_per_token=high * median, byte_share=median + BANDS["byte_share"], entropy=F.lit(1.0 + BIN))
    ends = ends.select("script", "measure",
                       F.greatest(outer_low, median - F.greatest(REACH * (median - F.col("q_low")), least)).alias("low"),
                       F.least(outer_high, median + F.greatest(REACH * (F.col("q_high") - median), least)).alias("high"))
    return ends.groupBy("script").pivot("measure", list(MEASURES)).agg(F.first("low").alias("low"), F.first("high").alias("high"))


def quality_rules(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, the measures, base_failed and kept of each document.

    Null and empty texts have no words and fail the plain rules.  A script without
    any document that passes them has no band, and none of its documents is kept
    anyway.  Repeated rows are judged alike, and a measure on the end of its band fits;
    an empty table gives none."""
    rows = docs.select("doc_id", measured(F.col("text"), path).alias("m")).select("doc_id", "m.*")
    rows = rows.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    rows = stored(rows, "fertility")
    # one row per script: SCRIPTS and 'none' bound it
    band = bands(rows.where("not base_failed"))
    fits = reduce(and_, [F.col(m).between(F.col(f"{m}_low"), F.col(f"{m}_high")) for m in MEASURES])
    joined = rows.join(F.broadcast(band), "script", "left")
    return joined.withColumn("kept", ~F.col("base_failed") & F.coalesce(fits, F.lit(False)))


def op10(docs: DataFrame) -> DataFrame:
    return quality_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "script", *MEASURES)
