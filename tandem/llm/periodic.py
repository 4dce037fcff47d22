"""Runs of repeated words: stretches with a period, found from maximal pairs.

A suffix array of a text's words and the lengths that neighbours in it share give the
LCP-interval tree.  It is walked from its leaves up.  Every node keeps the positions
where its word string occurs, in order, and each position's class is the word to its left.
Where children of a node of depth l meet, two positions of different children and classes
are a maximal pair: the string cannot be made longer on either side.  If their distance d
is small enough against l, the words from the first position to the end of the second
occurrence are a run with period d, whole as it stands.

Between two neighbouring occurrences a period and its run lie no further ones, or the
period would not be the smallest.  So only positions next to each other in a node's list
are looked at, and lists are merged smaller into larger: n log n in all, whatever the
number of pairs.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import vector_udf

LEAST_WORDS, LEAST_EXPONENT = 24, 3
GROUP = 1 << 20  # words looked through together for repeated word strings

Run = tuple[int, int, int]  # start, length, period


def least_common(least: int, exponent: int) -> int:
    """The fewest words that the two occurrences of a pair share: with the distance d,
    d + l >= least and d + l >= exponent * d."""
    return min(max(least - d, (exponent - 1) * d) for d in range(1, least + 1))


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """The starts of the suffixes in order, by doubling the compared length."""
    n, step = len(symbols), 1
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64) + 1  # 0 stands past the end
    while True:
        key = rank * (n + 2)
        key[:-step] += rank[step:]
        order = np.argsort(key, kind="stable")
        key = key[order]
        fresh = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]]))
        if fresh[-1] == n:
            return order
        rank[order] = fresh
        step *= 2


def common_lengths(symbols: list[int], order: np.ndarray) -> list[int]:
    """How many words each suffix in ``order`` shares with the one before it."""
    n = len(symbols)
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    before = np.empty(n, np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    found, k = [0] * n, 0
    for i, (r, j) in enumerate(zip(rank.tolist(), before.tolist())):
        if j < 0:
            k = 0
            continue
        most = n - max(i, j)
        while k < most and symbols[i + k] == symbols[j + k]:
            k += 1
        found[r] = k
        if k:
            k -= 1
    return found


def maximal_pairs(symbols: list[int], least: int, exponent: int) -> Iterator[tuple[int, int, int]]:
    """(i, j, l): neighbouring occurrences i < j of a string of l words that differ in the
    words to their left and to their right, near enough for a run."""
    fewest = least_common(least, exponent)
    order = suffix_array(np.array(symbols, np.int64))
    common = common_lengths(symbols, order)
    left = [-1, *symbols]  # the class of position i is left[i]
    nodes: list[tuple[int, list[int]]] = []  # open nodes of the tree: depth, positions in order

    def meets(depth: int, a: list[int], b: list[int]) -> Iterator[tuple[int, int, int]]:
        """Pairs of the children's position lists; the smaller goes into the larger."""
        few, many = (a, b) if len(a) <= len(b) else (b, a)
        for p in few:
            k = bisect_left(many, p)
            for q in many[max(0, k - 1):k + 1]:
                i, j = (p, q) if p < q else (q, p)
                d = j - i
                if (exponent - 1) * d <= depth and d + depth >= least and left[i] != left[j]:
                    yield i, j, depth
        if len(few) < 8:
            for p in few:
                insort(many, p)
        else:
            many.extend(few)
            many.sort()  # two ordered parts: a merge
        merged[0] = many

    merged: list[list[int]] = [[]]
    own = [int(order[0])]
    for start, depth in zip(chain(order[1:].tolist(), [-1]), chain(islice(common, 1, None), [0])):
        while nodes and nodes[-1][0] > depth:
            d, positions = nodes.pop()
            yield from meets(d, positions, own)
            own = merged[0]
        if depth >= fewest:
            if nodes and nodes[-1][0] == depth:
                yield from meets(depth, nodes.pop()[1], own)
                own = merged[0]
            nodes.append((depth, own))
        own = [start]


def runs_of(words: list, least: int = LEAST_WORDS, exponent: int = LEAST_EXPONENT) -> list[Run]:
    """All runs of at least ``least`` words and ``exponent`` (2 or more) periods, by start
    and period.  A stretch that has several periods counts with the smallest."""
    if len(words) < least:
        return []
    number: dict = {}
    symbols = [number.setdefault(w, len(number)) for w in words]
    smallest: dict[tuple[int, int], int] = {}
    for i, j, depth in maximal_pairs(symbols, least, exponent):
        stretch = i, j + depth - i
        smallest[stretch] = min(j - i, smallest.get(stretch, j - i))
    return sorted(((start, length, period) for (start, length), period in smallest.items()), key=lambda r: (r[0], r[2]))


def with_repeats(texts: list[list[bytes]], size: int) -> np.ndarray:
    """Which texts may hold the same ``size`` words twice: all that do, by equal hashes."""
    lengths = np.array([len(t) for t in texts])
    text = np.repeat(np.arange(len(texts)), lengths)
    found = np.zeros(len(texts), bool)
    n = len(text) - size + 1
    if n < 2:
        return found
    with np.errstate(over="ignore"):
        h = np.fromiter(map(hash, chain.from_iterable(texts)), np.int64, len(text)).view(np.uint64)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        total, width, done = np.zeros(len(text), np.uint64), 1, 0
        base = np.uint64(0x9E3779B97F4A7C15)
        power, part = base, h  # part: hashes of `width` words
        while done < size:  # size by its binary digits
            if size & width:
                moved = np.zeros(len(text), np.uint64)
                moved[:len(text) - done] = part[done:]
                total = total * power + moved
                done += width
            ahead = np.zeros(len(text), np.uint64)
            ahead[:-width] = part[width:]
            part, power, width = part * power + ahead, power * power, width * 2
        total = total[:n] ^ (text[:n].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    inside = text[:n] == text[size - 1:]
    total, text = total[inside], text[:n][inside]
    seen = np.sort(total)
    twice = np.unique(seen[1:][seen[1:] == seen[:-1]])
    if len(twice):
        at = np.minimum(np.searchsorted(twice, total), len(twice) - 1)
        found[text[twice[at] == total]] = True
    return found


def runs_of_all(texts: list[list[bytes]], least: int = LEAST_WORDS, exponent: int = LEAST_EXPONENT) -> list[list[Run]]:
    """`runs_of` each text.  The tree is built only for texts in which some string as long
    as any pair's occurs twice."""
    out: list[list[Run]] = [[] for _ in texts]
    group, size = [], 0
    for i, words in enumerate(texts):
        group.append(i)
        size += len(words)
        if size >= GROUP or i == len(texts) - 1:
            for k in np.flatnonzero(with_repeats([texts[g] for g in group], least_common(least, exponent))):
                out[group[k]] = runs_of(texts[group[k]], least, exponent)
            group, size = [], 0
    return out


def collapsed(words: list, runs: list[Run]) -> list:
    """The words that stay: of every run only its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def words_of(text: str | None) -> list[bytes]:
    """The words between ASCII spaces (20, 09 to 0D), as UTF-8."""
    return (text or "").encode().split()


def periodic(text: Column, least: int = LEAST_WORDS, exponent: int = LEAST_EXPONENT) -> Column:
    """runs (an array of start, length, period) and collapsed (the text with one period of
    each run, words joined by one space) of each text.

    Null and empty texts have no runs and collapse to an empty text.  Rows are independent
    of each other, so ties, repeated rows and other columns do not matter.  Memory grows
    with the longest text of a batch, some 100 bytes a word while it is looked at."""
    @vector_udf("runs array<struct<start: long, length: long, period: long>>, collapsed string")
    def run(texts: pd.Series) -> pd.DataFrame:
        words = [words_of(t) for t in texts]
        found = runs_of_all(words, least, exponent)
        return pd.DataFrame({
            "runs": [[dict(zip(("start", "length", "period"), r)) for r in rs] for rs in found],
            "collapsed": [b" ".join(collapsed(w, rs)).decode() for w, rs in zip(words, found)]})

    return run(text)


def damaged(words: list, doc_id: str | None) -> list:
    """The contract's trial text: in a tenth of the ids the words from some place on become
    repetitions.  Without an id nothing changes."""
    h = 1 if doc_id is None else zlib.crc32(doc_id.encode())
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    again = words[a:a + period] * -(-(n - a) // period)
    return words[:a] + again[:n - a]


def strongest(runs: list[Run]) -> Run | None:
    """The run with the greatest length/period, by exact comparison; then start, period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:  # runs come by start and period
            best = run
    return best


def op12(docs: DataFrame) -> DataFrame:
    """The runs of each document's damaged words and digests of them.

    Null and empty texts have no words: n_runs 0, four nulls, digests of the empty string.
    Repeated rows are answered each; a null doc_id leaves the text as it is.  An empty
    table gives none; other columns are not read."""
    kind = ("n_runs long, start long, length long, period long, exponent_milli long, "
            "runs_sha256 string, collapsed_sha256 string")

    @vector_udf(kind)
    def run(ids: pd.Series, texts: pd.Series) -> pd.DataFrame:
        words = [damaged(words_of(t), i) for i, t in zip(ids, texts)]
        rows = []
        for own, found in zip(words, runs_of_all(words)):
            best = strongest(found)
            listed = "".join(f"{s},{length},{p}\n" for s, length, p in found)
            rows.append((len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                         hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(collapsed(own, found))).hexdigest()))
        frame = pd.DataFrame(rows, columns=[c.split()[0] for c in kind.split(", ")])
        return frame.astype({c: "Int64" for c in ("start", "length", "period", "exponent_milli")})

    return docs.select("doc_id", run(F.col("doc_id").cast("string"), "text").alias("got")).select("doc_id", "got.*")
