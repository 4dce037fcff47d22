"""Improbable-feature digests of documents.

Windows of 64 bytes are ranked by how rare their entropy is in the corpus.  A window
that is the rarest of its neighbourhood often enough is a feature.  Features go, in
the order of the text, into chained Bloom filters; two digests are compared by the
overlap of their filters beyond what chance gives.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, vector_udf

WINDOW, NEIGHBOURS, POPULAR = 64, 64, 16
ENTROPY_BINS = 1000
LEAST_BIN = 100  # windows of less entropy (runs of one byte) are no features
FILTER_BITS, PER_FILTER, HASHES = 2048, 160, 5
BLOCK = 1 << 17  # windows handled at a time: bounds memory for texts of any length
GROUP = 1 << 20  # bytes of short texts handled together

_F = np.array([0] + [round(c * np.log2(c) * (1 << 20)) for c in range(1, WINDOW + 1)], np.int64)
_G = (_F[1:] - _F[:-1])[:WINDOW].astype(np.int32)
_MULTIPLIERS = np.random.default_rng(20).integers(1, 1 << 63, WINDOW, dtype=np.int64).astype(np.uint64) | np.uint64(1)


def entropy_bins(data: np.ndarray) -> np.ndarray:
    """The entropy of each window of ``data`` (bytes), in 0..ENTROPY_BINS.

    Moving on by a byte changes the sum of c*log2(c) only for the byte that leaves and
    the one that comes; how often each stands in the window is counted by comparing the
    data with itself at 63 distances.  Integers only, so the same window always has the
    same bin."""
    n = len(data) - WINDOW + 1
    if n < 1:
        return np.zeros(0, np.int16)
    after, before = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)
    for k in range(1, WINDOW):
        same = (data[k:] == data[:-k]).view(np.uint8)
        after[:-k] += same
        before[k:] += same
    first = _F[np.bincount(data[:WINDOW], minlength=256)].sum()
    sums = np.empty(n, np.int64)
    sums[0] = first
    if n > 1:
        np.cumsum(_G[before[WINDOW:]] - _G[after[:n - 1]], out=sums[1:], dtype=np.int64)
        sums[1:] += first
    most = 6 * (WINDOW << 20)  # log2(64) bits
    return ((most - sums) * ENTROPY_BINS // most).astype(np.int16)


def _joined(texts: list[bytes]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Texts put together to groups of about GROUP bytes: their numbers, data and offsets."""
    some, size = [], 0
    for i, t in enumerate(texts):
        some.append(i)
        size += len(t)
        if size >= GROUP or i == len(texts) - 1:
            data = np.frombuffer(b"".join(texts[k] for k in some), np.uint8)
            yield some, data, np.cumsum([0] + [len(texts[k]) for k in some])
            some, size = [], 0


def _inside(offsets: np.ndarray, a: int, b: int) -> np.ndarray:
    """Which windows that begin at a..b-1 lie within one text."""
    starts = np.arange(a, b)
    text = np.searchsorted(offsets, starts, side="right")
    return starts + WINDOW <= offsets[np.minimum(text, len(offsets) - 1)]


def histogram(texts: list[bytes]) -> np.ndarray:
    """How many windows of the texts have each entropy."""
    total = np.zeros(ENTROPY_BINS + 1, np.int64)
    for _, data, offsets in _joined(texts):
        for a in range(0, len(data) - WINDOW + 1, BLOCK):
            b = min(len(data) - WINDOW + 1, a + BLOCK)
            bins = entropy_bins(data[a:b + WINDOW - 1])
            total += np.bincount(bins[_inside(offsets, a, b)], minlength=ENTROPY_BINS + 1)
    return total


def window_counts(docs: DataFrame) -> np.ndarray:
    """How many windows of all documents have each entropy."""
    @vector_udf("array<long>")
    def run(texts: pd.Series) -> pd.Series:
        total = histogram([t.encode() for t in texts if t])
        return pd.Series([total.tolist(), *[[]] * (len(texts) - 1)])

    counts = (docs.select(F.posexplode(run("text")).alias("bin", "n")).where("n > 0")
              .groupBy("bin").agg(F.sum("n").alias("n")).collect())  # at most 1001 rows
    total = np.zeros(ENTROPY_BINS + 1, np.int64)
    for row in counts:
        total[row.bin] = row.n
    return total


def ranked(counts: np.ndarray) -> np.ndarray:
    """The rank of each entropy, rarest first; entropies that never occur, and those under
    LEAST_BIN, come last."""
    seen = sorted((int(counts[b]), b) for b in range(LEAST_BIN, len(counts)) if counts[b])
    rank = np.full(ENTROPY_BINS + 1, ENTROPY_BINS + 1, np.int64)
    for k, (_, b) in enumerate(seen):
        rank[b] = k
    return rank


def rarity(docs: DataFrame) -> np.ndarray:
    """The rank of each entropy by counts over all windows of all documents."""
    return ranked(window_counts(docs))


def _hash(rows: np.ndarray) -> np.ndarray:
    h = np.zeros(len(rows), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(WINDOW):
            h += (rows[:, k].astype(np.uint64) + np.uint64(1)) * _MULTIPLIERS[k]
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(29)
    return h


def features(texts: list[bytes], rank: np.ndarray) -> list[np.ndarray]:
    """The distinct feature hashes of each text, in the order of the text.

    A text shorter than a window, or without any allowed one, has one feature: itself."""
    out: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(texts)
    never = np.int64(ENTROPY_BINS + 1)
    for some, data, offsets in _joined(texts):
        n = len(data) - WINDOW + 1
        votes = np.zeros(max(n, 0) + NEIGHBOURS, np.uint8)
        allowed = np.zeros(max(n, 0), bool)
        for a in range(0, n, BLOCK):
            b = min(n, a + BLOCK)
            end = min(n, b + NEIGHBOURS - 1)  # neighbourhoods that begin before b reach so far
            inside = _inside(offsets, a, end)
            key = np.where(inside, rank[entropy_bins(data[a:end + WINDOW - 1])], never)
            allowed[a:end] = key < never
            low = np.concatenate([(key << 20) | np.arange(len(key)), np.full(NEIGHBOURS, never << 20)])
            for step in (1, 2, 4, 8, 16, 32):  # the smallest of 64 in a row, by doubling
                low = np.minimum(low[:-step], low[step:])
            best = low[:b - a][inside[:b - a]]
            best = best[best < never << 20] & ((1 << 20) - 1)
            votes[a:a + len(key)] += np.bincount(best, minlength=len(key))[:len(key)].astype(np.uint8)
        sizes = np.diff(offsets)
        need = np.minimum(POPULAR, np.maximum(1, sizes - WINDOW + 1))
        at = np.flatnonzero(allowed & (votes[:max(n, 0)] > 0))
        text = np.searchsorted(offsets, at, side="right") - 1
        at, text = (x[votes[at] >= need[text]] for x in (at, text))
        hashes = np.concatenate([_hash(data[at[k:k + 8192, None] + np.arange(WINDOW)]) for k in range(0, len(at), 8192)]) \
            if len(at) else np.zeros(0, np.uint64)
        cuts = np.searchsorted(text, np.arange(len(some) + 1))
        for k, i in enumerate(some):
            own = hashes[cuts[k]:cuts[k + 1]]
            if len(own):
                out[i] = own[np.sort(np.unique(own, return_index=True)[1])]
            elif texts[i]:
                out[i] = np.frombuffer(hashlib.sha256(texts[i]).digest()[:8], np.uint64)
    return out


def bloom(hashes: np.ndarray) -> np.ndarray:
    """Chained filters, one row of bytes each, of PER_FILTER features but for the last."""
    n = -(-len(hashes) // PER_FILTER)
    bits = np.zeros((n, FILTER_BITS), np.uint8)
    row = np.arange(len(hashes)) // PER_FILTER
    for k in range(HASHES):
        bits[row, (hashes >> np.uint64(11 * k)) & np.uint64(FILTER_BITS - 1)] = 1
    return np.packbits(bits, axis=1)


def to_text(filters: np.ndarray) -> str:
    return base64.b64encode(filters.tobytes()).decode()


def from_text(digest: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(digest), np.uint8).reshape(-1, FILTER_BITS // 8)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: for each filter of the shorter digest its best match in the other, as the part
    of the overlap beyond chance, on average.  Equal digests (two empty ones too) have 1; an
    empty and another one 0."""
    if a.shape == b.shape and np.array_equal(a, b):
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    ones = np.bitwise_count(b).sum(axis=1, dtype=np.int64)
    total = 0.0
    for row in a:
        own = int(np.bitwise_count(row).sum())
        common = np.bitwise_count(row & b).sum(axis=1, dtype=np.int64)
        most = np.minimum(own, ones)
        chance = own * ones / FILTER_BITS
        floor = chance + 0.15 * (most - chance)
        total += float(np.clip((common - floor) / np.maximum(most - floor, 1e-9), 0, 1).max())
    return total / len(a)


def digest_texts(texts: list[str], rank: np.ndarray) -> list[np.ndarray]:
    return [bloom(h) for h in features([t.encode() for t in texts], rank)]


def _order_keys(absent: pd.Series, down: pd.Series, tie: pd.Series) -> np.ndarray:
    """The order of the documents (ids descending, null last, then the hash of the text) as
    byte strings that compare alike."""
    out = np.empty((len(absent), 3), ">u8")
    out[:, 0] = absent.to_numpy(bool)
    for k, x in enumerate((down, tie), 1):
        out[:, k] = x.to_numpy(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return out.view("S24").ravel()


def _keyed(docs: DataFrame) -> DataFrame:
    ids, text = F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))
    return docs.select(text.alias("text"), ids.isNull().alias("absent"),
                       F.coalesce(F.bitwise_not(ids), F.lit(0).cast("long")).alias("down"), F.xxhash64(text).alias("tie"))


def split_points(docs: DataFrame, total: int, n_buckets: int = 512, bucket_bytes: int = 1 << 28) -> np.ndarray:
    """The keys that begin a bucket, the least key of all first.

    Buckets are of about ``total`` bytes over ``n_buckets``, and of ``bucket_bytes`` at most.
    A row is looked at with a chance of its length over an eighth of that, so the
    driver holds about eight keys of 24 bytes a bucket whatever the corpus, 75 MB for
    100 TB.  The draw moves the borders only, never a result."""
    keyed = _keyed(docs).select("absent", "down", "tie", F.length("text").alias("size"))
    least = keyed.agg(F.min(F.struct("absent", "down", "tie")).alias("k")).first().k
    if least is None:
        return np.zeros(0, "S24")
    step = max(1.0, min(total / n_buckets, bucket_bytes) / 8)
    drawn = keyed.where(F.rand(5) < (F.col("size") + WINDOW) / F.lit(step)).select("absent", "down", "tie").toPandas()
    first = pd.DataFrame([tuple(least)], columns=["absent", "down", "tie"])
    borders = np.sort(_order_keys(drawn["absent"], drawn["down"], drawn["tie"]))[8::8]
    return np.unique(np.concatenate([_order_keys(first["absent"], first["down"], first["tie"]), borders]))


def with_next(docs: DataFrame, splits: np.ndarray) -> DataFrame:
    """``docs`` dealt into buckets of neighbours, plus for each bucket a copy of the row that
    follows its last one (is_next true): bucket, is_next, absent, down, tie, text, where
    down is the id with all bits turned.

    Each split point is the key of a row, so the first row of every bucket is known without
    a look at the others; its copy goes to the bucket before.  Rows of one id, or of none,
    are split by the hash of their texts; only equal texts of one id stay together."""
    shared = docs.sparkSession.sparkContext.broadcast(splits)

    @vector_udf("array<int>")
    def places(absent: pd.Series, down: pd.Series, tie: pd.Series) -> pd.Series:
        starts, keys = shared.value, _order_keys(absent, down, tie)
        at = np.searchsorted(starts, keys, side="right") - 1
        return pd.Series([[b, (b - 1) % len(starts)] if first else [b] for b, first in zip(at.tolist(), starts[at] == keys)])

    placed = _keyed(docs).select("*", F.posexplode(places("absent", "down", "tie")).alias("copy", "bucket"))
    return placed.select("bucket", (F.col("copy") == 1).alias("is_next"), "absent", "down", "tie", "text")


OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double")


def op5(docs: DataFrame, n_buckets: int = 512, bucket_bytes: int = 1 << 28) -> DataFrame:
    """The digest of each document and of its edited text, and their likeness.

    Null texts count as empty; empty texts have an empty digest.  Rows with equal ids, or
    with none, follow each other by a hash of their texts; a single document is its own
    next.  Equal rows are answered each.  Texts of any length are read whole, other
    columns are not read, and an empty table gives none."""
    spark = docs.sparkSession
    ship(spark)
    counts = window_counts(docs)
    shared = spark.sparkContext.broadcast(ranked(counts))
    splits = split_points(docs, int(counts.sum()), n_buckets, bucket_bytes)
    rows = (with_next(docs, splits).repartition("bucket")
            .sortWithinPartitions("bucket", "is_next", "absent", "down", "tie", "text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rank, open_ = shared.value, None  # open_: the row that waits for the one after it

        def digests(texts: list[str]) -> list[np.ndarray]:
            """Each distinct text once."""
            found = list(dict.fromkeys(texts))
            made = dict(zip(found, digest_texts(found, rank)))
            return [made[t] for t in texts]

        def made(group: list[tuple]) -> pd.DataFrame:
            """group: (bucket, doc_id, text, is_next) rows; all but the last are answered."""
            pairs = [(x, y) for x, y in zip(group, group[1:]) if not x[3]]
            edited = [x[2][:len(x[2]) - len(x[2]) // 2] + y[2][:len(x[2]) // 2] for x, y in pairs]
            own, other = digests([r[2] for r in group]), digests(edited)
            out, k = [], 0
            for i, x in enumerate(group[:-1]):
                if x[3]:
                    continue
                out.append((x[1], len(x[2]), hashlib.sha256(edited[k].encode()).hexdigest(), to_text(own[i]), to_text(other[k]),
                            likeness(own[i], other[k]), likeness(own[i], own[i + 1])))
                k += 1
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in OUT.split(", ")])
            frame["doc_id"] = pd.array([r[0] for r in out], dtype="Int64")
            return frame.astype({c: object for c in ("edited_sha256", "fingerprint", "edited_fingerprint")})

        for batch in batches:
            ids = [None if absent else ~down for absent, down in zip(batch["absent"], batch["down"].tolist())]
            group, size = [open_] if open_ else [], 0
            for row in zip(batch["bucket"], ids, batch["text"], batch["is_next"]):
                group.append(row)
                size += len(row[2])
                if size > 4 * GROUP:
                    answered = made(group)
                    if len(answered):
                        yield answered
                    group, size = group[-1:], 0
            answered = made(group)
            if len(answered):
                yield answered
            open_ = group[-1]
        # the last row of a partition is always a bucket's next one: nothing waits

    return rows.select("bucket", "absent", "down", "text", "is_next").mapInPandas(run, OUT)
