"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Every distinct fingerprint emits all 64-bit values within half the radius of it.
Two fingerprints within the radius share such a value; two that share one are
within the radius.  Fingerprints are deduplicated before they emit, so a value
never has more of them than its own small ball has points, however many
documents are copies.  Links go to the smallest fingerprint at a value, not to
all, and connected components join them.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, vector_udf, whole


def fingerprint(text: str | None, shingle: int, seed: int = 42) -> int:
    """The 64-bit SimHash of a text's word shingles, as a signed integer."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and the six ASCII spaces only
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return int(np.array([digest(joined, seed)], np.uint64).view(np.int64)[0])
    starts, at = [], 0
    for w in words:
        starts.append(at)
        at += len(w) + 1
    ends = [s - 1 for s in starts[shingle:]] + [at - 1]
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends)], np.uint64)
    n, ones = len(hashes), np.zeros(64, np.int64)
    for k in range(0, n, 65_536):
        bits = np.unpackbits(hashes[k:k + 65_536].view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def simhash(text: Column, shingle: int) -> Column:
    @vector_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return run(text)


def _masks(radius: int) -> list[int]:
    """All 64-bit values with at most ``radius`` ones, signed."""
    sums = [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(64), r)]
    return [s - (1 << 64) if s >= 1 << 63 else s for s in sums]


def links(fps: DataFrame, max_bits: int) -> DataFrame:
    """(a, b), a > b: links that connect exactly the distinct fingerprints ``fp``
    that chains of steps of at most ``max_bits`` bits connect.

    With an odd radius the two half radii differ by one; a value links only where a
    fingerprint lies within the smaller one."""
    if not 0 <= max_bits <= 4:
        raise ValueError("max_bits must be 0 to 4: the balls grow with its half's power")
    near, far = max_bits // 2, (max_bits + 1) // 2
    masks = F.array([F.lit(m) for m in _masks(far)])
    n_near = len(_masks(near))
    balls = (fps.select("fp", F.posexplode(masks).alias("k", "mask"))
             .select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("value"), (F.col("k") < n_near).alias("near")))
    anchor = F.min(F.when(F.col("near"), F.col("fp"))).over(Window.partitionBy("value"))
    return (balls.withColumn("b", anchor).where("b != fp")
            .select(F.greatest("fp", "b").alias("a"), F.least("fp", "b").alias("b")).distinct()
            .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))


def components(edges: DataFrame, tag: str) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a > b) reaches.

    Alternates large-star and small-star steps until no link changes; each round is
    a written table.  Minima are partial aggregations and the joins can be split, so
    one huge component does not land in one task."""
    edges, state = stored(edges, tag), None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.where("b > a").join(low, "a").where("b != m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.explode(F.array(
            F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.*").where("a != b").distinct())
        edges = stored(small, tag)
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(found) == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = tuple(found)


def grouped(ids: DataFrame, max_bits: int) -> DataFrame:
    """``ids`` (doc_id, fp) with component_id, the smallest doc_id reachable.

    Null doc_ids link like others but are never the smallest; a group of nulls only
    has component_id null.  Repeated rows stay repeated; an empty table gives none."""
    per_fp = stored(ids.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fp")
    roots = components(links(per_fp, max_bits), "links")
    named = per_fp.join(roots, per_fp.fp == roots.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    named = stored(named, "roots")
    first = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = named.join(first, "root").select("fp", "root", "component_id")
    return ids.join(by_fp, "fp", "left")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """doc_id, fp and component_id of each row of ``docs``.

    Null and empty texts, and texts without words, have fingerprint zero and link
    like any other.  Texts of fewer than ``shingle`` words are one shingle."""
    ids = stored(docs.select("doc_id", simhash(F.col("text"), shingle).alias("fp")), "simhash")
    return grouped(ids, max_bits)


def op4(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, 3, 2).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one document of each group: that with the smallest doc_id.

    Rows that repeat a doc_id are one document; of them the row with the smallest text
    stays, then that whose other columns come first as JSON text, so that the choice does not
    depend on the order of rows.  A group whose doc_ids are all null keeps one row, chosen
    alike.  Null and empty texts are documents like others.  Columns of any names are
    kept; an empty table stays empty."""
    ids = stored(docs.select("doc_id", simhash(F.col("text"), shingle).alias("fp")), "simhash")
    groups = grouped(ids, max_bits)
    # the rows travel as one column, so that no name of theirs meets one used here
    packed = docs.select(whole(docs).alias("doc"), F.col("doc_id").alias("id"),
                         F.struct(F.coalesce("text", F.lit("")).alias("text"), F.to_json(whole(docs.drop("text"))).alias("others")).alias("rank"))
    keep = groups.where("doc_id = component_id").select(F.col("doc_id").alias("kept")).distinct()
    named = packed.join(keep, F.col("id") == F.col("kept")).groupBy("kept").agg(F.min_by("doc", "rank").alias("doc"))
    nameless = packed.where("id is null").withColumn("fp", simhash(F.col("doc.text"), shingle))
    alone = groups.where(F.col("component_id").isNull()).select(F.col("fp").alias("of"), F.col("root").alias("group")).distinct()
    nameless = nameless.join(alone, F.col("fp") == F.col("of")).groupBy("group").agg(F.min_by("doc", "rank").alias("doc"))
    return named.select("doc.*").unionByName(nameless.select("doc.*"))
