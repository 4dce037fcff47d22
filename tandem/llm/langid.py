"""Language identification by n-gram filters that hold all languages side by side.

For each language a Bloom filter holds the n-grams typical of it.  All filters use the
same hashes, so they are stored bit-sliced: a cell is one bit mask with a bit for each
language, and the AND of an n-gram's cells is the mask of all languages that contain it.
A text's score for a language is the number of its n-grams with that bit, corrected for
the share that the filter lets through by chance.

What is learnt comes from all documents and is counted by Spark.  An n-gram is admitted
to a language by its share there, so a filter holds at most 1/`SHARE` n-grams of each
length however large the corpus is, and the table has a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, stored, vector_udf

ORDERS = (3, 4)  # letters in an n-gram, a word's border counting as one
CELLS, HASHES = 1 << 20, 4
SHARE = 2.0 ** -17  # least share of a language's n-grams of all lengths
NEAR = 1 / 16  # least share, as a part of the largest that any language gives the n-gram
BLOCK = 1 << 19  # characters handled together
MOST_LANGUAGES = 1024  # more distinct values are refused: the table has a bit for each


@lru_cache(1)
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)


def pieces(texts: list[str | None]) -> Iterator[tuple[list[str], list[int]]]:
    """The texts in lower case, as groups of about BLOCK characters with the number of the
    text each part is of.  Long texts are cut at spaces, across which no n-gram reaches."""
    parts, of, size = [], [], 0
    for i, text in enumerate(texts):
        text, a = (text or "").lower(), 0
        while a < len(text):
            b = len(text) if len(text) - a <= BLOCK else text.find(" ", a + BLOCK)
            b = len(text) if b < 0 else b
            parts.append(text[a:b])
            of.append(i)
            size += b - a
            a = b
            if size >= BLOCK:
                yield parts, of
                parts, of, size = [], [], 0
    if parts:
        yield parts, of


def ngrams(parts: list[str], of: list[int], orders: tuple[int, ...] = ORDERS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order the hashes of all n-grams and the texts they are of.  What is no
    letter is a border; an n-gram may begin and end with one and has only letters between."""
    codes = np.frombuffer((" " + " ".join(parts) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    text = np.concatenate([[of[0]], np.repeat(of, [len(p) + 1 for p in parts])])
    letter = letters()[codes]
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]
    codes, letter, text = np.where(letter, codes, 32)[keep].astype(np.uint64), letter[keep], text[keep]
    for order in orders:
        n = len(codes) - order + 1
        if n < 1:
            continue
        whole = np.ones(n, bool)
        h = np.full(n, order, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(order):
                h = h * np.uint64(0x9E3779B97F4A7C15) + codes[k:k + n]
                if 0 < k < order - 1:
                    whole &= letter[k:k + n]
            h = h[whole]
            h ^= h >> np.uint64(31)
            h *= np.uint64(0x94D049BB133111EB)
            h ^= h >> np.uint64(29)
        yield h, text[1:1 + n][whole]  # the second character is a letter: its text


def counted(docs: DataFrame, orders: tuple[int, ...] = ORDERS) -> DataFrame:
    """lang, gram (hash) and n, partly counted: one row for each n-gram of a task's texts."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list[np.ndarray]] = {}

        def merged(lang: str) -> None:
            grams, where = np.unique(np.concatenate([g for g, _ in held[lang]]), return_inverse=True)
            n = np.bincount(where, weights=np.concatenate([n for _, n in held[lang]]), minlength=len(grams))
            held[lang] = [(grams, n)]

        def made(lang: str) -> pd.DataFrame:
            merged(lang)
            grams, n = held.pop(lang)[0]
            return pd.DataFrame({"lang": lang, "gram": grams.view(np.int64), "n": n.astype(np.int64)})

        for batch in batches:
            for lang, texts in batch.groupby("lang", sort=False)["text"]:
                for parts, of in pieces(texts.tolist()):
                    for h, _ in ngrams(parts, of, orders):
                        held.setdefault(lang, []).append(np.unique(h, return_counts=True))
                    if sum(len(g) for g, _ in held.get(lang, ())) > 1_000_000:
                        merged(lang)
                if lang in held and sum(len(g) for g, _ in held[lang]) > 500_000:
                    yield made(lang)
        for lang in list(held):
            yield made(lang)

    return docs.select("lang", "text").mapInPandas(run, "lang string, gram long, n long")


class Filters:
    """The learnt table: cells[w, c] is a mask of the languages 64w to 64w+63."""

    def __init__(self, names: list[str], cells: np.ndarray, hashes: int, orders: tuple[int, ...]):
        self.names, self.cells, self.hashes, self.orders = names, cells, hashes, orders
        full = [float(np.mean((cells[i // 64] >> np.uint64(i % 64)) & np.uint64(1))) for i in range(len(names))]
        self.by_chance = np.array([f ** hashes for f in full])

    def masks(self, grams: np.ndarray) -> np.ndarray:
        """For each n-gram the languages containing it, one row of masks for 64 languages."""
        low, high = grams & np.uint64(0xFFFFFFFF), (grams >> np.uint64(32)) | np.uint64(1)
        found = np.full((len(self.cells), len(grams)), ~np.uint64(0))
        for k in range(self.hashes):
            found &= self.cells[:, ((low + np.uint64(k) * high) % np.uint64(self.cells.shape[1])).astype(np.int64)]
        return found

    def counts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """n-grams of each text; for each text and language those in the language, less
        what comes by chance."""
        total, hits = np.zeros(len(texts)), np.zeros((len(texts), len(self.names)))
        for parts, of in pieces(texts):
            for grams, text in ngrams(parts, of, self.orders):
                total += np.bincount(text, minlength=len(texts))
                found = self.masks(grams)
                for i in range(len(self.names)):
                    has = (found[i // 64] >> np.uint64(i % 64)) & np.uint64(1)
                    hits[:, i] += np.bincount(text[has.view(np.int64) != 0], minlength=len(texts))
        return total, np.clip((hits - total[:, None] * self.by_chance) / (1 - np.minimum(self.by_chance, 0.99)), 0, None)

    def decide(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        total, own = self.counts(texts)
        if not self.names:
            return ["und"] * len(texts), np.zeros(len(texts))
        best = own.argmax(axis=1)  # the first of equal ones: the language with most text
        score = own[np.arange(len(texts)), best] / np.maximum(own.sum(axis=1), 1e-9)
        none = total == 0
        return [("und" if z else self.names[b]) for b, z in zip(best, none)], np.where(none, 0.0, score)


def learn(docs: DataFrame, cells: int = CELLS, hashes: int = HASHES, orders: tuple[int, ...] = ORDERS,
          share: float = SHARE, near: float = NEAR) -> Filters:
    """Filters from the rows of ``docs`` (lang, text) that have both.  The driver gets one
    row for each language and the table: at most ``cells`` rows for 64 languages."""
    spark = docs.sparkSession
    grams = stored(counted(docs.where("lang is not null and text is not null"), orders)
                   .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "ngrams")
    totals = grams.groupBy("lang").agg(F.sum("n").alias("total")).orderBy(F.desc("total"), "lang").limit(MOST_LANGUAGES + 1).collect()
    if len(totals) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    names = [r.lang for r in totals]
    table = np.zeros((max(1, -(-len(names) // 64)), cells), np.uint64)
    if names:
        known = spark.createDataFrame([(r.lang, i, float(r.total)) for i, r in enumerate(totals)], "lang string, i int, total double")
        typical = (grams.join(F.broadcast(known), "lang")  # MOST_LANGUAGES rows at most
                   .select("gram", "i", (F.col("n") / F.col("total")).alias("share"))
                   .groupBy("gram").agg(F.max("share").alias("top"), F.collect_list(F.struct("i", "share")).alias("all"))
                   .select("gram", "top", F.explode("all").alias("one"))
                   .where((F.col("one.share") >= share) & (F.col("one.share") >= near * F.col("top"))))
        low, high = F.expr("gram & 4294967295L"), F.expr("shiftrightunsigned(gram, 32) | 1L")
        at = F.array(*[(low + k * high) % cells for k in range(hashes)])
        bits = (typical.select(F.explode(at).alias("cell"), F.expr("one.i div 64").alias("word"), F.expr("shiftleft(1L, cast(one.i % 64 as int))").alias("bit"))
                .groupBy("cell", "word").agg(F.bit_or("bit").alias("mask"))).toArrow()
        table[bits["word"].to_numpy(), bits["cell"].to_numpy()] = bits["mask"].to_numpy().view(np.uint64)
    return Filters(names, table, hashes, orders)


def identified(text: Column, filters: Filters, spark) -> Column:
    """lang and score of each text; the table is broadcast."""
    shared = spark.sparkContext.broadcast(filters)

    @vector_udf("lang string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        lang, score = shared.value.decide(texts.tolist())
        return pd.DataFrame({"lang": lang, "score": score})

    return run(text)


def op13(docs: DataFrame) -> DataFrame:
    """The predicted language of each document, learnt from rows that are not held out.

    Null texts and texts without a letter are 'und' with score 0, and so is everything if
    no row can be learnt from.  A null doc_id is not held out (held_out false) and not
    learnt from.  Equal scores go to the language with most text, then by name; repeated
    rows get equal answers.  An empty table gives none; other columns are not read."""
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    filters = learn(docs.where(~held))
    got = identified(F.col("text"), filters, docs.sparkSession)
    return (docs.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), got.alias("got"))
            .select("doc_id", "held_out", F.col("got.lang").alias("lang_pred"), "got.score"))
