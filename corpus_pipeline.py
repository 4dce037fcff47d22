"""A corpus pipeline over the ``documents`` table, from raw rows to token counts.

Each stage takes the documents that its predecessor kept, does its whole work on them
and hands on documents; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.llm import bpe, mixing, secrets, simhash, toxicity
from tandem.llm.common import read, stored, whole


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose restored text scores as toxic.

    Null and empty texts have the model's base score, which is under the threshold where
    most labelled documents are clean.  Rows that repeat a doc_id are judged each; all
    columns are handed on, whatever their names; an empty table stays empty.  Texts of any
    length are read whole."""
    return toxicity.reject(docs, read(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that with the smallest doc_id, of each SimHash group.

    Null, empty and wordless texts form a group like others; ties between rows of one
    doc_id go by text, then by all columns; see `simhash.keep_one`."""
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces confirmed secrets in the texts; drops no document.

    Null and empty texts stay as they are, repeated rows are redacted each; see
    `secrets.redact`."""
    return secrets.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples documents towards the target weights of source, language and topic.

    The draw is a hash of the doc_id, so repeated rows fare alike; null columns are values
    of their own; see `mixing.sampled`."""
    return mixing.sampled(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the token ids, their number and the digests of ids and decoded bytes.

    Null and empty texts have no tokens.  Columns that already have one of the four names
    are replaced, all others handed on; an empty table stays empty."""
    fields = ("ids", "n_tokens", "ids_sha256", "decoded_sha256")
    others = docs.drop(*[c for c in docs.columns if c.lower() in fields])
    return others.select(whole(others).alias("doc"), bpe.encoded(F.col("text"), spark, fields=fields).alias("bpe")).select("doc.*", "bpe.*")


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("encoding", encoding_stage),
]

#: A trained classifier and a tokeniser have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each written as Parquet and reread."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
