"""The registered queries of the corpus operators, and DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, conversation, digest, fertility, gam, langid, mixing, periodic, pii, secrets, simhash, toxicity, urlfilter
from .common import read


def _on_documents(op: Callable[[DataFrame], DataFrame]):
    return lambda spark, sf_dir: op(read(spark, sf_dir, "documents"))


def _with_labels(op: Callable[[DataFrame, DataFrame], DataFrame]):
    return lambda spark, sf_dir: op(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": _with_labels(toxicity.op1),
    "op2_byte_bpe": _on_documents(bpe.op2),
    "op3_secret_scan": _on_documents(secrets.op3),
    "op4_simhash": _on_documents(simhash.op4),
    "op5_fingerprints": _on_documents(digest.op5),
    "op6_pii": _on_documents(pii.op6),
    "op7_mixing": _on_documents(mixing.op7),
    "op8_url_filter": lambda spark, d: urlfilter.op8(read(spark, d, "pages")),
    "op9_quality_gam": _with_labels(gam.op9),
    "op10_quality_rules": _on_documents(fertility.op10),
    "op11_conversation_repair": lambda spark, d: conversation.op11(read(spark, d, "conversations")),
    "op12_periodic_runs": _on_documents(periodic.op12),
    "op13_language_id": _on_documents(langid.op13),
}

ORACLES: dict[str, str] = {"op7_mixing": mixing.op7_sql()}
