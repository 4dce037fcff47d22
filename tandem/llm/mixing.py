"""Mixing sources to target weights by iterative proportional fitting.

The tokens of all documents are summed into cells (source, language, topic).  Raking
scales the cells to each margin's targets in turn; no cell may get more than all its
tokens.  A cell's weight against its tokens is the probability of its documents.
DataFrame expressions only.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, whole

OTHER = "(other)"
#: Target shares; what a table does not name (nulls too) counts as OTHER.  The tables
#: bound the number of cells, however many values the data have.
SOURCES = {**{f"src{i}": 0.048 for i in range(20)}, OTHER: 0.04}
LANGS = {"en": 0.5, "de": 0.18, "fr": 0.18, "es": 0.12, OTHER: 0.02}
#: Topics by markers in the text; the first that fits counts.
TOPIC_MARKERS = (
    ("legal", ("Licensed under", "Copyright")), ("contact", ("@mail", "http")), ("table", (" | ",)),
    ("loud", ("!! ",)), ("markup", ("$$$", "%%%", "</")),
)
TOPICS = {"legal": 0.1, "contact": 0.06, "table": 0.05, "loud": 0.04, "markup": 0.05, "prose": 0.7}
ROUNDS = 10
MARGINS = ("source", "lang", "topic")


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def topic_of(text: Column) -> Column:
    found = [(name, reduce(lambda a, b: a | b, [F.coalesce(text.contains(m), F.lit(False)) for m in marks])) for name, marks in TOPIC_MARKERS]
    return F.coalesce(*[F.when(hit, F.lit(name)) for name, hit in found], F.lit("prose"))


def _known(column: Column, targets: Mapping[str, float]) -> Column:
    return F.when(column.isin(*[k for k in targets if k != OTHER]), column).otherwise(OTHER)


def _target(margin: str, targets: Mapping[str, float]) -> Column:
    return F.coalesce(*[F.when(F.col(margin) == k, F.lit(float(v))) for k, v in targets.items()])


def fitted(cells: DataFrame, targets: Mapping[str, Mapping[str, float]], rate: float, rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (the margins and tokens) with p, the share of each cell's tokens to take.

    Targets are shares among the values that occur.  ``rate`` is the share of all tokens
    wanted.  The cells are at most the product of the target tables' sizes: one partition
    holds them, so that no round shuffles."""
    everything = Window.partitionBy()
    w = cells.where("tokens > 0").coalesce(1)
    w = w.withColumn("budget", F.sum("tokens").over(everything) * F.lit(rate)).withColumn("w", F.col("tokens") * F.lit(rate))
    for m in MARGINS:  # targets of the values that occur, scaled to the budget
        first = F.row_number().over(Window.partitionBy(m).orderBy(*MARGINS)) == 1
        w = w.withColumn("__t", _target(m, targets[m])).withColumn("__f", F.when(first, F.col("__t")).otherwise(0.0))
        w = w.withColumn(f"t_{m}", F.col("__t") / F.sum("__f").over(everything) * F.col("budget")).drop("__t", "__f")
    for _ in range(rounds):
        for m in MARGINS:
            raked = F.col("w") * F.col(f"t_{m}") / F.sum("w").over(Window.partitionBy(m))
            w = w.withColumn("w", F.least(raked, F.col("tokens").cast("double")))
    return w.select(*MARGINS, F.round(F.col("w") / F.col("tokens"), 6).alias("p"))


def uniform(doc_id: Column) -> Column:
    """A number in [0, 1) from the id alone: the same in each run and retry."""
    return F.conv(F.substring(F.md5(F.concat(F.lit("mix:"), F.coalesce(doc_id.cast("string"), F.lit("null")))), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def mixed(docs: DataFrame, rate: float = 0.5, sources=SOURCES, langs=LANGS, topics=TOPICS, rounds: int = ROUNDS) -> DataFrame:
    """``docs`` with __source, __lang, __topic, __tokens, __p and __take.

    Texts without words have no weight; their probability is ``rate``.  Rows of one id
    are taken or left together.  An empty table gives none."""
    rows = docs.withColumns({"__source": _known(F.col("source"), sources), "__lang": _known(F.col("lang"), langs),
                             "__topic": topic_of(F.col("text")), "__tokens": n_tokens(F.col("text"))})
    cells = rows.groupBy(*[F.col(f"__{m}").alias(m) for m in MARGINS]).agg(F.sum("__tokens").alias("tokens"))
    p = stored(fitted(cells, {"source": sources, "lang": langs, "topic": topics}, rate, rounds), "mix")
    p = p.select(*[F.col(m).alias(f"__of_{m}") for m in MARGINS], F.col("p").alias("__of_p"))
    same = reduce(lambda a, b: a & b, [F.col(f"__{m}") == F.col(f"__of_{m}") for m in MARGINS])
    # at most len(sources) * len(langs) * len(topics) rows
    rows = rows.join(F.broadcast(p), same, "left").withColumn("__p", F.coalesce("__of_p", F.lit(rate)))
    return rows.withColumn("__take", uniform(F.col("doc_id")) < F.col("__p")).drop("__of_p", *[f"__of_{m}" for m in MARGINS])


def reached(docs: DataFrame, rate: float = 0.5, sources=SOURCES, langs=LANGS, topics=TOPICS, rounds: int = ROUNDS, tolerance: float = 0.01) -> DataFrame:
    """margin, value, target and reached share of the wanted tokens (``rate`` of all), and met:
    whether they differ by at most ``tolerance`` of the target.  A value with too few tokens
    falls short, and other margins with it."""
    rows = mixed(docs, rate, sources, langs, topics, rounds)
    taken = F.sum(F.col("__tokens") * F.col("__p"))
    cells = rows.groupBy(*[F.col(f"__{m}").alias(m) for m in MARGINS]).agg(F.sum("__tokens").alias("tokens"), taken.alias("taken")).where("tokens > 0")
    everything = Window.partitionBy()  # from here on at most one row per cell
    cells = cells.withColumn("budget", F.sum("tokens").over(everything) * rate)
    tables = {"source": sources, "lang": langs, "topic": topics}
    parts = [cells.groupBy(F.lit(m).alias("margin"), F.col(m).alias("value"), _target(m, tables[m]).alias("t"))
             .agg((F.sum("taken") / F.max("budget")).alias("reached")) for m in MARGINS]
    out = reduce(DataFrame.unionByName, parts).withColumn("target", F.col("t") / F.sum("t").over(Window.partitionBy("margin")))
    return out.select("margin", "value", "target", "reached", (F.abs(F.col("reached") - F.col("target")) <= tolerance * F.col("target")).alias("met"))


def op7(docs: DataFrame) -> DataFrame:
    return mixed(docs.select("doc_id", "text", "lang", "source")).select(
        "doc_id", F.col("__source").alias("source"), F.col("__lang").alias("lang"), F.col("__topic").alias("topic"),
        F.col("__tokens").alias("n_tokens"), F.col("__p").alias("probability"), F.col("__take").alias("selected"))


def sampled(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are taken, with their columns, whatever their names.

    Null sources, languages and texts count as the values 'other' and no words (see
    `mixed`); texts are counted whole; rows of one id are taken or left together."""
    packed = docs.select("doc_id", "text", "lang", "source", whole(docs).alias("doc"))
    return mixed(packed, **options).where("__take").select("doc.*")


def op7_sql(rate: float = 0.5, rounds: int = ROUNDS) -> str:
    """`op7` for DuckDB."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    case = lambda m, t: f"CASE {m} " + " ".join(f"WHEN {quoted(k)} THEN {float(v)!r}" for k, v in t.items()) + " END"
    known = lambda m, t: f"CASE WHEN {m} IN ({', '.join(quoted(k) for k in t if k != OTHER)}) THEN {m} ELSE {quoted(OTHER)} END"
    topic = "CASE " + " ".join("WHEN " + " OR ".join(f"coalesce(contains(text, {quoted(x)}), false)" for x in marks) + f" THEN {quoted(name)}"
                               for name, marks in TOPIC_MARKERS) + " ELSE 'prose' END"
    tables = {"source": SOURCES, "lang": LANGS, "topic": TOPICS}
    steps = [f"""WITH rows AS MATERIALIZED (SELECT doc_id, {known('source', SOURCES)} AS source, {known('lang', LANGS)} AS lang, {topic} AS topic,
        coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n_tokens FROM documents),
    cells AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM rows GROUP BY ALL HAVING sum(n_tokens) > 0),
    t AS MATERIALIZED (SELECT *, tokens * {rate} AS w, (SELECT sum(tokens) FROM cells) * {rate} AS budget,
        {', '.join(f"{case(m, tables[m])} / (SELECT sum({case(m, tables[m])}) FROM (SELECT DISTINCT {m} FROM cells)) AS s_{m}" for m in MARGINS)} FROM cells)"""]
    last, k = "t", 0
    for _ in range(rounds):
        for m in MARGINS:
            steps.append(f"w{k} AS MATERIALIZED (SELECT * REPLACE (least(w * (s_{m} * budget) / sum(w) OVER (PARTITION BY {m}), tokens) AS w) FROM {last})")
            last, k = f"w{k}", k + 1
    return ",\n".join(steps) + f"""
    SELECT doc_id, source, lang, topic, n_tokens, coalesce(round(w / tokens, 6), {rate}) AS probability,
        ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT / 4294967296.0 < coalesce(round(w / tokens, 6), {rate}) AS selected
    FROM rows LEFT JOIN {last} USING (source, lang, topic)"""
