"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sink import materialize


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Table ``name`` of the folder ``sf_dir`` (any store that Spark reads)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_ROWS = 2_000  # texts handed to a Python worker at a time: Spark's 10,000 are tens of MB, held several times over


def ship(spark: SparkSession) -> None:
    """Sends this library's modules to the executors, once per application, and bounds the
    rows of a batch where the session leaves Spark's default."""
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(batch) == "10000":
        spark.conf.set(batch, str(BATCH_ROWS))
    sc, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    if getattr(sc, "_tandem_shipped", False):
        return
    target = Path(tempfile.mkdtemp(prefix="tandem-")) / "tandem_modules.zip"
    with zipfile.ZipFile(target, "w") as z:
        for module in sorted(package.rglob("*.py")):
            z.write(module, module.relative_to(package.parent))
    sc.addPyFile(str(target))
    sc._tandem_shipped = True


def vector_udf(kind) -> Callable:
    """`pandas_udf` whose workers can import this library."""
    ship(SparkSession.active())
    return F.pandas_udf(kind)


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back: cuts the
    lineage, so a lost executor costs one read, not the plan before it."""
    return materialize(df, f"llm-{tag}")


def whole(df: DataFrame) -> Column:
    """A row of ``df`` as one column, so that no column of it meets a name used here."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def held_out(doc_id: Column) -> Column:
    """True on the quarter of the ids whose labels no model may learn from."""
    return F.crc32(doc_id.cast("string")) % 4 == 2


def labelled_sample(labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """At most ``max_rows`` rows (doc_id, label) to learn from: not held out, label and
    id not null, in the order of a hash of the id, so that the choice is the same in
    each run.  Repeated rows of an id count once (the larger label)."""
    return (labels.select("doc_id", F.col(label).cast("int").alias("label"))
            .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max("label").alias("label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))


class Memo(dict):
    """A per-worker cache.  When ``size`` entries are new it forgets the older half, those
    not asked for since it was last full.  Only speed depends on it, never a result."""

    def __init__(self, make: Callable, size: int):
        super().__init__()
        self.make, self.size, self.older = make, size, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self.learn({key: value})
        return value

    def learn(self, more: dict) -> None:
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self.update(more)
