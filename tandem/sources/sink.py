"""The mart sink: replace the whole table in one step, with a schema check.

A mart is a folder of snapshots and commits::

    <root>/<name>/snapshots/<id>/part-*.parquet
    <root>/<name>/commits/000000000042.json

A write makes a snapshot folder and then creates one small commit file that names
it.  The commit with the highest number is the mart.  Creating that file is the only
step that readers can see, on any store Spark writes to: there is no moment without a
mart, no rename, and a failed write leaves no commit.  A reader asks for the current
commit once and goes on reading its snapshot, which stays until ``keep`` later commits
have been made.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Commit:
    """A whole table: ``buckets`` and ``bucket_by`` tell how its rows are placed."""

    number: int
    path: str
    schema: StructType
    bucket_by: tuple[str, ...] = ()
    buckets: int = 0


class _Files:
    """The few file operations the sink needs, on the store of ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm
        self.fs = self.at(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def listed(self, path: str) -> dict[str, int]:
        """Names in a folder (none if it does not exist) and when they were last changed."""
        if not self.fs.exists(self.at(path)):
            return {}
        return {s.getPath().getName(): s.getModificationTime() for s in self.fs.listStatus(self.at(path))}

    def read(self, path: str) -> str:
        stream = self.fs.open(self.at(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Creates a file; False if there is one already."""
        try:
            stream = self.fs.create(self.at(path), False)
        except Exception as e:
            if self.fs.exists(self.at(path)):
                return False
            raise e
        stream.write(bytearray(text.encode()))
        stream.close()
        return True

    def delete(self, path: str) -> None:
        self.fs.delete(self.at(path), True)


def _commits(files: _Files, root: str, name: str) -> list[tuple[int, dict]]:
    """All whole commits, oldest first.  A file that a writer has created and not yet
    closed (or died over) is no commit."""
    folder, found = f"{root}/{name}/commits", []
    for file in sorted(files.listed(folder)):
        if file.endswith(".json"):
            try:
                found.append((int(file[:-5]), json.loads(files.read(f"{folder}/{file}"))))
            except ValueError:
                continue
    return found


def current(spark: SparkSession, root: str, name: str) -> Commit | None:
    """The commit that is the mart now; None if nothing was written yet."""
    root = root.rstrip("/")
    found = _commits(_Files(spark, root), root, name)
    if not found:
        return None
    number, c = found[-1]
    return Commit(number, f"{root}/{name}/snapshots/{c['snapshot']}", StructType.fromJson(c["schema"]),
                  tuple(c["bucket_by"]), c["buckets"])


def _columns(schema: StructType) -> list[tuple]:
    return [(f.name, f.dataType) for f in schema.fields]


def overwrite_mart(df: DataFrame, root: str, name: str, schema: StructType | None = None,
                   partition_by: Sequence[str] = (), bucket_by: Sequence[str] = (), buckets: int = 0,
                   keep: int = 2) -> Commit:
    """Write ``df`` as mart ``name`` under ``root``, replacing what was there
    (the warehouse's WRITE_TRUNCATE).  If ``schema`` is given the frame must
    have exactly its column names and types (nullability aside).

    With ``partition_by`` (e.g. the order date) the mart is laid out in one
    folder per value, so readers filtering on it prune folders.  The rows are
    first rebalanced on those columns: AQE then sizes the output partitions,
    splitting a value that holds many rows over several tasks instead of one,
    and merging small ones, so each task writes few, reasonably sized files.

    With ``bucket_by`` the rows are placed in ``buckets`` files by a hash of
    those columns and sorted by them in each; :func:`read_mart` tells Spark so,
    and joins and groupings on them need no exchange.

    Snapshots older than the last ``keep`` commits are deleted.
    """
    if schema is not None and _columns(df.schema) != _columns(schema):
        raise ValueError(f"mart {name}: schema {_columns(df.schema)} differs from {_columns(schema)}")
    if partition_by and bucket_by:
        raise ValueError(f"mart {name}: either partitions or buckets")
    spark, root, snapshot = df.sparkSession, root.rstrip("/"), uuid.uuid4().hex
    path = f"{root}/{name}/snapshots/{snapshot}"
    if partition_by:
        df.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(path)
    elif bucket_by:
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        table = f"tandem_{snapshot}"  # a table definition for the write only; the files stay
        try:
            (df.repartition(buckets, *bucket_by).write.format("parquet").option("path", path)
               .bucketBy(buckets, *bucket_by).sortBy(*bucket_by).saveAsTable(table))
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
    else:
        df.write.parquet(path)
    files = _Files(spark, root)
    entry = {"snapshot": snapshot, "schema": df.schema.jsonValue(), "bucket_by": list(bucket_by), "buckets": buckets if bucket_by else 0}
    taken = [int(f[:-5]) for f in files.listed(f"{root}/{name}/commits") if f.endswith(".json")]
    number = max(taken, default=0) + 1
    while not files.create(f"{root}/{name}/commits/{number:012d}.json", json.dumps(entry)):
        number += 1  # another writer was faster: this one, whole as well, comes after it
    expire(spark, root, name, keep)
    return Commit(number, path, df.schema, tuple(bucket_by), entry["buckets"])


def expire(spark: SparkSession, root: str, name: str, keep: int = 2, orphan_hours: float = 24.0) -> None:
    """Deletes all but the last ``keep`` commits and their snapshots, and snapshots that
    no commit names (failed writes) once they are ``orphan_hours`` old: younger ones may
    be writes that are still going on."""
    root = root.rstrip("/")
    files, folder = _Files(spark, root), f"{root}/{name}"
    found = _commits(files, root, name)
    named = {c["snapshot"] for _, c in found}
    kept = {c["snapshot"] for _, c in found[-max(keep, 1):]}
    for number, c in found[:-max(keep, 1)]:
        if c["snapshot"] not in kept:
            files.delete(f"{folder}/snapshots/{c['snapshot']}")
        files.delete(f"{folder}/commits/{number:012d}.json")  # last: until then the snapshot is named
    before = (time.time() - orphan_hours * 3600) * 1000
    for snapshot, changed in files.listed(f"{folder}/snapshots").items():
        if snapshot not in named and changed < before:
            files.delete(f"{folder}/snapshots/{snapshot}")


def read_commit(spark: SparkSession, commit: Commit) -> DataFrame:
    """The rows of a commit, with the placement they were written in."""
    if not commit.buckets:
        return spark.read.schema(commit.schema).parquet(commit.path)
    table = "tandem_" + commit.path.rsplit("/", 1)[1]
    columns = spark.sparkContext._jvm.org.apache.spark.sql.types.DataType.fromJson(commit.schema.json()).toDDL()
    by = ", ".join(f"`{c}`" for c in commit.bucket_by)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
              f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {commit.buckets} BUCKETS LOCATION '{commit.path}'")
    return spark.table(table)


def read_mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The mart as of now: later commits do not change the returned frame."""
    commit = current(spark, root, name)
    if commit is None:
        raise FileNotFoundError(f"no mart {name} under {root}")
    return read_commit(spark, commit)


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once as a table in the shared checkpoint folder (the one
    ``spark.checkpoint.dir`` names) and return it read back.

    This cuts the lineage like ``checkpoint()`` but computes the plan once
    (an eager RDD checkpoint runs it twice: once to count, once to save), and
    it keeps the columnar layout for the readers.
    """
    from ..session import ensure_checkpoint_dir
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/{tag}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
