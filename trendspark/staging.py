"""Hand-off of tables between steps: written once, read as often as needed.

A table that two consumers read (quantiles and ranking, counting and joining) is
written as Parquet below the shared folder that the cluster names in
``spark.checkpoint.dir``. That cuts the lineage, survives the loss of executors, and
lets every consumer prune columns and push filters into the scan.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_local_dir: tempfile.TemporaryDirectory | None = None


def shared_dir(spark: SparkSession) -> str:
    """Folder for staged tables; a temporary one only for local masters that set none."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    global _local_dir
    if _local_dir is None:
        _local_dir = tempfile.TemporaryDirectory(prefix="trendspark-")
    return _local_dir.name


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet (replacing what is at ``path``) and return the written table."""
    path = path or new_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Write ``df`` in buckets of ``keys``, sorted by them, and return the written table.

    Tables in as many buckets of keys of the same types are joined on them bucket by bucket, without moving a row:
    bucket what is joined more than once. The table has a name of its own in the session's catalog, its files lie
    below the shared folder like those of :func:`stage`. Rows of one key share a bucket: not for hot keys, whose
    join adaptive execution splits only where it shuffles. ``buckets`` is by default the number of shuffle partitions.
    """
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    number = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = path.rpartition("/")[2].replace("-", "_")
    # one task writes one bucket, so a bucket is one sorted file
    dealt = df.repartition(number, *keys)
    dealt.write.bucketBy(number, *keys).sortBy(*keys).option("path", path).saveAsTable(table, format="parquet")
    return spark.table(table)


def release(*tables: DataFrame | str, spark: SparkSession | None = None) -> None:
    """Delete staged tables (as returned by ``stage``) or paths below the shared folder.

    Call it when nothing that is still to be evaluated reads them. Only what lies below
    the shared folder is touched; a path that is already gone is no error.
    """
    for table in tables:
        session = spark if isinstance(table, str) else table.sparkSession
        jvm, conf = session._jvm, session._jsparkSession.sessionState().newHadoopConf()
        roots = [table] if isinstance(table, str) else {f.rpartition("/")[0] for f in table.inputFiles()}
        base = jvm.org.apache.hadoop.fs.Path(shared_dir(session))
        base = base.getFileSystem(conf).makeQualified(base).toUri().getPath()
        for root in roots:
            path = jvm.org.apache.hadoop.fs.Path(root)
            if path.toUri().getPath().startswith(base.rstrip("/") + "/"):
                path.getFileSystem(conf).delete(path, True)


class Scratch:
    """Staged tables of one job, below one folder that goes when the block ends.

    ::

        with Scratch(spark, "job") as scratch:
            halfway = scratch.stage(df, "halfway")
            return stage(halfway.where(...), "result")
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, new_path(spark, name)

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        return stage(df, name, f"{self.root}/{name}-{uuid.uuid4().hex[:8]}")

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_exc) -> None:
        release(self.root, spark=self.spark)


def stage_all(**tables: DataFrame) -> list[DataFrame]:
    """Write tables that do not depend on each other, all at the same time.

    A small table then does not wait for the stragglers of a large one; with the fair
    scheduler their jobs share the cores.
    """
    spark = next(iter(tables.values())).sparkSession
    write = inheritable_thread_target(spark)(lambda item: stage(item[1], item[0].replace("_", "-")))
    with ThreadPoolExecutor(len(tables)) as pool:
        return list(pool.map(write, tables.items()))
