"""Joins and stages that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000_000
MOST_HOT_KEYS = 10_000


def spread_join(
    rows: DataFrame,
    per_key: DataFrame,
    key: str,
    *,
    spread_by: list[str],
    counts: DataFrame | None = None,
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Join many `rows` per key with a table that has one row per key.

    Keys with more than `rows_per_task` rows are cut into pieces by a hash of
    `spread_by`, and only their row of `per_key` is copied to each piece. The list of
    such keys is broadcast: a key on it holds at least one `MOST_HOT_KEYS`th of all rows, so it
    has no more entries than that. Keys between the two bounds are left to Spark's own
    splitting of skewed joins.
    """
    if counts is None:
        counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    share = counts.select(F.coalesce(F.sum("n"), F.lit(0)) / MOST_HOT_KEYS).scalar()
    hot = F.broadcast(
        counts.where(F.col(key).isNotNull() & (F.col("n") > F.greatest(F.lit(rows_per_task), share)))
        .select(key, F.ceil(F.col("n") / rows_per_task).cast("int").alias("_pieces"))
    )
    left = rows.join(hot, key, "left").withColumn(
        "_piece",
        F.coalesce(F.pmod(F.xxhash64(*spread_by), F.col("_pieces")), F.lit(0)).cast(
            "int"
        ),
    )
    right = (
        per_key.join(hot, key, "left")
        .withColumn(
            "_piece",
            F.explode(
                F.sequence(F.lit(0), F.coalesce(F.col("_pieces"), F.lit(1)) - 1)
            ),
        )
        .drop("_pieces")
    )
    return left.drop("_pieces").join(right, [key, "_piece"], how).drop("_piece")


@cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="quarterbill-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def new_folder(spark: SparkSession, name: str = "staged") -> str:
    """A path in the shared folder that no other run uses.

    The folder is the one the session names in `spark.checkpoint.dir`. Where none is named,
    a session whose tasks all run in this process gets one of its own, removed at its end;
    on a cluster that is an error, as executors share no other folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"file://{_own_folder()}"
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: What the innermost `staged_steps` has to remove; nothing is noted outside of one.
_steps: ContextVar[list[tuple[str, str | None]] | None] = ContextVar("_steps", default=None)
MOST_BUCKETS = 100_000


def _noted(path: str, table: str | None = None) -> str:
    steps = _steps.get()
    if steps is not None:
        steps.append((path, table))
    return path


def stage(df: DataFrame) -> DataFrame:
    """Write a result that several later steps read, as Parquet in the shared folder."""
    spark = df.sparkSession
    path = _noted(new_folder(spark))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_by(df: DataFrame, key: str) -> DataFrame:
    """`stage`, but the rows keep their partitioning by `key`: what groups, joins or orders them
    by it later needs no shuffle.

    It is a bucketed table with as many buckets as the session has shuffle partitions. A
    plan that is partitioned by `key` already is written as it is; any key's rows go to one bucket,
    so use it for keys whose rows are few.
    """
    spark = df.sparkSession
    table = f"staged_{uuid.uuid4().hex}"
    buckets = min(int(spark.conf.get("spark.sql.shuffle.partitions")), MOST_BUCKETS)
    path = _noted(new_folder(spark), table)
    df.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return spark.table(table)


@contextmanager
def staged_steps(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end, all that is staged within it. What is returned must not read it."""
    outer = _steps.set([])
    try:
        yield
    finally:
        for path, table in _steps.get():
            if table:
                spark.sql(f"DROP TABLE IF EXISTS {table}")
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        _steps.reset(outer)
