"""What the operators share: tables, staging, whole-text helpers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words, in the syntax of Java's and Python's patterns.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read by Spark."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="quarterbill-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    A local session without that setting gets a folder of its own, as all its tasks run on
    this machine. A cluster session without it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master:
        return f"file://{_own_folder()}"
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path for one written table, used by no other run."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a step as Parquet in the shared folder and read it back.

    The rows are computed once, survive the loss of an executor and have no lineage.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Remove a staged table that no later step reads."""
    spark = df.sparkSession
    hadoop = spark._jsc.hadoopConfiguration()
    shared = shared_folder(spark).removeprefix("file://")
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if shared in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(hadoop).delete(path, True)


def same_key(left: DataFrame, right: DataFrame, columns: list[str], how: str = "left") -> DataFrame:
    """Equi-join on columns of equal names in which a null equals a null."""
    renamed = right.select(
        *(F.col(c).alias(f"_r_{c}") for c in columns),
        *(c for c in right.columns if c not in columns),
    )
    on = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in columns]
    joined = left.join(renamed, on, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*(f"_r_{c}" for c in columns))


def word_blocks(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text in lists of about `size` bytes, so that a list stays small."""
    # bytes.split() parts at exactly the white space of SPACE
    start = 0
    while start < len(data):
        end = start + size
        if end < len(data):
            while end < len(data) and data[end] not in b" \t\n\r\x0b\x0c":
                end += 1
        yield data[start:end].split()
        start = end


def ship(spark: SparkSession) -> None:
    """Send this library to the executors, once per context, as --py-files would."""
    context = spark.sparkContext
    if getattr(context, "_quarterbill_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    folder = Path(tempfile.mkdtemp(prefix="quarterbill-"))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(folder / "quarterbill.zip", "w") as bundle:
        for path in sorted(package.rglob("*.py")):
            bundle.write(path, path.relative_to(package.parent))
    context.addPyFile(str(folder / "quarterbill.zip"))
    context._quarterbill_shipped = True
