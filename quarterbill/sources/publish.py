"""Reports of a quarter, published as one.

Every report is first written to a folder of its own. Then one manifest, which names the
quarter's files, is put in place by a rename. Readers go by the newest manifest of each
quarter, so they see all new reports of a quarter or all old ones; a run that fails leaves
no more than files that no manifest names.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFESTS = "_manifests"
DATA = "data"


class PublishConflict(Exception):
    """Raised when another run published the quarter at the same time."""


def _path(spark: SparkSession, path: str) -> tuple:
    """The Hadoop path and its file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _listed(spark: SparkSession, folder: str) -> list:
    at, system = _path(spark, folder)
    return list(system.listStatus(at)) if system.exists(at) else []


def _quarter_folder(out_dir: str, quarter: dt.date) -> str:
    return f"{out_dir}/{MANIFESTS}/quarter_start={quarter}"


def _versions(spark: SparkSession, folder: str) -> list[str]:
    """Names of a quarter's manifests, oldest first."""
    return sorted(s.getPath().getName() for s in _listed(spark, folder) if s.getPath().getName().endswith(".json"))


def _read(spark: SparkSession, path: str) -> dict:
    at, system = _path(spark, path)
    stream = system.open(at)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _commit(spark: SparkSession, folder: str, after: str | None, manifest: dict) -> None:
    """Put the next manifest in place, unless another run has done so."""
    version = int(after.removesuffix(".json")) + 1 if after else 1
    draft, system = _path(spark, f"{folder}/_draft-{uuid.uuid4().hex}")
    system.mkdirs(draft.getParent())
    stream = system.create(draft, False)
    stream.write(bytearray(json.dumps(manifest).encode()))
    stream.close()
    final, _ = _path(spark, f"{folder}/{version:012d}.json")
    if system.exists(final) or not system.rename(draft, final):
        system.delete(draft, False)
        raise PublishConflict(f"{final} is there already")


def publish(
    spark: SparkSession,
    reports: dict[str, DataFrame],
    quarter: dt.date,
    out_dir: str,
    *,
    source: str = "parquet",
    note: dict | None = None,
) -> None:
    """Replace the named reports of one quarter, all at once.

    A report without rows replaces the old one by none. Reports of the quarter that are
    not named stay, other quarters are not touched. Each report gets a column
    `quarter_start`. `source` is parquet or csv (with a header line). `note` is kept in the
    manifest.
    """
    folder = _quarter_folder(out_dir, quarter)
    versions = _versions(spark, folder)
    last = versions[-1] if versions else None
    entries = dict(_read(spark, f"{folder}/{last}")["reports"]) if last else {}
    run = f"{DATA}/{quarter}-{uuid.uuid4().hex}"
    for name, report in reports.items():
        dated = report.withColumn("quarter_start", F.lit(quarter))
        target = f"{out_dir}/{run}/{name}"
        dated.write.options(header=True).format(source).save(target)
        files = sorted(
            f"{run}/{name}/{s.getPath().getName()}"
            for s in _listed(spark, target)
            if s.isFile() and s.getPath().getName()[0] not in "._"
        )
        entries[name] = {"source": source, "schema": json.loads(dated.schema.json()), "files": files}
    _commit(spark, folder, last, {"quarter_start": str(quarter), "reports": entries, "note": note or {}})


def quarters(spark: SparkSession, out_dir: str) -> list[dt.date]:
    """The quarters that have been published."""
    names = [s.getPath().getName() for s in _listed(spark, f"{out_dir}/{MANIFESTS}")]
    return sorted(dt.date.fromisoformat(n.split("=")[1]) for n in names if n.startswith("quarter_start="))


def _newest(spark: SparkSession, out_dir: str, quarter: dt.date) -> dict:
    folder = _quarter_folder(out_dir, quarter)
    versions = _versions(spark, folder)
    return _read(spark, f"{folder}/{versions[-1]}") if versions else {"reports": {}, "note": {}}


def read_note(spark: SparkSession, out_dir: str, quarter: dt.date) -> dict:
    """What the last run noted in the quarter's manifest."""
    return _newest(spark, out_dir, quarter)["note"]


def read_report(
    spark: SparkSession, out_dir: str, name: str, quarter: dt.date | None = None
) -> DataFrame:
    """A published report, of one quarter or of all, as the newest manifests have it."""
    wanted = [quarter] if quarter else quarters(spark, out_dir)
    found = [e[name] for q in wanted if name in (e := _newest(spark, out_dir, q)["reports"])]
    if not found:
        raise ValueError(f"no report {name} has been published in {out_dir}")
    # one reader per kind of file and columns, not one per quarter
    readers: dict[tuple, list[str]] = {}
    for entry in found:
        readers.setdefault((entry["source"], json.dumps(entry["schema"])), []).extend(entry["files"])
    parts = []
    for (source, schema), files in readers.items():
        kind = T.StructType.fromJson(json.loads(schema))
        if files:
            paths = [f"{out_dir}/{f}" for f in files]
            parts.append(spark.read.schema(kind).options(header=True).format(source).load(paths))
        else:
            parts.append(spark.createDataFrame([], kind))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def remove_superseded(spark: SparkSession, out_dir: str) -> int:
    """Delete files that only older manifests name, and those manifests; the number of files.

    Run it when no reader still goes by an older manifest.
    """
    removed = 0
    for quarter in quarters(spark, out_dir):
        folder = _quarter_folder(out_dir, quarter)
        *old, newest = _versions(spark, folder)
        kept = {f for e in _read(spark, f"{folder}/{newest}")["reports"].values() for f in e["files"]}
        for version in old:
            named = {f for e in _read(spark, f"{folder}/{version}")["reports"].values() for f in e["files"]}
            for path in [*(named - kept), f"{MANIFESTS}/quarter_start={quarter}/{version}"]:
                at, system = _path(spark, f"{out_dir}/{path}")
                removed += system.delete(at, False) and not path.startswith(MANIFESTS)
    return removed
