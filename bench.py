"""Times the headline reports and prints one JSON line.

The star-schema tables are turned into form tables once, outside the timing, since forms
are what the reports read. One round over all queries warms up the session; the figure is
the median of the next three. A run reads the forms anew and produces all rows, with plan
building and staging included.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import tempfile
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from quarterbill import Forms, Period, QuarterBilling
from quarterbill.operators import terms
from quarterbill.sources import derived

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_UP, ROUNDS = 1, 3
BILL_DATE = dt.date(1998, 10, 1)

QUERIES = {
    "projects": lambda run: run.projects,
    "user_segments": lambda run: run.replayed_segments,
    "closure_pass": lambda run: terms.terms(run.segments),
    "power_user_list": lambda run: run.power_user_list(),
    "power_user_charges": lambda run: run.priced_members,
    "quarter_summary": lambda run: run.summary(),
    "quarter_totals": lambda run: run.totals(),
    "bills": lambda run: run.bill_lines(BILL_DATE),
    "bill_documents": lambda run: run.bill_documents(BILL_DATE),
    "violations": lambda run: run.violations(),
}


def write_forms(spark: SparkSession, folder: str) -> dict[str, str]:
    """Write the derived forms as Parquet tables."""
    forms = derived.DerivedForms(spark, SF_DIR)
    paths = {}
    for name in ("pi", "pi_update", "user", "user_update"):
        paths[name] = f"{folder}/{name}"
        getattr(forms, name).repartition(int(CPUS)).write.parquet(paths[name])
    return paths


def main() -> None:
    """Run the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC")
        # The reports compile more generated classes than the default cache holds.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    started = time.perf_counter()
    paths = write_forms(spark, tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    setup = time.perf_counter() - started

    def once(query: object) -> float:
        begin = time.perf_counter()
        forms = Forms(**{n: spark.read.parquet(p) for n, p in paths.items()})
        result: DataFrame = query(QuarterBilling(forms, Period.quarter(derived.QUARTER)))
        result.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    rounds = [
        {name: once(query) for name, query in QUERIES.items()}
        for _ in range(WARM_UP + ROUNDS)
    ]
    seconds = {
        name: round(statistics.median(r[name] for r in rounds[WARM_UP:]), 3)
        for name in QUERIES
    }
    print(
        json.dumps(
            {
                "metric": "sum of warm medians over the headline reports",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "setup_sec": round(setup, 3),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
