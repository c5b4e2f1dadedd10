"""As-of lookups against a plain search, with a hot key, gaps and nulls."""

import datetime as dt
import random

from pyspark.sql import functions as F

from quarterbill.operators.asof import as_of_join
from quarterbill.operators.spread import stage

DAY = dt.date(2020, 1, 1)


def test_lookups_against_a_plain_search(spark):
    rng = random.Random(6)
    intervals = []
    for k in range(30):
        day = DAY
        for i in range(rng.randint(0, 12)):
            day += dt.timedelta(days=rng.randint(1, 9))
            end = day + dt.timedelta(days=rng.randint(0, 6))
            if i == 11 and k % 2:
                end = None
            intervals.append((f"k{k}", day, end, i, None if i % 4 == 3 else f"v{i}"))
            day = end or day
    lookups = [(f"k{rng.randint(0, 33)}", DAY + dt.timedelta(days=rng.randint(-3, 120)), n) for n in range(2000)]
    lookups += [("k1", DAY + dt.timedelta(days=20), 0)] * 500 + [(None, DAY, 1), ("k1", None, 2), (None, None, 3)]
    found = as_of_join(
        spark.createDataFrame(lookups, "who string, on date, v int"),
        spark.createDataFrame(intervals, "who string, from_date date, to_date date, i int, held string"),
        "who", "on", ["i", "held"],
        rows_per_task=100,
    )
    assert found.columns == ["who", "on", "v", "i", "held"]

    def plain(who, on):
        for k, start, end, i, held in intervals:
            if k == who and on is not None and start <= on and (end is None or on <= end):
                return i, held
        return None, None

    want = [(*row, *plain(*row[:2])) for row in lookups]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)
    assert sum(w[3] is not None for w in want) > 300


def test_a_hot_key_is_reduced_to_its_days(spark):
    lookups = spark.range(300_000).selectExpr("'hot' AS k", "date_add(date'2020-01-01', int(id % 50)) AS day", "id")
    intervals = spark.sql("SELECT 'hot' AS k, date'2020-01-11' AS from_date, cast(NULL AS date) AS to_date, 5 AS v")
    found = as_of_join(stage(lookups), intervals, "k", "day", ["v"], rows_per_task=1000)
    counts = {r.v: r["count"] for r in found.groupBy("v").count().collect()}
    assert counts == {5: 240_000, None: 60_000}
    tasks = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert max(tasks) < 100_000  # the rows of a key and day go to several tasks
