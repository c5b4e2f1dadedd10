"""As-of lookups for a table of keys and dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterbill.operators.spread import spread_join


def as_of_join(
    lookups: DataFrame, intervals: DataFrame, key: str, day: str, values: list[str], **spread: object
) -> DataFrame:
    """`lookups` with the `values` that hold for their key on their day; null where none do.

    intervals: (key, from_date, to_date, values), both ends closed, a null end open; the
    intervals of a key do not overlap. Dates and intervals are merged: a key's different days
    and its interval starts are sorted together, and each day takes the last start before
    it. That window has one row per day and start of a key, which the calendar bounds; the lookups
    themselves, of which a key and day may have any number, are joined back in pieces.
    A null key or day finds nothing; every lookup is kept once.
    """
    rows = lookups.withColumn("_at", F.struct(F.col(key).alias("key"), F.col(day).alias("day")))
    starts = intervals.selectExpr(
        f"{key} AS key", "from_date AS day", f"struct(to_date, {', '.join(values)}) AS held"
    )
    days = rows.where(F.col(key).isNotNull() & F.col(day).isNotNull()).select("_at.key", "_at.day").distinct()
    found = (
        starts.where("key IS NOT NULL AND day IS NOT NULL")
        .withColumn("asks", F.lit(False))
        .unionByName(days.withColumn("asks", F.lit(True)), allowMissingColumns=True)
        .selectExpr(
            "key", "day", "asks",
            """last(held) IGNORE NULLS OVER (PARTITION BY key ORDER BY day, asks
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS held""",
        )
        .where("asks AND (held.to_date IS NULL OR held.to_date >= day)")
        .selectExpr("struct(key, day) AS _at", *[f"held.{v} AS {v}" for v in values])
    )
    joined = spread_join(rows, found, "_at", spread_by=lookups.columns, how="left", **spread)
    return joined.select(*lookups.columns, *values)
