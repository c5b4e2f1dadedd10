"""Report tables: summary, totals, bills."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterbill.functions import text
from quarterbill.functions.exact import exact_sum
from quarterbill.functions.periods import Period
from quarterbill.functions.policy import Policy
from quarterbill.operators import members as m
from quarterbill.operators.spread import stage

SUMMARY_COLUMNS = [
    "pi",
    "email",
    "storage_amount",
    "storage_price",
    "billed_power_users",
    "compute_price",
    "total_price",
    "speed_code",
]

# Column titles and wording of a bill.
TITLES = [
    "Name", "Start Date", "End Date", "Quantity", "Unit Price", "Quarter", "Amount",
]
STORAGE_LINE, USER_LINE, SUBTOTAL_LINE, BALANCE_LINE = 1, 2, 3, 4
LINE_FIELDS = [
    "name", "start_date", "end_date", "quantity", "unit_price", "share", "amount",
]
USERS_IN_PART = 5_000  # layout: power users on one part of a bill


def summary(charges: DataFrame) -> DataFrame:
    """One row per billable project."""
    return charges.select(*SUMMARY_COLUMNS)


def totals(charges: DataFrame) -> DataFrame:
    """Grand totals and means per billable project, one row; the same bits in any order of rows."""
    prices = {
        "storage": "storage_price", "compute": "compute_price", "overall": "total_price",
    }
    return charges.agg(
        *[F.expr(f"coalesce({exact_sum(c)}, 0D) AS total_{n}") for n, c in prices.items()],
        *[F.expr(f"try_divide({exact_sum(c)}, count({c})) AS mean_{n}") for n, c in prices.items()],
    )


def document_name(quarter: dt.date) -> Column:
    """Name of a bill's text."""
    return F.concat(
        F.lit("pi-"), F.col("pi"),
        F.lit("_started-"), F.col("open_date").cast("string"),
        F.lit(f"_quarter-{quarter.isoformat()}_bill.txt"),
    )


def bill_heads(
    charges: DataFrame, period: Period, policy: Policy, bill_date: dt.date
) -> DataFrame:
    """What a bill says once: one row per billable project."""
    return charges.select(
        "project_id",
        document_name(period.start).alias("doc_name"),
        F.col("pi_full_name").alias("pi_name"),
        F.struct(
            text.long_date(F.lit(period.start)).alias("start"),
            text.long_date(F.lit(period.end)).alias("end"),
            text.long_date(F.lit(bill_date)).alias("bill"),
        ).alias("dates"),
        F.struct(
            text.long_date(F.col("open_date")).alias("timestamp"),
            F.col("storage_end").alias("amount"),
            text.money(F.lit(policy.storage_per_tb)).alias("price"),
            text.money(F.col("storage_price")).alias("subtotal"),
        ).alias("storage"),
        "power_users",
        text.money(F.col("compute_price")).alias("power_users_subtotal"),
        text.money(F.col("total_price")).alias("total"),
        "speed_code",
    )


def bill_users(priced: DataFrame, period: Period, policy: Policy) -> DataFrame:
    """What a bill says per power user; a person's terms stay together."""
    return priced.select(
        "project_id",
        document_name(period.start).alias("doc_name"),
        "power_users",
        "first_start",
        "email",
        F.struct(
            F.col("name").alias("last_name"),
            F.transform("terms", lambda t: text.long_date(t["start"])).alias(
                "start_date"
            ),
            F.transform("terms", lambda t: text.long_date_or_open(t["end"])).alias(
                "end_date"
            ),
            text.money(F.col("price") / policy.year_share).alias("price"),
            text.money(F.col("price")).alias("subtotal"),
        ).alias("user"),
    )


def _line(section: int, **cells: Column) -> Column:
    blank = F.lit("")
    return F.struct(
        F.lit(section).alias("section"),
        *[cells.get(name, blank).alias(name) for name in LINE_FIELDS],
    )


def _dollars(amount: Column) -> Column:
    return F.concat(F.lit("$"), amount)


def _head_lines(policy: Policy) -> list[Column]:
    share = F.lit(str(policy.year_share))
    return [
        _line(
            STORAGE_LINE,
            name=F.col("pi_name"),
            start_date=F.col("storage.timestamp"),
            end_date=F.lit(text.OPEN_END),
            quantity=F.concat(text.plain_number(F.col("storage.amount")), F.lit(" TB")),
            unit_price=_dollars(F.col("storage.price")),
            share=share,
            amount=_dollars(F.col("storage.subtotal")),
        ),
        _line(
            SUBTOTAL_LINE,
            name=F.lit("Subtotal"),
            quantity=F.concat(F.col("power_users").cast("string"), F.lit(" Power Users")),
            share=share,
            amount=_dollars(F.col("power_users_subtotal")),
        ),
        _line(
            BALANCE_LINE,
            name=F.lit("Balance Due"),
            amount=_dollars(F.col("total")),
        ),
    ]


def _user_lines(user: Column, policy: Policy) -> Column:
    """One line per term; the first carries name and price, later ones the dates."""

    def line(start: Column, place: Column) -> Column:
        def on_first(cell: Column) -> Column:
            return F.when(place == 0, cell).otherwise("")

        return _line(
            USER_LINE,
            name=on_first(user["last_name"]),
            start_date=start,
            end_date=F.get(user["end_date"], place),
            quantity=on_first(F.lit("1 Power User")),
            unit_price=on_first(_dollars(user["price"])),
            share=on_first(F.lit(str(policy.year_share))),
            amount=on_first(_dollars(user["subtotal"])),
        )

    return F.transform(user["start_date"], line)


def bill_lines(heads: DataFrame, users: DataFrame, policy: Policy) -> DataFrame:
    """Every bill, one row per line; no bill is ever gathered in one place.

    Lines sort by (doc_name, project_id, section, user_start, user_email, place).
    """
    keys = ["project_id", "doc_name"]
    fixed = heads.select(
        *keys,
        F.explode(F.array(*_head_lines(policy))).alias("line"),
    ).select(
        *keys,
        "line.section",
        F.lit(None).cast("date").alias("user_start"),
        F.lit(None).cast("string").alias("user_email"),
        F.lit(0).alias("place"),
        *[f"line.{name}" for name in LINE_FIELDS],
    )
    per_user = users.select(
        *keys,
        F.col("first_start").alias("user_start"),
        F.col("email").alias("user_email"),
        F.posexplode(_user_lines(F.col("user"), policy)).alias("place", "line"),
    ).select(
        *keys,
        "line.section",
        "user_start",
        "user_email",
        "place",
        *[f"line.{name}" for name in LINE_FIELDS],
    )
    return fixed.unionByName(per_user)


def numbered_users(users: DataFrame) -> DataFrame:
    """Users with `number`, their place in their project's bill, from 0.

    Rows are sorted by range, counted per project and range, and placed after the counts
    before them, so that no task holds a whole project.
    """
    order = ["project_id", "first_start", "email"]
    placed = stage(
        users.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id())
    )
    earlier = (
        Window.partitionBy("project_id")
        .orderBy("_range")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranges = (
        placed.groupBy("project_id", "_range")
        .agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    )
    return (
        placed.join(ranges, ["project_id", "_range"])
        .withColumn("number", F.col("_at") - F.col("_first") + F.col("_before"))
        .drop("_range", "_at", "_first", "_n", "_before")
    )


def bills(heads: DataFrame, users: DataFrame, users_in_part: int = USERS_IN_PART) -> DataFrame:
    """Nested bills, one row per project and part.

    A part holds `users_in_part` power users, the last what is left; a bill without any has
    one part. Every part repeats the fields of the head.
    """
    part = (F.floor(F.col("number") / users_in_part) + 1).cast("int")
    nested = (
        numbered_users(users)
        .groupBy("project_id", part.alias("part_no"))
        .agg(
            F.transform(
                F.sort_array(F.collect_list(F.struct("number", "user"))),
                lambda entry: entry["user"],
            ).alias("users")
        )
    )
    joined = heads.join(nested, "project_id", "left")
    return joined.select(
        "project_id",
        "doc_name",
        F.coalesce("part_no", F.lit(1)).alias("part_no"),
        F.greatest(F.ceil(F.col("power_users") / users_in_part), F.lit(1))
        .cast("int")
        .alias("parts"),
        "pi_name",
        "dates",
        "storage",
        F.coalesce("users", F.array()).alias("power_users"),
        F.col("power_users").alias("power_user_count"),
        "power_users_subtotal",
        "total",
        "speed_code",
    )


def bill_documents(nested: DataFrame, policy: Policy) -> DataFrame:
    """Rendered bills: name, part and text; the parts of a bill in order are its text."""

    def rendered(line: Column) -> Column:
        return F.concat_ws(" | ", *[line[name] for name in LINE_FIELDS])

    counted = nested.withColumnRenamed("power_users", "users").withColumnRenamed(
        "power_user_count", "power_users"
    )
    storage, subtotal, balance = (rendered(line) for line in _head_lines(policy))
    user_lines = F.flatten(
        F.transform(
            "users",
            lambda user: F.transform(_user_lines(user, policy), rendered),
        )
    )
    head = F.array(
        F.concat(F.lit("Invoice To: "), F.col("pi_name")),
        F.concat(
            F.lit("Billing Period: "), F.col("dates.start"), F.lit("--"), F.col("dates.end")
        ),
        F.concat(F.lit("Date: "), F.col("dates.bill")),
        F.lit(" | ".join(TITLES)),
        F.lit("Storage"),
        storage,
        F.lit("Power Users"),
    )
    tail = F.array(
        subtotal,
        balance,
        F.concat(F.lit("Billed to speed code: "), F.coalesce("speed_code", F.lit(""))),
    )
    none = F.array().cast("array<string>")
    body = F.array_join(
        F.concat(
            F.when(F.col("part_no") == 1, head).otherwise(none),
            user_lines,
            F.when(F.col("part_no") == F.col("parts"), tail).otherwise(none),
        ),
        "\n",
    )
    return counted.select("project_id", "doc_name", "part_no", body.alias("body"))


def power_user_list(of_kept: DataFrame) -> DataFrame:
    """Name and email, one row per project and term."""
    return m.one_row_per_term(of_kept).select("name", "email")
