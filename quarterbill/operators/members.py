"""Who used a PI's project in a period, and for how many days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterbill.functions.periods import Period
from quarterbill.operators.spread import spread_join


def _days_inside(start: str, end: str, period: Period) -> str:
    """Days of a closed interval with an optional end that lie in the period."""
    last = f"least({end}, date'{period.end}')"
    first = f"greatest({start}, date'{period.start}')"
    return f"greatest(date_diff({last}, {first}) + 1, 0)"


def in_period(segment_rows: DataFrame, period: Period) -> DataFrame:
    """Segments with a day in the period, with their days and those of their term."""
    return (
        segment_rows.selectExpr(
            "*",
            _days_inside("from_date", "to_date", period) + " AS days",
            _days_inside("start", "end", period) + " AS active_days",
        )
        .where("days > 0")
        .selectExpr(
            "*",
            """sum(if(power_user, days, 0)) OVER (PARTITION BY email, term_no)
               AS power_days""",
        )
    )


def memberships(rows: DataFrame) -> DataFrame:
    """One row per PI and person; a person's terms in one period are few.

    Active and power days count every day of the terms that qualify, whichever PI the
    person had on that day.
    """
    term = ["start", "term_no", "end", "name", "active_days", "power_days"]
    return (
        rows.where("pi_name IS NOT NULL")
        .select("email", F.col("pi_name").alias("pi"), *term)
        .distinct()
        .groupBy("email", "pi")
        .agg(
            F.sum("active_days").alias("active_days"),
            F.sum("power_days").alias("power_days"),
            F.min("start").alias("first_start"),
            # Left out of the plan where a report does not list terms.
            F.sort_array(F.collect_list(F.struct(*term))).alias("terms"),
        )
        .withColumn("name", F.expr("terms[0].name"))
    )


def all_members(segment_rows: DataFrame, period: Period) -> DataFrame:
    """Everybody with a day under a PI."""
    return memberships(in_period(segment_rows, period))


def power_members(segment_rows: DataFrame, period: Period) -> DataFrame:
    """Everybody with a day under a PI as a power user."""
    return memberships(in_period(segment_rows, period).where("power_user"))


def holders(pis: DataFrame) -> DataFrame:
    """One row per PI with a kept project: the one that holds its power users."""
    return pis.where("holder_id IS NOT NULL").selectExpr(
        "pi",
        "holder_id AS project_id",
        "if(first_kept, first.open_date, second.open_date) AS open_date",
        "if(first_kept, close_date, NULL) AS close_date",
    )


def members_of_kept(members: DataFrame, pis: DataFrame, **spread: object) -> DataFrame:
    """Members of PIs that have a kept project, with the project that holds them."""
    return spread_join(
        members,
        holders(pis).select("pi", "project_id"),
        "pi",
        spread_by=["email"],
        **spread,
    )


def of_pis_with_projects(members: DataFrame, pis: DataFrame, **spread: object) -> DataFrame:
    """Members of PIs that have a kept project. All projects of a PI have the same ones."""
    return spread_join(
        members, holders(pis).select("pi"), "pi", spread_by=["email"], how="left_semi", **spread
    )


def one_row_per_term(members: DataFrame) -> DataFrame:
    """Flatten the terms of each member."""
    return members.selectExpr("* EXCEPT (terms, name)", "explode(terms) AS term").selectExpr(
        "* EXCEPT (term)", "term.name", "term.term_no", "term.start", "term.end"
    )
