"""What a quarter costs: storage per project, power users per project and person."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterbill.functions.periods import Period
from quarterbill.functions.policy import Policy
from quarterbill.operators import members as m
from quarterbill.operators.spread import spread_join


def is_billable(period: Period) -> str:
    """Opened by the end of the period, and not closed by the late cutoff."""
    return (
        f"open_date <= date'{period.end}'"
        f" AND (close_date IS NULL OR close_date > date'{period.late_cutoff}')"
    )


def storage_charges(projects: DataFrame, period: Period, policy: Policy) -> DataFrame:
    """Billable projects with their storage amount and price.

    The amount is the lesser of both cutoffs, and none when opened after the first.
    """
    return (
        projects.where(is_billable(period))
        .selectExpr(
            "*",
            f"""if(open_date > date'{period.early_cutoff}', 0D,
                   least(storage_early, storage_late)) AS storage_amount""",
        )
        .withColumn(
            "storage_price",
            F.col("storage_amount") * policy.storage_per_tb * policy.year_share,
        )
    )


def charged(members: DataFrame, period: Period) -> DataFrame:
    """Mark the members with enough days as a power user."""
    return members.selectExpr("*", f"power_days >= {period.min_days} AS charged")


def compute_per_pi(members: DataFrame, policy: Policy) -> DataFrame:
    """One row per PI: counts, the price, and who pays the first-user price.

    The price needs only the count of charged users, so nothing is ranked.
    """
    first = policy.first_power_user * policy.year_share
    more = policy.additional_power_user * policy.year_share
    return members.groupBy("pi").agg(
        F.expr("count(*) AS power_users"),
        F.expr("count_if(charged) AS billed_power_users"),
        F.expr(
            f"""CASE WHEN count_if(charged) = 0 THEN 0D
                     ELSE {first}D + (count_if(charged) - 1) * {more}D END
                AS compute_price"""
        ),
        F.expr(
            "(min(struct(first_start, email)) FILTER (WHERE charged)).email"
            " AS first_charged"
        ),
    )


def priced_members(
    members: DataFrame,
    pis: DataFrame,
    period: Period,
    policy: Policy,
    **spread: object,
) -> DataFrame:
    """One row per power user of each billable project, with tier and price."""
    per_pi = compute_per_pi(members, policy)
    targets = (
        m.holders(pis)
        .where(is_billable(period))
        .select("pi", "project_id", "open_date")
        .join(per_pi.select("pi", "power_users", "first_charged"), "pi")
    )
    return (
        spread_join(
            members,
            targets,
            "pi",
            spread_by=["email"],
            counts=per_pi.select("pi", F.col("power_users").alias("n")),
            **spread,
        )
        .selectExpr(
            "* EXCEPT (first_charged)",
            """CASE WHEN NOT charged THEN 'none' WHEN email = first_charged THEN 'first'
                    ELSE 'additional' END AS tier""",
        )
        .selectExpr(
            "*",
            f"""CASE tier WHEN 'first' THEN {policy.first_power_user * policy.year_share}D
                     WHEN 'additional'
                     THEN {policy.additional_power_user * policy.year_share}D
                     ELSE 0D END AS price""",
        )
    )


def quarter_charges(projects: DataFrame, period: Period, policy: Policy) -> DataFrame:
    """Billable projects with storage, compute and total price.

    `projects` carries the columns of `compute_per_pi`.
    """
    return (
        storage_charges(projects, period, policy)
        .na.fill(0, ["power_users", "billed_power_users", "compute_price"])
        .selectExpr("*", "storage_price + compute_price AS total_price")
    )
