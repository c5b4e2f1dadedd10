"""The two programs: bill a quarter, and list power users over any days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from quarterbill.functions.periods import Period
from quarterbill.functions.policy import Policy
from quarterbill.operators.spread import stage, staged_steps
from quarterbill.plans import reports
from quarterbill.plans.billing import QuarterBilling, today
from quarterbill.sources import sinks
from quarterbill.sources.event_tables import EventTables
from quarterbill.sources.forms import Forms
from quarterbill.sources.publish import publish


def bill_quarter(
    forms: Forms | EventTables,
    *,
    quarter_start: str | dt.date,
    out_dir: str,
    policy: Policy | None = None,
    bill_date: dt.date | None = None,
) -> DataFrame:
    """Publish summary, bill lines and bill texts of a quarter as one; return the totals.

    The priced projects and users are computed once and staged for all four. The reports
    are read with `read_report`.
    """
    policy = policy or Policy()
    period = Period.quarter(quarter_start, policy)
    run = QuarterBilling(forms, period, policy)
    spark = run.forms.pi.sparkSession
    with staged_steps(spark):
        charges = stage(run.charges_from(run.staged_candidates))
        heads = reports.bill_heads(charges, period, policy, bill_date or today())
        users = stage(reports.bill_users(run.priced_members, period, policy))
        lines = reports.bill_lines(heads, users, policy)
        documents = reports.bill_documents(reports.bills(heads, users), policy)
        publish(
            spark,
            {
                "summary": sinks.sorted_summary(charges),
                "bill_lines": sinks.sorted_bill_lines(lines),
                "bills": documents,
            },
            period.start,
            out_dir,
        )
        totals = reports.totals(charges)
        return spark.createDataFrame([totals.first()], totals.schema)  # one row


def list_power_users(
    forms: Forms | EventTables, *, start: str | dt.date, end: str | dt.date, out_path: str
) -> DataFrame:
    """Write name and email of everybody with a day of power use; return the list."""
    run = QuarterBilling(forms, Period.between(start, end))
    spark = run.forms.pi.sparkSession
    with staged_steps(spark):
        users = run.power_user_list()
        sinks.write_power_user_list(users, out_path)
    return spark.read.schema(users.schema).csv(out_path, header=True)
