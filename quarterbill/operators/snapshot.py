"""Replay from a snapshot: the log before a day, reduced to what later events can meet.

A person's days before the latest term can change nothing any more: an earlier term has
ended, and only its number and the values it handed on count. So a snapshot has the days of
each person's latest term, of which the first stands for all that came before. A PI has
one row per project, the last closure and one row per day. Both are bounded by the
calendar, not by the events, and are merged with newer events by union.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterbill.functions.periods import Period
from quarterbill.operators import events, projects, terms
from quarterbill.sources.forms import Forms

#: Columns of a day that a new term's first day does not need: all is in its end and values.
_WITHIN = {
    "split_end": "date",
    "split_pi": "string",
    "split_power": "boolean",
    "lowest_before": "date",
    "lowest_after": "date",
}
OPENED = ["pi", "open_date", "email", "speed_code", "storage"]


def _until(day: dt.date) -> Period:
    """A period that lets all events before a day through."""
    return Period(start=day, end=day)


def events_before(forms: Forms, before: dt.date) -> DataFrame:
    """The user log up to the day before."""
    return events.user_events(forms, _until(before)).where(f"date < date'{before}'")


def people(log: DataFrame) -> DataFrame:
    """The days of each person's latest term in a user log.

    `term_base` is set on the term's first day: how many terms came before it. That day has the
    values that hold from then on, wherever they were given.
    """
    walked = terms.walk_days(terms.day_states(log))
    given = [
        "first_name", "marker", "after", "has_request", "update_first", "first_sets_end", "backdated",
        "if(divides, split_pi, pi_name) AS day_pi", "if(divides, split_power, power_user) AS day_power",
    ]
    return (
        terms.valued(walked, *given)
        .selectExpr("*", "max(term_no) OVER (PARTITION BY email) AS latest", "from_date = start AS begins")
        .where("term_no = latest")
        .selectExpr(
            "email",
            "from_date AS date",
            "begins OR has_request AS has_request",
            "NOT begins AND update_first AS update_first",
            "first_sets_end",
            "first_name AS name",
            "if(begins, after, marker) AS marker",
            "if(begins, pi_name, day_pi) AS pi_name",
            "if(begins, power_user, day_power) AS power_user",
            "NOT begins AND backdated AS backdated",
            *[f"cast(NULL AS {kind}) AS {name}" for name, kind in _WITHIN.items()],
            "0 AS splits",
            "false AS split_sets_end",
            "if(begins, term_no, NULL) AS term_base",
        )
    )


def resume_people(days: DataFrame, newer: DataFrame) -> DataFrame:
    """Walk on: the days of a snapshot and the newer events of the same people."""
    new_days = terms.day_states(newer).withColumn("term_base", F.lit(None).cast("bigint"))
    walked = terms.walk_days(days.unionByName(new_days))
    base = """coalesce(max(term_base) OVER (PARTITION BY email ORDER BY date
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0L)"""
    return walked.withColumn("term_no", F.expr(f"term_no + {base}")).drop("term_base")


def project_state(forms: Forms, before: dt.date) -> dict[str, DataFrame]:
    """`opened`, `closed` and `days` of the project log, from events before a day."""
    period, earlier = _until(before), f"date < date'{before}'"
    opened = projects.opened_projects(forms, period).where(f"open_{earlier}")
    updates = events.pi_updates(forms, period).where(earlier)
    distinct = projects.distinct_updates(projects.first_projects(opened), updates)
    return {"opened": opened, "closed": projects.closed_pis(updates), "days": projects.update_days(distinct)}


def resume_projects(
    state: dict[str, DataFrame], forms: Forms, period: Period, before: dt.date, late: DataFrame | None, whole: Forms | None
) -> projects.ProjectLog:
    """The project log from a snapshot and newer forms.

    late: (pi) whose events before the snapshot's day came after it was taken. These PIs'
    days are made anew from the `whole` forms.
    """
    opened = (
        state["opened"]
        .unionByName(projects.opened_projects(forms, period))
        .groupBy(*OPENED, "project_id")
        .agg(F.min("open_ts").alias("open_ts"))
    )
    updates = events.pi_updates(forms, period)
    closed = state["closed"].unionByName(projects.closed_pis(updates)).groupBy("pi").agg(F.max("closed_ts").alias("closed_ts"))
    firsts = projects.first_projects(opened)
    fresh = firsts.where(f"first.open_date >= date'{before}'")
    if late is None:
        days = state["days"].unionByName(projects.update_days(projects.distinct_updates(fresh, updates)))
    else:
        others = lambda df: df.join(late, "pi", "left_anti")
        days = others(state["days"]).unionByName(projects.update_days(projects.distinct_updates(others(fresh), others(updates))))
        every = events.pi_updates(whole, period).join(late, "pi", "left_semi")
        again = projects.distinct_updates(firsts.join(late, "pi", "left_semi"), every)
        days = days.unionByName(projects.update_days(again))
    return projects.ProjectLog(opened=opened, pis=projects.pi_table(opened, closed, period, firsts), days=days)
