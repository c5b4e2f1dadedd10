"""Replay of the project log: open, update, close, and look up as of a date.

No step groups rows by PI before the rows are reduced: updates are first made distinct,
then summed per PI and day, so that what reaches one PI is bounded by the calendar.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterbill.functions.exact import exact_sum, exact_sum_over
from quarterbill.functions.periods import Period, active_on
from quarterbill.operators import events
from quarterbill.operators.spread import spread_join, stage
from quarterbill.sources.forms import Forms


@dataclass(frozen=True, kw_only=True)
class ProjectLog:
    """The reduced project log of one period.

    `opened`: one row per project; `pis`: one row per PI with its first two projects,
    the close date of the first and which of the two holds the PI's power users;
    `days`: one row per PI and day with what that day added.
    """

    opened: DataFrame
    pis: DataFrame
    days: DataFrame


def _cell(field: str) -> str:
    """A field as a part of `project_id`: no two values, null and blank among them, alike."""
    text = f"cast({field} AS string)"
    escaped = rf"replace(replace({text}, r'\', r'\\'), '|', r'\|')"
    return rf"CASE WHEN {field} IS NULL THEN '' WHEN {text} = '' THEN r'\' ELSE {escaped} END"


def opened_projects(forms: Forms, period: Period) -> DataFrame:
    """One row per project; equal requests of one day are one project."""
    fields = ("pi", "open_date", "email", "speed_code", "storage")
    return (
        events.pi_requests(forms, period)
        .where("pi IS NOT NULL")
        .groupBy("pi", F.col("date").alias("open_date"), "email", "speed_code", "storage")
        .agg(F.min("ts").alias("open_ts"))
        .selectExpr(
            "*",
            f"concat_ws('|', {', '.join(map(_cell, fields))}) AS project_id",
        )
    )


def first_projects(opened: DataFrame) -> DataFrame:
    """One row per PI: its first and second project in opening order.

    The rank filter is applied before the shuffle too, so a PI with any number of
    projects sends two of them per task.
    """
    project = "struct(project_id, open_date, open_ts, email, speed_code, storage)"
    return (
        opened.selectExpr(
            "pi",
            f"{project} AS project",
            """row_number() OVER (PARTITION BY pi ORDER BY open_date, open_ts, email,
                                  speed_code, storage) AS place""",
        )
        .where("place <= 2")
        .groupBy("pi")
        .agg(
            F.expr("any_value(project) FILTER (WHERE place = 1) AS first"),
            F.expr("any_value(project) FILTER (WHERE place = 2) AS second"),
        )
    )


def closed_pis(updates: DataFrame) -> DataFrame:
    """One row per PI that asked to close: the time of the last such request."""
    return (
        updates.where("account_closed AND pi IS NOT NULL")
        .groupBy("pi")
        .agg(F.max("ts").alias("closed_ts"))
    )


def pi_table(
    opened: DataFrame, closed: DataFrame, period: Period, firsts: DataFrame | None = None
) -> DataFrame:
    """One row per PI. A closure always closes the PI's first project.

    `first_kept`: still open on the first day of the period, or closed on it or later.
    `holder_id`: the first kept project, to which all the PI's power users belong.
    """
    return (
        (first_projects(opened) if firsts is None else firsts)
        .join(closed, "pi", "left")
        .selectExpr(
            "pi",
            "first",
            "second",
            "CASE WHEN closed_ts >= first.open_ts THEN cast(closed_ts AS date) END"
            " AS close_date",
        )
        .selectExpr(
            "*", f"coalesce(close_date >= date'{period.start}', true) AS first_kept"
        )
        .selectExpr(
            "*", "if(first_kept, first.project_id, second.project_id) AS holder_id"
        )
    )


def distinct_updates(firsts: DataFrame, updates: DataFrame) -> DataFrame:
    """Dated updates per PI as a set: equal (date, code, storage) count once.

    The opening of the PI's first project is one of them. `update_ts` is the earliest
    time at which an update form, not the opening, asked for it.
    """
    opening = firsts.selectExpr(
        "pi",
        "first.open_date AS date",
        "first.speed_code",
        "first.storage",
        "first.open_ts AS ts",
        "cast(NULL AS timestamp_ntz) AS update_ts",
    )
    asked = updates.where("pi IS NOT NULL").selectExpr(
        "pi", "date", "speed_code", "storage", "ts", "ts AS update_ts"
    )
    return (
        opening.unionByName(asked)
        .groupBy("pi", "date", "speed_code", "storage")
        .agg(F.max("ts").alias("ts"), F.min("update_ts").alias("update_ts"))
    )


def update_days(distinct: DataFrame) -> DataFrame:
    """One row per PI and day: storage added, the day's last speed code."""
    return distinct.groupBy("pi", "date").agg(
        F.expr(exact_sum("coalesce(storage, 0D)")).alias("day_storage"),
        F.expr(
            "max(struct(date, ts, speed_code)) FILTER (WHERE speed_code <> '') AS code"
        ),
        F.min("update_ts").alias("update_ts"),
    )


def read_log(forms: Forms, period: Period) -> ProjectLog:
    """Reduce the project forms of a period."""
    opened = opened_projects(forms, period)
    updates = events.pi_updates(forms, period)
    pis = pi_table(opened, closed_pis(updates), period)
    distinct = distinct_updates(first_projects(opened), updates)
    return ProjectLog(opened=opened, pis=pis, days=update_days(distinct))


def staged_log(log: ProjectLog) -> ProjectLog:
    """The log written once, for reports that read it several times."""
    return ProjectLog(opened=stage(log.opened), pis=stage(log.pis), days=stage(log.days))


def _cutoffs(period: Period) -> dict[str, str]:
    days = {"storage_end": f"date'{period.end}'"}
    if period.early_cutoff:
        days["storage_early"] = f"date'{period.early_cutoff}'"
        days["storage_late"] = f"date'{period.late_cutoff}'"
    return days


def first_project_state(log: ProjectLog, period: Period) -> DataFrame:
    """One row per PI: storage of the first project at the cutoffs, and its code.

    Updates dated before the project opened are left to the checks. At the end of the
    period the storage of a closed project is that of its close date.
    """
    # A project billed at a cutoff is open then, so the close date only bears on the end.
    last = {name: day for name, day in _cutoffs(period).items()}
    last["storage_end"] = f"least({last['storage_end']}, close_date)"
    sums = [
        F.expr(f"coalesce({exact_sum('day_storage', f'date <= {day}')}, 0D) AS {name}")
        for name, day in last.items()
    ]
    carried = ["first", "second", "close_date", "first_kept", "holder_id"]
    return (
        log.days.join(log.pis, "pi")
        .where("date >= first.open_date")
        .groupBy("pi")
        .agg(
            *[F.any_value(name).alias(name) for name in carried],
            *sums,
            F.expr("max(code).speed_code AS speed_code"),
        )
    )


def projects(
    log: ProjectLog, period: Period, per_holder: DataFrame | None = None
) -> DataFrame:
    """Projects kept for the period, one row each.

    `per_holder` may bring columns keyed by `pi`; they go to the project that holds the
    PI's power users and are null on all others.
    """
    state = first_project_state(log, period)
    extra = []
    if per_holder is not None:
        state = state.join(per_holder, "pi", "left")
        extra = [c for c in per_holder.columns if c != "pi"]
    cutoffs = _cutoffs(period)

    # At most two projects of a PI differ from what their own request says, so the
    # state goes back to the projects by project and not by PI.
    marks = (
        state.selectExpr(
            "*",
            """explode(array(
                 struct(first.project_id, first.project_id <=> holder_id AS holds,
                        true AS is_first),
                 struct(second.project_id, second.project_id <=> holder_id AS holds,
                        false AS is_first))) AS mark""",
        )
        .where("mark.project_id IS NOT NULL")
        .selectExpr(
            "mark.project_id",
            "mark.holds",
            "mark.is_first",
            "if(mark.is_first, close_date, NULL) AS close_date",
            "NOT mark.is_first OR first_kept AS kept",
            "speed_code AS state_code",
            *[f"{c} AS state_{c}" for c in cutoffs],
            *[f"if(mark.holds, {c}, NULL) AS {c}" for c in extra],
        )
    )
    return (
        log.opened.join(marks, "project_id", "left")
        .where("coalesce(kept, true)")
        .selectExpr(
            "project_id",
            "pi",
            "pi AS pi_full_name",
            "email",
            "open_date",
            "open_ts",
            "close_date",
            "coalesce(holds, false) AS has_power_users",
            *[
                f"CASE WHEN is_first THEN state_{c} WHEN open_date <= {day}"
                f" THEN coalesce(storage, 0D) ELSE 0D END AS {c}"
                for c, day in cutoffs.items()
            ],
            "if(coalesce(is_first, false), state_code, speed_code) AS speed_code",
            *extra,
        )
    )


def active(project_rows: DataFrame, day: dt.date) -> DataFrame:
    """Projects open on a day."""
    return project_rows.where(active_on(f"date'{day}'", "open_date", "close_date"))


def storage_history(log: ProjectLog) -> DataFrame:
    """Storage of every kept project as validity intervals, for any as-of lookup.

    The windows run over the days of one PI, which the calendar bounds.
    """
    by_day = "PARTITION BY pi ORDER BY date"
    changes = (
        log.days.join(
            log.pis.where("first_kept").selectExpr(
                "pi", "first.project_id", "first.open_date", "close_date"
            ),
            "pi",
        )
        .where("date = open_date OR (date > open_date AND day_storage <> 0)")
        .selectExpr(
            "project_id",
            "pi",
            "date AS from_date",
            f"least(date_sub(lead(date) OVER ({by_day}), 1), close_date) AS to_date",
            f"""sum(day_storage) OVER ({by_day}
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS storage""",
        )
        .where("to_date IS NULL OR to_date >= from_date")
    )
    firsts = log.pis.selectExpr("first.project_id")
    others = log.opened.join(firsts, "project_id", "left_anti").selectExpr(
        "project_id",
        "pi",
        "open_date AS from_date",
        "cast(NULL AS date) AS to_date",
        "coalesce(storage, 0D) AS storage",
    )
    return changes.unionByName(others)


def project_history(log: ProjectLog) -> DataFrame:
    """Storage and speed code of every kept project as validity intervals.

    The windows run over the days of one PI, which the calendar bounds.
    """
    by_day = "PARTITION BY pi ORDER BY date"
    so_far = f"({by_day} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    changes = (
        log.days.join(
            log.pis.where("first_kept").selectExpr(
                "pi", "first.project_id", "first.open_date", "close_date"
            ),
            "pi",
        )
        .where("date >= open_date")
        .selectExpr(
            "project_id",
            "pi",
            "date AS from_date",
            f"least(date_sub(lead(date) OVER ({by_day}), 1), close_date) AS to_date",
            f"{exact_sum_over('day_storage', so_far)} AS storage",
            f"last(code.speed_code) IGNORE NULLS OVER {so_far} AS speed_code",
        )
        .where("to_date IS NULL OR to_date >= from_date")
    )
    firsts = log.pis.selectExpr("first.project_id")
    others = log.opened.join(firsts, "project_id", "left_anti").selectExpr(
        "project_id",
        "pi",
        "open_date AS from_date",
        "cast(NULL AS date) AS to_date",
        "coalesce(storage, 0D) AS storage",
        "speed_code",
    )
    return changes.unionByName(others)


def storage_on(history: DataFrame, day: dt.date) -> DataFrame:
    """Storage on a day of every project open then."""
    return history.where(active_on(f"date'{day}'", "from_date", "to_date")).select(
        "project_id", "pi", "storage"
    )


def project_updates(forms: Forms, period: Period) -> DataFrame:
    """The distinct dated updates of every project, joined to the project.

    Updates go to the PI's first project; any further project has its opening only.
    """
    opened = opened_projects(forms, period)
    firsts = first_projects(opened)
    distinct = stage(distinct_updates(firsts, events.pi_updates(forms, period)))
    targets = firsts.selectExpr("pi", "first.project_id", "first.open_date")
    to_first = (
        spread_join(
            distinct, targets, "pi", spread_by=["date", "speed_code", "storage"]
        )
        .where("date >= open_date")
        .select("project_id", "pi", "date", "speed_code", "storage")
    )
    others = opened.join(targets.select("project_id"), "project_id", "left_anti")
    return to_first.unionByName(
        others.selectExpr(
            "project_id", "pi", "open_date AS date", "speed_code", "storage"
        )
    )
