"""Data-quality rules. Each yields rows (rule, entity, key, event_date, detail)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quarterbill.functions.periods import Period, day_after
from quarterbill.operators import members, pricing, projects, terms
from quarterbill.operators.spread import spread_join, stage
from quarterbill.sources.forms import Forms
from quarterbill.sources.schemas import UNREADABLE


class ViolationsFound(Exception):
    """Raised in strict mode when any rule has a row; `counts` has the rows of each rule."""

    def __init__(self, counts: dict[str, int]) -> None:
        super().__init__("the forms break a data-quality rule: " + ", ".join(f"{r} {n}" for r, n in sorted(counts.items())))
        self.counts = counts


def _finding(
    df: DataFrame, rule: str, entity: str, key: str, day: str, detail: str = "NULL"
) -> DataFrame:
    return df.selectExpr(
        f"'{rule}' AS rule",
        f"'{entity}' AS entity",
        f"cast({key} AS string) AS key",
        f"cast({day} AS date) AS event_date",
        f"cast({detail} AS string) AS detail",
    )


def _rules(forms: Forms, period: Period) -> list[tuple[DataFrame, str, list[tuple]]]:
    """Per form: its rows, its time, and the rules as (condition, rule, entity, key, detail)."""
    no_name = ("last_name IS NULL", "missing_key", "project", "email", "'last_name'")
    no_user = ("email IS NULL", "missing_key", "user", "last_name", "'email'")
    whole, short = day_after(period.end), period.end  # user forms stop before the last day
    return [
        (
            forms.pi, "start_timestamp", whole,
            [
                no_name,
                ("email IS NULL", "missing_key", "project", "last_name", "'email'"),
                ("storage IS NULL", "missing_storage", "project", "last_name", "NULL"),
                ("speed_code IS NULL", "missing_speed_code", "project", "last_name", "NULL"),
            ],
        ),
        (
            forms.pi_update, "timestamp", whole,
            [no_name, ("account_closed AND email IS NULL", "missing_key", "project", "last_name", "'email'")],
        ),
        (
            forms.user, "start_timestamp", short,
            [
                no_user,
                ("pi_last_name IS NULL", "missing_pi", "user", "email", "NULL"),
                ("power_user IS NULL", "missing_power_user", "user", "email", "NULL"),
            ],
        ),
        (forms.user_update, "timestamp", short, [no_user]),
    ]


def form_findings(forms: Forms, period: Period) -> DataFrame:
    """Forms that lack a field the rules need, or have a cell that cannot be read.

    Every form is read once: the rules that a row breaks are an array, which is exploded.
    """
    found = []
    for form, stamp, end, rules in _rules(forms, period):
        checks = [(f"{stamp} < timestamp_ntz'{end}' AND ({when})", *rest) for when, *rest in rules]
        checks.append((f"{stamp} IS NULL", "missing_timestamp", "form", "email", "NULL"))
        if UNREADABLE in form.columns:
            checks.append((f"{UNREADABLE} IS NOT NULL", "unreadable_cell", "form", "email", UNREADABLE))
        broken = ", ".join(
            f"""if({when}, named_struct('rule', '{rule}', 'entity', '{entity}', 'key', {key},
                   'event_date', cast({stamp} AS date), 'detail', cast({detail} AS string)), NULL)"""
            for when, rule, entity, key, detail in checks
        )
        found.append(form.selectExpr(f"inline(array_compact(array({broken})))"))
    return reduce(DataFrame.unionByName, found)


#: The rules.
RULES = (
    "missing_key", "missing_storage", "missing_speed_code", "missing_pi", "missing_power_user",
    "missing_timestamp", "unreadable_cell", "user_update_without_user", "end_before_start",
    "pi_update_without_pi", "inactive_at_period_end", "closure_before_term", "unattached_power_user",
)


def raise_if_any(found: DataFrame) -> DataFrame:
    """The findings, written once; `ViolationsFound` if there are any.

    The rows of each rule are counted while they are written, so nothing runs twice.
    """
    seen = Observation()
    staged = stage(found.observe(seen, *[F.count_if(F.col("rule") == r).alias(r) for r in RULES]))
    counts = {rule: n for rule, n in seen.get.items() if n}
    if counts:
        raise ViolationsFound(counts)
    return staged


def replay_findings(walked: DataFrame) -> DataFrame:
    """Updates for unknown persons, and terms that would end before they start."""
    too_early = """
        CASE WHEN creates THEN backdated
             WHEN reopens THEN NOT first_sets_end OR backdated
             ELSE coalesce(lowest_before < prior_start, false)
                  OR (divides AND (NOT split_sets_end OR splits > 1
                                   OR coalesce(lowest_after < date, false)))
        END"""
    found = walked.selectExpr(
        "email",
        "date",
        f"""explode(array_compact(array(
              if(NOT known OR (creates AND update_first), 'user_update_without_user', NULL),
              if(known AND {too_early}, 'end_before_start', NULL)))) AS rule""",
    )
    return found.selectExpr(
        "rule",
        "'user' AS entity",
        "email AS key",
        "date AS event_date",
        "cast(NULL AS string) AS detail",
    )


def project_findings(
    log: projects.ProjectLog, kept: DataFrame, period: Period
) -> DataFrame:
    """Updates without a project, and projects billed though closed by the end."""
    orphans = log.days.join(
        log.pis.selectExpr("pi", "first.open_ts"), "pi", "left"
    ).where("update_ts IS NOT NULL AND coalesce(update_ts < open_ts, true)")
    found = _finding(orphans, "pi_update_without_pi", "project", "pi", "date")
    if period.late_cutoff is None:
        return found
    closed = kept.where(pricing.is_billable(period)).where(
        f"close_date < date'{period.end}'"
    )
    return found.unionByName(
        _finding(
            closed, "inactive_at_period_end", "project", "project_id", "close_date"
        )
    )


def closure_findings(kept_segments: DataFrame, pis: DataFrame) -> DataFrame:
    """Closures whose PI has no term to end, or only one that starts later."""
    latest = kept_segments.groupBy("email").agg(F.max("start").alias("latest_start"))
    closed = terms.close_dates(pis).selectExpr("email", "explode(closes) AS close_date")
    return (
        closed.join(latest, "email", "left")
        .where("coalesce(close_date < latest_start, true)")
        .selectExpr(
            "if(latest_start IS NULL, 'user_update_without_user', 'closure_before_term')"
            " AS rule",
            "'user' AS entity",
            "email AS key",
            "close_date AS event_date",
            "'project closure' AS detail",
        )
    )


def unattached(power_rows: DataFrame, pis: DataFrame, **spread: object) -> DataFrame:
    """Power users whose PI has no kept project; project dates do not matter."""
    found = spread_join(
        power_rows,
        members.holders(pis).select("pi"),
        "pi",
        spread_by=["email"],
        how="left_anti",
        **spread,
    )
    return _finding(
        found, "unattached_power_user", "user", "email", "first_start", "pi"
    )
