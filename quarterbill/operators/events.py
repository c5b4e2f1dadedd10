"""The two event logs: what was asked for, by whom, in replay order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from quarterbill.functions.periods import Period, day_after
from quarterbill.sources.forms import Forms
from quarterbill.sources.schemas import SUBMISSION_ID

# Rank of a source among events with equal timestamps; odd ranks are updates.
USER_REQUEST, USER_UPDATE, PI_REQUEST, PI_CLOSURE = 0, 1, 2, 3


def _seq(form: DataFrame) -> str:
    if SUBMISSION_ID in form.columns:
        return f"coalesce(cast({SUBMISSION_ID} AS bigint), 0L) AS seq"
    return "0L AS seq"


def pi_requests(forms: Forms, period: Period) -> DataFrame:
    """Project requests up to and including the last day of the period."""
    return forms.pi.where(
        f"start_timestamp < timestamp_ntz'{day_after(period.end)}'"
    ).selectExpr(
        "start_timestamp AS ts",
        "cast(start_timestamp AS date) AS date",
        "email",
        "last_name AS pi",
        "speed_code",
        "storage",
        "pi_is_power_user AS power_user",
        _seq(forms.pi),
    )


def pi_updates(forms: Forms, period: Period) -> DataFrame:
    """Project updates up to and including the last day of the period."""
    return forms.pi_update.where(
        f"timestamp < timestamp_ntz'{day_after(period.end)}'"
    ).selectExpr(
        "timestamp AS ts",
        "cast(timestamp AS date) AS date",
        "email",
        "last_name AS pi",
        "speed_code",
        "new_storage AS storage",
        "account_closed",
        _seq(forms.pi_update),
    )


def user_events(forms: Forms, period: Period) -> DataFrame:
    """Every event that bears on a person: user forms, and what PI forms imply.

    User forms stop before the last day of the period; events implied by PI forms
    include it. A project request makes its PI a user; a closure ends the term of the
    person who filed it.
    """
    requests = forms.user.where(
        f"start_timestamp < timestamp_ntz'{period.end}'"
    ).selectExpr(
        "email",
        "last_name AS name",
        "pi_last_name AS pi_name",
        "power_user",
        "cast(end_timestamp AS date) AS end_date",
        "start_timestamp AS ts",
        f"{USER_REQUEST} AS src_rank",
        _seq(forms.user),
    )
    updates = forms.user_update.where(
        f"timestamp < timestamp_ntz'{period.end}'"
    ).selectExpr(
        "email",
        "last_name AS name",
        "pi_last_name AS pi_name",
        "new_power_user AS power_user",
        "cast(new_end_timestamp AS date) AS end_date",
        "timestamp AS ts",
        f"{USER_UPDATE} AS src_rank",
        _seq(forms.user_update),
    )
    from_pi = pi_requests(forms, period).selectExpr(
        "email",
        "pi AS name",
        "pi AS pi_name",
        "power_user",
        "cast(NULL AS date) AS end_date",
        "ts",
        f"{PI_REQUEST} AS src_rank",
        "seq",
    )
    from_closure = (
        pi_updates(forms, period)
        .where("account_closed")
        .selectExpr(
            "email",
            "pi AS name",
            "cast(NULL AS string) AS pi_name",
            "cast(NULL AS boolean) AS power_user",
            "date AS end_date",
            "ts",
            f"{PI_CLOSURE} AS src_rank",
            "seq",
        )
    )
    return reduce(
        DataFrame.unionByName, [requests, updates, from_pi, from_closure]
    ).selectExpr("*", "cast(ts AS date) AS date", "src_rank % 2 = 0 AS is_request")
