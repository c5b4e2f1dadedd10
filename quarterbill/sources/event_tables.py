"""Canonical events as input, for records that do not come from the four forms."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterbill.sources.forms import Forms
from quarterbill.sources.schemas import FLAG, NUMBER, SUBMISSION_ID, TEXT, TIME

OPEN, UPDATE, CLOSE, REQUEST = "open", "update", "close", "request"

#: Columns and their types.
PROJECT_EVENTS = {"kind": TEXT, "ts": TIME, "email": TEXT, "pi": TEXT, "speed_code": TEXT, "storage": NUMBER, "power_user": FLAG}
USER_EVENTS = {"kind": TEXT, "ts": TIME, "email": TEXT, "name": TEXT, "pi_name": TEXT, "power_user": FLAG, "end_date": T.DateType()}
#: May be left out; breaks ties between equal times.
SEQ = "seq"


class SchemaMismatch(ValueError):
    """Raised when a table of events lacks a column or has one of another type."""


def _checked(df: DataFrame, columns: dict[str, T.DataType], table: str) -> DataFrame:
    has = {f.name: f.dataType for f in df.schema}
    wrong = [f"{c} is missing" for c in columns if c not in has]
    wrong += [f"{c} is {has[c].simpleString()}, not {t.simpleString()}" for c, t in columns.items() if c in has and has[c] != t]
    if SEQ in has and not isinstance(has[SEQ], T.IntegralType):
        wrong.append(f"{SEQ} is {has[SEQ].simpleString()}, not a whole number")
    if wrong:
        raise SchemaMismatch(f"{table}: {'; '.join(wrong)}")
    return df.withColumn(SEQ, F.col(SEQ).cast("long") if SEQ in has else F.lit(0).cast("long"))


def _of_kind(df: DataFrame, kinds: tuple[str, ...], known: tuple[str, ...]) -> DataFrame:
    """The events of some kinds; a kind that is not known is an error when the rows are read."""
    names = ", ".join(f"'{k}'" for k in known)
    unknown: Column = F.expr(f"coalesce(kind NOT IN ({names}), true)")
    wrong = F.raise_error(F.concat(F.lit("unknown kind of event: "), F.coalesce("kind", F.lit("null")))).cast("boolean")
    return df.where(F.when(unknown, wrong).otherwise(F.col("kind").isin(*kinds)))


@dataclass(frozen=True, kw_only=True)
class EventTables:
    """Events of projects and of people, in no order; checked when they are given.

    project_events: `open` with all fields, `update` with what changes (storage is added),
    `close`. user_events: `request` and `update`, the latter with what changes. A project's opening
    and closing bear on its PI as a user too, as with forms.
    """

    project_events: DataFrame
    user_events: DataFrame

    def __post_init__(self) -> None:
        _checked(self.project_events, PROJECT_EVENTS, "project_events")
        _checked(self.user_events, USER_EVENTS, "user_events")

    def as_forms(self) -> Forms:
        """The same events as the four tables that the operators read."""
        project = _checked(self.project_events, PROJECT_EVENTS, "project_events")
        user = _checked(self.user_events, USER_EVENTS, "user_events")
        kinds, user_kinds = (OPEN, UPDATE, CLOSE), (REQUEST, UPDATE)
        number = f"{SEQ} AS {SUBMISSION_ID}"
        return Forms(
            pi=_of_kind(project, (OPEN,), kinds).selectExpr(
                "ts AS start_timestamp", "email", "pi AS last_name", "power_user AS pi_is_power_user",
                "speed_code", "storage", number,
            ),
            pi_update=_of_kind(project, (UPDATE, CLOSE), kinds).selectExpr(
                "ts AS timestamp", "email", "pi AS last_name", "speed_code", "storage AS new_storage",
                f"kind = '{CLOSE}' AS account_closed", number,
            ),
            user=_of_kind(user, (REQUEST,), user_kinds).selectExpr(
                "ts AS start_timestamp", "email", "name AS last_name", "pi_name AS pi_last_name", "power_user",
                "cast(end_date AS timestamp_ntz) AS end_timestamp", number,
            ),
            user_update=_of_kind(user, (UPDATE,), user_kinds).selectExpr(
                "ts AS timestamp", "email", "name AS last_name", "pi_name AS pi_last_name",
                "power_user AS new_power_user", "cast(end_date AS timestamp_ntz) AS new_end_timestamp", number,
            ),
        )
