"""Reading form tables (CSV or Parquet) into canonical, normalised DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterbill.functions import text
from quarterbill.operators.spread import stage
from quarterbill.sources.csv_records import read_csv
from quarterbill.sources.schemas import (
    FORMS,
    NUMBER,
    SUBMISSION_ID,
    TIME,
    UNREADABLE,
    FormField,
)


@dataclass(frozen=True, kw_only=True)
class Forms:
    """The four canonical form tables."""

    pi: DataFrame
    pi_update: DataFrame
    user: DataFrame
    user_update: DataFrame


def read_form(
    spark: SparkSession,
    path: str,
    form: str,
    *,
    source: str = "csv",
    timestamp_format: str | None = None,
) -> DataFrame:
    """Read one form; CSV cells arrive as text, so no schema is inferred.

    CSV files are read in splits, each by its own header line (see `read_csv`), and the
    form is then written to the shared folder, so that no report parses text again.
    """
    if source == "csv":
        headers = [name for field in FORMS[form] for name in (field.header, field.name)]
        raw = read_csv(spark, path, [*headers, SUBMISSION_ID])
        return stage(normalise(raw, form, timestamp_format=timestamp_format))
    return normalise(spark.read.format(source).load(path), form, timestamp_format=timestamp_format)


def read_forms(
    spark: SparkSession,
    *,
    pi: str,
    pi_update: str,
    user: str,
    user_update: str,
    **options: object,
) -> Forms:
    """Read all four forms; `options` are those of `read_form`."""
    return Forms(
        pi=read_form(spark, pi, "pi", **options),
        pi_update=read_form(spark, pi_update, "pi_update", **options),
        user=read_form(spark, user, "user", **options),
        user_update=read_form(spark, user_update, "user_update", **options),
    )


def normalise(
    raw: DataFrame, form: str, *, timestamp_format: str | None = None
) -> DataFrame:
    """Rename source headers, clean text and cast; unknown columns are left out.

    A column may come under its header or under its canonical name. A column the form
    lacks becomes null (false for yes/no questions). `unreadable` names the cells of a
    row that hold text which is no time or number; the checks report them.
    """
    present = {field.name: field.dataType for field in raw.schema}
    columns, unreadable = [], []
    for field in FORMS[form]:
        found = next((n for n in (field.header, field.name) if n in present), None)
        cell = F.lit(None).cast("string") if found is None else F.col(f"`{found}`")
        kind = T.StringType() if found is None else present[found]
        value = _read_cell(cell, kind, field, timestamp_format)
        columns.append(value.alias(field.name))
        if isinstance(kind, T.StringType) and field.type in (TIME, NUMBER):
            is_bad = (text.clean(cell) != "") & value.isNull()
            unreadable.append(F.when(is_bad, F.lit(field.name)))
    if SUBMISSION_ID in present:
        columns.append(F.col(SUBMISSION_ID).cast("long").alias(SUBMISSION_ID))
    if unreadable:
        names = F.nullif(F.concat_ws(",", *unreadable), F.lit(""))
        columns.append(names.alias(UNREADABLE))
    return raw.select(*columns)


def _read_cell(
    cell: Column, kind: T.DataType, field: FormField, timestamp_format: str | None
) -> Column:
    is_text = isinstance(kind, T.StringType)
    cleaned = F.nullif(text.clean(cell), F.lit("")) if is_text else cell
    if field.reading == "yes":
        return text.yes(cleaned) if is_text else F.coalesce(cell, F.lit(False))
    if field.reading == "power_user":
        return cleaned == "power user" if is_text else cell
    if field.type == NUMBER:
        number = cleaned.try_cast("double") if is_text else cell.cast("double")
        return F.when(F.abs(number) < float("inf"), number)  # not for NaN either
    if field.type == TIME:
        if not is_text:
            return cell.cast(TIME)
        if timestamp_format is None:
            return cleaned.try_cast(TIME)
        # read and written in one zone, so that no session's clock change moves a time
        instant = F.try_to_timestamp(
            F.concat(cleaned, F.lit(" +00:00")), F.lit(f"{timestamp_format} XXX")
        )
        epoch = F.lit("1970-01-01 00:00:00").cast(TIME)
        return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)
    return cleaned if is_text else text.clean(cell.cast("string"))
