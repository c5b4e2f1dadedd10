"""Writing the reports."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quarterbill.functions.periods import Period
from quarterbill.plans.reports import SUMMARY_COLUMNS
from quarterbill.sources.publish import publish


def sorted_summary(charges: DataFrame) -> DataFrame:
    """The summary sorted by PI."""
    return charges.orderBy("pi", "open_date", "project_id").select(*SUMMARY_COLUMNS)


def sorted_bill_lines(lines: DataFrame) -> DataFrame:
    """Bill lines in reading order, spread over as many files as they need."""
    order = ["project_id", "section", "user_start", "user_email", "place"]
    return lines.repartitionByRange(*order).sortWithinPartitions(*order)


def write_summary(charges: DataFrame, period: Period, path: str, *, source: str = "parquet") -> None:
    """Publish the summary of a quarter."""
    publish(charges.sparkSession, {"summary": sorted_summary(charges)}, period.start, path, source=source)


def write_bill_lines(lines: DataFrame, period: Period, path: str, *, source: str = "parquet") -> None:
    """Publish the bill lines of a quarter."""
    publish(lines.sparkSession, {"bill_lines": sorted_bill_lines(lines)}, period.start, path, source=source)


def write_bill_documents(documents: DataFrame, period: Period, path: str) -> None:
    """Publish the bill texts of a quarter, one row per bill and part: name, part and text."""
    publish(documents.sparkSession, {"bills": documents}, period.start, path)


def write_power_user_list(users: DataFrame, path: str) -> None:
    """A CSV of names and emails."""
    users.write.mode("overwrite").option("header", True).csv(path)


def print_totals(totals: DataFrame) -> None:
    """The six figures of the one-row totals table."""
    row = totals.first()
    for name in ("storage", "compute", "overall"):
        print(f"Total ({name.title()}): {row[f'total_{name}']}")
        print(f"Mean ({name.title()}): {row[f'mean_{name}']}")
