"""Writes form submissions as CSV under the headers of the source forms."""

from __future__ import annotations

import csv

from quarterbill import read_forms
from quarterbill.sources.schemas import FORMS


def write_forms(spark, folder, submissions, **read):
    """`submissions` maps a form to rows of canonical name -> cell."""
    paths = {}
    for form, fields in FORMS.items():
        target = folder / f"{form}.csv"
        with target.open("w", newline="", encoding="utf-8") as out:
            writer = csv.writer(out)
            writer.writerow([field.header for field in fields])
            for row in submissions.get(form, []):
                assert set(row) <= {field.name for field in fields}, row
                writer.writerow([row.get(field.name, "") for field in fields])
        paths[form] = str(target)
    return read_forms(spark, **paths, **read)
