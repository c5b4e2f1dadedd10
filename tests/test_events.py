"""Billing from tables of events."""

import datetime as dt

import pytest

from quarterbill import EventTables, Period, QuarterBilling
from quarterbill.sources.event_tables import SchemaMismatch

PROJECT = "kind string, ts timestamp_ntz, email string, pi string, speed_code string, storage double, power_user boolean"
USER = "kind string, ts timestamp_ntz, email string, name string, pi_name string, power_user boolean, end_date date"


def _at(month, day):
    return dt.datetime(2020, month, day, 9)


def _tables(spark, projects=(), users=(), project=PROJECT, user=USER):
    return EventTables(project_events=spark.createDataFrame(list(projects), project), user_events=spark.createDataFrame(list(users), user))


def test_a_quarter_from_events(spark):
    tables = _tables(
        spark,
        [
            ("open", _at(1, 5), "kiwi@x", "kiwi", "sc1", 4.0, True),
            ("update", _at(4, 1), "kiwi@x", "kiwi", "sc2", 2.0, None),
            ("open", _at(2, 1), "fig@x", "fig", "sc3", 1.0, False),
            ("close", _at(6, 1), "fig@x", "fig", None, None, None),
        ],
        [
            ("request", _at(3, 1), "ann@x", "ann", "kiwi", True, None),
            ("update", _at(10, 1), "ann@x", "ann", None, None, dt.date(2021, 6, 30)),
        ],
    )
    rows = QuarterBilling(tables, Period.quarter("2020-11-01")).summary().collect()
    assert [(r.pi, r.storage_amount, r.billed_power_users, r.speed_code) for r in rows] == [("kiwi", 6.0, 2, "sc2")]


def test_a_table_of_another_shape_is_told_at_once(spark):
    with pytest.raises(SchemaMismatch, match="pi_name is missing"):
        _tables(spark, user=USER.replace("pi_name", "group"))
    with pytest.raises(SchemaMismatch, match="storage is string, not double"):
        _tables(spark, project=PROJECT.replace("storage double", "storage string"))
    with pytest.raises(SchemaMismatch, match="seq is string"):
        _tables(spark, project=PROJECT + ", seq string")


def test_a_kind_that_is_not_known_is_an_error(spark):
    for kind in ("merge", None):
        tables = _tables(spark, [(kind, _at(1, 5), "kiwi@x", "kiwi", "sc1", 4.0, True)])
        with pytest.raises(Exception, match="unknown kind of event"):
            QuarterBilling(tables, Period.quarter("2020-11-01")).summary().collect()


def test_seq_breaks_ties(spark):
    users = [("request", _at(3, 1), "ann@x", "ann", "kiwi", True, None, 1)]
    users += [("update", _at(4, 1), "ann@x", "ann", pi, None, None, n) for n, pi in ((2, "zoe"), (3, "abe"))]
    run = QuarterBilling(_tables(spark, users=users, user=USER + ", seq int"), Period.quarter("2020-11-01"))
    assert {r.pi_name for r in run.segments.where("to_date IS NULL").collect()} == {"abe"}
