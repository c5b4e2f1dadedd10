"""Every registered query against its SQL twin, and the known totals."""

import collections
import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from quarterbill import Forms, Period, QuarterBilling
from quarterbill.operators import checks, spread
from quarterbill.sources import derived

DATA = Path("/root/testdata/sf0.001")
MORE_DATA = Path("/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="needs the driver's tables")
TABLES = ["supplier", "orders", "lineitem"]


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day).isoformat()
    if isinstance(value, (int, float, decimal.Decimal)):
        return None if math.isnan(value) else round(float(value), 9)
    return value


def _sorted(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return con


#: The library's own queries; the training-data operators have their tests in tests/llm.
OWN = sorted(
    name
    for name, query in entry_point.queries().items()
    if not query.__module__.startswith(("quarterbill.llm", "corpus_pipeline"))
)


@pytest.mark.parametrize("name", OWN)
def test_equals_sql(spark, duck, name):
    frame = entry_point.queries()[name](spark, str(DATA))
    result = duck.execute(entry_point.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(frame.columns) == sorted(columns)
    assert _sorted(frame.collect(), frame.columns) == _sorted(result.fetchall(), columns)


def test_every_query_has_a_twin():
    assert len(OWN) == 44 and set(OWN) <= set(entry_point.oracle_sql())


def test_known_figures(spark):
    run = QuarterBilling(
        derived.DerivedForms(spark, str(DATA)), Period.quarter(derived.QUARTER)
    )
    forms = run.forms
    assert [f.count() for f in (forms.pi, forms.pi_update, forms.user, forms.user_update)] == [
        11, 6001, 150, 1350,
    ]
    row = run.totals().first()
    assert (round(row.total_storage, 6), row.total_compute) == (44904.2375, 11250.0)


@pytest.fixture(scope="module")
def stored_forms(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("forms")
    made = derived.DerivedForms(spark, str(DATA))
    stored = {}
    for name in ("pi", "pi_update", "user", "user_update"):
        getattr(made, name).write.parquet(f"{folder}/{name}")
        stored[name] = spark.read.parquet(f"{folder}/{name}")
    return Forms(**stored)


def _final_plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.mark.parametrize(
    "report", ["summary", "projects", "segments", "priced_members", "bill_lines"]
)
def test_plans_stay_distributed(stored_forms, report):
    run = QuarterBilling(stored_forms, Period.quarter(derived.QUARTER))
    made = getattr(run, report)
    plan = _final_plan(made() if callable(made) else made)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert node not in plan
    # One task may gather one partial sum per task (the total of the key counts), and no rows.
    lines = plan.split("\n")
    for line, below in zip(lines, lines[1:]):
        if "SinglePartition" in line:
            assert "HashAggregate(keys=[], functions=[partial_sum(n#" in below


def test_one_shuffle_serves_all_windows_of_the_replay(stored_forms):
    run = QuarterBilling(stored_forms, Period.quarter(derived.QUARTER))
    plan = _final_plan(run.replayed_segments)
    # By person and day, then by person.
    assert plan.count("Exchange hashpartitioning") == 2
    assert "LessThan(start_timestamp" in plan


@pytest.mark.skipif(not MORE_DATA.exists(), reason="needs the driver's tables")
def test_closures_change_terms_in_all_ways(spark):
    made = entry_point.queries()

    def rows(name):
        return {tuple(r) for r in made[name](spark, str(MORE_DATA)).collect()}

    before, after = rows("user_terms"), rows("closure_pass")
    day = dt.date(1998, 9, 15)
    gone = {t[0] for t in before - after}
    assert "pi19@x.org" in gone and any(t[0] == "pi19@x.org" and t[4] == day for t in after)
    one_day = {t for t in after - before if t[3] == t[4] == dt.date(1998, 8, 20)}
    assert "pi29@x.org" in {t[0] for t in one_day}
    findings = made["violations_clean"](spark, str(MORE_DATA)).where("rule = 'closure_before_term'")
    assert "pi39@x.org" in {r.key for r in findings.collect()}


@pytest.mark.skipif(not MORE_DATA.exists(), reason="needs the driver's tables")
def test_every_rule_has_a_finding(spark):
    found = entry_point.queries()["violations_dirty"](spark, str(MORE_DATA))
    assert {r.rule for r in found.select("rule").distinct().collect()} == {
        "missing_key", "missing_storage", "missing_speed_code", "missing_pi",
        "missing_power_user", "missing_timestamp", "user_update_without_user",
        "end_before_start", "pi_update_without_pi", "inactive_at_period_end",
        "closure_before_term", "unattached_power_user", "unreadable_cell",
    }


def test_checks_read_each_form_once(stored_forms):
    found = checks.form_findings(stored_forms, Period.quarter(derived.QUARTER))
    plan = _final_plan(found)
    assert plan.count("Scan parquet") == 4 and "Exchange" not in plan


def test_strict_runs_the_checks_once(spark, monkeypatch):
    run = QuarterBilling(derived.DirtyForms(spark, str(DATA)), Period.quarter(derived.QUARTER))
    staged = []
    monkeypatch.setattr(checks, "stage", lambda df: staged.append(df) or spread.stage(df))
    with pytest.raises(checks.ViolationsFound) as error:
        run.violations(strict=True)
    rules = collections.Counter(r.rule for r in run.violations().collect())
    assert len(staged) == 1 and error.value.counts == dict(rules)


def test_a_project_that_is_not_billable_has_no_bill(spark):
    run = QuarterBilling(
        derived.DerivedForms(spark, str(DATA)), Period.quarter(derived.QUARTER)
    )
    closed = run.projects.where("close_date IS NOT NULL").first().project_id
    assert run.bill_of(closed).collect() == []
    assert run.bill_of("no such project").collect() == []
