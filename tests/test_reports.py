"""The golden bill, normalisation, sinks and strict mode on small forms."""

import datetime as dt

import pytest

from quarterbill import Period, Policy, QuarterBilling
from quarterbill.functions import text
from quarterbill.operators.checks import ViolationsFound
from quarterbill.plans import reports
from quarterbill.plans.jobs import bill_quarter, list_power_users
from quarterbill.sources import sinks
from quarterbill.sources.publish import PublishConflict, publish, quarters, read_report, remove_superseded
from tests.forms_csv import write_forms

SUBMISSIONS = {
    "pi": [
        {"start_timestamp": "2020-09-15 08:00:00", "email": "kiwi@uwo.ca", "last_name": "Kiwi",
         "storage": "4", "pi_is_power_user": "Yes", "speed_code": "  KKKK "},
        {"start_timestamp": "2020-09-16 08:00:00", "email": "mango@uwo.ca", "last_name": "Mango",
         "storage": "10", "pi_is_power_user": "Yes", "speed_code": "MMMM"},
        {"start_timestamp": "2020-09-17 08:00:00", "email": "banana@uwo.ca",
         "last_name": "Banana", "storage": "10", "pi_is_power_user": "no",
         "speed_code": "BBBB"},
    ],
    "pi_update": [
        {"timestamp": "2020-10-15 08:00:00", "email": "banana@uwo.ca", "last_name": "Banana",
         "new_storage": "5", "speed_code": "BBBC"},
    ],
    "user": [
        {"start_timestamp": "2020-11-12 08:00:00", "email": "lemon@uwo.ca",
         "last_name": "Lemon", "pi_last_name": "Kiwi", "power_user": "Yes",
         "end_timestamp": "2025-09-30 00:00:00"},
    ]
    + [
        {"start_timestamp": f"2020-{day} 08:00:00", "email": f"{name}@uwo.ca",
         "last_name": name, "pi_last_name": " MANGO ", "power_user": "yes"}
        for name, day in (
            ("Nectarine", "10-01"), ("Pomegranate", "10-02"), ("Xigua", "10-03"),
            ("Orange", "12-20"), ("Quince", "12-21"),
        )
    ],
    "user_update": [
        {"timestamp": "2020-12-22 08:00:00", "email": "lemon@uwo.ca", "agree": "",
         "feedback": 'It is "fine",\nthank you'},
        {"timestamp": "2020-12-23 08:00:00", "email": "quince@uwo.ca", "agree": "Yes",
         "new_power_user": "Regular user"},
    ],
}


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    forms = write_forms(spark, tmp_path_factory.mktemp("forms"), SUBMISSIONS)
    return QuarterBilling(forms, Period.quarter("2020-11-01"))


def test_normalisation(run):
    assert run.forms.pi.where("last_name = 'kiwi'").first().speed_code == "kkkk"
    first, second = run.forms.user_update.orderBy("timestamp").collect()
    assert first.agree is False and first.new_power_user is None
    assert second.agree is True and second.new_power_user is False
    assert first.feedback == 'it is "fine",\nthank you'
    assert run.forms.user.where("pi_last_name = 'mango'").count() == 5
    assert run.forms.pi.count() == 3 and run.forms.user.count() == 6


def test_example_prices(run):
    prices = {r.email.split("@")[0]: r.price for r in run.priced_members.collect()}
    assert prices == {
        "kiwi": 250, "lemon": 125, "mango": 250, "nectarine": 125, "pomegranate": 125,
        "xigua": 125, "orange": 0, "quince": 0,
    }
    summary = {r.pi: r for r in run.summary().collect()}
    assert summary["banana"].storage_price == 187.5
    assert summary["banana"].speed_code == "bbbc"
    assert summary["kiwi"].total_price == 425 and summary["kiwi"].billed_power_users == 2
    assert summary["mango"].total_price == 750


def test_golden_bill(run):
    lines = [
        tuple(r[name] for name in reports.LINE_FIELDS)
        for r in run.bill_lines()
        .where("doc_name = 'pi-kiwi_started-2020-09-15_quarter-2020-11-01_bill.txt'")
        .orderBy("section", "user_start", "user_email", "place")
        .collect()
    ]
    assert lines == [
        ("kiwi", "Sep 15, 2020", "N/A", "4.0 TB", "$50.00", "0.25", "$50.00"),
        ("kiwi", "Sep 15, 2020", "N/A", "1 Power User", "$1000.00", "0.25", "$250.00"),
        ("lemon", "Nov 12, 2020", "Sep 30, 2025", "1 Power User", "$500.00", "0.25", "$125.00"),
        ("Subtotal", "", "", "2 Power Users", "", "0.25", "$375.00"),
        ("Balance Due", "", "", "", "", "", "$425.00"),
    ]
    text = run.bill_documents(dt.date(2020, 12, 9)).where("doc_name LIKE 'pi-kiwi%'").first()
    assert text.body.split("\n")[1:3] == [
        "Billing Period: Nov 01, 2020--Jan 31, 2021", "Date: Dec 09, 2020",
    ]
    assert text.body.endswith("Billed to speed code: kkkk")


def test_large_bills_have_parts(run):
    date = dt.date(2020, 12, 9)
    found = {}
    for r in run.bills(date, users_in_part=2).collect():
        found.setdefault(r.pi_name, {})[r.part_no] = (r.parts, [u.last_name for u in r.power_users])
    assert [len(users) for _, users in found["mango"].values()] == [2, 2, 2]
    assert found["banana"] == {1: (1, [])} and len(found["kiwi"]) == 1
    whole = {r.project_id: r.body for r in run.bill_documents(date).collect()}
    parts = {}
    for r in run.bill_documents(date, users_in_part=1).orderBy("part_no").collect():
        parts.setdefault(r.project_id, []).append(r.body)
    assert {k: "\n".join(v) for k, v in parts.items()} == whole and max(map(len, parts.values())) == 6


def test_values_that_a_bill_must_show(spark, tmp_path):
    numbers = spark.createDataFrame([(2.0,), (0.0002,), (12345678.0,), (1e20,)], "x double")
    assert [r[0] for r in numbers.select(text.plain_number(numbers.x)).collect()] == [
        "2.0", "0.0002", "12345678.0", "100000000000000000000.0",
    ]
    forms = write_forms(
        spark,
        tmp_path,
        {"pi": [{"start_timestamp": " 2021-03-14 02:30 ", "email": "a@b", "last_name": "A", "storage": "inf"}]},
        timestamp_format="yyyy-MM-dd HH:mm",
    )
    spark.conf.set("spark.sql.session.timeZone", "America/Toronto")
    try:
        row = forms.pi.first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row.start_timestamp == dt.datetime(2021, 3, 14, 2, 30) and row.storage is None


def test_totals_and_policy(run):
    row = run.totals().first()
    assert (row.total_storage, row.total_compute, row.mean_overall) == (
        362.5, 1000.0, 1362.5 / 3,
    )
    dear = QuarterBilling(run.forms, run.period, Policy(storage_per_tb=100.0))
    assert dear.totals().first().total_storage == 725.0
    none = QuarterBilling(run.forms, Period.quarter("2019-01-01")).totals().first()
    assert none.total_overall == 0 and none.mean_overall is None


def test_sinks(run, spark, tmp_path, capsys):
    path = str(tmp_path / "summary")
    sinks.write_summary(run.charges, run.period, path)
    later = QuarterBilling(run.forms, Period.quarter("2021-02-01"))
    sinks.write_summary(later.charges, later.period, path)
    sinks.write_summary(later.charges, later.period, path)
    written = read_report(spark, path, "summary")
    assert {(str(r.quarter_start), r["count"]) for r in written.groupBy("quarter_start").count().collect()} == {
        ("2020-11-01", 3), ("2021-02-01", 3),
    }
    lines = str(tmp_path / "lines")
    sinks.write_bill_lines(run.bill_lines(), run.period, lines)
    assert read_report(spark, lines, "bill_lines").where("section = 2").count() == 8
    sinks.write_bill_documents(run.bill_documents(), run.period, str(tmp_path / "bills"))
    assert read_report(spark, str(tmp_path / "bills"), "bills").count() == 3
    users = str(tmp_path / "users")
    sinks.write_power_user_list(run.power_user_list(), users)
    listed = spark.read.option("header", True).csv(users)
    assert listed.columns == ["name", "email"] and listed.count() == 8
    sinks.print_totals(run.totals())
    assert capsys.readouterr().out.splitlines()[:2] == [
        "Total (Storage): 362.5", f"Mean (Storage): {362.5 / 3}",
    ]


def test_jobs(run, spark, tmp_path):
    out = str(tmp_path / "out")
    totals = bill_quarter(
        run.forms, quarter_start="2020-11-01", out_dir=out, bill_date=dt.date(2020, 12, 9)
    )
    assert totals.first().total_overall == 1362.5
    summary = read_report(spark, out, "summary")
    assert {r.pi: r.total_price for r in summary.collect()} == {
        "kiwi": 425, "mango": 750, "banana": 187.5,
    }
    assert read_report(spark, out, "bills").where("body LIKE '%Dec 09, 2020%'").count() == 3
    assert read_report(spark, out, "bill_lines", dt.date(2020, 11, 1)).count() == 3 * 3 + 8
    days = {"start": "2020-10-01", "end": "2020-10-02"}
    users = list_power_users(run.forms, **days, out_path=str(tmp_path / "users"))
    assert sorted(r.name for r in users.collect()) == ["kiwi", "mango", "nectarine"]


FIRST, SECOND = dt.date(2020, 1, 1), dt.date(2020, 4, 1)


def _values(spark, out, name, quarter=None):
    return sorted((str(r.quarter_start), r.v) for r in read_report(spark, out, name, quarter).collect())


def test_a_quarter_is_published_as_one(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = lambda *v: spark.createDataFrame([(x,) for x in v], "v long")
    publish(spark, {"a": rows(1, 2), "b": rows(3)}, FIRST, out)
    publish(spark, {"a": rows(9)}, SECOND, out, source="csv")
    assert _values(spark, out, "a") == [("2020-01-01", 1), ("2020-01-01", 2), ("2020-04-01", 9)]

    # a report without rows takes the old ones away, a report that is not named stays
    publish(spark, {"a": rows()}, FIRST, out)
    assert _values(spark, out, "a") == [("2020-04-01", 9)]
    assert _values(spark, out, "a", FIRST) == [] and _values(spark, out, "b") == [("2020-01-01", 3)]

    # a run that fails between two reports changes nothing
    broken = rows(5).selectExpr("if(v = 5, raise_error('no'), v) AS v")
    with pytest.raises(Exception, match="no"):
        publish(spark, {"b": rows(4), "a": broken}, FIRST, out)
    assert _values(spark, out, "b") == [("2020-01-01", 3)] and _values(spark, out, "a", FIRST) == []

    assert quarters(spark, out) == [FIRST, SECOND]
    assert remove_superseded(spark, out) > 0 and remove_superseded(spark, out) == 0
    assert _values(spark, out, "a") == [("2020-04-01", 9)] and _values(spark, out, "b") == [("2020-01-01", 3)]
    with pytest.raises(ValueError):
        read_report(spark, out, "c")


def test_of_two_runs_at_once_one_is_told(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    rows = spark.range(1).selectExpr("id AS v")
    from quarterbill.sources import publish as module

    seen = module._versions
    monkeypatch.setattr(module, "_versions", lambda *a: seen(*a)[:0])  # both began before the other ended
    publish(spark, {"a": rows}, FIRST, out)
    with pytest.raises(PublishConflict):
        publish(spark, {"a": rows}, FIRST, out)


def test_strict(run, spark, tmp_path):
    assert run.violations(strict=True).isEmpty()
    forms = write_forms(
        spark,
        tmp_path,
        {**SUBMISSIONS, "user_update": [{"timestamp": "2020-12-01 00:00:00", "email": "x@y"}]},
    )
    broken = QuarterBilling(forms, run.period)
    with pytest.raises(ViolationsFound):
        broken.violations(strict=True)


def test_unreadable_cells_are_reported(spark, tmp_path):
    forms = write_forms(
        spark,
        tmp_path,
        {
            **SUBMISSIONS,
            "user": [
                {"start_timestamp": "2020-11-12 08:00:00", "email": "lemon@uwo.ca",
                 "last_name": "Lemon", "pi_last_name": "Kiwi", "power_user": "Yes",
                 "end_timestamp": "end of term"}
            ],
            "user_update": [],
        },
    )
    found = QuarterBilling(forms, Period.quarter("2020-11-01")).violations().collect()
    assert [(r.rule, r.key, r.detail) for r in found] == [
        ("unreadable_cell", "lemon@uwo.ca", "end_timestamp")
    ]


def test_other_timestamp_format(spark, tmp_path):
    forms = write_forms(
        spark,
        tmp_path,
        {"user": [{"start_timestamp": "9/15/2020 14:05", "email": "a@b"}]},
        timestamp_format="M/d/yyyy H:mm",
    )
    assert forms.user.first().start_timestamp == dt.datetime(2020, 9, 15, 14, 5)
    assert forms.user.first().unreadable is None
