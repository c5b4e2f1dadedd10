"""Both sides of every bound, read from CSV forms. Quarter 2020-11-01..2021-01-31."""

import datetime as dt
import random
from types import SimpleNamespace

import pytest

from quarterbill import Period, QuarterBilling
from quarterbill.functions import text
from quarterbill.operators.projects import opened_projects
from tests.forms_csv import write_forms

PERIOD = Period.quarter("2020-11-01")


class Log:
    """Collects the submissions of many independent cases."""

    def __init__(self):
        self.forms = {"pi": [], "pi_update": [], "user": [], "user_update": []}

    def case(self, name, opened="2020-01-01", power="No", storage="4"):
        self.name = name
        if opened:
            self.project("a", opened, storage, power)

    def _who(self, person):
        return f"{self.name}-{person}@X"

    def project(self, pi, day, storage="4", power="No"):
        self.forms["pi"].append(
            {"start_timestamp": f"{day} 09:00:00", "email": self._who(pi),
             "last_name": f" {self.name}-{pi.upper()} ", "speed_code": f"{pi}{day}",
             "storage": storage, "pi_is_power_user": power}
        )

    def change(self, day, **cells):
        self.forms["pi_update"].append(
            {"timestamp": f"{day} 10:00:00", "email": self._who("a"),
             "last_name": f"{self.name}-a", **cells}
        )

    def user(self, day, end="", person="u", pi="a", power="Yes"):
        self.forms["user"].append(
            {"start_timestamp": f"{day} 11:00:00", "email": self._who(person),
             "last_name": person, "pi_last_name": f"{self.name}-{pi}",
             "end_timestamp": end and f"{end} 00:00:00", "power_user": power}
        )

    def update(self, day, end="", pi="", power="", person="u"):
        self.forms["user_update"].append(
            {"timestamp": f"{day} 12:00:00", "email": self._who(person),
             "last_name": person, "pi_last_name": pi and f"{self.name}-{pi}",
             "new_end_timestamp": end and f"{end} 00:00:00", "new_power_user": power}
        )


def _submissions():
    log = Log()
    log.case("e1"); log.user("2020-12-01")
    log.case("e2"); log.user("2020-12-02")
    log.case("e3a"); log.user("2020-06-01", "2020-12-31")
    log.case("e3b"); log.user("2020-06-01", "2021-01-01")
    log.case("e4a"); log.change("2020-11-30", new_storage="5")
    log.case("e4b"); log.change("2020-12-01", new_storage="5")
    log.case("e4c"); log.change("2020-12-15", new_storage="-2")
    log.case("e4d"); log.change("2021-01-01", new_storage="-2")
    log.case("e5")
    log.change("2020-10-01", new_storage="2"); log.change("2020-10-01", new_storage="2")
    log.case("e6", opened="2020-12-01")
    log.case("e7a"); log.change("2020-12-31", account_closed="yes")
    log.case("e7b"); log.change("2021-01-01", account_closed="YES ")
    log.case("e8"); log.user("2020-09-01", "2020-10-15"); log.update("2020-12-01", "2021-06-30")
    log.case("e8b"); log.user("2020-09-01", "2020-10-15"); log.update("2020-12-01")
    log.case("e9"); log.user("2020-09-01", "2020-10-15"); log.user("2020-12-20")
    log.case("e10"); log.project("b", "2020-02-01", "0"); log.user("2020-09-01")
    log.update("2020-12-15", pi="b")
    log.case("e11"); log.project("a", "2020-10-01", "2"); log.user("2020-09-01")
    log.case("e12"); log.user("2021-01-31", person="v")
    log.project("b", "2021-01-31", "1", "yes")
    log.case("e13", power="Yes"); log.user("2020-06-01", person="u1")
    log.user("2020-12-20", person="u2")
    log.case("e14"); log.project("a", "2020-10-01", "2"); log.user("2020-09-01")
    log.change("2020-11-15", account_closed="yes")
    log.case("e15"); log.change("2020-11-01", account_closed="yes")
    log.case("e16", power="yes"); log.change("2021-01-02", account_closed="yes")
    log.project("a", "2021-01-05", "2", "yes")
    log.case("e17"); log.user("2020-09-01")
    log.update("2020-12-25", "2020-12-10", power="Regular user")
    log.update("2021-01-05", "2021-06-30")
    return log.forms


# (pi, open date) -> total; None where the project is not billable.
TOTALS = {
    ("e1-a", "2020-01-01"): 300, ("e2-a", "2020-01-01"): 50,
    ("e3a-a", "2020-01-01"): 50, ("e3b-a", "2020-01-01"): 300,
    ("e4a-a", "2020-01-01"): 112.5, ("e4b-a", "2020-01-01"): 50,
    ("e4c-a", "2020-01-01"): 25, ("e4d-a", "2020-01-01"): 50,
    ("e5-a", "2020-01-01"): 75, ("e6-a", "2020-12-01"): 0,
    ("e7a-a", "2020-01-01"): None, ("e7b-a", "2020-01-01"): 50,
    ("e8-a", "2020-01-01"): 300, ("e8b-a", "2020-01-01"): 50,
    ("e9-a", "2020-01-01"): 300,
    ("e10-a", "2020-01-01"): 300, ("e10-b", "2020-02-01"): 250,
    ("e11-a", "2020-01-01"): 300, ("e11-a", "2020-10-01"): 25,
    ("e12-a", "2020-01-01"): 50, ("e12-b", "2021-01-31"): 0,
    ("e13-a", "2020-01-01"): 425,
    ("e14-a", "2020-01-01"): None, ("e14-a", "2020-10-01"): 25,
    ("e15-a", "2020-01-01"): None,
    ("e16-a", "2020-01-01"): 300, ("e16-a", "2021-01-05"): 0,
    ("e17-a", "2020-01-01"): 300,
}

# (pi, email) -> (power days, price)
DAYS = {
    ("e1-a", "e1-u@x"): (62, 250), ("e2-a", "e2-u@x"): (61, 0),
    ("e3a-a", "e3a-u@x"): (61, 0), ("e3b-a", "e3b-u@x"): (62, 250),
    ("e8-a", "e8-u@x"): (62, 250), ("e9-a", "e9-u@x"): (92, 250),
    ("e10-a", "e10-u@x"): (92, 250), ("e10-b", "e10-u@x"): (92, 250),
    ("e11-a", "e11-u@x"): (92, 250), ("e12-b", "e12-b@x"): (1, 0),
    ("e13-a", "e13-a@x"): (92, 250), ("e13-a", "e13-u1@x"): (92, 125),
    ("e13-a", "e13-u2@x"): (43, 0),
    ("e16-a", "e16-a@x"): (63, 250), ("e17-a", "e17-u@x"): (67, 250),
}

FINDINGS = {
    ("inactive_at_period_end", "e7b-a|2020-01-01|e7b-a@x|a2020-01-01|4.0", "2021-01-01"),
    ("inactive_at_period_end", "e16-a|2020-01-01|e16-a@x|a2020-01-01|4.0", "2021-01-02"),
    ("end_before_start", "e8b-u@x", "2020-12-01"),
    ("user_update_without_user", "e15-a@x", "2020-11-01"),
}


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    forms = write_forms(spark, tmp_path_factory.mktemp("forms"), _submissions())
    return QuarterBilling(forms, PERIOD)


def test_period():
    assert str(PERIOD.end) == "2021-01-31"
    assert (str(PERIOD.early_cutoff), str(PERIOD.late_cutoff)) == ("2020-11-30", "2020-12-31")
    assert PERIOD.min_days == 62
    assert Period.quarter("1998-07-01").min_days == 61


def test_totals(run):
    found = {(r.pi, str(r.open_date)): r.total_price for r in run.charges.collect()}
    assert found == {k: v for k, v in TOTALS.items() if v is not None}


def test_days_and_prices(run):
    found = {
        (r.pi, r.email): (r.power_days, r.price) for r in run.priced_members.collect()
    }
    assert found == DAYS


def test_kept_projects_and_storage(run):
    kept = {(r.pi, str(r.open_date)) for r in run.projects.collect()}
    assert kept == set(TOTALS)
    amounts = {r.pi: r.storage_amount for r in run.storage_charges.collect()}
    assert amounts["e4a-a"] == 9 and amounts["e4c-a"] == 2 and amounts["e5-a"] == 6


def test_findings(run):
    found = {(r.rule, r.key, str(r.event_date)) for r in run.violations().collect()}
    assert found == FINDINGS


def test_bill_lines(run):
    lines = run.bill_lines().where("doc_name LIKE 'pi-e13-a%'").collect()
    users = [r for r in lines if r.section == 2]
    assert len(users) == 3
    subtotal = next(r for r in lines if r.section == 3)
    assert (subtotal.quantity, subtotal.amount) == ("3 Power Users", "$375.00")


def test_users_of_one_project(run):
    moved = run.users_of("e10-b|2020-02-01|e10-b@x|b2020-02-01|0.0")
    assert {r.email for r in moved.collect()} == {"e10-b@x", "e10-u@x"}


def test_money_is_rounded_from_the_stored_value(spark):
    rng = random.Random(5)
    amounts = [2.675, 0.125, 0.375, 1.005, 0.0, -2.675, -0.125, 1e11 + 0.125, 0.004999999]
    amounts += [rng.randrange(10**7) * 0.0125 for _ in range(3000)]
    amounts += [rng.randrange(10**6) / 1000 + 0.005 for _ in range(3000)]
    rows = spark.createDataFrame([(a,) for a in amounts], "a double")
    shown = rows.select("a", text.money(rows.a).alias("shown")).collect()
    assert [(r.a, r.shown) for r in shown if r.shown != f"{r.a:.2f}"] == []


def test_project_ids_keep_different_requests_apart(spark):
    day = dt.datetime(2020, 1, 1)
    cells = [("a|b", "c"), ("a", "b|c"), ("a\\", "c"), (None, "a"), ("", "a"), ("a\\|c", "")]
    rows = [(day, email, "a", "a", False, code, 1.0) for email, code in cells]
    pi = spark.createDataFrame(
        rows,
        "start_timestamp timestamp_ntz, email string, first_name string, last_name string,"
        " pi_is_power_user boolean, speed_code string, storage double",
    )
    forms = SimpleNamespace(pi=pi)
    opened = opened_projects(forms, Period.quarter("2020-11-01"))
    assert len({r.project_id for r in opened.collect()}) == len(cells)
