"""Replay from a snapshot equals the whole replay, on random logs and with late events."""

import datetime as dt
import random

import pytest

from quarterbill import Period
from quarterbill.operators import snapshot, terms
from quarterbill.plans.resumed import ResumedBilling, take_snapshot
from quarterbill.sources.form_store import FormStore
from tests.fold import Broken, days_of, replay
from tests.forms_csv import write_forms
from tests.test_replay import FIRST, LAST, _events, _random_log

BEFORE = dt.date(2020, 1, 12)


@pytest.mark.parametrize("backdated", [0.0, 0.3])
def test_random_logs_from_a_snapshot(spark, backdated):
    rng = random.Random(int(backdated * 10) + 7)
    logs = {f"u{n}": _random_log(rng, 12, backdated) for n in range(3000)}
    expected = {}
    for email, log in logs.items():
        try:
            expected[email] = replay([(k, m.date(), e, p, w) for k, m, e, p, w in log])
        except Broken:
            pass
    events = _events(spark, logs)
    days = snapshot.people(events.where(f"date < date'{BEFORE}'"))
    walked = snapshot.resume_people(days, events.where(f"date >= date'{BEFORE}'"))
    found = {}
    for row in terms.segments(walked).collect():
        found.setdefault(row.email, []).append(row)
    resumed = 0
    for email, want in expected.items():
        # terms that were over before the snapshot, but for the latest, are not in it
        rows = found.get(email, [])
        first = min((r.term_no for r in rows), default=0)
        resumed += first > 0
        assert {(r.term_no, r.start, r.end) for r in rows} == {
            (n, t["start"], t["end"]) for n, t in enumerate(want) if n >= first
        }, (email, logs[email])
        assert first == 0 or want[first]["start"] < BEFORE
        want_days = {d for d in days_of(want, FIRST, LAST) if d[1] >= first}
        got_days = set()
        for r in rows:
            day = max(FIRST, r.from_date)
            while day <= LAST and (r.to_date is None or day <= r.to_date):
                got_days.add((day, r.term_no, r.pi_name, r.power_user))
                day += dt.timedelta(days=1)
        assert got_days == want_days, (email, logs[email])
    assert resumed > 20


def _row(form, day, who, **cells):
    stamp = "start_timestamp" if form in ("pi", "user") else "timestamp"
    return form, {stamp: f"{day} 09:00:00", "email": f"{who}@x", "last_name": who, **cells}


def _forms(spark, folder, rows):
    folder.mkdir()
    by_form = {}
    for form, cells in rows:
        by_form.setdefault(form, []).append(cells)
    return write_forms(spark, folder, by_form)


OLD = [
    _row("pi", "2020-01-05", "kiwi", storage="4", pi_is_power_user="Yes"),
    _row("pi", "2020-02-05", "mango", storage="1"),
    _row("user", "2020-03-01", "ann", pi_last_name="kiwi", power_user="Yes", end_timestamp="2020-06-30 00:00:00"),
    _row("user_update", "2020-09-01", "ann", new_end_timestamp="2021-12-31 00:00:00"),
    _row("user", "2020-03-02", "bob", pi_last_name="mango", power_user="Yes"),
    _row("pi_update", "2020-04-01", "kiwi", new_storage="2"),
]
NEW = [
    _row("user_update", "2020-12-01", "ann", new_power_user="Regular user"),
    _row("pi_update", "2020-11-20", "mango", new_storage="3"),
    _row("user", "2020-11-05", "cat", pi_last_name="kiwi", power_user="Yes"),
    _row("pi", "2020-11-02", "plum", storage="8"),
]
LATE = [
    _row("user_update", "2020-08-01", "bob", pi_last_name="kiwi"),
    _row("pi_update", "2020-05-01", "mango", new_storage="5"),
]
DAY, PERIOD = dt.date(2020, 11, 1), Period.quarter("2020-11-01")


def _files(df):
    return {f.split("/forms/")[1].split("/")[0] for f in df.inputFiles() if "/forms/" in f}


@pytest.mark.parametrize("late", [False, True])
def test_reports_from_a_snapshot(spark, tmp_path, late):
    from quarterbill import QuarterBilling

    store = FormStore(spark, str(tmp_path / "forms"))
    store.append(_forms(spark, tmp_path / "old", OLD))
    take_snapshot(spark, store, DAY, str(tmp_path / "state"))
    store.append(_forms(spark, tmp_path / "new", NEW + (LATE if late else [])))
    run = ResumedBilling(spark, store, str(tmp_path / "state"), DAY, PERIOD)
    whole = QuarterBilling(store.forms(), PERIOD)
    for report in (lambda r: r.summary(), lambda r: r.replayed_segments, lambda r: r.projects, lambda r: r.totals(),
                   lambda r: r.bill_lines(DAY)):
        got, want = report(run), report(whole)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))
    # only newer files are scanned, unless events came late
    assert _files(run.replayed_segments) == ({"batch=000001", "batch=000002"} if late else {"batch=000002"})
    assert _files(run.projects) == ({"batch=000001", "batch=000002"} if late else {"batch=000002"})
    with pytest.raises(ValueError):
        ResumedBilling(spark, store, str(tmp_path / "state"), DAY, Period.quarter("2020-08-01"))


def test_a_batch_counts_once_it_is_whole(spark, tmp_path):
    store = FormStore(spark, str(tmp_path / "forms"))
    assert store.batches() == [] and store.forms().user.count() == 0
    store.append(_forms(spark, tmp_path / "old", OLD))
    (tmp_path / "forms" / "batch=000002").mkdir()  # a run that failed
    assert store.append(_forms(spark, tmp_path / "new", NEW)) == 3
    assert store.batches() == [1, 3] and store.forms(after=1).user.count() == 1
