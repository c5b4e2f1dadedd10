"""The windowed replay equals the sequential one, on valid and on broken logs."""

import collections
import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from quarterbill.operators import checks, terms
from quarterbill.operators.spread import stage
from tests.fold import Broken, days_of, replay

FIRST, LAST = dt.date(2020, 1, 1), dt.date(2020, 3, 15)
SCHEMA = (
    "email string, name string, pi_name string, power_user boolean, end_date date,"
    " ts timestamp_ntz, src_rank int, seq long"
)


def _random_log(rng, days, backdated):
    log = []
    moment = dt.datetime(2020, 1, 1)
    for place in range(rng.randint(1, 9)):
        # Often several events on one day.
        moment += rng.choice(
            [dt.timedelta(minutes=7), dt.timedelta(minutes=7), dt.timedelta(days=rng.randint(1, days))]
        )
        day = moment.date()
        request = place == 0 and rng.random() < 0.95 or rng.random() < 0.25
        low = -12 if rng.random() < backdated else 0
        end = day + dt.timedelta(days=rng.randint(low, 14)) if rng.random() < 0.7 else None
        pi, power = rng.choice("abc"), rng.random() < 0.5
        if not request:
            pi = pi if rng.random() < 0.5 else None
            power = power if rng.random() < 0.5 else None
        log.append(("request" if request else "update", moment, end, pi, power))
    return log


def _events(spark, logs):
    rows = []
    for email, log in logs.items():
        for kind, moment, end, pi, power in log:
            rows.append(
                (email, f"n-{email}", pi, power, end, moment, 0 if kind == "request" else 1, 0)
            )
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).withColumns(
        {"date": F.to_date("ts"), "is_request": F.col("src_rank") == 0}
    )


@pytest.mark.parametrize(("backdated", "piece"), [(0.0, 1024), (0.4, 1024), (0.4, 1), (0.4, 2)])
def test_matches_sequential_replay(spark, monkeypatch, backdated, piece):
    monkeypatch.setattr(terms, "PIECE", piece)
    rng = random.Random(int(backdated * 10) + 20)
    logs = {f"u{n}": _random_log(rng, 12, backdated) for n in range(4000)}
    expected, broken = {}, {}
    for email, log in logs.items():
        try:
            expected[email] = replay([(k, m.date(), e, p, w) for k, m, e, p, w in log])
        except Broken as error:
            broken[email] = error.args
    assert len(expected) > 500 and len(broken) > 100
    reinstated = sum(len(found) > 1 for found in expected.values())
    assert reinstated > 100

    walked = terms.walk_days(terms.day_states(_events(spark, logs)))
    found_terms, found_days = collections.defaultdict(set), collections.defaultdict(set)
    for row in terms.segments(walked).collect():
        found_terms[row.email].add((row.term_no, row.start, row.end))
        day = max(FIRST, row.from_date)
        while day <= LAST and (row.to_date is None or day <= row.to_date):
            found_days[row.email].add((day, row.term_no, row.pi_name, row.power_user))
            day += dt.timedelta(days=1)
    for email, want in expected.items():
        assert found_terms[email] == {
            (n, t["start"], t["end"]) for n, t in enumerate(want)
        }, (email, logs[email])
        assert found_days[email] == days_of(want, FIRST, LAST), (email, logs[email])

    findings = collections.defaultdict(set)
    for row in checks.replay_findings(walked).collect():
        findings[row.key].add((row.event_date, row.rule))
    assert set(findings) == set(broken), set(findings) ^ set(broken)
    for email, (rule, day) in broken.items():
        first_day = min(d for d, _ in findings[email])
        assert first_day == day and (day, rule) in findings[email], (email, logs[email])


def test_a_hot_person_becomes_one_row_per_day(spark):
    events = spark.range(200_000).selectExpr(
        "'hot@x' AS email", "'hot' AS name", "concat('p', id % 7) AS pi_name",
        "id % 2 = 0 AS power_user", "cast(NULL AS date) AS end_date",
        "timestamp_ntz'2020-01-01' + make_dt_interval(0, 0, 0, id) AS ts",
        "if(id = 0, 0, 1) AS src_rank", "id AS seq",
    ).withColumns({"date": F.to_date("ts"), "is_request": F.col("src_rank") == 0})
    days = terms.day_states(events)
    assert days.count() == 3
    last = terms.segments(terms.walk_days(days)).orderBy(F.desc("from_date")).first()
    assert (last.pi_name, last.power_user) == (f"p{199_999 % 7}", False)


DAY = dt.date(2020, 3, 1)


def _hot_day(rng, n):
    """One person's log: a request, then `n` updates on one day, one of them back-dated."""
    log = [("request", dt.datetime(2020, 1, 1), None, "a", False)]
    cut = n * 2 // 5
    for i in range(n):
        end = None
        if i == cut:
            end = DAY - dt.timedelta(days=3)
        elif i == cut + 7:
            end = DAY + dt.timedelta(days=30)
        elif i > cut + 7 and rng.random() < 0.2:
            end = DAY + dt.timedelta(days=rng.randint(1, 40))
        moment = dt.datetime(2020, 3, 1) + dt.timedelta(microseconds=800_000 * i)
        if cut < i < cut + 7:  # nothing between the old end and the new term
            continue
        pi, power = rng.choice([*"abc", None]), rng.choice([True, False, None])
        log.append(("update", moment, end, pi, power))
    return log


def test_a_hot_back_dated_day_is_spread_over_tasks(spark):
    log = _hot_day(random.Random(4), 100_000)
    events = stage(_events(spark, {"hot@x": log, "other@x": _hot_day(random.Random(5), 50)}))
    want = replay([(k, m.date(), e, p, w) for k, m, e, p, w in log])
    assert len(want) == 2
    walked = terms.walk_days(terms.day_states(events))
    rows = terms.segments(walked).where("email = 'hot@x'").collect()
    assert {(r.term_no, r.start, r.end) for r in rows} == {(n, t["start"], t["end"]) for n, t in enumerate(want)}
    for day in (dt.date(2020, 2, 20), DAY, dt.date(2020, 3, 5)):
        found = {(r.term_no, r.pi_name, r.power_user) for r in rows if r.from_date <= day and (r.to_date is None or day <= r.to_date)}
        assert found == {x[1:] for x in days_of(want, day, day)}

    pieces = terms.in_pieces(events)
    sizes = [r["count"] for r in pieces.groupBy("email", "date", "piece").count().collect()]
    assert max(sizes) <= terms.PIECE and len(sizes) >= 98
    tasks = pieces.repartition(8, "email", "date", "piece").groupBy(F.spark_partition_id()).count()
    counts = sorted(r["count"] for r in tasks.collect())
    assert len(counts) == 8 and counts[-1] <= 2 * counts[4]
    # every window over events is cut by piece; the others run over one row per piece or day
    plan = walked._jdf.queryExecution().analyzed().toString()
    assert "PARTITION BY email, date ORDER BY ts" not in plan
    windows = re.findall(r"windowspecdefinition\(([^)]*)", plan)
    assert windows and not [w for w in windows if "ts#" in w]
