"""A third of all rows under one person, one PI and one day still gives whole results."""

import datetime as dt

from quarterbill import Forms, Period, QuarterBilling
from quarterbill.operators import pricing

PERIOD = Period.quarter("2020-11-01")


def _forms(spark, crowd=3000):
    pi = spark.createDataFrame(
        [(dt.datetime(2020, 1, 1), f"p{n}@x", f"p{n}", f"s{n}", 1.0, False) for n in range(40)],
        "start_timestamp timestamp_ntz, email string, last_name string, speed_code string,"
        " storage double, pi_is_power_user boolean",
    )
    # A third of the updates go to p0 and are all different; a third are copies.
    pi_update = spark.range(crowd * 3).selectExpr(
        "timestamp_ntz'2020-06-01' + make_dt_interval(0, 0, 0, id) AS timestamp",
        "'f@x' AS email",
        "CASE id % 3 WHEN 0 THEN 'p0' WHEN 1 THEN 'p1' ELSE concat('p', 2 + id % 38) END"
        " AS last_name",
        "if(id % 3 = 1, 0.125D, id / 8D) AS new_storage",
        "cast(NULL AS string) AS speed_code",
        "false AS account_closed",
    )
    # All of a third of the users belong to p0, most since the same day.
    user = spark.range(crowd * 3).selectExpr(
        "timestamp_ntz'2020-02-01' + make_dt_interval(if(id % 5 = 0, 300, 0)) AS start_timestamp",
        "concat('u', id, '@x') AS email",
        "concat('u', id) AS last_name",
        "if(id % 3 = 0, 'p0', concat('p', id % 40)) AS pi_last_name",
        "cast(NULL AS timestamp_ntz) AS end_timestamp",
        "true AS power_user",
    )
    # One person files a third of the account updates, on one day, some back-dated.
    user_update = spark.range(crowd * 3).selectExpr(
        """timestamp_ntz'2020-03-01' + make_dt_interval(if(id % 3 = 0, 0, cast(id % 50 AS int)),
             0, 0, id) AS timestamp""",
        "if(id % 3 = 0, 'u3@x', concat('u', id, '@x')) AS email",
        "'x' AS last_name",
        "cast(NULL AS string) AS pi_last_name",
        """CASE WHEN id = 3 THEN timestamp_ntz'2020-02-20'
                WHEN id = 6 THEN timestamp_ntz'2030-01-01' END AS new_end_timestamp""",
        "if(id % 7 = 0, true, NULL) AS new_power_user",
    )
    return Forms(pi=pi, pi_update=pi_update, user=user, user_update=user_update)


def test_whole_results(spark):
    crowd = 3000
    run = QuarterBilling(_forms(spark, crowd), PERIOD)
    # Users started on day 300 (2020-11-27) have 66 days, enough to be charged.
    expected = {}
    for n in range(crowd * 3):
        pi = "p0" if n % 3 == 0 else f"p{n % 40}"
        expected[pi] = expected.get(pi, 0) + 1
    found = {r.pi: r for r in run.charges.collect()}
    assert {k: v.billed_power_users for k, v in found.items()} == {
        **{f"p{n}": 0 for n in range(40)}, **expected,
    }
    for pi, count in expected.items():
        assert found[pi].compute_price == 250 + 125 * (count - 1)
    assert found["p0"].storage_amount == 1 + sum(range(0, crowd * 3, 3)) / 8
    assert found["p1"].storage_amount == 1 + 0.125

    # The same per person, with p0 cut into pieces.
    priced = pricing.priced_members(
        run.staged_candidates, run.log.pis, PERIOD, run.policy, rows_per_task=200
    )
    assert priced.count() == crowd * 3
    assert priced.where("tier = 'first'").count() == len(expected)
    assert priced.selectExpr("sum(price) AS s").first().s == sum(
        r.compute_price for r in found.values()
    )
    # The hot person: ended in the past by the first update, reinstated by the next.
    hot = [
        (r.term_no, str(r.start), str(r.end))
        for r in run.segments.where("email = 'u3@x'").orderBy("from_date").collect()
    ]
    assert hot[-1] == (1, "2020-03-01", "2030-01-01")
