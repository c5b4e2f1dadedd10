"""DuckDB statements for the registered queries.

They restate the rules event by event and day by day, not by the reduced per-day rows
the Spark plans use, so that the two ways check each other.
"""

from __future__ import annotations

FIRST_PROJECT = "pi3|1994-01-04|pi3@x.org|sc3|4.0"
SECOND_PROJECT = "pi3|1998-07-20|pi3@x.org|sc2-3|0.214"
START, EARLY, LATE, END = "1998-07-01", "1998-07-31", "1998-08-31", "1998-09-30"
MIN_DAYS = 61

FORMS = """
pi_form AS (
  SELECT CASE s_suppkey % 10 WHEN 8 THEN TIMESTAMP '1998-08-15 09:00:00'
                             WHEN 7 THEN TIMESTAMP '1998-11-01 09:00:00'
              ELSE TIMESTAMP '1994-01-01 09:00:00' + to_days(CAST(s_suppkey % 300 AS INT))
         END AS start_timestamp,
         'pi' || s_suppkey || '@x.org' AS email, 'pi' || s_suppkey AS last_name,
         'sc' || s_suppkey AS speed_code, CAST(1 + s_suppkey % 8 AS DOUBLE) AS storage,
         s_acctbal > 5000 AS pi_is_power_user
  FROM supplier
  UNION ALL
  SELECT TIMESTAMP '1998-07-20 09:00:00', 'pi' || s_suppkey || '@x.org', 'pi' || s_suppkey,
         'sc2-' || s_suppkey, CAST(0.214 AS DOUBLE), s_acctbal > 5000
  FROM supplier WHERE s_suppkey % 10 = 3),
pi_update_form AS (
  SELECT l_shipdate + to_seconds(CAST(l_orderkey % 86400 AS INT))
           + to_microseconds(CAST(l_linenumber AS BIGINT)) AS "timestamp",
         p.email, p.last_name,
         CASE WHEN l_returnflag = 'A' THEN 'sc' || l_partkey END AS speed_code,
         CASE WHEN l_linestatus = 'F' THEN l_quantity / 8 END AS new_storage,
         FALSE AS account_closed
  FROM lineitem JOIN (SELECT last_name, email, min(start_timestamp) AS s
                      FROM pi_form GROUP BY 1, 2) p ON p.last_name = 'pi' || l_suppkey
  UNION ALL
  SELECT CASE WHEN s_suppkey % 20 = 9 THEN TIMESTAMP '1998-08-20 10:00:00'
              ELSE TIMESTAMP '1998-09-15 10:00:00' END,
         CASE WHEN s_suppkey % 40 = 9 THEN 'pi' ELSE 'office' END || s_suppkey || '@x.org', 'pi' || s_suppkey, NULL, NULL, TRUE
  FROM supplier WHERE s_suppkey % 10 = 9),
submissions AS (
  SELECT o_custkey, o_orderkey, rn,
         o_orderdate + to_microseconds(CAST(o_orderkey % 86400000000 AS BIGINT)) AS ts,
         o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AS hi,
         CASE WHEN k % 10 IN (7, 9) THEN k - 5 ELSE k END AS pk
  FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn,
               (o_custkey + o_orderkey % 3) % (SELECT count(*) FROM supplier) AS k
        FROM orders) t),
user_form AS (
  SELECT ts AS start_timestamp, 'c' || o_custkey || '@x.org' AS email,
         'c' || o_custkey AS last_name, 'pi' || pk AS pi_last_name, hi AS power_user,
         CASE WHEN o_custkey % 5 <> 0
              THEN ts + to_days(CAST(400 + o_orderkey % 200 AS INT)) END AS end_timestamp
  FROM submissions WHERE rn = 1),
user_update_form AS (
  SELECT ts AS "timestamp", 'c' || o_custkey || '@x.org' AS email, 'c' || o_custkey AS last_name,
         CASE WHEN o_orderkey % 4 = 0 THEN 'pi' || pk END AS pi_last_name,
         CASE WHEN o_orderkey % 3 <> 1 THEN hi END AS new_power_user,
         CASE WHEN o_custkey % 5 <> 0
              THEN ts + to_days(CAST(400 + o_orderkey % 200 AS INT)) END AS new_end_timestamp
  FROM submissions WHERE rn > 1
  UNION ALL
  SELECT c.filed, 'pi' || s_suppkey || '@x.org', 'pi' || s_suppkey, NULL, NULL, c.until
  FROM supplier JOIN (VALUES
    (29, TIMESTAMP '1998-06-01 10:00:00', TIMESTAMP '1998-08-01 00:00:00'),
    (39, TIMESTAMP '1998-01-10 10:00:00', TIMESTAMP '1998-03-01 00:00:00'),
    (39, TIMESTAMP '1998-09-20 10:00:00', TIMESTAMP '1999-06-30 00:00:00')) c(k, filed, until)
    ON s_suppkey % 40 = c.k)
"""

# The same forms with faults in them, under the names the rules read.
DIRTY = """
dirty_pi AS (
  SELECT * REPLACE (CASE WHEN n % 20 <> 6 THEN last_name END AS last_name,
                    CASE WHEN n % 20 <> 1 THEN email END AS email,
                    CASE WHEN n % 10 <> 2 THEN storage END AS storage,
                    CASE WHEN n % 10 <> 4 THEN speed_code END AS speed_code)
  FROM (SELECT *, CAST(regexp_extract(last_name, '(\\d+)$', 1) AS BIGINT) AS n FROM pi_form)),
dirty_pi_update AS (
  SELECT * FROM pi_update_form
  UNION ALL
  SELECT * REPLACE ('no' || last_name AS last_name) FROM pi_update_form
  WHERE CAST(regexp_extract(last_name, '(\\d+)$', 1) AS BIGINT) % 10 = 5
  UNION ALL
  SELECT * REPLACE (TIMESTAMP '1990-01-01 00:00:00' AS "timestamp", FALSE AS account_closed)
  FROM pi_update_form WHERE account_closed),
dirty_user AS (
  SELECT * REPLACE (CASE WHEN n % 47 <> 5 THEN power_user END AS power_user,
                    CASE WHEN n % 53 <> 6 THEN start_timestamp END AS start_timestamp,
                    CASE WHEN n % 41 <> 3 THEN email END AS email,
                    CASE WHEN n % 43 <> 4 THEN pi_last_name END AS pi_last_name)
  FROM (SELECT *, CAST(regexp_extract(last_name, '(\\d+)$', 1) AS BIGINT) AS n FROM user_form)),
dirty_user_update AS (
  SELECT * REPLACE (
    CASE WHEN n % 37 = 5 THEN "timestamp" - to_days(4000)
         WHEN n % 31 = 6 THEN NULL ELSE new_end_timestamp END AS new_end_timestamp,
    CASE WHEN (CAST("timestamp" AS DATE) - DATE '1990-01-01') % 29 = 0 THEN 'nobody'
         ELSE pi_last_name END AS pi_last_name)
  FROM (SELECT *, CAST(regexp_extract(last_name, '(\\d+)$', 1) AS BIGINT) AS n
        FROM user_update_form))
"""


def _log(start: str, end: str, prefix: str = "") -> str:
    """Event logs and project state for a period."""
    name = {
        f: (f"dirty_{f}" if prefix else f"{f}_form")
        for f in ("pi", "pi_update", "user", "user_update")
    }
    return f"""
pi_req AS (SELECT *, CAST(start_timestamp AS DATE) AS open_date FROM {name["pi"]}
           WHERE CAST(start_timestamp AS DATE) <= DATE '{end}'),
pi_upd AS (SELECT *, CAST("timestamp" AS DATE) AS date FROM {name["pi_update"]}
           WHERE CAST("timestamp" AS DATE) <= DATE '{end}'),
user_log AS (
  SELECT email, last_name AS name, pi_last_name AS pi_name, power_user,
         CAST(end_timestamp AS DATE) AS end_date, start_timestamp AS ts, 0 AS src_rank
  FROM {name["user"]} WHERE CAST(start_timestamp AS DATE) < DATE '{end}'
  UNION ALL
  SELECT email, last_name, pi_last_name, new_power_user, CAST(new_end_timestamp AS DATE),
         "timestamp", 1
  FROM {name["user_update"]} WHERE CAST("timestamp" AS DATE) < DATE '{end}'
  UNION ALL
  SELECT email, last_name, last_name, pi_is_power_user, NULL, start_timestamp, 2 FROM pi_req
  UNION ALL
  SELECT email, last_name, NULL, NULL, date, "timestamp", 3 FROM pi_upd WHERE account_closed),
opened AS (
  SELECT last_name AS pi, open_date, email, speed_code, storage,
         min(start_timestamp) AS open_ts,
         last_name || '|' || strftime(open_date, '%Y-%m-%d') || '|'
           || coalesce(email, '') || '|'
           || coalesce(speed_code, '') || '|'
           || coalesce(CAST(storage AS VARCHAR), '') AS project_id
  FROM pi_req WHERE last_name IS NOT NULL GROUP BY ALL),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY pi ORDER BY open_date, open_ts, email,
                               speed_code, storage) AS place FROM opened),
applied AS (
  SELECT u.*, n.project_id FROM pi_upd u JOIN numbered n ON n.pi = u.last_name
  WHERE n.place = 1 AND u.date >= n.open_date),
closed AS (
  SELECT n.project_id, CAST(max(u."timestamp") AS DATE) AS close_date
  FROM pi_upd u JOIN numbered n ON n.pi = u.last_name
  WHERE n.place = 1 AND u.account_closed AND u."timestamp" >= n.open_ts GROUP BY 1),
kept AS (
  SELECT *, row_number() OVER (PARTITION BY pi ORDER BY place) = 1 AS has_power_users
  FROM (SELECT n.*, c.close_date FROM numbered n LEFT JOIN closed c USING (project_id)) t
  WHERE close_date IS NULL OR close_date >= DATE '{start}'),
all_updates AS (
  SELECT project_id, pi, date, speed_code, storage, max(ts) AS ts FROM (
    SELECT project_id, last_name AS pi, date, speed_code, new_storage AS storage,
           "timestamp" AS ts FROM applied
    UNION ALL
    SELECT project_id, pi, open_date, speed_code, storage, open_ts FROM opened) t
  GROUP BY ALL)
"""


def _terms(start: str) -> str:
    """Event-level replay of the user log, then the closure pass."""
    return f"""
e0 AS (SELECT *, CAST(ts AS DATE) AS date, src_rank IN (0, 2) AS is_request
       FROM user_log WHERE email IS NOT NULL),
e1 AS (SELECT *, bool_or(is_request) OVER w AS known,
              bool_or(is_request) OVER w AND NOT coalesce(bool_or(is_request) OVER
                (PARTITION BY email ORDER BY ts, src_rank
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS creates,
              CASE WHEN is_request OR end_date IS NOT NULL
                   THEN struct_pack(e := end_date) END AS marker
       FROM e0 WINDOW w AS (PARTITION BY email ORDER BY ts, src_rank
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
e2 AS (SELECT *,
         (last_value(marker IGNORE NULLS) OVER (PARTITION BY email ORDER BY ts, src_rank
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)).e AS end_after,
         (last_value(marker IGNORE NULLS) OVER (PARTITION BY email ORDER BY ts, src_rank
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)).e AS prior_end,
         first_value(CASE WHEN creates THEN name END IGNORE NULLS)
           OVER (PARTITION BY email ORDER BY ts, src_rank) AS first_name
       FROM e1 WHERE known),
e3 AS (SELECT *, coalesce(NOT is_request AND date > prior_end, FALSE) AS is_new FROM e2),
e4 AS (SELECT *, sum(CAST(is_new AS INT)) OVER (PARTITION BY email ORDER BY ts, src_rank
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS term_no FROM e3),
e5 AS (SELECT *, first_value(date) OVER t AS start_date, last_value(end_after) OVER t AS final_end
       FROM e4 WINDOW t AS (PARTITION BY email, term_no ORDER BY ts, src_rank
                            ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
e6 AS (SELECT *,
         last_value(CASE WHEN final_end IS NULL OR date <= final_end THEN pi_name END
                    IGNORE NULLS) OVER b AS carry_pi,
         last_value(CASE WHEN final_end IS NULL OR date <= final_end THEN power_user END
                    IGNORE NULLS) OVER b AS carry_power
       FROM e5 WINDOW b AS (PARTITION BY email ORDER BY ts, src_rank
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
e7 AS (SELECT *,
         CASE WHEN is_new THEN coalesce(pi_name, carry_pi) ELSE pi_name END AS pi_1,
         CASE WHEN is_new THEN coalesce(power_user, carry_power) ELSE power_user END AS power_1
       FROM e6),
e8 AS (SELECT *, last_value(pi_1 IGNORE NULLS) OVER t AS pi_2,
              last_value(power_1 IGNORE NULLS) OVER t AS power_2,
              lead(date) OVER (PARTITION BY email, term_no ORDER BY ts, src_rank) AS next_date
       FROM e7 WINDOW t AS (PARTITION BY email, term_no ORDER BY ts, src_rank
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
segs AS (
  SELECT email, first_name AS name, CAST(term_no AS BIGINT) AS term_no, start_date AS "start",
         final_end AS "end", date AS from_date,
         CASE WHEN next_date IS NULL THEN final_end
              WHEN final_end IS NULL OR next_date - 1 < final_end THEN next_date - 1
              ELSE final_end END AS to_date,
         pi_2 AS pi_name, power_2 AS power_user
  FROM e8),
replayed AS (
  SELECT * FROM segs WHERE (to_date IS NULL OR to_date >= from_date)
    AND ("end" IS NULL OR "end" > DATE '{start}')),
closing AS (
  SELECT DISTINCT email, close_date FROM kept WHERE close_date IS NOT NULL AND email IS NOT NULL),
latest AS (
  SELECT email, max(term_no) AS term_no, max("start") AS "start", max_by("end", term_no) AS "end"
  FROM (SELECT email, term_no, any_value("start") AS "start",
               CASE WHEN bool_or("end" IS NULL) THEN NULL ELSE max("end") END AS "end"
        FROM replayed GROUP BY ALL) GROUP BY email),
latest_end AS (
  SELECT l.email, l.term_no, r."start", r."end" FROM latest l
  JOIN (SELECT DISTINCT email, term_no, "start", "end" FROM replayed) r USING (email, term_no)),
first_close AS (
  SELECT l.email, l.term_no, min(c.close_date) AS close_date
  FROM latest_end l JOIN closing c ON c.email = l.email AND c.close_date >= l."start"
  GROUP BY ALL),
cut AS (
  SELECT f.email, f.term_no, f.close_date FROM first_close f
  JOIN latest_end l USING (email, term_no)
  WHERE l."end" IS NULL OR f.close_date <= l."end"),
after_cut AS (
  SELECT r.email, r.name, r.term_no, r."start", coalesce(c.close_date, r."end") AS "end",
         r.from_date,
         CASE WHEN c.close_date IS NULL THEN r.to_date
              WHEN r.to_date IS NULL OR r.to_date > c.close_date THEN c.close_date
              ELSE r.to_date END AS to_date,
         r.pi_name, r.power_user
  FROM replayed r LEFT JOIN cut c USING (email, term_no)),
one_day AS (
  SELECT l.email, c.close_date,
         l.term_no + row_number() OVER (PARTITION BY l.email ORDER BY c.close_date) AS term_no,
         l.term_no AS old_term
  FROM latest_end l JOIN closing c ON c.email = l.email
  LEFT JOIN cut k ON k.email = l.email
  WHERE c.close_date > coalesce(k.close_date, l."end")),
seg_final AS (
  SELECT * FROM after_cut WHERE to_date IS NULL OR to_date >= from_date
  UNION ALL
  SELECT a.email, a.name, o.term_no, o.close_date, o.close_date, o.close_date, o.close_date,
         a.pi_name, a.power_user
  FROM one_day o JOIN after_cut a ON a.email = o.email AND a.term_no = o.old_term
                 AND a.to_date = a."end")
"""


def _days(start: str, end: str) -> str:
    """Membership by listing every day of the period."""
    return f"""
cal AS (SELECT CAST(unnest(generate_series(DATE '{start}', DATE '{end}', INTERVAL 1 DAY)) AS DATE) AS day),
user_days AS (
  SELECT s.*, c.day FROM seg_final s JOIN cal c
    ON c.day >= s.from_date AND (s.to_date IS NULL OR c.day <= s.to_date)),
holder AS (SELECT pi, project_id, open_date, close_date FROM kept WHERE has_power_users),
power_terms AS (
  SELECT DISTINCT pi_name AS pi, email, term_no, name, "start", "end"
  FROM user_days WHERE power_user AND pi_name IS NOT NULL)
"""


PRICED = f"""
candidates AS (
  SELECT t.pi, t.email, min(t."start") AS first_start, arg_min(t.name, t."start") AS name,
         (SELECT count(DISTINCT d.day) FROM user_days d JOIN power_terms q
            ON q.email = d.email AND q.term_no = d.term_no
           WHERE q.pi = t.pi AND q.email = t.email) AS active_days,
         (SELECT count(DISTINCT d.day) FROM user_days d JOIN power_terms q
            ON q.email = d.email AND q.term_no = d.term_no
           WHERE q.pi = t.pi AND q.email = t.email AND d.power_user) AS power_days
  FROM power_terms t GROUP BY t.pi, t.email),
ranked AS (
  SELECT c.*, power_days >= {MIN_DAYS} AS charged,
         row_number() OVER (PARTITION BY pi, power_days >= {MIN_DAYS}
                            ORDER BY first_start, email) AS place
  FROM candidates c),
billable AS (
  SELECT * FROM kept WHERE open_date <= DATE '{END}'
    AND (close_date IS NULL OR close_date > DATE '{LATE}')),
priced AS (
  SELECT b.project_id, b.pi, b.open_date, r.email, r.name, r.first_start, r.active_days,
         r.power_days,
         CASE WHEN NOT charged THEN 'none' WHEN r.place = 1 THEN 'first'
              ELSE 'additional' END AS tier,
         CASE WHEN NOT charged THEN 0.0 WHEN r.place = 1 THEN 1000 * 0.25
              ELSE 500 * 0.25 END::DOUBLE AS price
  FROM billable b JOIN ranked r USING (pi) WHERE b.has_power_users),
stored AS (
  SELECT k.project_id,
         coalesce(sum(u.storage) FILTER (u.date <= DATE '{EARLY}'), 0.0) AS storage_early,
         coalesce(sum(u.storage) FILTER (u.date <= DATE '{LATE}'), 0.0) AS storage_late,
         coalesce(sum(u.storage) FILTER (u.date <= coalesce(k.close_date, DATE '{END}')), 0.0)
           AS storage_end,
         max_by(u.speed_code, struct_pack(d := u.date, t := u.ts, c := u.speed_code))
           FILTER (u.speed_code IS NOT NULL AND u.speed_code <> '') AS speed_code
  FROM kept k JOIN all_updates u USING (project_id) GROUP BY k.project_id),
charge AS (
  SELECT b.project_id, b.pi, b.email, b.open_date, s.storage_end, s.speed_code,
         CASE WHEN b.open_date > DATE '{EARLY}' THEN 0.0
              ELSE least(s.storage_early, s.storage_late) END AS storage_amount,
         CASE WHEN b.open_date > DATE '{EARLY}' THEN 0.0
              ELSE least(s.storage_early, s.storage_late) END * 50 * 0.25::DOUBLE AS storage_price,
         coalesce(p.n, 0) AS power_users, coalesce(p.billed, 0) AS billed_power_users,
         coalesce(p.price, 0.0)::DOUBLE AS compute_price
  FROM billable b JOIN stored s USING (project_id)
  LEFT JOIN (SELECT project_id, count(*) AS n, count(*) FILTER (price > 0) AS billed,
                    sum(price) AS price FROM priced GROUP BY 1) p USING (project_id))
"""

LINES = f"""
head AS (
  SELECT *, 'pi-' || pi || '_started-' || strftime(open_date, '%Y-%m-%d')
            || '_quarter-{START}_bill.txt' AS doc_name FROM charge),
term_rows AS (
  SELECT p.project_id, h.doc_name, p.first_start, p.email, p.name, p.price, t."start", t."end",
         CAST(row_number() OVER (PARTITION BY p.project_id, p.email
                                 ORDER BY t."start", t.term_no) - 1 AS INT) AS place
  FROM priced p JOIN head h USING (project_id)
  JOIN power_terms t ON t.pi = p.pi AND t.email = p.email),
lines AS (
  SELECT project_id, doc_name, 1 AS section, NULL::DATE AS user_start, NULL::VARCHAR AS user_email,
         0 AS place, pi AS name, strftime(open_date, '%b %d, %Y') AS start_date, 'N/A' AS end_date,
         CAST(storage_end AS VARCHAR) || ' TB' AS quantity, '$50.00' AS unit_price,
         '0.25' AS share, '$' || printf('%.2f', storage_price) AS amount FROM head
  UNION ALL
  SELECT project_id, doc_name, 2, first_start, email, place,
         CASE WHEN place = 0 THEN name ELSE '' END, strftime("start", '%b %d, %Y'),
         coalesce(strftime("end", '%b %d, %Y'), 'N/A'),
         CASE WHEN place = 0 THEN '1 Power User' ELSE '' END,
         CASE WHEN place = 0 THEN '$' || printf('%.2f', price * 4) ELSE '' END,
         CASE WHEN place = 0 THEN '0.25' ELSE '' END,
         CASE WHEN place = 0 THEN '$' || printf('%.2f', price) ELSE '' END FROM term_rows
  UNION ALL
  SELECT project_id, doc_name, 3, NULL, NULL, 0, 'Subtotal', '', '',
         power_users || ' Power Users', '', '0.25', '$' || printf('%.2f', compute_price) FROM head
  UNION ALL
  SELECT project_id, doc_name, 4, NULL, NULL, 0, 'Balance Due', '', '', '', '', '',
         '$' || printf('%.2f', storage_price + compute_price) FROM head)
"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def statements() -> dict[str, str]:
    """One statement per registered query that SQL can state."""
    log = _with(FORMS, _log(START, END))
    term = _with(FORMS, _log(START, END), _terms(START))
    days = _with(FORMS, _log(START, END), _terms(START), _days(START, END))
    priced = _with(FORMS, _log(START, END), _terms(START), _days(START, END), PRICED)
    lines = _with(FORMS, _log(START, END), _terms(START), _days(START, END), PRICED, LINES)
    year = ("1997-01-01", "1997-12-31")
    documents = lines + BODIES
    in_year = _with(FORMS, _log(*year), _terms(year[0]), _days(*year))
    dirty = _with(
        FORMS, DIRTY, _log(START, END, "dirty"), _terms(START), _days(START, END)
    )
    made = {
        "normalise_pi": _with(FORMS)
        + " SELECT start_timestamp, email, last_name, pi_is_power_user, speed_code, storage FROM pi_form",
        "normalise_pi_update": _with(FORMS)
        + ' SELECT "timestamp", email, last_name, new_storage, speed_code, FALSE AS agree,'
        " account_closed FROM pi_update_form",
        "normalise_user": _with(FORMS)
        + " SELECT start_timestamp, email, last_name, pi_last_name, end_timestamp, power_user FROM user_form",
        "user_form_csv": _with(FORMS)
        + " SELECT start_timestamp, email, last_name, pi_last_name, end_timestamp, power_user FROM user_form",
        "normalise_user_update": _with(FORMS)
        + ' SELECT "timestamp", email, last_name, pi_last_name, new_end_timestamp, new_power_user,'
        " FALSE AS agree FROM user_update_form",
        "period_bounds": """
          SELECT quarter_start, n_orders, last_day(quarter_start) AS early_cutoff,
                 last_day(CAST(quarter_start + INTERVAL 1 MONTH AS DATE)) AS late_cutoff,
                 last_day(CAST(quarter_start + INTERVAL 2 MONTH AS DATE)) AS quarter_end,
                 CAST(last_day(CAST(quarter_start + INTERVAL 2 MONTH AS DATE)) - quarter_start + 1
                      AS INT) AS n_days,
                 CAST(greatest(
                   last_day(CAST(quarter_start + INTERVAL 1 MONTH AS DATE)) - quarter_start,
                   last_day(CAST(quarter_start + INTERVAL 2 MONTH AS DATE)) - last_day(quarter_start)
                 ) AS INT) AS min_days
          FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS quarter_start,
                       count(*) AS n_orders FROM orders GROUP BY 1) t""",
        "derived_user_events": log
        + " SELECT email, name, pi_name, power_user, end_date, ts, src_rank FROM user_log",
        "projects": log
        + " SELECT project_id, pi, email, open_date, close_date, has_power_users FROM kept",
        "project_updates": log
        + " SELECT project_id, pi, date, speed_code, storage FROM all_updates",
        "projects_as_of": log
        + " SELECT project_id, pi, open_date, close_date FROM kept"
        f" WHERE open_date <= DATE '{LATE}' AND (close_date IS NULL OR close_date >= DATE '{LATE}')",
        "storage_history": log
        + """, changed AS (
              SELECT u.project_id, u.pi, u.date, k.close_date, sum(u.storage) AS added
              FROM all_updates u JOIN kept k USING (project_id) GROUP BY ALL
              HAVING added <> 0 OR u.date = any_value(k.open_date)),
            spans AS (
              SELECT project_id, pi, date AS from_date, close_date,
                     lead(date) OVER w - 1 AS before_next,
                     sum(added) OVER w AS storage
              FROM changed WINDOW w AS (PARTITION BY project_id ORDER BY date))
            SELECT project_id, pi, from_date, storage,
                   CASE WHEN close_date IS NULL OR before_next < close_date THEN before_next
                        ELSE close_date END AS to_date
            FROM spans WHERE close_date IS NULL OR from_date <= close_date""",
        "storage_on_a_day": log
        + f""" SELECT k.project_id, k.pi, sum(u.storage) AS storage
              FROM kept k JOIN all_updates u USING (project_id)
              WHERE k.open_date <= DATE '{START}' AND u.date <= DATE '{START}'
                AND (k.close_date IS NULL OR k.close_date >= DATE '{START}')
              GROUP BY ALL""",
        "states_at_close": term
        + """, asked AS (SELECT project_id, email, coalesce(close_date, CAST(open_date + 200 AS DATE)) AS day FROM kept),
            updated AS (
              SELECT a.project_id, a.day, coalesce(sum(u.storage), 0) AS storage,
                     arg_max(u.speed_code, (u.date, u.ts, u.speed_code)) FILTER (u.speed_code <> '') AS speed_code
              FROM asked a JOIN all_updates u ON u.project_id = a.project_id AND u.date <= a.day GROUP BY ALL)
            SELECT a.project_id, a.email, a.day, u.storage, u.speed_code, s.term_no, s.pi_name, s.power_user
            FROM asked a LEFT JOIN updated u ON u.project_id = a.project_id AND u.day = a.day
            LEFT JOIN seg_final s ON s.email = a.email AND s.from_date <= a.day
              AND (s.to_date IS NULL OR s.to_date >= a.day)""",
        "states_before_updates": term
        + """ SELECT a.email, a.updated, a.day, s.term_no, s.pi_name, s.power_user
            FROM (SELECT email, "timestamp" AS updated, CAST("timestamp" AS DATE) - 30 AS day FROM user_update_form) a
            LEFT JOIN seg_final s ON s.email = a.email AND s.from_date <= a.day
              AND (s.to_date IS NULL OR s.to_date >= a.day)""",
        "storage_as_of": priced
        + " SELECT project_id, storage_early, storage_late, storage_end FROM stored",
        "speed_codes": priced + " SELECT project_id, speed_code FROM stored",
        "user_terms": term
        + ' SELECT DISTINCT email, name, term_no, "start", "end" FROM replayed',
        "latest_terms": term
        + ' SELECT r.email, any_value(r.name) AS name, r.term_no, any_value(r."start") AS "start",'
        ' any_value(r."end") AS "end" FROM replayed r JOIN latest_end l USING (email, term_no)'
        " GROUP BY r.email, r.term_no",
        "user_segments": term
        + ' SELECT email, name, term_no, "start", "end", from_date, to_date, pi_name, power_user'
        " FROM replayed",
        "users_as_of": term
        + " SELECT email, name, term_no, pi_name, power_user FROM seg_final"
        f" WHERE from_date <= DATE '{LATE}' AND (to_date IS NULL OR to_date >= DATE '{LATE}')",
        "closure_pass": term
        + ' SELECT DISTINCT email, name, term_no, "start", "end" FROM seg_final',
        "project_users": days
        + ' SELECT DISTINCT d.pi_name AS pi, d.email, d.name, d.term_no, d."start", d."end"'
        " FROM user_days d WHERE d.pi_name IN (SELECT pi FROM kept)",
        "users_of_second_project": days
        + ' SELECT DISTINCT k.pi, d.email, d.name, d.term_no, d."start", d."end"'
        " FROM user_days d JOIN kept k ON k.pi = d.pi_name"
        f" WHERE k.project_id = '{SECOND_PROJECT}'",
        "power_user_list": days
        + " SELECT t.name, t.email FROM power_terms t JOIN holder h USING (pi)",
        "power_user_list_year": in_year
        + " SELECT t.name, t.email FROM power_terms t JOIN holder h USING (pi)",
        "billable_projects": priced
        + " SELECT project_id, pi, email, open_date, close_date FROM billable",
        "storage_charges": priced
        + " SELECT project_id, pi, storage_amount, storage_price FROM charge",
        "power_user_charges": priced
        + " SELECT project_id, pi, email, name, first_start, active_days, power_days, tier, price"
        " FROM priced",
        "compute_per_pi": priced
        + """ SELECT pi, count(*) AS power_users, count(*) FILTER (charged) AS billed_power_users,
                CAST(sum(CASE WHEN NOT charged THEN 0 WHEN place = 1 THEN 250 ELSE 125 END) AS DOUBLE)
                  AS compute_price,
                max(CASE WHEN charged AND place = 1 THEN email END) AS first_charged
              FROM ranked GROUP BY pi""",
        "quarter_summary": priced
        + " SELECT pi, email, storage_amount, storage_price, billed_power_users, compute_price,"
        " storage_price + compute_price AS total_price, speed_code FROM charge",
        "published_summary": priced
        + f" SELECT pi, email, storage_amount, storage_price, billed_power_users, compute_price,"
        f" storage_price + compute_price AS total_price, speed_code, DATE '{START}' AS quarter_start FROM charge",
        "quarter_totals": priced
        + """ SELECT fsum(storage_price) AS total_storage, fsum(compute_price) AS total_compute,
                fsum(storage_price + compute_price) AS total_overall,
                fsum(storage_price) / count(*) AS mean_storage,
                fsum(compute_price) / count(*) AS mean_compute,
                fsum(storage_price + compute_price) / count(*) AS mean_overall FROM charge""",
        "bills": lines
        + " SELECT project_id, doc_name, section, user_start, user_email, place, name, start_date,"
        " end_date, quantity, unit_price, share, amount FROM lines",
        "bill_documents": documents,
        "bill_of_project": f"SELECT * FROM ({documents}) WHERE project_id = '{FIRST_PROJECT}'",
        "bills_nested": lines
        + """, user_numbers AS (
              SELECT *, dense_rank() OVER (PARTITION BY project_id
                                           ORDER BY user_start, user_email) AS user_no
              FROM lines WHERE section = 2),
            per_user AS (
              SELECT project_id, CAST((user_no - 1) // 3 + 1 AS INTEGER) AS part_no,
                     CAST((user_no - 1) % 3 AS INTEGER) AS place_in_part,
                     max(name) AS last_name, max(amount) AS amount,
                     string_agg(start_date || ' to ' || end_date, '; ' ORDER BY place) AS terms
              FROM user_numbers GROUP BY project_id, user_no)
            SELECT h.project_id, h.doc_name, coalesce(u.part_no, 1) AS part_no,
                   CAST(greatest(ceil(h.power_users / 3), 1) AS INTEGER) AS parts,
                   h.pi AS pi_name, h.storage_end AS storage_tb,
                   printf('%.2f', h.storage_price) AS storage_subtotal,
                   printf('%.2f', h.compute_price) AS power_users_subtotal,
                   printf('%.2f', h.storage_price + h.compute_price) AS total, h.speed_code,
                   u.place_in_part, u.last_name, u.terms, substr(u.amount, 2) AS subtotal
            FROM head h LEFT JOIN per_user u USING (project_id)""",
        "violations_clean": days + _findings(),
        "violations_dirty": dirty + _findings("dirty_user") + _unreadable(),
    }
    # from a snapshot and newer events: the same rows as from all events
    for name in ("user_terms", "user_segments", "projects", "quarter_summary"):
        made[f"{name}_resumed"] = made[name]
    for name in ("user_segments", "quarter_summary"):
        made[f"{name}_of_events"] = made[name]
    return made


BODIES = """, bodies AS (
              SELECT project_id, section,
                     string_agg(concat_ws(' | ', name, start_date, end_date, quantity, unit_price,
                                          share, amount), chr(10)
                                ORDER BY user_start, user_email, place) AS body
              FROM lines GROUP BY 1, 2)
            , u AS (
              SELECT project_id, CAST((place_no - 1) // 3 + 1 AS INTEGER) AS part_no,
                     string_agg(concat_ws(' | ', name, start_date, end_date, quantity, unit_price,
                                          share, amount), chr(10)
                                ORDER BY user_start, user_email, place) AS body
              FROM (SELECT *, dense_rank() OVER (PARTITION BY project_id
                                                 ORDER BY user_start, user_email) AS place_no
                    FROM lines WHERE section = 2) GROUP BY 1, 2),
            parts AS (
              SELECT h.*, CAST(unnest(range(1, coalesce(m.parts, 1) + 1)) AS INTEGER) AS part_no,
                     coalesce(m.parts, 1) AS parts
              FROM head h LEFT JOIN (SELECT project_id, max(part_no) AS parts FROM u GROUP BY 1) m
                USING (project_id))
            SELECT h.project_id, h.doc_name, h.part_no, concat_ws(chr(10),
              CASE WHEN h.part_no = 1 THEN 'Invoice To: ' || h.pi || chr(10)
              || 'Billing Period: Jul 01, 1998--Sep 30, 1998' || chr(10)
              || 'Date: Oct 01, 1998' || chr(10)
              || 'Name | Start Date | End Date | Quantity | Unit Price | Quarter | Amount' || chr(10)
              || 'Storage' || chr(10) || s.body || chr(10) || 'Power Users' END,
              u.body,
              CASE WHEN h.part_no = h.parts THEN t.body || chr(10) || b.body || chr(10)
              || 'Billed to speed code: ' || coalesce(h.speed_code, '') END) AS body
            FROM parts h JOIN bodies s ON s.project_id = h.project_id AND s.section = 1
            LEFT JOIN u ON u.project_id = h.project_id AND u.part_no = h.part_no
            JOIN bodies t ON t.project_id = h.project_id AND t.section = 3
            JOIN bodies b ON b.project_id = h.project_id AND b.section = 4"""


def _findings(user_form: str = "user_form") -> str:
    return f""",
walk AS (
  SELECT *, max(CASE WHEN is_new OR creates THEN date END) OVER
              (PARTITION BY email ORDER BY ts, src_rank
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS term_start FROM e3),
found AS (
  SELECT 'missing_key' AS rule, 'user' AS entity, name AS key, CAST(ts AS DATE) AS event_date,
         'email' AS detail FROM user_log WHERE src_rank < 2 AND email IS NULL
  UNION ALL
  SELECT 'missing_key', 'project', email, open_date, 'last_name' FROM pi_req
  WHERE last_name IS NULL
  UNION ALL
  SELECT 'missing_key', 'project', last_name, open_date, 'email' FROM pi_req WHERE email IS NULL
  UNION ALL
  SELECT 'missing_power_user', 'user', email, CAST(ts AS DATE), NULL FROM user_log
  WHERE src_rank = 0 AND power_user IS NULL
  UNION ALL
  SELECT 'missing_timestamp', 'form', email, NULL, NULL FROM {user_form}
  WHERE start_timestamp IS NULL
  UNION ALL
  SELECT 'missing_storage', 'project', last_name, open_date, NULL FROM pi_req WHERE storage IS NULL
  UNION ALL
  SELECT 'missing_speed_code', 'project', last_name, open_date, NULL FROM pi_req
  WHERE speed_code IS NULL
  UNION ALL
  SELECT 'missing_pi', 'user', email, CAST(ts AS DATE), NULL FROM user_log
  WHERE src_rank = 0 AND pi_name IS NULL
  UNION ALL
  SELECT DISTINCT 'user_update_without_user', 'user', email, date, NULL FROM e1 WHERE NOT known
  UNION ALL
  SELECT DISTINCT 'end_before_start', 'user', email, date, NULL FROM walk
  WHERE end_after < term_start
  UNION ALL
  SELECT DISTINCT 'pi_update_without_pi', 'project', u.last_name, u.date, NULL
  FROM pi_upd u LEFT JOIN numbered n ON n.pi = u.last_name AND n.place = 1
  WHERE n.pi IS NULL OR u."timestamp" < n.open_ts
  UNION ALL
  SELECT 'inactive_at_period_end', 'project', project_id, close_date, NULL FROM kept
  WHERE close_date > DATE '{LATE}' AND close_date < DATE '{END}'
  UNION ALL
  SELECT CASE WHEN l.email IS NULL THEN 'user_update_without_user' ELSE 'closure_before_term' END,
         'user', c.email, c.close_date, 'project closure'
  FROM closing c LEFT JOIN latest_end l USING (email)
  WHERE l.email IS NULL OR c.close_date < l."start"
  UNION ALL
  SELECT 'unattached_power_user', 'user', t.email, min(t."start"), t.pi
  FROM power_terms t WHERE t.pi NOT IN (SELECT pi FROM kept) GROUP BY t.email, t.pi)
SELECT rule, entity, key, event_date, detail FROM found"""


def _unreadable() -> str:
    return """ UNION ALL
SELECT 'unreadable_cell', 'form', email, CAST(start_timestamp AS DATE), 'end_timestamp' FROM dirty_user
WHERE n % 59 = 7"""
