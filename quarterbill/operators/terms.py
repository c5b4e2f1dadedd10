"""Replay of the user log: from events to terms and validity intervals.

The log is folded in two steps. First every person's day becomes one row that says what
the day does to whatever state it meets; this is a plain aggregate, so a person with any
number of events never sits in one task. Then windows per person run over those rows, of
which there are at most as many as calendar days.

Only a day on which somebody asks for an end before that same day needs its events in
order. Such a day can hold any number of events too: it is cut into pieces, each reduced on
its own, and the state is carried from piece to piece (`splits`).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterbill.functions.periods import Period, active_on

REPLAY_ORDER = "ts, src_rank, seq, end_date, pi_name, power_user"
BACKDATED = "coalesce(end_date < date, false)"

#: Most events of a back-dated day that one window runs over.
PIECE = 1024


def _latest(field: str, when: str) -> str:
    return f"(max(event) FILTER (WHERE {when})).{field}"


def _day_columns() -> list[Column]:
    """What a day does; `event` is the struct of `REPLAY_ORDER`."""
    sets_end = "(event.src_rank % 2 = 0 OR event.end_date IS NOT NULL)"
    return [
        F.expr(column)
        for column in (
            "bool_or(event.src_rank % 2 = 0) AS has_request",
            "min(event).src_rank % 2 = 1 AS update_first",
            "min(event).end_date IS NOT NULL AS first_sets_end",
            """(min(struct(event, name)) FILTER (WHERE event.src_rank % 2 = 0)).name
               AS name""",
            # A struct, since a request without an end also sets one (to none).
            f"""CASE WHEN bool_or({sets_end})
                     THEN named_struct('end', {_latest("end_date", sets_end)}) END
                AS marker""",
            _latest("pi_name", "event.pi_name IS NOT NULL") + " AS pi_name",
            _latest("power_user", "event.power_user IS NOT NULL") + " AS power_user",
            "bool_or(coalesce(event.end_date < date, false)) AS backdated",
        )
    ]


def day_states(events: DataFrame) -> DataFrame:
    """One row per person and day.

    `split_*`: set when, within the day, a term was ended in the past and an update then
    began a new one; `split_end` is the end of the old term, the other two are what the
    new term was given.
    """
    events = events.where("email IS NOT NULL AND ts IS NOT NULL")
    plain = (
        events.selectExpr("email", "date", "name", f"struct({REPLAY_ORDER}) AS event")
        .groupBy("email", "date")
        .agg(*_day_columns())
    )
    return plain.join(splits(events), ["email", "date"], "left").withColumns(
        {
            "splits": F.expr("coalesce(splits, 0)"),
            "split_sets_end": F.expr("coalesce(split_sets_end, false)"),
        }
    )


def in_pieces(events: DataFrame) -> DataFrame:
    """The events of back-dated days, placed in replay order and cut into pieces.

    `place` is dealt out by range partitions, each sorted on its own, so a day of any
    length is spread over tasks; a piece has at most `PIECE` events of the global order.
    """
    backdated = events.where(BACKDATED).select("email", "date").distinct()
    return (
        events.join(backdated, ["email", "date"], "left_semi")
        .selectExpr("email", "date", *REPLAY_ORDER.split(", "), "is_request")
        .repartitionByRange("email", "date", *REPLAY_ORDER.split(", "))
        .sortWithinPartitions("email", "date", *REPLAY_ORDER.split(", "))
        .withColumn("place", F.monotonically_increasing_id())
        .withColumn("piece", F.expr(f"place div {PIECE}"))
    )


def _of_piece() -> list[Column]:
    """What a piece of a day does, for both things that can come before it.

    `past` has what holds if the term's end, as it stands before the piece, lies before the
    day; `open` what holds otherwise. Only events up to the piece's first new end differ.
    """

    def variant(name: str) -> str:
        starts, no = f"starts_{name}", f"split_no_{name}"
        return f"""struct(
            sum(cast({starts} AS int)) AS splits,
            min(struct(place, earlier IS NULL AS from_before, earlier.end AS end,
                       end_date IS NOT NULL AS sets_end)) FILTER (WHERE {starts}) AS first,
            min(end_date) FILTER (WHERE {no} = 0) AS low_before,
            min(end_date) FILTER (WHERE {no} > 0) AS low_after,
            max(struct(place, pi_name)) FILTER (WHERE {no} > 0 AND pi_name IS NOT NULL) AS pi,
            max(struct(place, power_user)) FILTER (WHERE {no} > 0 AND power_user IS NOT NULL)
              AS power) AS {name}"""

    return [
        F.expr(column)
        for column in (
            variant("open"),
            variant("past"),
            "max(struct(place, marker)) FILTER (WHERE marker IS NOT NULL) AS last_marker",
            "min(end_date) AS low",
            "max(struct(place, pi_name)) FILTER (WHERE pi_name IS NOT NULL) AS pi",
            "max(struct(place, power_user)) FILTER (WHERE power_user IS NOT NULL) AS power",
        )
    ]


def splits(events: DataFrame) -> DataFrame:
    """What back-dated days do in the middle, one row per person and such day.

    A prefix scan in three steps: each piece is reduced to what it does to any state, the
    state before each piece follows from the pieces before it, and the days are summed up
    from pieces of which the state is now known.
    """
    in_piece = "PARTITION BY email, date, piece ORDER BY place"
    before = """(PARTITION BY email, date ORDER BY piece
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
    pieces = (
        in_pieces(events)
        .selectExpr(
            "*",
            "CASE WHEN is_request OR end_date IS NOT NULL THEN named_struct('end', end_date) END AS marker",
        )
        .selectExpr(
            "*",
            f"""last(marker) IGNORE NULLS OVER ({in_piece}
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier""",
        )
        .selectExpr(
            "*",
            "NOT is_request AND coalesce(earlier.end < date, false) AS starts_open",
            "NOT is_request AND coalesce(earlier.end < date, earlier IS NULL) AS starts_past",
        )
        .selectExpr(
            "*",
            *[
                f"""sum(cast(starts_{name} AS int)) OVER ({in_piece}
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS split_no_{name}"""
                for name in ("open", "past")
            ],
        )
        .groupBy("email", "date", "piece")
        .agg(*_of_piece())
    )
    return (
        pieces.selectExpr(
            "*", f"(last(last_marker) IGNORE NULLS OVER {before}).marker.end AS end_before"
        )
        .selectExpr("*", "if(coalesce(end_before < date, false), past, open) AS does")
        .selectExpr("*", f"coalesce(sum(does.splits) OVER {before}, 0) > 0 AS was_split")
        .groupBy("email", "date")
        .agg(
            F.expr(
                """min(struct(piece, if(does.first.from_before, end_before, does.first.end) AS end,
                              does.first.sets_end))
                     FILTER (WHERE NOT was_split AND does.splits > 0) AS first"""
            ),
            F.expr("max(if(was_split, pi, does.pi)).pi_name AS split_pi"),
            F.expr("max(if(was_split, power, does.power)).power_user AS split_power"),
            F.expr("cast(sum(does.splits) AS int) AS splits"),
            F.expr("min(if(was_split, NULL, does.low_before)) AS lowest_before"),
            F.expr("min(if(was_split, low, does.low_after)) AS lowest_after"),
        )
        .selectExpr(
            "email",
            "date",
            "first.end AS split_end",
            "split_pi",
            "split_power",
            "splits",
            "coalesce(first.sets_end, false) AS split_sets_end",
            "lowest_before",
            "lowest_after",
        )
    )


def walk_days(days: DataFrame) -> DataFrame:
    """Number the terms of each person along their days.

    Keeps the days before a person's first request (`known` is false there), which
    only the checks look at.
    """
    by_day = "PARTITION BY email ORDER BY date"
    so_far = f"({by_day} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    earlier = f"({by_day} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return (
        days.selectExpr(
            "*",
            f"coalesce(bool_or(has_request) OVER {earlier}, false) AS known_before",
            f"last(marker) IGNORE NULLS OVER {earlier} AS prior",
            f"last(marker) IGNORE NULLS OVER {so_far} AS after",
            f"first(name) IGNORE NULLS OVER {so_far} AS first_name",
        )
        .selectExpr(
            "*",
            "known_before OR has_request AS known",
            "has_request AND NOT known_before AS creates",
            "known_before AND update_first AND coalesce(prior.end < date, false) AS reopens",
        )
        .selectExpr(
            "*", "known_before AND NOT reopens AND split_end IS NOT NULL AS divides"
        )
        .selectExpr("*", "creates OR reopens OR divides AS new_term")
        .selectExpr(
            "*",
            f"sum(cast(new_term AS int)) OVER {so_far} - 1 AS term_no",
            f"max(CASE WHEN new_term THEN date END) OVER {so_far} AS start",
            f"lead(if(new_term, NULL, date)) OVER ({by_day}) AS next_in_term",
            f"max(CASE WHEN new_term THEN date END) OVER {earlier} AS prior_start",
            f"lead(CASE WHEN divides THEN split_end END) OVER ({by_day}) AS cut_by_next",
        )
    )


def valued(walked: DataFrame, *carried: str) -> DataFrame:
    """Every known day with its term's end and the PI and privilege that hold from then on.

    `walked` comes from `walk_days`; its partitioning serves all windows here. `carried`
    are further columns to keep, as SQL text.
    """
    whole_term = """(PARTITION BY email, term_no ORDER BY date
                     ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""
    so_far = """(PARTITION BY email ORDER BY term_no, date
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

    def valid(name: str) -> str:
        # A reinstated term takes what it is not given from the old term's last day, so
        # values that came after a term's end must not count.
        return f"""last(if(end IS NULL OR date <= end, {name}, NULL)) IGNORE NULLS
                   OVER {so_far} AS {name}"""

    return (
        walked.where("known")
        .selectExpr(
            "email",
            "first_name AS name",
            "term_no",
            "start",
            "date",
            "next_in_term",
            "if(divides, split_pi, pi_name) AS pi_name",
            "if(divides, split_power, power_user) AS power_user",
            f"last(coalesce(cut_by_next, after.end)) OVER {whole_term} AS end",
            *carried,
        )
        .selectExpr(
            "email",
            "name",
            "term_no",
            "start",
            "end",
            "date AS from_date",
            "least(end, date_sub(next_in_term, 1)) AS to_date",
            valid("pi_name"),
            valid("power_user"),
            *[text.split(" AS ")[-1] for text in carried],
        )
    )


def segments(walked: DataFrame) -> DataFrame:
    """Validity intervals: in each, a term has one PI and one privilege.

    Both ends are closed, a null end is open. Terms that end before they start, which the
    checks report, have none.
    """
    return valued(walked).where("to_date IS NULL OR to_date >= from_date")


def kept_for(segment_rows: DataFrame, period: Period) -> DataFrame:
    """Terms that end after the first day of the period, or not at all."""
    return segment_rows.where(f"end IS NULL OR end > date'{period.start}'")


def terms(segment_rows: DataFrame) -> DataFrame:
    """One row per term."""
    return segment_rows.where("from_date = start").select(
        "email", "name", "term_no", "start", "end"
    )


def latest_terms(segment_rows: DataFrame) -> DataFrame:
    """Each person's term with the latest start."""
    return (
        terms(segment_rows)
        .selectExpr("*", "max(term_no) OVER (PARTITION BY email) AS newest")
        .where("term_no = newest")
        .drop("newest")
    )


def as_of(segment_rows: DataFrame, day: dt.date) -> DataFrame:
    """Who was active on a day, with the PI and the privilege of that day."""
    return segment_rows.where(active_on(f"date'{day}'", "from_date", "to_date")).select(
        "email", "name", "term_no", "pi_name", "power_user"
    )


def close_dates(pi_rows: DataFrame) -> DataFrame:
    """The close dates of kept projects per person; bounded by the calendar."""
    return (
        pi_rows.where(
            "first_kept AND close_date IS NOT NULL AND first.email IS NOT NULL"
        )
        .selectExpr("first.email", "close_date")
        .groupBy("email")
        .agg(F.sort_array(F.collect_set("close_date")).alias("closes"))
    )


def apply_closures(segment_rows: DataFrame, pi_rows: DataFrame) -> DataFrame:
    """End the latest term of a PI whose kept project closed, on the close date.

    `segment_rows` are the kept ones. A close date after the term's end adds a term of
    that one day; one before the term's start is left to the checks.
    """
    return (
        segment_rows.join(close_dates(pi_rows), "email", "left")
        .selectExpr(
            "*", "term_no = max(term_no) OVER (PARTITION BY email) AS is_latest"
        )
        .selectExpr(
            "* EXCEPT (closes)",
            "if(is_latest, filter(closes, day -> day >= start), NULL) AS closes",
        )
        .selectExpr(
            "*", "if(coalesce(get(closes, 0) <= end, true), get(closes, 0), NULL) AS cut"
        )
        .selectExpr(
            "email",
            "name",
            "term_no",
            "start",
            "coalesce(cut, end) AS end",
            "from_date",
            "least(to_date, cut) AS to_date",
            "pi_name",
            "power_user",
            "filter(closes, day -> cut IS NULL OR day > cut) AS later",
        )
        .where("to_date IS NULL OR to_date >= from_date")
        .selectExpr(
            "*",
            """posexplode(concat(array(cast(NULL AS date)),
                 if(to_date = end AND later IS NOT NULL, later, array()))) AS (place, day)""",
        )
        .selectExpr(
            "email",
            "name",
            "term_no + place AS term_no",
            "coalesce(day, start) AS start",
            "coalesce(day, end) AS end",
            "coalesce(day, from_date) AS from_date",
            "coalesce(day, to_date) AS to_date",
            "pi_name",
            "power_user",
        )
    )
