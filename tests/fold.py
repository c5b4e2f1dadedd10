"""A plain sequential replay of one person's log, to test the plans against."""

from __future__ import annotations

import datetime as dt


class Broken(Exception):
    """The log breaks a rule; carries the rule and the day."""


def replay(log):
    """Terms of one person, or `Broken`. `log` is in replay order."""
    terms = []
    for kind, day, end, pi, power in log:
        change = {"day": day, "pi": pi, "power": power}
        if kind == "request":
            if not terms:
                terms.append({"start": day, "end": end, "changes": [change]})
            else:
                terms[-1]["end"] = end
                terms[-1]["changes"].append(change)
        elif not terms:
            raise Broken("user_update_without_user", day)
        elif terms[-1]["end"] is None or terms[-1]["end"] >= day:
            terms[-1]["changes"].append(change)
            if end is not None:
                terms[-1]["end"] = end
        else:
            old = terms[-1]
            given = {
                name: change[name] if change[name] is not None else value_on(old, old["end"], name)
                for name in ("pi", "power")
            }
            terms.append(
                {"start": day, "end": end or old["end"], "changes": [{"day": day, **given}]}
            )
        last = terms[-1]
        if last["end"] is not None and last["end"] < last["start"]:
            raise Broken("end_before_start", day)
    return terms


def value_on(term, day, name):
    """The latest value given on or before a day; of one day's values the last."""
    found = None
    for change in term["changes"]:
        if change["day"] <= day and change[name] is not None:
            if found is None or change["day"] >= found["day"]:
                found = change
    return found[name]


def days_of(terms, first, last):
    """(day, term number, pi, power) for every active day in a range."""
    rows = set()
    for number, term in enumerate(terms):
        day = max(first, term["start"])
        while day <= last and (term["end"] is None or day <= term["end"]):
            rows.add((day, number, value_on(term, day, "pi"), value_on(term, day, "power")))
            day += dt.timedelta(days=1)
    return rows
