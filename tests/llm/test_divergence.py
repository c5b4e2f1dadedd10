"""The source audit against brute force with Python's whole numbers."""

import re
from collections import Counter, defaultdict

import pytest

from quarterbill.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least=3, most=200):
    docs, here, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        terms = TERM.findall(lower)
        sources[lang].add(source)
        docs[lang].update(set(terms))
        here[lang, source].update(terms)
    out = []
    for lang, all_sources in sources.items():
        kept = [t for t, n in docs[lang].items() if n >= least]

        def rates(counts, kept=kept):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // (total + len(kept)) for t in kept}

        whole = Counter()
        for s in all_sources:
            whole.update(here[lang, s])
        p, q = {s: rates(here[lang, s]) for s in all_sources}, rates(whole)
        for s in all_sources:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in all_sources - {s}]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if here[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                shown = found if part == "pair" else found[:most]
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(shown, 1)]
    return sorted(out)


def found(df):
    return sorted((r.lang, r.source, r.part, r["item"], r["value"], r["rank"]) for r in df.collect())


def given(docs):
    return [(r.text, r.lang, r.source) for r in docs.collect()]


def test_audit_against_brute_force(docs):
    for least in (1, 3):
        assert found(divergence.audit(docs, least_docs=least)) == brute(given(docs), least)


@pytest.mark.parametrize("most", [1, 3, 200])
def test_ties_repeats_and_many_groups(shipped, monkeypatch, most):
    monkeypatch.setattr(divergence, "HELD", 5)
    monkeypatch.setattr(divergence, "BLOCK", 7)
    rows = []
    for i in range(120):
        words = [f"w{chr(97 + (i * j) % 23)}" for j in range(1 + i % 9)] + ["Common", "straße", "\U0001f600x", "a1b2"][: i % 5]
        rows.append((" ".join(words) + "\x00-_Z", ["en", "de", None, ""][i % 4], [None, "", "s1", "s2", "é"][i % 5]))
    rows += [rows[0]] * 5 + [("", "xx", "a"), (None, "xx", "b"), ("once", "xx", "c")]  # a language without kept terms
    df = shipped.createDataFrame([(*r, 1, "t") for r in rows], "text string, lang string, source string, n long, term string")
    assert found(divergence.audit(df, most_terms=most)) == brute(rows, most=most)


def test_no_rows(empty):
    assert found(divergence.audit(empty)) == []
