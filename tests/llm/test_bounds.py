"""Learned bounds in groups that hold junk."""

from quarterbill.llm import quality


def test_junk_in_a_part_of_a_group_does_not_lift_the_bound(shipped):
    def text(i, kind):
        words = [f"w{i}x{j}" for j in range(200)]
        if kind == "dup_lines":  # 40 lines of one word, and ten others
            return "\n".join(" ".join(words[j : j + 20]) + "\nShare" * 4 for j in range(0, 200, 20))
        if kind == "repeats":
            return " ".join(words + words[:45])
        return " ".join(words) + (" ###" * 60 if kind == "symbols" else "")

    rows, want = [], set()
    for kind in ("dup_lines", "repeats", "symbols"):
        for percent in (2, 10, 30):
            for i in range(100):
                doc = len(rows)
                junk = i < percent
                rows.append((doc, text(doc, kind if junk else None), "en", f"{kind}{percent}"))
                if junk:
                    want.add(doc)
    judged = quality.judge(shipped.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    assert judged.where("base_failed").count() == 0
    assert {r.doc_id for r in judged.where("NOT kept").collect()} == want


def test_bounds_follow_what_is_usual_in_a_group(shipped):
    """Texts that are junk where sound texts have little of a measure are kept where much of it is usual."""

    def text(i, kind, n):
        words = [f"w{10_000 + i}x{100 + j}" for j in range(200)]
        if kind == "symbols":
            return " ".join(w + "#" * (j < n) for j, w in enumerate(words))
        if kind == "repeats":
            return " ".join(words + words[:n])
        lines = [" ".join(words[j : j + 8]) for j in range(0, 200, 8)]
        return "\n".join(l + "\nShare" * (j < n) for j, l in enumerate(lines))

    levels = {"symbols": (4, 100, 100), "repeats": (1, 50, 45), "dup_lines": (1, 24, 21)}  # usual, usual elsewhere, junk
    rows, want = [], set()
    for kind, (little, much, junk) in levels.items():
        for percent in (0, 0, 0, 0, 0, 2, 10, 30, 60):
            source = f"{percent}-{len(rows)}"
            for i in range(100):
                doc = len(rows)
                bad = i < percent
                if bad:
                    want.add(doc)
                rows.append((doc, text(doc, kind, junk if bad else i % (little + 1)), f"{kind} little", source))
                rows.append((doc + 1, text(doc + 1, kind, junk if bad else i % (much + 1)), f"{kind} much", source))
    judged = quality.judge(shipped.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    assert judged.where("base_failed").count() == 0
    assert {r.doc_id for r in judged.where("NOT kept").collect()} == want


def test_a_small_group_lies_between_itself_and_its_language(shipped):
    def high(n, own):
        counts = [("en", "few", "repeats", own, n), ("en", "many", "repeats", 64_000, 900)]
        counts += [("en", s, m, 1_000, k) for s, k in (("few", n), ("many", 900)) for m in quality.RULES if m != "repeats"]
        table = shipped.createDataFrame(counts, "lang string, source string, measure string, bin long, n long")
        return {r.source: r.upper_repeats for r in quality.thresholds(table).collect()}

    _, times, slack = quality.RULES["repeats"]
    bounds = [high(n, 8_000)["few"] for n in (1, 10, 50)]
    assert bounds == sorted(bounds, reverse=True) and slack + times * 8_000 < bounds[-1] < bounds[0] < slack + times * 64_000
    assert high(10, 900_000)["few"] <= slack + times * 2 * 64_000  # twice the peer's
