"""Which sources of a language differ from each other, and by which terms.

Counts are worked on in cells. Terms of a source with equal (count in the source, count in
the language) have equal rates and so one divergence: it is computed once per cell, cells
are ranked by their divergence with the number of their terms added up, cells of equal
divergence are merged, and only terms of the cells that reach the first ranks are listed.
Two sources are compared over cells (count in one, count in the other): terms that both
have are counted by cell, terms that one of them lacks by that one's count alone, so no row
is made for a term and a source that lacks it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarterbill.llm.common import stage

#: Runs of letters: ASCII letters and everything beyond ASCII; on lower-cased UTF-8 bytes.
TERM = re.compile(rb"[a-z\x80-\xff]+")
BREAK = re.compile(rb"[^a-z\x80-\xff]")
#: Different (lang, source, term) that a task holds before it passes their counts on.
HELD = 1_000_000
#: A term's documents are counted in so many low bits, its occurrences above them.
DOCS = 24
#: Bytes of a text that are searched at a time.
BLOCK = 1 << 20
RATE = 1_000_000_000

PARTIAL = "lang string, source string, term string, n long, docs long"


def _blocks(data: bytes) -> Iterator[bytes]:
    """A text in blocks that end between terms."""
    start = 0
    while start < len(data):
        cut = BREAK.search(data, start + BLOCK) if start + BLOCK < len(data) else None
        end = cut.start() if cut else len(data)
        yield data[start:end]
        start = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents per (lang, source, term); a row without term per group."""
    held: dict[tuple, dict[bytes, int]] = {}
    size = rows = 0

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), terms in held.items():
            names = [None, *(t.decode() for t in terms)]
            counts = np.array([0, *terms.values()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(names), pa.string()),
                    pa.array([source] * len(names), pa.string()),
                    pa.array(names, pa.string()),
                    pa.array(counts >> DOCS),
                    pa.array(counts & ((1 << DOCS) - 1)),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )

    for batch in batches:
        for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            found: Counter[bytes] = Counter()
            for block in _blocks((text or "").encode().lower()):  # bytes.lower() changes A-Z alone
                found.update(TERM.findall(block))
            terms = held.setdefault((lang or "", source or ""), {})
            before = len(terms)
            for term, n in found.items():
                terms[term] = terms.get(term, 0) + (n << DOCS | 1)
            size += len(terms) - before
            rows += 1
            if size > HELD or rows >> DOCS - 1:
                yield from out()
                held, size, rows = {}, 0, 0
    yield from out()


def _rate(n: str, total: str, kinds: str) -> Column:
    """1 + floor(10^9 (n + 1) / (total + kinds)), exact."""
    return F.expr(f"1L + ({RATE}BD * ({n} + 1BD)) div cast({total} + {kinds} AS decimal(20, 0))")


def _divergence(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) div {q})"  # rates are at most 10^9 + 1: fits a long


def counts(docs: DataFrame, least_docs: int = 3) -> tuple[DataFrame, DataFrame]:
    """The kept terms and the groups of documents, both staged.

    terms: (lang, term, lang_n, by_source: array of (source, n), sorted by source).
    groups: (lang, source, total: occurrences of kept terms in the source, lang_total, kinds:
    kept terms of the language); one row per (lang, source) of documents.
    """
    partial = stage(docs.select("lang", "source", "text").mapInArrow(_count, PARTIAL), "term_counts")
    kept = stage(
        partial.where("term IS NOT NULL")
        .repartition("lang", "term")  # serves both groupings
        .groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .groupBy("lang", "term")
        .agg(
            F.sum("n").alias("lang_n"),
            F.sum("docs").alias("docs"),
            F.sort_array(F.collect_list(F.struct("source", "n"))).alias("by_source"),
        )
        .where(F.col("docs") >= least_docs)
        .drop("docs"),
        "terms",
    )
    langs = kept.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count(F.lit(1)).alias("kinds"))
    totals = kept.select("lang", F.inline("by_source")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    seen = partial.where("term IS NULL").select("lang", "source").distinct()
    groups = (
        seen.join(langs, "lang", "left")
        .join(totals, ["lang", "source"], "left")
        .na.fill(0, ["total", "lang_total", "kinds"])
        .select("lang", "source", "total", "lang_total", "kinds")
    )
    return kept, stage(groups, "groups")


def top_terms(kept: DataFrame, groups: DataFrame, most: int = 200) -> DataFrame:
    """(lang, source, item, value, rank): the terms a source uses more than its language does."""
    terms = kept.select("lang", "term", "lang_n", F.inline("by_source"))
    key = ["lang", "source"]
    cells = (
        terms.groupBy(*key, "n", "lang_n")
        .agg(F.count(F.lit(1)).alias("terms"))
        .join(groups, key)
        .select(*key, "n", "lang_n", "terms", _rate("n", "total", "kinds").alias("p"), _rate("lang_n", "lang_total", "kinds").alias("q"))
        .where("p > q")
        .selectExpr(*key, "n", "lang_n", "terms", f"{_divergence('p', 'q')} AS value")
    )
    by_value = Window.partitionBy(*key).orderBy(F.desc("value"))
    # each value has a term at least, so the first `most` values hold all terms up to that rank
    values = (
        cells.groupBy(*key, "value")
        .agg(F.sum("terms").alias("terms"))
        .withColumn("place", F.row_number().over(by_value))
        .where(F.col("place") <= most)
        .withColumn("before", F.sum("terms").over(by_value) - F.col("terms"))
        .where(F.col("before") < most)
        .select(*key, "value", "before")
    )
    reached = stage(cells.join(values, [*key, "value"]).select(*key, "n", "lang_n", "value", "before"), "cells")
    in_value = Window.partitionBy(*key, "value").orderBy("term")
    return (
        terms.join(reached, [*key, "n", "lang_n"])
        .withColumn("place", F.row_number().over(in_value))
        .where(F.col("place") <= most)
        .withColumn("rank", (F.col("before") + F.col("place")).cast("int"))
        .where(F.col("rank") <= most)
        .select(*key, F.col("term").alias("item"), "value", "rank")
    )


def source_pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): every other source of the language, most different first.

    With f(a, b) for a term that the first source has a times and the second b times, the sum
    over all kept terms is that of f(a, 0) over the first's cells, f(0, b) over the second's,
    f(0, 0) over the terms left, and over the cells of both what these three have wrong.
    """
    has = kept.select("lang", F.inline("by_source"))
    own = stage(has.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("terms")), "own_cells")
    size = own.groupBy("lang", "source").agg(F.sum("terms").alias("has"))
    known = groups.join(size, ["lang", "source"], "left").na.fill(0, ["has"])
    side = lambda c: known.select(
        "lang", F.col("source").alias(c), F.col("total").alias(f"{c}_total"), F.col("has").alias(f"{c}_has"), "kinds"
    )
    pairs = stage(side("s").join(side("t").drop("kinds"), "lang").where("s != t"), "pairs")

    # terms with the same counts in the same sources are one row before their sources are paired
    vectors = kept.where(F.size("by_source") > 1).groupBy("lang", "by_source").agg(F.count(F.lit(1)).alias("terms"))
    both = (
        vectors.select("lang", "by_source", "terms", F.posexplode("by_source").alias("at", "a"))
        .select("lang", "terms", "a", F.explode(F.expr("slice(by_source, at + 2, size(by_source))")).alias("b"))
        .groupBy("lang", F.col("a.source").alias("s"), F.col("b.source").alias("t"), F.col("a.n").alias("a"), F.col("b.n").alias("b"))
        .agg(F.sum("terms").alias("terms"))
    )
    both = both.select("lang", "terms", F.inline(F.expr("array(struct(s, t, a, b), struct(t AS s, s AS t, b AS a, a AS b))")))

    def value(name: str, a: str, b: str) -> str:
        return f"cast({_divergence(f'p_{a}', f'q_{b}')} AS decimal(38, 0))"

    def rated(df: DataFrame, a: str, b: str) -> DataFrame:
        return df.select(
            "lang", "s", "t", "terms",
            _rate(a, "s_total", "kinds").alias("p_n"), _rate("0", "s_total", "kinds").alias("p_0"),
            _rate(b, "t_total", "kinds").alias("q_n"), _rate("0", "t_total", "kinds").alias("q_0"),
        )

    def summed(df: DataFrame, f: str) -> DataFrame:
        return df.groupBy("lang", "s", "t").agg(F.expr(f"sum(terms * ({f})) AS part"))

    f = {(a, b): value("f", a, b) for a in "n0" for b in "n0"}
    some = pairs.where("kinds > 0")
    parts = [
        summed(rated(both.join(some, ["lang", "s", "t"]), "a", "b"), f"{f['n', 'n']} - {f['n', '0']} - {f['0', 'n']} + {f['0', '0']}"),
        summed(rated(some.join(own.withColumnRenamed("source", "s"), ["lang", "s"]), "n", "0"), f["n", "0"]),
        summed(rated(some.join(own.withColumnRenamed("source", "t"), ["lang", "t"]), "0", "n"), f["0", "n"]),
        summed(rated(some.withColumn("terms", F.expr("kinds - s_has - t_has")), "0", "0"), f["0", "0"]),
        pairs.select("lang", "s", "t", F.lit(0).cast("decimal(38, 0)").alias("part")),
    ]
    everything = parts[0]
    for part in parts[1:]:
        everything = everything.unionByName(part)
    ranked = Window.partitionBy("lang", "s").orderBy(F.desc("value"), "t")
    return (
        everything.groupBy("lang", "s", "t")
        .agg(F.sum("part").cast("long").alias("value"))
        .select("lang", F.col("s").alias("source"), F.col("t").alias("item"), "value", F.row_number().over(ranked).alias("rank"))
    )


def audit(docs: DataFrame, least_docs: int = 3, most_terms: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank) of documents, in two parts.

    `pair`: each other source of the language by its divergence from the source, all ranks.
    `term`: the terms that the source has more often than its language, ranks to `most_terms`.
    A term is a run of letters (ASCII letters, lower-cased, and all characters beyond ASCII)
    that `least_docs` documents of the language hold. With p and q two rates in 10^-9, add-one
    smoothed over the kept terms, the divergence is floor((p - q)^2 / q).

    A null text, lang or source is the empty string, and such rows form a group like any other.
    Repeated rows are documents of their own. Ties go to the smaller item in UTF-8 order. A
    group without kept terms has pairs and no terms; a language without kept terms has pairs of
    value 0. An empty table gives no rows. Other columns are ignored. The pairs of a language
    are as many as the contract asks for: the square of its sources.
    """
    kept, groups = counts(docs, least_docs)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = source_pairs(kept, groups).withColumn("part", F.lit("pair")).select(columns)
    return pairs.unionByName(top_terms(kept, groups, most_terms).withColumn("part", F.lit("term")).select(columns))
