"""Quality rules with thresholds learned from quantile sketches, in DataFrame functions alone.

Measures of a text are integers. A sketch is a table of counts per (group, measure, bin);
bins keep six leading binary digits, so a quantile is exact below 64 and within 1/32 above.
Sketches merge by adding counts: the same sketches serve a language and source, a language,
and all documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterbill.llm.common import stage

#: Fixed values of the base rules.
LEAST_WORDS, MOST_REPEATED = 50, 50
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"
#: Measures: the quantile that stands for the tail of sound texts, how far the bound lies beyond
#: it, and a slack in the measure's unit (millionths; hundredths for word_length).
#: symbols counts one symbol and one word more than a text has, so that a text without any has a
#: rate by its length. word_length is bounded on either side of its median, by so many times the
#: distance of the quantiles from it; the others above, by so many times the quantile.
RULES = {
    "symbols": (0.75, 8, 20_000),
    "dup_lines": (0.95, 5, 350_000),
    "repeats": (0.95, 5, 250_000),
    "word_length": (0.90, 4, 100),
}
#: A group's quantiles are drawn to its language's, and those to all documents', as if so many
#: more documents had these; sources of as many or more are peers of their language.
LEAST_GROUP = 100
#: A quantile counts up to so many times that of the lower quartile of the peers, so that a
#: source full of junk does not set its own bound, nor do such sources for each other while a
#: quarter of the peers is sound.
PEERS = 2


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of each whole text; a null text has none.

    Repeated windows are found by sorting the hashes of a text's windows beside their
    places, so the work per text grows as its length times the logarithm of it.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    counted = docs.select("doc_id", "lang", "source", text.alias("t")).select(
        "doc_id",
        "lang",
        "source",
        F.array_remove(F.split("t", r"[\x20\x09-\x0D]+"), "").alias("w"),
        F.length(F.translate("t", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("t", "\n"), lambda l: F.length(F.translate(l, SPACES, "")) > 0).alias("l"),
    )
    counted = counted.select(
        "doc_id", "lang", "source", "word_chars", "n_symbols",
        F.size("w").cast("long").alias("n_words"),
        F.size("l").cast("long").alias("n_lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.sort_array(
            F.expr(
                "transform(slice(w, 1, greatest(size(w) - 2, 0)),"
                " (x, i) -> struct(xxhash64(x, get(w, i + 1), get(w, i + 2)) AS h, i AS p))"
            )
        ).alias("s"),
    )
    counted = counted.withColumn(
        "p",
        F.expr(
            "sort_array(transform(filter(s, (x, k) -> get(s, k - 1).h <=> x.h OR get(s, k + 1).h <=> x.h), x -> x.p))"
        ),
    ).drop("s")
    covered = F.expr("aggregate(transform(p, (x, k) -> least(3, coalesce(get(p, k + 1) - x, 3))), 0L, (a, n) -> a + n)")
    return counted.withColumn("n_repeat_words", covered).drop("p")


def base_failed() -> Column:
    """The fixed rules: too few words, or too many of them repeated."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def _rates() -> dict[str, Column]:
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    rate = lambda part, whole: F.floor(1_000_000 * part / whole).cast("long")
    return {
        "symbols": rate(F.col("n_symbols") + 1, F.col("n_words") + 1),
        "dup_lines": rate(F.col("n_dup_lines"), lines),
        "repeats": rate(F.col("n_repeat_words"), words),
        "word_length": F.floor(100 * F.col("word_chars") / words).cast("long"),
    }


def sketch(measured: DataFrame) -> DataFrame:
    """Counts per lang, source, measure and bin, over texts that pass the base rules."""
    pairs = F.array(*(F.struct(F.lit(n).alias("measure"), r.alias("v")) for n, r in _rates().items()))
    return (
        measured.where(~base_failed())
        .select("lang", "source", F.explode(pairs).alias("m"))
        .select("lang", "source", "m.measure", "m.v")
        .groupBy("lang", "source", "measure", F.expr("v - pmod(v, shiftleft(1L, greatest(length(bin(v)) - 6, 0)))").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _by_measure(n: int) -> Column:
    pairs = (F.lit(x) for measure, rule in RULES.items() for x in (measure, rule[n]))
    return F.element_at(F.create_map(*pairs), F.col("measure"))


def quantiles(sketches: DataFrame, group: list[str]) -> DataFrame:
    """Low tail, median, high tail and size of each group, from its merged sketches."""
    merged = sketches.groupBy(*group, "measure", "bin").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*group, "measure")
    running = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    ranked = merged.withColumn("c", F.sum("n").over(running)).withColumn("total", F.sum("n").over(whole))
    at = lambda q: F.min(F.when(F.col("c") >= q * F.col("total"), F.col("bin")))
    return ranked.withColumn("tail", _by_measure(0)).groupBy(*group, "measure").agg(
        at(1 - F.col("tail")).alias("low"), at(F.lit(0.5)).alias("mid"), at(F.col("tail")).alias("high"),
        F.first("total").alias("total"),
    )


def thresholds(sketches: DataFrame) -> DataFrame:
    """Bounds of each measure per lang and source: a row with a column for each bound.

    Every bound moves with its group's quantiles, the less the smaller the group is. A language
    without a peer has no limit from peers; of up to four, the smallest quantile counts.
    """
    names = ("low", "mid", "high", "total")

    def level(group: list[str], p: str) -> DataFrame:
        return quantiles(sketches, group).withColumnsRenamed({c: f"{p}_{c}" for c in (*group, "measure", *names)})

    own = level(["lang", "source"], "o")
    peers = (
        own.where(F.col("o_total") >= LEAST_GROUP)
        .groupBy(F.col("o_lang").alias("p_lang"), F.col("o_measure").alias("p_measure"))
        .agg(F.expr("percentile_disc(0.25) WITHIN GROUP (ORDER BY o_high)").cast("long").alias("p_high"))
    )
    joined = (
        own.join(level(["lang"], "l"), F.expr("o_lang <=> l_lang AND o_measure = l_measure"))
        .join(level([], "e"), F.expr("o_measure = e_measure"))
        .join(peers, F.expr("o_lang <=> p_lang AND o_measure = p_measure"), "left")
        .withColumnRenamed("o_measure", "measure")
    )
    drawn = joined.select("o_lang", "o_source", "measure", "p_high", *(
        F.expr(
            f"(o_total * o_{c} + {LEAST_GROUP} * ((l_total * l_{c} + {LEAST_GROUP} * e_{c}) div (l_total + {LEAST_GROUP})))"
            f" div (o_total + {LEAST_GROUP})"
        ).alias(c)
        for c in ("low", "mid", "high")
    ))
    times, slack = _by_measure(1), _by_measure(2)
    limited = F.least("high", PEERS * F.col("p_high"))
    bounds = drawn.select(
        F.col("o_lang").alias("lang"),
        F.col("o_source").alias("source"),
        "measure",
        F.when(F.col("measure") == "word_length", F.col("mid") + times * (F.col("high") - F.col("mid")) + slack)
        .otherwise(times * limited + slack)
        .alias("upper"),
        (F.col("mid") - times * (F.col("mid") - F.col("low")) - slack).alias("lower"),
    )
    return bounds.groupBy("lang", "source").agg(
        *(F.max(F.when(F.col("measure") == m, F.col("upper"))).alias(f"upper_{m}") for m in RULES),
        F.max(F.when(F.col("measure") == "word_length", F.col("lower"))).alias("lower_word_length"),
    )


def judge(docs: DataFrame) -> DataFrame:
    """The counts of each document, whether the base rules fail it, and whether it is kept.

    Null lang and source are groups of their own. A null text has no words and fails. Rows
    with equal ids are judged one by one; other columns are ignored.
    """
    measured = stage(measures(docs), "measures")
    bounds = thresholds(stage(sketch(measured), "sketches"))
    rates = _rates()
    joined = measured.alias("d").join(
        bounds.withColumnsRenamed({"lang": "b_lang", "source": "b_source"}),
        F.expr("lang <=> b_lang AND source <=> b_source"),
        "left",
    )
    passed = rates["word_length"] >= F.col("lower_word_length")
    for m in RULES:
        passed = passed & (rates[m] <= F.col(f"upper_{m}"))
    failed = base_failed()
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & F.coalesce(passed, F.lit(True))).alias("kept"),
    )
