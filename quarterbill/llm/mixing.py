"""Mixing sources to target weights by entropy balancing.

Each source has a target number of words. Among all document rates r whose words meet the
target, entropy balancing takes those nearest to one copy each, that is the least sum of
r * log(r) - r. The convex dual has one multiplier a source, and the rates are exponentially
tilted: r = min(cap, exp(lambda * size / mean size)). Newton's iterations on the dual are
sums over a table of counts per (source, size), which is as long as there are different
sizes; their state is a table with one row per source. Rates are then rounded to copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterbill.llm.common import SPACE, same_key, stage, unstage

#: Sums of rates are made in fixed point, so that they do not depend on the order of rows.
FIXED = "decimal(38,6)"
MOST_ROUNDS = 100
CELL_BITS = 20  # extra copies are dealt over 2^20 cells a source, found in two steps
TOP_BITS = 10


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), "")


def targets(histogram: DataFrame, weights: tuple[float, ...], budget: float, cap: float) -> DataFrame:
    """source, source_size, mean, weight, target: one row per source.

    Sources in order of code points, null last, weigh as in `weights`, repeating. They share
    `budget` times all words by weight; a source stops at `cap` times its words, and what is
    over goes to the others by weight until none is above.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1  # a row per source
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (place % len(weights) + 1).cast("int"))
    sources = stage(
        histogram.groupBy("source")
        .agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("documents"))
        .withColumn("weight", weight),
        "sources",
    )
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, None
    while True:  # the level rises, so sources only join the capped ones: ends after as many rounds
        over = F.col("weight") * F.lit(level) > cap * F.col("source_size")
        row = sources.agg(
            F.count(F.when(over, 1)).alias("n"),
            F.sum(F.when(over, cap * F.col("source_size")).otherwise(0.0)).alias("full"),
            F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("free"),
        ).first()
        if row.n == capped or not row.free:
            break
        capped, level = row.n, (budget * total - row.full) / row.free
    limit = cap * F.col("source_size")
    target = limit if row.free == 0 else F.least(F.col("weight") * level, limit)
    mean = F.greatest(F.col("source_size") / F.col("documents"), F.lit(1.0))
    return sources.select("source", "source_size", mean.alias("mean"), "weight", target.cast("double").alias("target"))


def _rate(cap: float) -> Column:
    """The tilted rate; a source at its cap takes all its documents so often."""
    tilted = F.exp(F.least(F.col("lambda") * F.col("size") / F.col("mean"), F.lit(50.0)))
    return F.when(F.col("full"), F.lit(cap)).otherwise(F.least(tilted, F.lit(cap)))


def multipliers(histogram: DataFrame, wanted: DataFrame, cap: float) -> DataFrame:
    """`wanted` with each source's multiplier, by Newton's iterations on the dual.

    The step is Newton's on log(words) and is kept inside the bracket of the root, which
    every evaluation narrows. A source without words, or at its cap, needs none.
    """
    full = F.col("target") >= cap * F.col("source_size") * (1 - 1e-12)
    state = stage(
        wanted.select(
            *wanted.columns,
            full.alias("full"),
            F.lit(0.0).alias("lambda"),
            F.lit(None).cast("double").alias("low"),
            F.lit(None).cast("double").alias("high"),
            (full | (F.col("source_size") == 0)).alias("done"),
        ),
        "multipliers",
    )
    for _ in range(MOST_ROUNDS):
        if state.where("NOT done").isEmpty():
            return state
        rate = _rate(cap)
        got = F.col("size") * F.col("n") * F.col("rate")
        slope = F.when(F.col("rate") < cap, got * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = (
            same_key(histogram, state.where("NOT done"), ["source"], "inner")
            .withColumn("rate", rate)
            .groupBy("source")
            .agg(F.sum(got.cast(FIXED)).cast("double").alias("words"), F.sum(slope.cast(FIXED)).cast("double").alias("slope"))
        )
        above = F.col("words") > F.col("target")
        low = F.when(above, F.col("low")).otherwise(F.col("lambda"))
        high = F.when(above, F.col("lambda")).otherwise(F.col("high"))
        newton = F.when(
            (F.col("slope") > 0) & (F.col("words") > 0),
            F.col("lambda") - F.log(F.col("words") / F.col("target")) * F.col("words") / F.col("slope"),
        )
        middle = (
            F.when(F.col("low").isNull(), F.col("high") - 1 - F.abs("high"))
            .when(F.col("high").isNull(), F.col("low") + 1 + F.abs("low"))
            .otherwise((F.col("low") + F.col("high")) / 2)
        )
        inside = F.coalesce(newton > F.col("low"), F.lit(True)) & F.coalesce(newton < F.col("high"), F.lit(True))
        near = F.abs(F.col("words") - F.col("target")) <= 0.01 + 1e-9 * F.col("target")
        then = (
            same_key(state, sums, ["source"])
            .withColumn("done", F.col("done") | F.coalesce(near, F.lit(False)))
            .withColumns({"low": F.when(F.col("done"), F.col("low")).otherwise(low), "high": F.when(F.col("done"), F.col("high")).otherwise(high)})
            .withColumn("next", F.when(newton.isNotNull() & inside, newton).otherwise(middle))
            .withColumn("lambda", F.when(F.col("done"), F.col("lambda")).otherwise(F.col("next")))
            .select(*state.columns)
        )
        new = stage(then, "multipliers")
        unstage(state)
        state = new
    raise ArithmeticError(f"no multiplier after {MOST_ROUNDS} rounds")


def _dealt(rows: DataFrame, rates: DataFrame, cap: float) -> DataFrame:
    """Rows with their rate, whole copies, and cell in the order of extra copies.

    The order is that of sequential Poisson sampling: a hash of the document over the
    fraction that its rate leaves, so a document's chance of an extra copy is its fraction.
    """
    joined = same_key(rows, rates, ["source"], "inner").withColumn("rate", _rate(cap))
    whole = F.floor("rate").cast("long")
    chance = F.col("rate") - whole
    draw = (F.pmod(F.xxhash64("doc_id", "size"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    order = F.when((chance > 0) & (F.col("size") > 0), draw / (draw + chance))
    return joined.withColumns({"copies": whole, "order": order}).withColumn(
        "cell", F.floor(F.col("order") * (1 << CELL_BITS)).cast("int")
    )


def _edge(sums: DataFrame, cell: str) -> DataFrame:
    """Per source, the first cell at which the running words reach what is missing."""
    running = Window.partitionBy("source").orderBy(cell).rowsBetween(Window.unboundedPreceding, 0)
    return (
        sums.withColumn("upto", F.sum("words").over(running))
        .where("upto >= missing")
        .groupBy("source")
        .agg(F.min(F.struct(cell, (F.col("upto") - F.col("words")).alias("before"))).alias("e"))
        .select("source", F.col(f"e.{cell}").alias("edge"), F.col("e.before").alias("before"))
    )


class Mix:
    """The mix of a table of documents: its plan, and what it takes of each row."""

    def __init__(self, docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), budget: float = 1.5, cap: float = 2.0):
        self.cap = cap
        self.sized = stage(self._sized(docs.select("doc_id", "source", "text")).drop("text"), "sizes")
        histogram = stage(self.sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "histogram")
        wanted = targets(histogram, weights, budget, cap)
        rates = multipliers(histogram, wanted, cap)
        dealt = _dealt(self.sized, rates, cap)
        whole = dealt.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("whole"))
        missing = same_key(rates.select("source", "target"), whole, ["source"]).select(
            "source", F.greatest(F.floor("target") - F.coalesce("whole", F.lit(0)), F.lit(0)).cast("long").alias("missing")
        )
        missing = stage(missing, "missing")
        open_ = dealt.where("cell IS NOT NULL").select("source", "cell", "size")
        tops = open_.groupBy("source", F.shiftright("cell", CELL_BITS - TOP_BITS).alias("top")).agg(F.sum("size").alias("words"))
        first = stage(_edge(same_key(tops, missing.where("missing > 0"), ["source"], "inner"), "top"), "edge")
        inner = (
            same_key(open_, first, ["source"], "inner")
            .where(F.shiftright("cell", CELL_BITS - TOP_BITS) == F.col("edge"))
            .groupBy("source", "cell")
            .agg(F.sum("size").alias("words"), F.first("before").alias("outer"))
        )
        inner = same_key(inner, missing, ["source"], "inner").withColumn("missing", F.col("missing") - F.col("outer"))
        second = same_key(_edge(inner, "cell"), first.select("source", F.col("before").alias("outer")), ["source"])
        bounds = same_key(
            missing, second.select("source", "edge", (F.col("before") + F.col("outer")).alias("before")), ["source"]
        )
        #: One row per source: multiplier, target, and where its extra copies end.
        self.bounds = stage(same_key(rates, bounds, ["source"]), "bounds")

    @staticmethod
    def _sized(docs: DataFrame) -> DataFrame:
        return docs.withColumn("size", F.size(words(F.col("text"))).cast("long"))

    def taken(self, rows: DataFrame) -> DataFrame:
        """rows (doc_id, source, size and any more) with rate, copies and taken.

        Extra copies go to the cells before the edge; in the edge cell, which holds about a
        millionth of a source's rows, documents follow one by one, and the last is cut.
        """
        dealt = _dealt(rows, self.bounds, self.cap)
        at_edge = F.coalesce(F.col("cell") == F.col("edge"), F.lit(False))
        sure = F.when(F.coalesce(F.col("cell") < F.col("edge"), F.lit(False)), F.col("size")).otherwise(F.lit(0))
        outside = dealt.where(~at_edge).withColumn("extra", sure.cast("long"))
        running = (
            Window.partitionBy("source").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
        )
        ahead = F.coalesce(F.sum("size").over(running), F.lit(0)) + F.col("before")
        left = F.least(F.greatest(F.col("missing") - ahead, F.lit(0)), F.col("size"))
        inside = dealt.where(at_edge).withColumn("extra", left.cast("long"))
        both = outside.unionByName(inside)
        return both.withColumn("taken", F.col("copies") * F.col("size") + F.col("extra"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), budget: float = 1.5, cap: float = 2.0) -> DataFrame:
    """doc_id, size, source_size, target, taken and rate of each document.

    A null text has no words and nothing is taken of it; a null source is a source, the last.
    Each source's words sum to its target, rounded down, and no document gives more than
    `cap` times its own. Rows with equal ids and sizes are dealt alike but for a last, cut
    one. Reruns agree: sums are exact and draws are hashes. Other columns are ignored.
    """
    plan = Mix(docs, weights, budget, cap)
    return plan.taken(plan.sized).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "rate"
    )


def mixed(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), budget: float = 1.5, cap: float = 2.0) -> DataFrame:
    """The mix itself: rows of documents, repeated as often as they are taken.

    A cut copy holds the first words of its text, parted by a space, and its n_chars is set
    anew. Columns stay as they are; none may be named as one that the plan adds.
    """
    plan = Mix(docs, weights, budget, cap)
    packed = docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("row"))
    took = plan.taken(Mix._sized(packed)).where("taken > 0")
    rest = (F.col("taken") % F.col("size")).cast("int")
    counts = F.concat(
        F.array_repeat(F.lit(0), F.floor(F.col("taken") / F.col("size")).cast("int")),
        F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>")),
    )
    copies = took.select("row", F.explode(counts).alias("cut"))
    text = F.when(F.col("cut") == 0, F.col("row.text")).otherwise(
        F.array_join(F.slice(words(F.col("row.text")), 1, F.greatest("cut", F.lit(1))), " ")
    )
    out = {c: F.col("row")[c] for c in docs.columns} | {"text": text}
    if "n_chars" in out:
        kind = docs.schema["n_chars"].dataType
        out["n_chars"] = F.when(F.col("cut") == 0, out["n_chars"]).otherwise(F.length(text).cast(kind))
    return copies.select(*(v.alias(c) for c, v in out.items()))
