"""Near duplicates by word shingles, found through fast similarity sketches.

A sketch has one coordinate per bin. In round i every shingle hash is thrown into one bin at
random; bins that earlier rounds left empty take the least hash of what falls into them, and
the rounds stop once all bins are full. A set of n shingles needs about t log(t) / n rounds of
t bins, so a long text needs one or two. After t rounds, round t + b fills bin b from all
hashes, so every coordinate fills. Each coordinate agrees with a probability equal to the
similarity, and their number is concentrated about it as for independent ones.

Sets that agree in all coordinates of a band meet in a bucket. Every member is compared with
the bucket's first on the full sets, which joins most groups by as many comparisons as
members. Where members of a bucket are still apart, their full sets travel to it once, and those
of which at least half of the coordinates agree are compared there; what leaves the task is
no more than the links that join groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterbill.llm.common import stage, word_blocks
from quarterbill.llm.components import components

SEED = 42
BINS = 128  # a power of two
#: Coordinates per band. At similarity 0.8 all 32 bands miss with (1 - 0.8^4)^32 = 5e-8.
BAND = 4
#: Least agreeing coordinates of a pair that is compared on full sets. Of 128 coordinates that
#: agree with probability 0.8, fewer than 64 agree with a probability under 1e-12.
LEAST_AGREEING = 64
#: Members of a bucket, and hashes of theirs, that a task compares with as many others; more are dealt in pieces.
PIECE = 4096
PIECE_HASHES = 1 << 22
#: Bits of the map that tells which texts are compared in full.
BITS = 1 << 26
#: Partners of one set that a task verifies.
PARTNERS_PER_TASK = 512


# --- sets and sketches --------------------------------------------------------------------


def shingle_set(text: str | None, shingle: int = 4) -> np.ndarray:
    """The sorted 64-bit hashes of a text's different shingles; fewer words are one shingle."""
    data = (text or "").encode().lower()  # bytes.lower() changes A-Z alone
    found, kept = [], []
    for words in word_blocks(data):
        kept += words
        if len(kept) < shingle:
            continue
        hashes = (xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in zip(*(kept[i:] for i in range(shingle))))
        found.append(np.unique(np.fromiter(hashes, np.uint64, len(kept) - shingle + 1)))
        kept = kept[len(kept) - shingle + 1 :]
    if not found:
        return np.array([xxhash.xxh64_intdigest(b" ".join(kept), SEED)] if kept else [], np.uint64)
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))


@cache
def _seeds() -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(b"round %d" % i, SEED) for i in range(2 * BINS)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each number."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The BINS coordinates of a set that is not empty: the round, then 48 bits of the hash."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    bins = np.full(BINS, empty)
    shift = np.uint64(64 - BINS.bit_length() + 1)
    low = np.uint64((1 << 48) - 1)
    step = max(1, int(BINS * np.log(BINS) / len(hashes)))
    for first in range(0, BINS, step):
        rounds = np.arange(first, min(first + step, BINS))
        thrown = mix(hashes ^ _seeds()[rounds][:, None])
        # an earlier round's value is smaller, so what a bin already holds stays
        values = thrown & low | rounds.astype(np.uint64)[:, None] << np.uint64(48)
        np.minimum.at(bins, (thrown >> shift).ravel(), values.ravel())
        if (bins != empty).all():
            return bins
    for b in np.nonzero(bins == empty)[0]:
        bins[b] = (mix(hashes ^ _seeds()[BINS + b]) & low).min() | np.uint64(BINS + b) << np.uint64(48)
    return bins


def band_keys(bins: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    keys = np.arange(1, BINS // BAND + 1, dtype=np.uint64)
    for column in bins.reshape(-1, BAND).T:
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) ^ column)
    return keys


SKETCHES = "doc_id long, text_a long, text_b long, n_shingles long, set_a long, set_b long, bands array<long>, bins binary"


def _sketches(shingle: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, sets, bands, bins = [], [], [], []
            for text in batch.column(3):
                hashes = shingle_set(text.as_py(), shingle)
                sizes.append(len(hashes))
                both = xxhash.xxh3_128_intdigest(hashes.tobytes(), SEED)
                sets.append((both >> 64, both & 0xFFFFFFFFFFFFFFFF))
                full = sketch(hashes) if len(hashes) else None
                bands.append(None if full is None else band_keys(full).view(np.int64))
                bins.append(None if full is None else full.astype(np.uint8).tobytes())
            sets = np.array(sets, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in range(3)),
                    pa.array(sizes, pa.int64()),
                    pa.array(sets[:, 0]),
                    pa.array(sets[:, 1]),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(bins, pa.binary()),
                ],
                names=["doc_id", "text_a", "text_b", "n_shingles", "set_a", "set_b", "bands", "bins"],
            )

    return work


def _text_key() -> list:
    """128 bits that tell texts apart."""
    return [F.xxhash64("text").alias("text_a"), F.xxhash64(F.lit(SEED), "text").alias("text_b")]


def _holding(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of `texts` whose key is in `keys`, and a few others.

    A bitmap of BITS bits tells which keys there are, so that most texts stay where they are
    read. It is broadcast: 2048 rows of 4 KB at most, whatever the number of keys.
    """
    bit = F.pmod("text_a", F.lit(BITS))
    bitmap = (
        keys.select(F.bitmap_bucket_number(bit).alias("part"), F.bitmap_bit_position(bit).alias("at"))
        .groupBy("part")
        .agg(F.bitmap_construct_agg("at").alias("bits"))
    )
    byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("at") / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    return (
        texts.withColumns({"part": F.bitmap_bucket_number(bit), "at": F.bitmap_bit_position(bit)})
        .join(F.broadcast(bitmap), "part")
        .withColumn("byte", byte)
        .where(F.expr("shiftright(byte, int(at % 8)) & 1 = 1"))
        .select(texts.columns)
    )


# --- exact comparison ---------------------------------------------------------------------


def _full_sets(shingle: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies of a text are read once in a task
        for batch in batches:
            nodes, sets = [], []
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if node not in seen:
                    seen.add(node)
                    nodes.append(node)
                    sets.append(shingle_set(text.as_py(), shingle).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], names=["node", "hashes"])

    return work


def _compare(percent: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, first = None, np.empty(0, np.uint64)
        for batch in batches:
            out = []
            for u, piece, v, data in zip(*(batch.column(i).to_pylist() for i in range(4))):
                hashes = np.frombuffer(data, np.uint64)
                if v is None:  # sorted before its partners
                    at, first = (u, piece), hashes
                elif at == (u, piece):
                    common = len(np.intersect1d(first, hashes, assume_unique=True))
                    if 100 * common >= percent * (len(first) + len(hashes) - common):
                        out.append((u, v))
            links = np.array(out, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], names=["u", "v"])

    return work


def _verified(full: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets (node, hashes) are similar.

    The set of u travels once per PARTNERS_PER_TASK partners, that of v once per pair.
    """
    counts = pairs.groupBy("u").agg(F.ceil(F.count(F.lit(1)) / PARTNERS_PER_TASK).cast("int").alias("pieces"))
    partners = (
        pairs.join(full.withColumnRenamed("node", "v"), "v")
        .join(counts, "u")
        .select("u", F.pmod(F.xxhash64("v"), "pieces").cast("int").alias("piece"), "v", "hashes")
    )
    firsts = full.withColumnRenamed("node", "u").join(counts, "u").select(
        "u", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), F.lit(None).cast("long").alias("v"), "hashes"
    )
    return (
        firsts.unionByName(partners)
        .repartition("u", "piece")
        .sortWithinPartitions("u", "piece", F.asc_nulls_first("v"))
        .mapInArrow(_compare(percent), "u long, v long")
    )


# --- what the first comparisons leave apart -----------------------------------------------


def _forest(rows: list[tuple], same: bool, percent: int) -> list[tuple[int, int]]:
    """Edges that connect what the links of one bucket connect (of two pieces, or of one with itself).

    rows: (side, node, root, bins, hashes); members with one root are connected already.
    """
    node = [r[1] for r in rows]
    label = np.unique([r[2] for r in rows], return_inverse=True)[1]
    bins = np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(-1, BINS)
    sets = [np.frombuffer(r[4], np.uint64) for r in rows]
    sizes = np.array([len(s) for s in sets])
    ids = np.split(np.unique(np.concatenate(sets), return_inverse=True)[1], np.cumsum(sizes)[:-1])
    mark = np.zeros(max(int(i.max()) for i in ids) + 1, bool)
    side = np.array([r[0] for r in rows])
    left, right = np.nonzero(side != 1)[0], np.nonzero(side != 0)[0]
    edges = []
    for start in range(0, len(left), 32):
        some = left[start : start + 32]
        agree = (bins[some, None, :] == bins[None, right, :]).sum(2, dtype=np.int16)
        small, large = np.minimum(sizes[some, None], sizes[right]), np.maximum(sizes[some, None], sizes[right])
        possible = (agree >= LEAST_AGREEING) & (100 * small >= percent * large)
        if same:
            possible &= some[:, None] < right
        for k, u in enumerate(some.tolist()):
            partners = right[possible[k] & (label[right] != label[u])]
            if len(partners):
                mark[ids[u]] = True
                for v in partners.tolist():
                    if label[v] != label[u]:
                        common = int(np.count_nonzero(mark[ids[v]]))
                        if 100 * common >= percent * (sizes[u] + sizes[v] - common):
                            edges.append((node[u], node[v]))
                            label[label == label[v]] = label[u]
                mark[ids[u]] = False
    return edges


def _bucket_links(percent: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []

        def out() -> pa.RecordBatch:
            edges = np.array(_forest(rows, at[1] == at[2], percent), np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1])], names=["u", "v"])

        for batch in batches:
            for key, a, b, *row in zip(*(column.to_pylist() for column in batch.columns)):
                if (key, a, b) != at:
                    if rows:
                        yield out()
                    at, rows = (key, a, b), []
                rows.append(row)  # a run has two pieces at most
        if rows:
            yield out()

    return work


def _apart(met: DataFrame, roots: DataFrame, sizes: DataFrame) -> DataFrame:
    """The members, but the first, of buckets whose members are not all in one group yet, as pairs of pieces."""
    rows = (
        met.where("node != first")
        .join(roots, "node", "left")
        .join(sizes, "node")
        .select("key", "node", F.coalesce("root", "node").alias("root"), "n")
    )
    pieces = F.ceil(F.greatest(F.count(F.lit(1)) / PIECE, F.sum("n") / PIECE_HASHES)).cast("int")
    apart = rows.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), pieces.alias("pieces")).where("lo != hi")
    return (
        rows.join(apart.select("key", "pieces"), "key")
        .withColumn("own", F.pmod(F.xxhash64("node"), "pieces").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        .select(
            "key",
            F.least("own", "other").alias("a"),
            F.greatest("own", "other").alias("b"),
            F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
            "node", "root",
        )
    )


def _links(docs: DataFrame, sets: DataFrame, sketched: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(node, root) for each set that is linked with another."""
    chosen = sketched.join(sets.select("node"), sketched["row_id"] == F.col("node")).drop("row_id")
    bands = chosen.select(F.explode("bands").alias("key"), "node")
    buckets = stage(
        bands.groupBy("key").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("members")).where("members > 1").drop("members"),
        "buckets",
    )
    # one row per bucket: where a bucket holds many rows, the join can be split
    met = stage(bands.join(buckets, "key"), "met")
    nodes = met.select("node").distinct()
    known = stage(chosen.join(nodes, "node").select("node", F.col("n_shingles").alias("n"), "bins"), "met_sketches")
    keys = stage(chosen.join(nodes, "node").select("node", "text_a", "text_b"), "met_texts")
    full = stage(
        _holding(docs.select("text", *_text_key()), keys)
        .join(keys, ["text_a", "text_b"])
        .select("node", "text")
        .mapInArrow(_full_sets(shingle), "node long, hashes binary")
        .dropDuplicates(["node"]),
        "full_sets",
    )
    pairs = stage(met.where("node != first").select(F.col("first").alias("u"), F.col("node").alias("v")).distinct(), "pairs")
    linked = stage(_verified(full, pairs, percent), "links")
    roots = stage(components(linked), "roots")
    more = (
        stage(_apart(met, roots, known.select("node", "n")), "apart")
        .join(known.select("node", "bins"), "node")
        .join(full, "node")
        .select("key", "a", "b", "side", "node", "root", "bins", "hashes")
        .repartition("key", "a", "b")
        .sortWithinPartitions("key", "a", "b")
        .mapInArrow(_bucket_links(percent), "u long, v long")
    )
    return stage(components(linked.unionByName(more)), "roots")


def near_duplicates(docs: DataFrame, shingle: int = 4, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of documents.

    A document's set holds its different `shingle`-word shingles, A-Z lower-cased; a text of
    fewer words is one shingle. Documents are linked if 100 * intersection >= percent * union,
    `percent` from 80; every link is confirmed on full sets (of 64-bit hashes). component_id is the smallest
    doc_id that links reach, and `kept` says whether it is the row's own.

    Equal sets are one node, so copies make no pairs. A text that is null or has no words has
    an empty set, is linked with nothing and is kept. Rows with one doc_id are rows of their
    own, and all of them are kept where it is the smallest. A null doc_id counts for no
    minimum; such a row is kept only if no row of its group has an id. Other columns are
    ignored; an empty table gives no rows.
    """
    if percent < 80:
        raise ValueError("the bands are made for similarities of 80 percent and more")
    sketched = stage(
        docs.select("doc_id", *_text_key(), "text")
        .mapInArrow(_sketches(shingle), SKETCHES)
        .withColumn("row_id", F.monotonically_increasing_id()),
        "sketches",
    )
    full = sketched.where("n_shingles > 0")
    sets = stage(full.groupBy("set_a", "set_b").agg(F.min("row_id").alias("node"), F.min("doc_id").alias("least")), "nodes")
    roots = _links(docs, sets, sketched.drop("doc_id", "set_a", "set_b"), shingle, percent)
    grouped = sets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    # written, so that the join back can be split where a set has many rows
    of_set = stage(grouped.join(least, "root").select("set_a", "set_b", "component_id"), "components")
    linked = full.select("doc_id", "n_shingles", "set_a", "set_b").join(of_set, ["set_a", "set_b"])
    alone = sketched.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id"]
    return linked.select(columns).unionByName(alone.select(columns)).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
