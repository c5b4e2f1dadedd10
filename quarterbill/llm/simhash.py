"""Near duplicates by SimHash, found through Golay-code fuzzy hashing.

A fingerprint's 64 bits are cut into segments of 22, 21 and 21 bits, each a (shortened)
word of the perfect binary Golay code [23, 12, 7]: every 23-bit word lies within three bits
of exactly one codeword. If two fingerprints differ in at most three bits, at most one
segment holds two or more of the errors, so two segments hold at most one each. For a pair
of segments (a, b) a fingerprint is filed under (code(a), k) for each k in near(b), and looked up
under (k, code(b)) for each k in near(a), where near(x) has the codewords of x and of all
words one bit from x. If a and b differ in one bit at most, code(a) is in near(a') and
code(b') in near(b), so the two meet under one of about 32 keys of 24 bits. Whoever meets is verified on
all 64 bits; nothing is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterbill.llm.common import same_key, stage, word_blocks
from quarterbill.llm.components import components

SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, width
PAIRS = ((0, 1), (0, 2), (1, 2))
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
#: Up to so many comparisons a key's pairs are listed; beyond, a spanning forest of them is.
FEW = 4096
#: Rows of a key that one task compares; larger keys are cut into blocks of so many rows.
BLOCK = 32_768


# --- fingerprints -------------------------------------------------------------------------


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of a text: a bit is 1 if set in over half of the shingle hashes."""
    data = (text or "").encode().lower()  # bytes.lower() changes A-Z alone
    counts, total, kept = np.zeros(64, np.int64), 0, []
    for words in word_blocks(data):
        kept += words
        if len(kept) < shingle:
            continue
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in zip(*(kept[i:] for i in range(shingle)))),
            np.uint64,
            len(kept) - shingle + 1,
        )
        total += len(hashes)
        for i in range(0, len(hashes), 65_536):
            bits = np.unpackbits(hashes[i : i + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(0, dtype=np.int64)
        kept = kept[len(kept) - shingle + 1 :]
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(kept), SEED) if kept else 0
    return int(np.packbits(counts * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, a hash of the text, and its fingerprint (64 bits as a signed long) for each row."""

    @F.pandas_udf("long")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for some in texts:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in some], np.uint64).view(np.int64))

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), of("text").alias("fp"))


# --- Golay code ---------------------------------------------------------------------------


@cache
def golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and high 11 bits, and the error pattern of each syndrome."""

    def remainder(v: int) -> int:
        for i in range(22, 10, -1):
            if v >> i & 1:
                v ^= GENERATOR << (i - 11)
        return v

    bit = [remainder(1 << i) for i in range(23)]
    low, high = np.zeros(4096, np.int64), np.zeros(2048, np.int64)
    for i in range(12):
        low[np.arange(4096) >> i & 1 == 1] ^= bit[i]
    for i in range(11):
        high[np.arange(2048) >> i & 1 == 1] ^= bit[12 + i]
    errors = np.zeros(2048, np.int64)
    for i in range(23):
        errors[bit[i]] = 1 << i
        for j in range(i):
            errors[bit[i] ^ bit[j]] = 1 << i | 1 << j
            for k in range(j):
                errors[bit[i] ^ bit[j] ^ bit[k]] = 1 << i | 1 << j | 1 << k
    return low, high, errors


def code(words: np.ndarray) -> np.ndarray:
    """The 12-bit index of the codeword nearest to each 23-bit word."""
    low, high, errors = golay()
    return (words ^ errors[low[words & 4095] ^ high[words >> 12]]) >> 11


def near(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Codeword indices of each word and of its one-bit neighbours, and which are first of their kind."""
    flips = np.concatenate([[0], 1 << np.arange(width)])
    keys = np.sort(code(words[:, None] ^ flips), axis=1)
    first = np.ones(keys.shape, bool)
    first[:, 1:] = keys[:, 1:] != keys[:, :-1]
    return keys, first


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        all_fps = np.asarray(batch.column(0))
        for at in range(0, len(all_fps), 8192):
            fps = all_fps[at : at + 8192].view(np.uint64)
            parts = [(fps >> np.uint64(s) & np.uint64((1 << w) - 1)).astype(np.int64) for s, w in SEGMENTS]
            codes = [code(p) for p in parts]
            nears = [near(p, w) for p, (_, w) in zip(parts, SEGMENTS)]
            for n, (a, b) in enumerate(PAIRS):
                for side, (keys, first) in enumerate((nears[b], nears[a])):
                    full = keys | codes[a][:, None] << 12 if side == 0 else keys << 12 | codes[b][:, None]
                    rows = np.nonzero(first)[0]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array((full[first] | n << 24) << 1 | side),
                            pa.array(fps[rows].view(np.int64)),
                        ],
                        names=["key_side", "fp"],
                    )


# --- verified links -----------------------------------------------------------------------


def _forest(left: np.ndarray, right: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Edges that connect what the links between two lists connect; no more than their rows."""
    label, edges = np.arange(len(left)), []
    for r in right:
        at = np.nonzero(np.bitwise_count(left ^ r) <= most)[0]
        if len(at):
            groups, first = np.unique(label[at], return_index=True)
            edges += [(int(r), int(left[at[f]])) for f in first]
            if len(groups) > 1:
                label[np.isin(label, groups)] = groups[0]
    return edges


def _pairs(key: np.ndarray, fp: np.ndarray, most: int) -> tuple[np.ndarray, list[tuple], list[tuple]]:
    """Links among the whole runs of key (two sides, sorted): pairs, forest edges, blocks left."""
    side, key = key & 1, key >> 1
    starts = np.concatenate([[0], np.nonzero(np.diff(key))[0] + 1, [len(key)]])
    ones = np.concatenate([[0], np.cumsum(side)])
    rights = ones[starts[1:]] - ones[starts[:-1]]
    lefts = np.diff(starts) - rights
    work = lefts * rights
    edges: list[tuple] = []
    blocks: list[tuple] = []
    for i in np.nonzero(work > FEW)[0]:
        mid = starts[i] + lefts[i]
        left, right = fp[starts[i] : mid], fp[mid : starts[i + 1]]
        if max(len(left), len(right)) > BLOCK:
            for s, rows in enumerate((left, right)):
                blocks += [(int(key[starts[i]]), s, rows[j : j + BLOCK].tobytes()) for j in range(0, len(rows), BLOCK)]
        else:
            edges += _forest(left, right, most)
    found = [np.empty((0, 2), np.uint64)]
    small = np.nonzero((work > 0) & (work <= FEW))[0]
    cuts = np.concatenate([[0], np.nonzero(np.diff(np.cumsum(work[small]) >> 20))[0] + 1, [len(small)]])
    for a, b in zip(cuts[:-1], cuts[1:]):
        runs = small[a:b]
        n = work[runs]
        run = np.repeat(np.arange(len(runs)), n)
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        l = fp[starts[runs][run] + place // rights[runs][run]]
        r = fp[(starts[runs] + lefts[runs])[run] + place % rights[runs][run]]
        ok = (l < r) & (np.bitwise_count(l ^ r) <= most)
        found.append(np.stack([l[ok], r[ok]], 1))
    return np.unique(np.concatenate(found), axis=0), edges, blocks


LINKS = "u long, v long, key long, side int, fps binary"


def _links(most: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.empty(0, np.int64), np.empty(0, np.uint64)

        def out(end: int) -> pa.RecordBatch:
            pairs, edges, blocks = _pairs(key[:end], fp[:end], most)
            pairs = np.concatenate([pairs, np.array(edges, np.uint64).reshape(-1, 2)]).view(np.int64)
            n, m = len(pairs), len(blocks)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(list(pairs[:, 0]) + [None] * m, pa.int64()),
                    pa.array(list(pairs[:, 1]) + [None] * m, pa.int64()),
                    pa.array([None] * n + [b[0] for b in blocks], pa.int64()),
                    pa.array([None] * n + [b[1] for b in blocks], pa.int32()),
                    pa.array([None] * n + [b[2] for b in blocks], pa.binary()),
                ],
                names=["u", "v", "key", "side", "fps"],
            )

        for batch in batches:
            key = np.concatenate([key, np.asarray(batch.column(0))])
            fp = np.concatenate([fp, np.asarray(batch.column(1)).view(np.uint64)])
            end = int(np.searchsorted(key, key[-1] >> 1 << 1)) if len(key) else 0
            if end > 100_000:  # all runs but the last are whole
                yield out(end)
                key, fp = key[end:], fp[end:]
        if len(key):
            yield out(len(key))

    return work


def _block_links(most: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for l, r in zip(batch.column(0), batch.column(1)):
                edges = _forest(np.frombuffer(l.as_buffer(), np.uint64), np.frombuffer(r.as_buffer(), np.uint64), most)
                both = np.array(edges, np.uint64).reshape(-1, 2).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["u", "v"])

    return work


def links(distinct: DataFrame, max_bits: int = 3) -> DataFrame:
    """(u, v): edges that connect what the links of at most `max_bits` bits connect.

    distinct: (fp), each once. Runs of a key are compared in the task that sorts them; runs
    of over BLOCK rows are cut into blocks, whose pairs go to tasks of their own.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("three segments find up to 3 differing bits")
    met = stage(
        distinct.select("fp")
        .mapInArrow(_keys, "key_side long, fp long")
        .repartition(F.shiftright("key_side", 1))
        .sortWithinPartitions("key_side")
        .mapInArrow(_links(max_bits), LINKS),
        "links",
    )
    blocks = met.where("key is not null")
    across = (
        blocks.where("side = 0")
        .select("key", F.col("fps").alias("l"))
        .join(blocks.where("side = 1").select("key", F.col("fps").alias("r")), "key")
        .select("l", "r")
        .mapInArrow(_block_links(max_bits), "u long, v long")
    )
    return met.where("u is not null").select("u", "v").unionByName(across)


def _grouped(docs: DataFrame, shingle: int, max_bits: int) -> DataFrame:
    """doc_id, text_hash, fp, and the group (a fingerprint) of each row of documents."""
    fps = stage(fingerprints(docs, shingle), "fingerprints")
    members = components(links(fps.select("fp").distinct(), max_bits))
    linked = stage(members.select(F.col("node").alias("fp"), "root"), "members")
    return fps.join(linked, "fp", "left").select(
        "doc_id", "text_hash", "fp", F.coalesce("root", "fp").alias("group")
    )


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of documents.

    Fingerprints of at most `max_bits` differing bits are linked; component_id is the
    smallest doc_id that can be reached. Equal fingerprints are one node, so copies make no
    pairs. A null or empty text has fingerprint zero and is linked like any other. Rows
    with the same doc_id are rows of their own; a null doc_id stays null and counts for no
    minimum (a group of such rows alone has a null component). Other columns are ignored.
    """
    grouped = _grouped(docs, shingle, max_bits)
    # written, so that the join back can be split where a group holds many rows
    least = stage(grouped.groupBy("group").agg(F.min("doc_id").alias("component_id")), "least")
    return grouped.join(least, "group").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """documents with one row of each group: the smallest doc_id, then the smallest text hash.

    Rows without an id stay only where the whole group has none. All columns stay.
    """
    grouped = _grouped(docs, shingle, max_bits)
    first = F.min(F.struct(F.isnull("doc_id").alias("n"), "doc_id", "text_hash")).alias("f")
    keep = grouped.groupBy("group").agg(first).select("f.doc_id", "f.text_hash")
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"))
    kept = same_key(rows, keep, ["doc_id", "text_hash"], "inner").dropDuplicates(["doc_id", "text_hash"])
    return kept.select(*(F.col("row")[c].alias(c) for c in docs.columns))
