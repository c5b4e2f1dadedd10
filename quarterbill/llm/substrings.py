"""Removal of byte strings that an earlier document holds, exactly, at any offset.

A byte goes if a string of `length` bytes around it also starts in a document with a smaller
id. Sorting all suffixes would move every byte several times (see README), so places are
thinned first, as a difference cover would, but by content: of the grams in a string the one with the
least hash is its anchor, so equal strings have their anchors at the same place. An anchor's
context are the bytes of all strings that it can anchor.

1. Contexts are compared under their gram. A context that a smaller document repeats goes
   whole; copies are settled within a task before anything is shuffled.
2. Where a gram stands in several different contexts, one of each (of the smallest document)
   is sent with its bytes, and its strings are compared one by one. Where a gram has many
   contexts, their strings are compared within a task, and one of each goes on by its hash, so
   that no task meets all contexts of the gram with their bytes.
3. Both kinds of spans meet the texts again, which are cut.

Rows travel as arrays per bucket of grams, strings or documents. Memory of a task is one
bucket as it travels, and what is made of one block of it (of whole grams or strings); one
chunk of texts; or the longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarterbill.llm.common import stage

LENGTH, GRAM = 50, 24
CHUNK = 8 << 20  # bytes of text that a task compares before it sends anything
BASE = 0x9E3779B97F4A7C15
ROW = "kind int, bucket int, blob binary"
ANCHORS, COVERED, OPEN, SPANS, MANY, STRINGS = 0, 1, 2, 3, 4, 5
MOST_CONTEXTS = 1000  # open contexts of a gram that are compared in one array
ANCHOR_BLOCK, CONTEXT_BLOCK, STRING_BLOCK = 1 << 22, 1 << 16, 1 << 22  # rows of a bucket that are unpacked at once
U = np.uint64


class Hasher:
    """Hashes of any bytes of a text from running sums of its polynomial, modulo 2^64."""

    def __init__(self) -> None:
        self.power = self.inverse = np.ones(1, U)

    def _grow(self, n: int) -> None:
        if len(self.power) <= n:
            grown = lambda base: np.multiply.accumulate(np.concatenate([[U(1)], np.full(2 * n, U(base), U)]))
            self.power, self.inverse = grown(BASE), grown(pow(BASE, -1, 1 << 64))

    def sums(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        terms = (data.astype(U) + U(1)) * self.power[: len(data)]
        return np.concatenate([[U(0)], np.cumsum(terms, dtype=U)])

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((sums[end] - sums[start]) * self.inverse[start])


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of a hash."""
    h = (h ^ h >> U(32)) * U(0xD6E8FEB86659FD93)
    h = (h ^ h >> U(32)) * U(0xD6E8FEB86659FD93)
    return h ^ h >> U(32)


def _sliding(x: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """The least or greatest of each `width` neighbours."""
    step = 1
    while 2 * step <= width:
        x = best(x[:-step], x[step:])
        step *= 2
    rest = width - step
    return best(x[: len(x) - rest], x[rest:]) if rest else x


def anchors(hasher: Hasher, data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Places of the anchors of a text, hashes of their grams and contexts, and the contexts' bounds."""
    n = len(data)
    sums = hasher.sums(data)
    at = np.arange(n - gram + 1)
    h = hasher.of(sums, at, at + gram)
    width = length - gram + 1
    least = _sliding(h, width, np.minimum)
    edge = np.zeros(width - 1, U)
    # a gram is an anchor if it is the least of some string that holds it
    place = np.flatnonzero(_sliding(np.concatenate([edge, least, edge]), width, np.maximum) == h)
    low, high = np.maximum(place - (length - gram), 0), np.minimum(place + length, n)
    context = mixed(hasher.of(sums, low, high) + ((place - low) << 16 | high - low).astype(U))
    return place, h[place], context, low, high


def _pack(kind: int, bucket: np.ndarray, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """A row per bucket, with the columns of its entries one after the other."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    bucket, columns = bucket[order], [c[order] for c in columns]
    starts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
    blobs = [b"".join(c[a:b].tobytes() for c in columns) for a, b in zip(starts[:-1], starts[1:])]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(blobs), kind, np.int32)),
            pa.array(bucket[starts[:-1]].astype(np.int32)),
            pa.array(blobs, pa.binary()),
        ],
        names=["kind", "bucket", "blob"],
    )


def _blocks(blobs: list[bytes], kinds: tuple, most: int, key: int) -> Iterator[list[np.ndarray]]:
    """The rows of a bucket in blocks of about `most` rows; rows with equal keys are in one block. Empties `blobs`."""
    n = -(-sum(map(len, blobs)) // (most * sum(np.dtype(k).itemsize for k in kinds)))
    blocks: list[list[list[np.ndarray]]] = [[] for _ in range(n)]
    while blobs:
        columns = _unpack([blobs.pop()], kinds)
        if n > 1:
            block = (mixed(columns[key].astype(U)) >> U(32)) % U(n)
            order = np.argsort(block, kind="stable")
            bounds = np.searchsorted(block[order], np.arange(n + 1, dtype=U))
            for parts, a, b in zip(blocks, bounds[:-1], bounds[1:]):
                parts.append([c[order[a:b]] for c in columns])
        elif n:
            blocks[0].append(columns)
    while blocks:
        yield [np.concatenate(c) for c in zip(*blocks.pop())]


def _unpack(blobs: list[bytes], kinds: tuple) -> list[np.ndarray]:
    width = sum(np.dtype(k).itemsize for k in kinds)
    parts: list[list[np.ndarray]] = [[np.empty(0, k)] for k in kinds]
    for blob in blobs:
        n, at = len(blob) // width, 0
        for part, kind in zip(parts, kinds):
            part.append(np.frombuffer(blob, kind, n, at))
            at += n * np.dtype(kind).itemsize
    return [np.concatenate(p) for p in parts]


ANCHOR_ROW = (np.uint64, np.uint32, np.int64, np.uint32)  # context, gram, document, place
PLACE_ROW = (np.int64, np.uint32)  # document, place
OPEN_ROW = (np.int64, np.uint32, np.uint64)  # document, place, gram
SPAN_ROW = (np.int64, np.uint32, np.uint32)  # document, start, end
STRING_ROW = (np.uint64, np.int64, np.uint32)  # string, document, start


def _strings_of(g: np.ndarray, sizes: np.ndarray, c: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Hashes of the strings of contexts, the contexts' numbers, and where in them the strings start."""
    width = c.shape[1]
    powers = np.multiply.accumulate(np.concatenate([[U(1)], np.full(width, U(BASE), U)]))
    inverse = np.multiply.accumulate(np.concatenate([[U(1)], np.full(width, U(pow(BASE, -1, 1 << 64)), U)]))
    sums = np.zeros((len(c), width + 1), U)
    np.cumsum((c.astype(U) + U(1)) * powers[:width], axis=1, dtype=U, out=sums[:, 1:])
    starts = np.arange(width - length + 1)
    h = mixed(mixed((sums[:, starts + length] - sums[:, starts]) * inverse[starts]) + g[:, None])
    valid = starts + length <= sizes[:, None]
    row, start = np.nonzero(valid)
    return h[valid], row, start.astype(np.int64)


def _repeats(h: np.ndarray, doc: np.ndarray, shift: int) -> np.ndarray:
    """Whether a smaller document has the string, for strings sorted by hash and document."""
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    return _later(doc, new, shift) if len(h) else new


def _later(doc: np.ndarray, new: np.ndarray, shift: int) -> np.ndarray:
    """Whether a row's document is greater than that of the first row of its run."""
    return doc >> shift > (doc[new] >> shift)[np.cumsum(new) - 1]


# --- rows that share an id ----------------------------------------------------------------


def _numbered(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct rows with `number`: 0, 1, ... in the order of the columns, over all partitions."""
    placed = stage(
        df.repartitionByRange(*columns).sortWithinPartitions(*columns).withColumn("at", F.monotonically_increasing_id()), "numbered"
    ).withColumn("part", F.shiftright("at", 33))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("part").count().withColumn("start", F.coalesce(F.sum("count").over(before), F.lit(0)))
    return placed.join(starts, "part").withColumn("number", F.col("at") - F.shiftleft("part", 33) + F.col("start")).drop("at", "part", "start", "count")


def _told_apart(docs: DataFrame) -> tuple[DataFrame, int, DataFrame | None]:
    """documents in which each text of an id has an id of its own, which is the id, or its rank, and a
    number in the low bits; how many bits those are; and the ranks, if they were needed.

    Where every id has one text, the documents are returned as they are.
    """
    hashed = docs.withColumn("h", F.xxhash64("text"))
    several = stage(
        hashed.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo != hi").select("doc_id"),
        "repeated_ids",
    )
    if several.isEmpty():
        return docs, 0, None
    texts = stage(_numbered(hashed.select("doc_id", "h").join(several, "doc_id").distinct(), "doc_id", "h"), "texts")
    own = stage(
        texts.join(texts.groupBy("doc_id").agg(F.min("number").alias("first")), "doc_id").select("doc_id", "h", (F.col("number") - F.col("first")).alias("own")),
        "own",
    )
    shift = int(own.agg(F.max("own")).first()[0]).bit_length()
    lo, hi = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    ranks = None
    if max(-lo, hi) >> (62 - shift):
        ranks = stage(_numbered(docs.where("doc_id IS NOT NULL").select("doc_id").distinct(), "doc_id"), "ranks")
        hashed = hashed.join(ranks, "doc_id", "left").withColumnRenamed("number", "place")
    else:
        hashed = hashed.withColumn("place", F.col("doc_id"))
    known = hashed.join(own, ["doc_id", "h"], "left")
    return known.select((F.shiftleft("place", shift) + F.coalesce("own", F.lit(0))).alias("doc_id"), "text"), shift, ranks


def _spans(doc: np.ndarray, start: np.ndarray, length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """The spans of repeated strings; those that start one after the other are one."""
    if not len(doc):
        return
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    cut = np.ones(len(doc), bool)
    cut[1:] = (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + 1)
    at = np.flatnonzero(cut)
    last = np.concatenate([at[1:] - 1, [len(doc) - 1]])
    d, a, b = doc[at], start[at], start[last] + length
    yield from _pack(SPANS, d % buckets, [d, a.astype(np.uint32), b.astype(np.uint32)])


def _grouped(batches: Iterator[pa.RecordBatch], columns: int = 0) -> Iterator[tuple]:
    """(kind, bucket, blobs) of sorted rows."""
    now, blobs = None, []
    for batch in batches:
        for kind, bucket, blob in zip(*(c.to_pylist() for c in batch.columns)):
            if (kind, bucket) != now:
                if now:
                    yield (*now, blobs)
                now, blobs = (kind, bucket), []
            blobs.append(blob)
    if now:
        yield (*now, blobs)


class Remover:
    """The steps for one table; buckets grow with the partitions that the session asks for."""

    def __init__(self, docs: DataFrame, length: int = LENGTH, gram: int = GRAM):
        if not 8 <= gram < length < 1 << 15:
            raise ValueError("a gram is shorter than the strings, and 8 bytes at least")
        docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        self.docs, self.shift, self.ranks = _told_apart(docs)
        self.length, self.gram = length, gram
        self.buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def _anchors(self):
        length, gram, buckets, shift = self.length, self.gram, self.buckets, self.shift

        def send(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            doc, place, g, c = (np.concatenate(x) for x in zip(*rows))
            order = np.lexsort((doc, c, g))
            doc, place, g, c = doc[order], place[order].astype(np.uint32), g[order], c[order]
            new = np.ones(len(g), bool)
            new[1:] = (g[1:] != g[:-1]) | (c[1:] != c[:-1])
            later = _later(doc, new, shift)  # this task holds a smaller document with it
            yield from _pack(COVERED, doc[later] % buckets, [doc[later], place[later]])
            keep = np.flatnonzero(~later)
            keep = keep[np.lexsort((place[keep], doc[keep]))]
            rest = (g[keep] // U(buckets)).astype(np.uint32)
            yield from _pack(ANCHORS, (g[keep] % U(buckets)).astype(np.int64), [c[keep], rest, doc[keep], place[keep]])

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hasher, rows, size = Hasher(), [], 0
            for batch in batches:
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    data = (text.as_py() or "").encode()
                    if doc is None or len(data) < length:
                        continue
                    place, g, c, _, _ = anchors(hasher, np.frombuffer(data, np.uint8), length, gram)
                    rows.append((np.full(len(place), doc, np.int64), place, g, c))
                    size += len(data)
                    if size >= CHUNK:
                        yield from send(rows)
                        rows, size = [], 0
            if rows:
                yield from send(rows)

        return work

    def _compare(self):
        buckets, most, shift = self.buckets, MOST_CONTEXTS, self.shift

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for kind, bucket, blobs in _grouped(batches):
                if kind == COVERED:
                    doc, place = _unpack(blobs, PLACE_ROW)
                    yield from _pack(COVERED, doc % buckets, [doc, place])
                    continue
                for c, g, doc, place in _blocks(blobs, ANCHOR_ROW, ANCHOR_BLOCK, 1):
                    order = np.lexsort((doc, c, g))
                    c, g, doc, place = c[order], g[order], doc[order], place[order]
                    new_g = np.ones(len(g), bool)
                    new_g[1:] = g[1:] != g[:-1]
                    new = new_g.copy()
                    new[1:] |= c[1:] != c[:-1]
                    later = _later(doc, new, shift)
                    yield from _pack(COVERED, doc[later] % buckets, [doc[later], place[later]])
                    run = np.cumsum(new_g) - 1
                    several = np.bincount(run, new)[run] > 1  # contexts of the gram
                    many = np.bincount(run, ~later)[run] > most
                    for sent, open_ in ((OPEN, several & ~later & ~many), (MANY, several & ~later & many)):
                        full = g[open_].astype(U) << U(32) | U(bucket)
                        yield from _pack(sent, doc[open_] % buckets, [doc[open_], place[open_], full])

        return work

    def _with_texts(self, rows: DataFrame) -> DataFrame:
        """Texts and rows about them by bucket of documents, the rows first."""
        bucket: Column = F.pmod("doc_id", F.lit(self.buckets)).cast("int")
        texts = self.docs.select(
            F.lit(9).alias("kind"), F.coalesce(bucket, F.lit(-1)).alias("bucket"),
            F.lit(None).cast("binary").alias("blob"), F.col("doc_id").cast("long").alias("doc_id"), "text",
        )
        blank = rows.select("kind", "bucket", "blob", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"))
        return texts.unionByName(blank).repartition("bucket").sortWithinPartitions("bucket", "kind")

    @staticmethod
    def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(doc_id, text's bytes, blobs of its bucket by kind); the dict is new for each bucket."""
        now, held = None, {}
        for batch in batches:
            kinds, buckets, blobs, ids = (batch.column(i).to_pylist() for i in range(4))
            for i, (kind, bucket, blob, doc) in enumerate(zip(kinds, buckets, blobs, ids)):
                if bucket != now:
                    now, held = bucket, {}
                if kind == 9:
                    yield doc, (batch.column(4)[i].as_py() or "").encode(), held
                else:
                    held.setdefault(kind, []).append(blob)

    def _contexts(self):
        length, gram, buckets, texts, shift = self.length, self.gram, self.buckets, self._texts, self.shift
        width = 2 * length - gram

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, rows, size = None, [], 0

            def send() -> Iterator[pa.RecordBatch]:
                g, doc, low, sizes, c, many = (np.concatenate(x) for x in zip(*rows))
                few = ~many
                yield from _pack(OPEN, (g[few] % U(buckets)).astype(np.int64), [x[few] for x in (g, doc, low, sizes, c)])
                g, doc, low, sizes, c = (x[many] for x in (g, doc, low, sizes, c))
                if not len(g):
                    return
                h, row, start = _strings_of(g, sizes, np.frombuffer(c.tobytes(), np.uint8).reshape(-1, width), length)
                doc, start = doc[row], low[row] + start
                order = np.lexsort((doc, h))
                h, doc, start = h[order], doc[order], start[order]
                gone = _repeats(h, doc, shift)  # a smaller document of this task has the string
                yield from _spans(doc[gone], start[gone], length, buckets)
                h, doc, start = h[~gone], doc[~gone], start[~gone].astype(np.uint32)
                yield from _pack(STRINGS, (h % U(buckets)).astype(np.int64), [h, doc, start])

            for doc, data, blobs in texts(batches):
                if blobs is not held:
                    held = blobs
                    few, rest = _unpack(blobs.get(OPEN, []), OPEN_ROW), _unpack(blobs.get(MANY, []), OPEN_ROW)
                    docs, places, grams = (np.concatenate(x) for x in zip(few, rest))
                    hot = np.arange(len(docs)) >= len(few[0])
                    order = np.argsort(docs, kind="stable")
                    docs, places, grams, hot = docs[order], places[order].astype(np.int64), grams[order], hot[order]
                if doc is None:
                    continue
                a, b = np.searchsorted(docs, doc, "left"), np.searchsorted(docs, doc, "right")
                place, g, many = places[a:b], grams[a:b], hot[a:b]
                inside = place + gram <= len(data)
                place, g, many = place[inside], g[inside], many[inside]
                if not len(place) or len(data) < length:
                    continue
                low, high = np.maximum(place - (length - gram), 0), np.minimum(place + length, len(data))
                padded = np.frombuffer(data + bytes(width), np.uint8)
                c = padded[low[:, None] + np.arange(width)]
                c = np.where(np.arange(width) < (high - low)[:, None], c, 0).astype(np.uint8)
                rows.append((g, np.full(len(g), doc, np.int64), low.astype(np.uint32), (high - low).astype(np.uint16), np.ascontiguousarray(c).view(f"V{width}").ravel(), many))
                size += len(g)
                if size >= CONTEXT_BLOCK:
                    yield from send()
                    rows, size = [], 0
            if rows:
                yield from send()

        return work

    def _strings(self):
        length, gram, buckets, shift = self.length, self.gram, self.buckets, self.shift
        width = 2 * length - gram
        kinds = (np.uint64, np.int64, np.uint32, np.uint16, np.dtype(f"V{width}"))

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for kind, _, blobs in _grouped(batches):
                if kind == SPANS:
                    doc, start, end = _unpack(blobs, SPAN_ROW)
                    yield from _pack(SPANS, doc % buckets, [doc, start, end])
                elif kind == STRINGS:
                    for h, doc, start in _blocks(blobs, STRING_ROW, STRING_BLOCK, 0):
                        order = np.lexsort((doc, h))
                        h, doc, start = h[order], doc[order], start[order].astype(np.int64)
                        gone = _repeats(h, doc, shift)
                        yield from _spans(doc[gone], start[gone], length, buckets)
                else:
                    for g, doc, low, sizes, c in _blocks(blobs, kinds, CONTEXT_BLOCK, 0):
                        c = np.frombuffer(c.tobytes(), np.uint8).reshape(-1, width)
                        h, row, start = _strings_of(g, sizes, c, length)
                        order = np.lexsort((doc[row], h))
                        h, row, start = h[order], row[order], start[order]
                        gone = _repeats(h, doc[row], shift)
                        row, start = row[gone], start[gone]
                        yield from _spans(doc[row], low[row] + start, length, buckets)

        return work

    def _cut(self):
        length, gram, texts = self.length, self.gram, self._texts

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, rows = None, []

            def out() -> pa.RecordBatch:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()))
                names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "bounds")
                return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

            for doc, data, blobs in texts(batches):
                if blobs is not held:
                    held = blobs
                    d1, place = _unpack(blobs.get(COVERED, []), PLACE_ROW)
                    d2, start, end = _unpack(blobs.get(SPANS, []), SPAN_ROW)
                    docs = np.concatenate([d1, d2])
                    starts = np.concatenate([place.astype(np.int64) - (length - gram), start.astype(np.int64)])
                    ends = np.concatenate([place.astype(np.int64) + length, end.astype(np.int64)])
                    order = np.lexsort((starts, docs))
                    docs, starts, ends = docs[order], np.maximum(starts[order], 0), ends[order]
                a, b = (0, 0) if doc is None else (np.searchsorted(docs, doc, "left"), np.searchsorted(docs, doc, "right"))
                s, e = starts[a:b], np.minimum(ends[a:b], len(data))
                bounds: list[int] = []
                if len(s):
                    reach = np.maximum.accumulate(e)
                    first = np.ones(len(s), bool)
                    first[1:] = s[1:] > reach[:-1]  # touching spans are one
                    at = np.flatnonzero(first)
                    stops = reach[np.concatenate([at[1:] - 1, [len(s) - 1]])]
                    bounds = np.stack([s[at], stops], 1).ravel().tolist()
                kept, last, removed = hashlib.sha256(), 0, 0
                for x, y in zip(bounds[::2], bounds[1::2]):
                    kept.update(data[last:x])
                    last, removed = y, removed + y - x
                kept.update(data[last:])
                rows.append((doc, len(data), removed, len(bounds) // 2, kept.hexdigest(), bounds))
                if len(rows) >= 1000:
                    yield out()
                    rows = []
            if rows:
                yield out()

        return work

    def removed(self) -> DataFrame:
        spark = self.docs.sparkSession
        met = (
            self.docs.mapInArrow(self._anchors(), ROW)
            .repartition("bucket")
            .sortWithinPartitions("kind", "bucket")
            .mapInArrow(self._compare(), ROW)
        )
        settled = stage(met, "settled")
        del met
        spark._jvm.System.gc()  # lets Spark remove the shuffle files of the finished step
        contexts = self._with_texts(settled.where(F.col("kind").isin(OPEN, MANY))).mapInArrow(self._contexts(), ROW)
        spans = stage(
            contexts.repartition("bucket").sortWithinPartitions("kind", "bucket").mapInArrow(self._strings(), ROW), "spans"
        )
        del contexts
        spark._jvm.System.gc()
        about = settled.where(F.col("kind") == COVERED).unionByName(spans)
        schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, bounds array<bigint>"
        done = self._with_texts(about).mapInArrow(self._cut(), schema).withColumn("doc_id", F.shiftright("doc_id", self.shift))
        if self.ranks is None:
            return done
        ids = self.ranks.select("number", F.col("doc_id").alias("own"))
        return done.join(ids, F.col("doc_id") == F.col("number"), "left").withColumn("doc_id", F.col("own")).drop("own", "number")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and bounds of the removed spans, in bytes.

    A null text is empty; texts shorter than `length` lose nothing. Rows that share an id
    are no smaller than each other, and a row without an id neither loses nor takes bytes. Other columns are
    ignored; an empty table gives an empty one. Strings are compared by 64-bit hashes under
    equal grams.
    """
    return Remover(docs, length, gram).removed()
