"""The prefix trie of conversations: who shares which opening turns, and what that saves.

Sorted by their turns, conversations stand in the order of the trie's leaves. They are cut
into shards of that order. A shard writes its part of the trie as balanced parentheses:
findclose over blocks of least excess delimits each subtree, ranks of pairs () count its
leaves, cumulative arrays give its members and savings. Only nodes on a shard's first and last
path, its spines, can go on in another shard. A shard keeps those apart, with what hangs off
them; the spines of all shards, two paths from each, form a small trie, in which equal nodes
merge and which is summed up in the same way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterbill.llm.common import stage
from quarterbill.llm.parens import Tree

NONE = np.iinfo(np.int64).max
NO_ENDS = hashlib.sha256().digest()
#: Turns of a shard; a task holds some 250 bytes for each.
SHARD = 1 << 20
#: Ids that one row holds while the ids of a sequence are gathered.
CHUNK = 1 << 16
#: Rows in a batch of results.
BATCH = 1 << 16


# --- sequences ----------------------------------------------------------------------------


def rebuild(conversations: DataFrame, family: int = 100, most: int = 6) -> DataFrame:
    """(conv_id, path, chars): every conversation c with an opening taken from c - c % family.

    The first h turns are those of that conversation (all if it has fewer, none if it is
    absent), then c's own after its first h follow; h = crc32(decimal c) % most. path has
    the md5 of each turn's role and text, chars the code points of the text. Turns are ordered by
    number, null first, equal numbers by that md5. Null roles and texts count as empty; rows without conv_id
    belong to no conversation and are left out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", "turn",
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("key"),
        F.length(text).alias("chars"),
    )
    own = stage(
        turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "key", "chars"))).alias("turns")),
        "conversations",
    )
    opening = own.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("opening")
    )
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    return (
        own.withColumn("base", F.col("conv_id") - F.col("conv_id") % family)
        .join(opening, "base", "left")
        .withColumn("h", h)
        .withColumn("opening", F.when(F.col("opening").isNotNull(), F.slice("opening", F.lit(1), F.col("h"))).otherwise(F.array()))
        .withColumn("all", F.concat("opening", F.slice("turns", F.col("h") + 1, F.size("turns"))))
        .select("conv_id", F.col("all.key").alias("path"), F.col("all.chars").alias("chars"))
    )


def _runs(table: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """The runs of equal first two columns."""
    a, b = (np.asarray(table.column(i)) for i in range(2))
    cuts = np.nonzero((np.diff(a) != 0) | (np.diff(b) != 0))[0] + 1
    yield from zip([0, *cuts], [*cuts, len(a)])


def _id_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ids of each sequence as text, up to CHUNK in a row."""
    for batch in batches:
        rows = []
        a, b, ids = (batch.column(i).to_pylist() for i in range(3))
        for start, end in _runs(batch) if batch.num_rows else ():
            for i in range(start, end, CHUNK):
                some = ids[i : min(i + CHUNK, end)]
                rows.append((a[start], b[start], some[0], len(some), ",".join(map(str, some))))
        columns = zip(*rows) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(),) * 4 + (pa.string(),))], names=["path_a", "path_b", "conv_id", "n", "ids"]
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number, least and digest of the ids of each sequence; a sequence's chunks come in order."""
    at, least, n, digest = None, 0, 0, hashlib.sha256()
    for batch in batches:
        rows = []
        for a, b, first, some, ids in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if (a, b) != at:
                if at is not None:
                    rows.append((least, n, digest.digest()))
                at, least, n, digest = (a, b), first, 0, hashlib.sha256()
            digest.update((b"," if n else b"") + ids.encode())
            n += some
        yield _ends(rows)
    if at is not None:
        yield _ends([(least, n, digest.digest())])


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary()))], names=["conv_id", "n_ends", "ends"])


def _distinct(sequences: DataFrame) -> DataFrame:
    """Each different path once: (path, chars, conv_id: its least, n_ends, ends: SHA-256 of its ids)."""
    given = stage(
        sequences.select("conv_id", "path", "chars", F.xxhash64("path").alias("path_a"), F.xxhash64(F.lit(1), "path").alias("path_b")),
        "sequences",
    )
    key = ["path_a", "path_b"]
    ends = (
        given.select(*key, "conv_id")
        .repartitionByRange(*key, "conv_id")  # a sequence that many hold is dealt to many tasks
        .sortWithinPartitions(*key, "conv_id")
        .mapInArrow(_id_chunks, "path_a long, path_b long, conv_id long, n long, ids string")
        .repartition(*key)
        .sortWithinPartitions(*key, "conv_id")
        .mapInArrow(_digests, "conv_id long, n_ends long, ends binary")
    )
    return stage(given.drop(*key).join(ends, "conv_id"), "paths")


# --- shards -------------------------------------------------------------------------------


class _Paths:
    """Sorted, different paths as one trie in preorder."""

    def __init__(self, paths: pa.ListArray, chars: pa.ListArray):
        lengths = np.diff(np.asarray(paths.offsets))
        self.keys = paths.flatten().to_pylist()
        flat = np.frombuffer(b"".join(self.keys), np.uint64).reshape(-1, 2)
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        self.lengths = lengths
        owner = np.repeat(np.arange(len(lengths)), lengths)
        place = np.arange(len(flat)) - self.starts[owner]
        # how many turns each path shares with the one before it
        shared = lengths.copy()
        before = np.maximum(owner - 1, 0)
        compare = (owner > 0) & (place < lengths[before])
        same = np.zeros(len(flat), bool)
        here = np.nonzero(compare)[0]
        same[here] = (flat[here] == flat[self.starts[before[here]] + place[here]]).all(1)
        np.minimum.at(shared, owner[~same], place[~same])
        self.shared = shared
        new = np.nonzero(place >= shared[owner])[0]
        self.depths = np.concatenate([[0], place[new] + 1])
        self.chars = np.concatenate([[0], np.asarray(chars.flatten())[new].astype(np.int64)])
        self.number = np.zeros(len(flat), np.int64)
        self.number[new] = np.arange(1, len(new) + 1)
        # the node at which each path ends; it is new, as no path is a prefix of one before it
        self.end = np.zeros(len(lengths), np.int64)
        some = lengths > 0
        self.end[some] = self.number[self.starts[1:][some] - 1]

    def key(self, i: int) -> list[bytes]:
        return self.keys[self.starts[i] : self.starts[i + 1]]


def _chain(path: list[bytes]) -> list[bytes]:
    """An id for each prefix of a path, from the empty one on."""
    out = [hashlib.md5().digest()]
    for key in path:
        out.append(hashlib.md5(out[-1] + key).digest())
    return out


NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends binary"
SPINE = "path array<binary>, chars array<int>, members array<long>, least array<long>, leaves array<long>, saved array<long>, children array<long>, ends_at array<binary>"
PARTS = f"{NODE}, parent_key binary, {SPINE}"
_TYPES = [
    *[pa.int64()] * 7, pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int32()),
    *[pa.list_(pa.int64())] * 5, pa.list_(pa.binary()),
]
_NAMES = [c.strip().split()[0] for c in PARTS.split(",")]


def _part(columns: dict, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in zip(_NAMES, _TYPES)], names=_NAMES
    )


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of a shard that are its own, and its spines."""
    table = pa.Table.from_batches(list(batches))
    if not table.num_rows:
        return
    table = table.combine_chunks()
    column = lambda name: table.column(name).chunk(0)
    paths = _Paths(column("path"), column("chars"))
    tree, n = Tree(paths.depths), len(paths.depths)
    ends = np.zeros(n, np.int64)
    ends[paths.end] = np.asarray(column("n_ends"))
    least = np.full(n, NONE)
    least[paths.end] = np.asarray(column("conv_id"))
    digests = dict(zip(paths.end.tolist(), column("ends").to_pylist()))

    latest = np.zeros(int(paths.depths.max()) + 1, np.int64)
    latest[paths.depths] = np.arange(n)  # the last of each depth
    first, last = np.arange(paths.lengths[0] + 1), latest[: paths.lengths[-1] + 1]
    spine = np.zeros(n, bool)
    spine[first] = spine[last] = True

    parents = tree.parents()
    members, mins = tree.sums(ends), tree.minima(least)
    leaves = tree.leaves()
    saved = tree.sums(np.where(spine, 0, (members - 1) * paths.chars))
    children = np.bincount(parents[1:], minlength=n)

    # what hangs off the spines: the whole of a spine node without its children on a spine
    on = np.nonzero(spine)[0]
    inner = on[on > 0]
    off_members, off_saved, off_leaves, off_children = members.copy(), saved.copy(), np.where(children > 0, leaves, 0), children.copy()
    for total, part in ((off_members, members), (off_saved, saved), (off_leaves, leaves), (off_children, np.ones(n, np.int64))):
        np.subtract.at(total, parents[inner], part[inner])
    off_least = least.copy()
    hanging = np.nonzero(~spine & spine[np.maximum(parents, 0)])[0]
    np.minimum.at(off_least, parents[hanging], mins[hanging])

    keys: dict[int, bytes] = {}
    told = np.zeros(n, bool)  # each node's part is told once, by the first path if on both
    for path, nodes in ((0, first), (len(paths.lengths) - 1, last)):
        if path == 0 or len(paths.lengths) > 1:
            keys |= zip(nodes.tolist(), _chain(paths.key(path)))
            fresh = ~told[nodes]
            told[nodes] = True
            yield _part(
                {
                    "path": [paths.key(path)],
                    "chars": [paths.chars[nodes]],
                    "members": [np.where(fresh, off_members[nodes], 0)],
                    "least": [np.where(fresh, off_least[nodes], NONE)],
                    "leaves": [np.where(fresh, off_leaves[nodes], 0)],
                    "saved": [np.where(fresh, off_saved[nodes], 0)],
                    "children": [np.where(fresh, off_children[nodes], 0)],
                    "ends_at": [[digests.get(v) if f else None for v, f in zip(nodes.tolist(), fresh)]],
                },
                1,
            )
    own = np.nonzero(~spine)[0]
    for i in range(0, len(own), BATCH):
        some = own[i : i + BATCH]
        above = parents[some]
        yield _part(
            {
                "conv_id": mins[some],
                "depth": paths.depths[some],
                "parent_conv_id": pa.array(mins[above], mask=spine[above]),
                "n_convs": members[some],
                "n_children": children[some],
                "n_leaves": leaves[some],
                "saved_tokens": saved[some],
                "ends": [digests.get(v, NO_ENDS) for v in some.tolist()],
                "parent_key": [keys.get(v) for v in above.tolist()],
            },
            len(some),
        )


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of all spines, equal ones merged."""
    table = pa.Table.from_batches(list(batches))
    if not table.num_rows:
        return
    table = table.combine_chunks()
    column = lambda name: table.column(name).chunk(0)
    chars = column("chars")
    # chars and the parts have an entry for the root in front
    per_turn = pa.array([c[1:] for c in chars.to_pylist()], pa.list_(pa.int32()))
    paths = _Paths(column("path"), per_turn)
    n = len(paths.depths)
    sums = {c: np.zeros(n, np.int64) for c in ("members", "leaves", "saved", "children")}
    least = np.full(n, NONE)
    ends: list[bytes] = [NO_ENDS] * n
    keys: list[bytes] = [b""] * n
    stack = np.zeros(int(paths.lengths.max()) + 1, np.int64)  # the nodes of the path so far
    parts = {c: column(c) for c in (*sums, "least", "ends_at")}
    for i, length in enumerate(paths.lengths.tolist()):
        shared = int(paths.shared[i]) if i else 0
        stack[shared + 1 : length + 1] = paths.number[paths.starts[i] + shared : paths.starts[i + 1]]
        nodes = stack[: length + 1]
        for c, total in sums.items():
            total[nodes] += np.asarray(parts[c][i].values)
        least[nodes] = np.minimum(least[nodes], np.asarray(parts["least"][i].values))
        for v, key, digest in zip(nodes.tolist(), _chain(paths.key(i)), parts["ends_at"][i].as_py()):
            keys[v] = key
            if digest is not None:
                ends[v] = digest
    tree = Tree(paths.depths)
    parents = tree.parents()
    children = sums["children"] + np.bincount(parents[1:], minlength=n)
    members, mins = tree.sums(sums["members"]), tree.minima(least)
    saved = tree.sums(sums["saved"] + (members - 1) * paths.chars)
    leaves = tree.sums(sums["leaves"] + (children == 0))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(mins),
            pa.array(paths.depths, pa.int64()),
            pa.array(mins[parents], mask=parents < 0),
            pa.array(members),
            pa.array(children),
            pa.array(leaves),
            pa.array(saved),
            pa.array(ends, pa.binary()),
            pa.array(keys, pa.binary()),
        ],
        names=["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends", "key"],
    )


def prefix_trie(sequences: DataFrame, shard: int = SHARD) -> DataFrame:
    """One row per node of the trie of `sequences` (conv_id: unique; path: array of 16-byte binary;
    chars: array of int).

    Returns conv_id (the smallest member), depth, parent_conv_id (null for the root), n_convs
    (members: sequences that begin with the node's), n_children, n_leaves (childless nodes of
    the subtree), saved_tokens (summed over the subtree: members but one, times the chars
    of the node's last turn) and ends_sha256 (of the sorted ids of sequences that end there).

    Empty sequences end at the root. Equal sequences are one path, whose ids are gathered in
    chunks. No sequences give no rows. A sequence is held as one row of some 30 bytes per
    turn, without texts. `shard` is the number of turns in a task; the task that merges the spines gets two
    paths from each shard.
    """
    paths = _distinct(sequences)
    spark = paths.sparkSession
    turns = paths.agg(F.coalesce(F.sum(F.size("path") + 1), F.lit(0))).first()[0]
    shards = max(spark.sparkContext.defaultParallelism, -(-turns // shard))
    parts = stage(
        paths.select("path", "chars", "conv_id", "n_ends", "ends")
        .repartitionByRange(shards, "path")
        .sortWithinPartitions("path")
        .mapInArrow(_shard, PARTS),
        "shards",
    )
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    spines = stage(
        parts.where("path IS NOT NULL")
        .select(*(c.strip().split()[0] for c in SPINE.split(",")))
        .repartition(1)
        .sortWithinPartitions("path")
        .mapInArrow(_merge, f"{NODE}, key binary"),
        "spines",
    )
    nodes = parts.where("path IS NULL").select(*columns, "ends", "parent_key")
    above = spines.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    hanging = nodes.where("parent_key IS NOT NULL").join(above, "parent_key").withColumn("parent_conv_id", F.col("above"))
    every = nodes.where("parent_key IS NULL").drop("parent_key")
    every = every.unionByName(hanging.select(every.columns)).unionByName(spines.select(every.columns))
    return every.select(*columns, F.lower(F.hex("ends")).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all rebuilt conversations; see `rebuild` and `prefix_trie`."""
    return prefix_trie(rebuild(conversations))
