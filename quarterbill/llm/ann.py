"""Approximate nearest neighbours by cosine: multiprobe hashing with p-stable projections.

Vectors are scaled to length one, where the largest cosine is the least Euclidean distance.
A table hashes a vector to floor((a . x + b) / width) for several Gaussian a. A query visits
its own bucket of each table and then buckets with some hashes moved by one, in the order of
the estimated chance that a neighbour lies there: the least sum of squared distances to the
cell walls that are crossed. Whatever lies in a visited bucket is ranked by its cosine.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterbill.llm.common import stage

TABLES, HASHES, WIDTH, PROBES, SEED = 4, 8, 2.8, 96, 7
#: Vectors, and queries, of a bucket that one task compares; larger buckets are cut.
BLOCK = 20_000
NEAREST = "query_id long, vec_id long, score double"


def valid(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (doubles) of the vectors that take part, each pair once.

    Left out: null, empty or zero vectors and any with a null or non-finite component, and
    rows without an id.
    """
    numbers = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.where("vec_id IS NOT NULL AND size(embedding) > 0")
        .where(F.coalesce(finite, F.lit(False)) & F.exists("embedding", lambda x: x != 0))
        .select(F.col("vec_id").cast("long").alias("vec_id"), numbers.alias("embedding"))
        .distinct()
    )


def _planes(dim: int, tables: int, hashes: int, width: float) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng([SEED, dim, hashes])
    # a unit vector's product with a Gaussian row is a standard normal number
    return random.standard_normal((tables, hashes, dim)), random.uniform(0, width, (tables, hashes))


def places(x: np.ndarray, tables: int, hashes: int, width: float) -> np.ndarray:
    """(a . u + b) / width of unit vectors: row, table, hash."""
    a, b = _planes(x.shape[1], tables, hashes, width)
    top = np.abs(x).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    unit = x / top
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    return (np.einsum("nd,thd->nth", unit, a) + b) / width


def bucket(dim: int, table: int, cells: np.ndarray) -> int:
    """A bucket's key; two buckets with one key would but share their members."""
    return xxhash.xxh64_intdigest(cells.astype("<i8").tobytes(), seed=int(dim) * 1024 + table) - (1 << 63)


def probes(place: np.ndarray, most: int) -> list[np.ndarray]:
    """Cells to visit for the hashes of one table, the likeliest first, at most `most`.

    Moves of one hash up or down are sorted by the squared distance to the wall; sets of
    moves come from a heap by their sums: from each set, its last move is replaced by the
    next or the next is added, and sets that move one hash both ways are skipped.
    """
    cell = np.floor(place)
    n = len(place)
    down = place - cell
    cost = np.concatenate([down**2, (1 - down) ** 2])
    order = np.argsort(cost, kind="stable")
    cost = cost[order]
    out = [cell.astype(np.int64)]
    heap = [(float(cost[0]), (0,))]
    while heap and len(out) < most:
        total, moves = heapq.heappop(heap)
        hashes = [order[m] % n for m in moves]
        if len(set(hashes)) == len(hashes):
            moved = cell.copy()
            for m in moves:
                moved[order[m] % n] += -1 if order[m] < n else 1
            out.append(moved.astype(np.int64))
        last = moves[-1] + 1
        if last < 2 * n:
            heapq.heappush(heap, (total - float(cost[last - 1]) + float(cost[last]), (*moves[:-1], last)))
            heapq.heappush(heap, (total + float(cost[last]), (*moves, last)))
    return out


def _keys(tables: int, hashes: int, width: float, most: int):
    def of(some: pd.Series) -> pd.Series:
        out = [None] * len(some)
        dims = some.map(len)
        for dim in dims.unique():
            at = np.nonzero((dims == dim).to_numpy())[0]
            place = places(np.stack(some.iloc[at].to_list()), tables, hashes, width)
            for i, p in zip(at, place):
                out[i] = [bucket(dim, t, c) for t in range(tables) for c in (probes(p[t], most) if most > 1 else [np.floor(p[t])])]
        return pd.Series(out, dtype=object)

    return F.pandas_udf(of, "array<long>")


def _nearest(k: int):
    def work(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(queries) and len(vectors):
            ids, place = np.unique(vectors.vec_id.to_numpy(), return_inverse=True)
            x = np.stack(vectors.embedding.to_list())
            length = np.sqrt((x * x).sum(1))
            small = (length < 1e-100) | ~np.isfinite(length)
            for q, v in zip(queries.query_id, queries.embedding):
                own = np.sqrt((v * v).sum())
                if small.any() or not 1e-100 < own < np.inf:  # scale first, where squares vanish or overflow
                    y, u = x / np.abs(x).max(1, keepdims=True), v / np.abs(v).max()
                    score = (y @ u) / (np.sqrt((y * y).sum(1)) * np.sqrt((u * u).sum()))
                else:
                    score = (x @ v) / (length * own)
                if len(ids) < len(score):  # an id's nearest vector stands for it
                    rows, score = score, np.full(len(ids), -np.inf)
                    np.maximum.at(score, place, rows)
                else:
                    score = score[np.argsort(place)]
                other = np.nonzero(ids != q)[0]
                if len(other) > k:
                    least = np.partition(score[other], len(other) - k)[len(other) - k]
                    other = other[score[other] >= least]
                best = sorted(zip(-score[other], ids[other]))[:k]
                found += [(q, i, -s) for s, i in best]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    return work


def _compare(queries: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """The k nearest of each query among the vectors under its keys, key by key.

    queries: key, query_id, embedding; index: key, vec_id, embedding. Keys with many rows
    are cut into blocks; each block of queries meets each block of vectors.
    """
    size = lambda df, name: df.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name))
    blocks = stage(size(queries, "nq").join(size(index, "nv"), "key"), "blocks")

    def cut(df: DataFrame, id_: str, own: str, other: str) -> DataFrame:
        each = df.join(blocks, "key").withColumn(f"{own}_block", F.pmod(F.xxhash64(id_), F.col(own)).cast("int"))
        return each.withColumn(f"{other}_block", F.explode(F.sequence(F.lit(0), F.col(other) - 1))).select(
            *(F.col(c).alias(c) for c in ("key", "nq_block", "nv_block", id_, "embedding"))
        )

    by = ["key", "nq_block", "nv_block"]
    q = cut(queries, "query_id", "nq", "nv").groupBy(*by)
    v = cut(index, "vec_id", "nv", "nq").groupBy(*by)
    return q.cogroup(v).applyInPandas(_nearest(k), NEAREST)


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
    )


def exact(queries: DataFrame, vectors: DataFrame, k: int = 5) -> DataFrame:
    """query_id, vec_id, score, rank by comparing a query set with all vectors, in blocks."""
    key = F.size("embedding").cast("long").alias("key")
    return _top(_compare(queries.select(key, "query_id", "embedding"), vectors.select(key, "vec_id", "embedding"), k), k)


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    tables: int = TABLES,
    hashes: int = HASHES,
    width: float = WIDTH,
    most_probes: int = PROBES,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each vector that is a query.

    A vector is no candidate of its own id. Vectors of another length than the query's are
    not comparable. Of identical vectors only the k + 1 smallest ids can be among the k
    nearest, so the index keeps these alone. Queries whose probes met fewer than k vectors
    are compared with all. Ties go to the smaller vec_id; other columns are ignored. Of rows
    that share an id, the best pair of vectors counts, as query and as candidate.
    """
    all_ = stage(valid(vectors), "vectors")
    same = Window.partitionBy("embedding").orderBy("vec_id")
    index = stage(
        all_.withColumn("_n", F.dense_rank().over(same))
        .where(F.col("_n") <= k + 1)
        .drop("_n")
        .dropDuplicates(["embedding", "vec_id"]),
        "index",
    )
    queries = all_.where(is_query).select(F.col("vec_id").alias("query_id"), "embedding")
    keyed = _keys(tables, hashes, width, 1)
    asked = _keys(tables, hashes, width, most_probes)
    probed = queries.select(F.explode(F.array_distinct(asked("embedding"))).alias("key"), "query_id", "embedding")
    filed = index.select(F.explode(keyed("embedding")).alias("key"), "vec_id", "embedding")
    near = stage(_top(_compare(probed, filed, k), k), "nearest")
    whole = near.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
    short = stage(queries.join(whole, "query_id", "left_anti"), "short")
    if short.isEmpty():
        found = near
    else:
        found = near.join(whole, "query_id", "left_semi").unionByName(exact(short, index, k).select(*near.columns))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
