"""Exact top-k search by inner product, as a three-phase uniform threshold algorithm.

Vectors are cut into ``slices`` of their dimensions; each slice is a list of local scores (partial inner products), and a
total score is the sum over the slices.  For a block of queries:

1. each slice's best ``k`` + 1 local scores are gathered (a bounded list from each task, then from all tasks); the objects
   in them are scored exactly, and the k-th best total ``t`` is a safe cutoff: it is reached by k objects;
2. ``t`` is broadcast, and every task takes from each slice the entries with a local score of ``t / slices`` or more: an
   object below that in every slice has a total below ``t``.  With the bound ``t / slices`` for slices without an entry,
   objects whose upper bound is below ``t`` go;
3. the scores that are missing for what is left are resolved exactly, in the same task, since a vector's slices lie in one
   row.  A task sends on its ``k`` best objects a query (ties: the smaller id) at most, so what is shuffled is in proportion
   to queries and tasks, not to objects.

Equal vectors are one object with its ``k`` + 1 least ids, so a vector that a third of all rows repeat counts once and no
tie is lost.  Queries are taken in blocks of ``BLOCK``, each broadcast (at most ``BLOCK`` vectors and cutoffs) and each
written on its own; nothing else goes to the driver.

Components become ``floor(1024 * x)``.  Products are made in doubles where all sums stay below 2**53 (they are exact
there), else in 64-bit integers.

Defined cases: vectors that are null, or hold a null, NaN or infinite component, are neither queries nor candidates;
shorter vectors count as padded with zeros, empty ones score 0; ids that repeat are one candidate each vector, and never
a candidate of the query with that id; ties go to the smaller id; fewer candidates than ``k`` are all returned; null ids
take no part; further columns are ignored; vectors of any length are taken whole; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_dir, written

BLOCK, SLICES, STRIP = 1024, 2, 2_000


def quantised(c: Column) -> Column:
    return F.transform(c, lambda x: F.floor(x.cast("double") * 1024).cast("bigint"))


def usable(c: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return c.isNotNull() & ~F.coalesce(F.exists(c, bad), F.lit(True))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), np.int64)
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(column)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


class _Block:
    """A block of queries: ids, integer vectors, the bounds of the slices."""

    def __init__(self, ids: list[int], vectors: np.ndarray, slices: int, exact: type):
        self.ids, self.vectors = np.array(ids, np.int64), vectors.astype(exact)
        self.cuts = [vectors.shape[1] * j // slices for j in range(slices + 1)]

    def parts(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], np.ndarray]]:
        """Strips of objects with their local scores (a matrix for each slice, query by object) and whether they may answer."""
        for batch in batches:
            for at in range(0, batch.num_rows, STRIP):
                strip = batch.slice(at, STRIP)
                objects = _matrix(strip.column("v"), self.vectors.shape[1]).astype(self.vectors.dtype)
                local = [self.vectors[:, a:b] @ objects[:, a:b].T for a, b in zip(self.cuts, self.cuts[1:])]
                alone = np.array([x[0] if len(x) == 1 else np.iinfo(np.int64).min for x in strip.column("ids").to_pylist()])
                yield strip, local, self.ids[:, None] != alone[None, :]


def _local_lists(shared, keep: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, best = shared.value, None
        for strip, local, other in block.parts(batches):
            names = strip.column("object").to_numpy()
            for j, scores in enumerate(local):
                s = np.where(other, scores.astype(np.float64), -np.inf)
                if best is None:
                    best = [(np.empty((len(block.ids), 0)), np.empty((len(block.ids), 0), np.int64)) for _ in local]
                s = np.concatenate([best[j][0], s], 1)
                n = np.concatenate([best[j][1], np.broadcast_to(names, scores.shape)], 1)
                if s.shape[1] > keep:
                    top = np.argpartition(-s, keep - 1, 1)[:, :keep]
                    s, n = np.take_along_axis(s, top, 1), np.take_along_axis(n, top, 1)
                best[j] = (s, n)
        for j, (s, n) in enumerate(best or ()):
            q, at = np.nonzero(np.isfinite(s))
            yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), pa.array(np.full(len(q), j, np.int32)), pa.array(n[q, at]), pa.array(s[q, at])], names=["q", "slice", "object", "local"])

    return run


def _totals(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            q = batch.column("q").to_numpy()
            total = (block.vectors[q] * _matrix(batch.column("v"), block.vectors.shape[1]).astype(block.vectors.dtype)).sum(1)
            yield pa.RecordBatch.from_arrays([batch.column("q"), batch.column("object"), batch.column("ids"), pa.array(total.astype(np.int64))], names=["q", "object", "ids", "total"])

    return run


class _Best:
    """The best ``k`` objects of each query so far, by score and then the least id that may answer."""

    def __init__(self, k: int):
        self.k, self.q, self.total, self.least, self.ids = k, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), []

    def add(self, q: np.ndarray, total: np.ndarray, least: np.ndarray, ids: list[list[int]]) -> None:
        self.q, self.total, self.least = np.concatenate([self.q, q]), np.concatenate([self.total, total]), np.concatenate([self.least, least])
        self.ids += ids
        order = np.lexsort((self.least, -self.total, self.q))
        q = self.q[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        kept = order[place < self.k]
        self.q, self.total, self.least, self.ids = self.q[kept], self.total[kept], self.least[kept], [self.ids[i] for i in kept]


def _answers(shared, cutoffs, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, cutoff, best = shared.value, cutoffs.value[:, None], _Best(k)
        for strip, local, other in block.parts(batches):
            slices, ids = len(local), strip.column("ids").to_pylist()
            entry = np.zeros(other.shape, bool)
            for scores in local:
                entry |= scores * slices >= cutoff
            q, at = np.nonzero(other & entry)
            parts = np.stack([scores[q, at] for scores in local])
            t = cutoff[q, 0]
            share = np.where(np.isfinite(t), t, 0.0) / slices
            upper = np.where(parts * slices >= t, parts, share)
            good = upper.sum(0) + 1e-9 * np.abs(upper).sum(0) + 1 >= t
            q, at, t, total = q[good], at[good], t[good], parts[:, good].astype(np.int64).sum(0)
            good = total >= t
            q, at, total = q[good], at[good], total[good]
            first = np.array([x[0] for x in ids], np.int64)
            second = np.array([x[1] if len(x) > 1 else x[0] for x in ids], np.int64)
            least = np.where(first[at] == block.ids[q], second[at], first[at])
            best.add(q.astype(np.int64), total, least, [ids[i] for i in at.tolist()])
        yield pa.RecordBatch.from_arrays([pa.array(best.q.astype(np.int32)), pa.array(block.ids[best.q]), pa.array(best.ids, pa.list_(pa.int64())), pa.array(best.total)], names=["q", "query_id", "ids", "total"])

    return run


def _search_block(objects: DataFrame, block: _Block, k: int, path: str) -> None:
    """Writes the answers of a block of queries."""
    context = objects.sparkSession.sparkContext
    shared = context.broadcast(block)
    scored = "q int, object bigint, ids array<bigint>, total bigint"
    lists = objects.select("object", "ids", "v").mapInArrow(_local_lists(shared, k + 1), "q int, slice int, object bigint, local double")
    first = lists.withColumn("r", F.row_number().over(Window.partitionBy("q", "slice").orderBy(F.desc("local"), "object"))).where(F.col("r") <= k + 1)
    seen = first.select("q", "object").distinct().join(objects, "object").select("q", "object", "ids", "v").mapInArrow(_totals(shared), scored)
    ranked = seen.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("total")))).where(F.col("r") == k)
    cutoff = np.full(len(block.ids), -np.inf)
    for row in ranked.select("q", "total").collect():  # at most one number a query of the block
        t = float(row["total"])
        cutoff[row["q"]] = t if t <= row["total"] else np.nextafter(t, -np.inf)
    cutoffs = context.broadcast(cutoff)
    found = objects.select("object", "ids", "v").mapInArrow(_answers(shared, cutoffs, k), "q int, query_id bigint, ids array<bigint>, total bigint")
    # Answers are expanded into their ids: at most k + 1 of each.
    rows = found.select("q", "query_id", F.explode("ids").alias("vec_id"), F.col("total").alias("score")).where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    rows.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score").write.parquet(path)
    for b in (shared, cutoffs):
        b.destroy()


def search(vectors: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", slices: int = SLICES, block: int = BLOCK) -> DataFrame:
    """Each query's ``k`` best other rows: query_id, rank (from 1), vec_id, score.  ``queries``: a condition on the id column."""
    spark = vectors.sparkSession
    clean = vectors.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("vec_id"), quantised(F.col(vector_col)).alias("v")).distinct()
    least = Window.partitionBy("h", "v").orderBy("vec_id")
    few = clean.withColumn("h", F.xxhash64("v")).withColumn("r", F.row_number().over(least)).where(F.col("r") <= k + 1)
    objects = written(few.groupBy("h", "v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).select(F.element_at("ids", 1).alias("object"), "ids", "v"))
    # An object's name is its least id and the place among objects of that id (ids may repeat with other vectors).
    objects = written(objects.select(F.xxhash64("object", "v").alias("object"), "ids", "v")) if objects.groupBy("object").count().where("count > 1").limit(1).count() else objects
    most = objects.agg(F.max(F.size("v")).alias("width"), F.max(F.aggregate("v", F.lit(0).cast("bigint"), lambda a, x: F.greatest(a, F.abs(x)))).alias("high")).first()
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    if most["width"] is None:
        return empty
    width = max(most["width"], slices)
    exact = np.float64 if most["high"] ** 2 * width * slices < 2**53 else np.int64
    root, n, ids, rows = shared_dir(spark), 0, [], []

    def flush() -> None:
        nonlocal n, ids, rows
        own = np.zeros((len(rows), width), np.int64)
        for i, r in enumerate(rows):
            own[i, : len(r)] = r
        _search_block(objects, _Block(ids, own, slices, exact), k, f"{root}/part={n}")
        n, ids, rows = n + 1, [], []

    for row in clean.where(queries).toLocalIterator():
        ids.append(row["vec_id"])
        rows.append(row["v"])
        if len(ids) == block:
            flush()
    if ids:
        flush()
    return spark.read.schema(empty.schema).parquet(root).select(*empty.columns) if n else empty
