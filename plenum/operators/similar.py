"""Equivalence sets without a model (G14): propositions linked by the Jaccard share of their word n-grams, exact.

1. *Filter.*  Linked propositions share ``least`` of their n-grams, so one with fewer n-grams that occur elsewhere has no
   link.  Map tasks deal 32-bit fingerprints, packed by portion, over buckets of near-equal size; buckets answer with the
   propositions whose fingerprints occur twice.  Fingerprints that collide keep a proposition and never drop one.
2. *Classes.*  Propositions of equal n-grams are one class, of which one goes on.
3. *Groups.*  In one order of all n-grams linked classes share one of their prefixes, the first ``n - ceil(least * n) + 1``.
   The order is by hash, but n-grams of more than ``FREQUENT`` classes come last, the most frequent at the end; at most
   ``LISTED`` of them are broadcast, and any order gives the same result.  Classes with an n-gram in their prefixes meet in
   the group of the least such class, once whatever the number of n-grams.  Large groups are split in blocks, and each pair
   of blocks is a task.
4. *Count.*  A pair of blocks counts common n-grams for all its pairs at once: those of many classes by products of 0/1
   matrices, the others by their lists.  A pair that meets in several groups is linked in the least of them only.

N-grams are compared by 64-bit hashes; two different ones are taken for one with a chance of about 2**-64 a pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import shingle_sets
from ..session import materialised, small_batches

#: N-grams that a map task packs at a time; propositions a bucket, for the number of buckets.
PORTION, ROWS_A_BUCKET = 600_000, 4_000
#: Classes that make an n-gram frequent; how many such n-grams are broadcast.
FREQUENT, LISTED = 64, 65_536
#: Classes and n-grams of a block.
BLOCK_CLASSES, BLOCK_GRAMS = 400, 1_000_000
#: Most groups that are broadcast: those of more than 100 classes and one in HOT of all rows.
HOT = 10_000
#: Columns of a 0/1 matrix; how much dearer a listed pair is than one in a product.
COLUMNS, DEARER = 2_048, 20

_PACKED = pa.schema([("key", pa.int64()), ("portion", pa.int64()), ("ids", pa.list_(pa.string())), ("info", pa.binary()), ("docs", pa.binary()), ("prints", pa.binary())])
_INFO = np.dtype([("n", "<i8"), ("d1", "<i8"), ("d2", "<i8")])
#: For products such as 0.55 * 100 that come out above the whole number.
_SLACK = 1e-9


def _digest(grams: np.ndarray) -> tuple[int, int]:
    d = hashlib.blake2b(grams.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _pack(words: int, bits: int):
    """Map side of step 1: for each portion one row with its propositions, and a row for each bucket with fingerprints."""

    def portion(name: int, ids: list[str], owned: list[np.ndarray]) -> Iterator[dict]:
        info = np.array([(len(s), *_digest(s)) for s in owned], _INFO)
        # Keys below zero are no buckets: they carry a portion's own row, each to a group of its own.
        yield {"key": -1 - name, "portion": name, "ids": ids, "info": info.tobytes()}
        doc, grams = np.repeat(np.arange(len(owned), dtype=np.uint16), info["n"]), np.concatenate(owned)
        order = np.argsort(grams, kind="stable")
        doc, grams = doc[order].copy(), grams[order]
        prints = (grams >> np.uint64(32 - bits)).astype(np.uint32)
        cuts = np.searchsorted(grams >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
        for b in np.flatnonzero(cuts[1:] > cuts[:-1]):
            yield {"key": int(b), "portion": name, "docs": doc[cuts[b] : cuts[b + 1]].tobytes(), "prints": prints[cuts[b] : cuts[b + 1]].tobytes()}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        name, ids, owned, size = (TaskContext.get().partitionId() + 1) << 24, [], [], 0
        for batch in batches:
            every = batch.column("proposition_id").to_pylist()
            for i, s in shingle_sets(batch.column("words"), words):
                if not len(s):
                    continue
                ids.append(every[i])
                owned.append(s)
                size += len(s)
                if size >= PORTION or len(ids) == 60_000:
                    yield from portion(name, ids, owned)
                    name, ids, owned, size = name + 1, [], [], 0
        if ids:
            yield from portion(name, ids, owned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for r in rows(batches):
            held.append(r)
            size += sum(len(v) for v in r.values() if isinstance(v, bytes))
            if size > 4_000_000:
                yield pa.RecordBatch.from_pylist(held, _PACKED)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, _PACKED)

    return run


def _meet(table: pa.Table) -> pa.Table:
    """A bucket: for each portion, the propositions of the fingerprints that occur twice, once for each of these."""
    if table.column("key")[0].as_py() < 0:
        return table.select(["portion", "ids", "info", "docs"])
    prints = [np.frombuffer(x, np.uint32) for x in table.column("prints").to_pylist()]
    seen, n = np.unique(np.concatenate(prints), return_counts=True)
    shared = seen[n >= 2]
    found = []
    for name, docs, p in zip(table.column("portion").to_pylist(), table.column("docs").to_pylist(), prints):
        hit = np.zeros(len(p), bool)
        if len(shared):
            hit = shared[np.minimum(np.searchsorted(shared, p), len(shared) - 1)] == p
        if hit.any():
            found.append({"portion": name, "docs": np.frombuffer(docs, np.uint16)[hit].tobytes()})
    return pa.Table.from_pylist(found, pa.schema([f for f in _PACKED if f.name in ("portion", "ids", "info", "docs")]))


def _answer(least: float):
    def run(table: pa.Table) -> pa.Table:
        """A portion: its propositions, each with whether enough of its n-grams are shared for it to have a link."""
        own = next(r for r in table.select(["ids", "info"]).to_pylist() if r["info"] is not None)
        info = np.frombuffer(own["info"], _INFO)
        shared = np.zeros(len(info), np.int64)
        for x in table.column("docs").to_pylist():
            if x is not None:
                shared += np.bincount(np.frombuffer(x, np.uint16), minlength=len(info))
        maybe = shared >= least * info["n"] - _SLACK
        return pa.table({"proposition_id": pa.array(own["ids"], pa.string()), "d1": info["d1"].copy(), "d2": info["d2"].copy(), "maybe": maybe})

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """N-grams of the rows that stand for a class; a row that repeats the id with another text is left out."""
        for batch in batches:
            d1, d2 = batch.column("d1").to_pylist(), batch.column("d2").to_pylist()
            found = [(i, s.view(np.int64)) for i, s in shingle_sets(batch.column("words"), words) if _digest(s) == (d1[i], d2[i])]
            own = batch.select(["node", "c", "many"]).take(pa.array([i for i, _ in found], pa.int64()))
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array([s for _, s in found], pa.list_(pa.int64()))], names=["node", "c", "many", "grams"])

    return run


def _prefixes(least: float, frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, number = frequent.value

        def first_of(s: np.ndarray) -> np.ndarray:
            size = len(s) - int(np.ceil(least * len(s) - _SLACK)) + 1
            if not len(keys):
                return np.sort(s)[:size]
            at = np.minimum(np.searchsorted(keys, s), len(keys) - 1)
            return s[np.lexsort((s, np.where(keys[at] == s, number[at], 0)))[:size]]

        for batch in batches:
            first = [first_of(x.values.to_numpy()) for x in batch.column("grams")]
            nodes = np.repeat(batch.column("node").to_numpy(), [len(x) for x in first])
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(np.concatenate([*first, np.empty(0, np.int64)]))], names=["node", "g"])

    return run


def overlaps(lists: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many values the lists numbered ``left`` (rows) and ``right`` (columns) have in common; a list repeats no value."""
    common = np.zeros((len(left), len(right)), np.float32)
    if not len(left) or not len(right):
        return common
    sides = []
    for side in (left, right):
        sides.append((np.repeat(np.arange(len(side)), [len(lists[k]) for k in side]), np.concatenate([lists[k] for k in side])))
    values, code = np.unique(np.concatenate([v for _, v in sides]), return_inverse=True)
    codes = code[: len(sides[0][1])], code[len(sides[0][1]) :]
    na, nb = (np.bincount(c, minlength=len(values)) for c in codes)
    heavy = (na * nb > 0) & (DEARER * na * nb >= len(left) * len(right))
    light = (na * nb > 0) & ~heavy

    def only(kind: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Rows and columns of the 0/1 matrices of both sides, by column."""
        number, out = np.cumsum(kind) - 1, []
        for (row, _), c in zip(sides, codes):
            mine = kind[c]
            row, column = row[mine], number[c[mine]]
            order = np.argsort(column, kind="stable")
            out.append((row[order], column[order]))
        return out

    both = only(heavy)
    for at in range(0, int(heavy.sum()), COLUMNS):
        dense = []
        for (row, column), side in zip(both, (left, right)):
            a, b = np.searchsorted(column, [at, at + COLUMNS])
            part = np.zeros((len(side), COLUMNS), np.float32)
            part[row[a:b], column[a:b] - at] = 1
            dense.append(part)
        common += dense[0] @ dense[1].T
    (row, column), (listed, at) = only(light)
    if len(row):
        cuts = np.searchsorted(at, np.arange(int(light.sum()) + 1))
        order = np.argsort(row, kind="stable")
        column, ends = column[order], np.searchsorted(row[order], np.arange(len(left) + 1))
        for k in range(len(left)):
            own = column[ends[k] : ends[k + 1]]
            size = cuts[own + 1] - cuts[own]
            from_ = np.repeat(cuts[own] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
            common[k] += np.bincount(listed[from_], minlength=len(right))
    return common


def _linked(least: float):
    def run(table: pa.Table) -> pa.Table:
        """A pair of blocks: for each class ``c`` the greater ones it is linked with, by id or, if they have several, by node."""
        table = table.sort_by("c")
        hub, i, j = (table.column(k)[0].as_py() for k in ("hub", "i", "j"))
        names, nodes, many = table.column("c").to_pylist(), table.column("node").to_numpy(), table.column("many").to_numpy()
        own, grams = table.column("own").to_numpy(), [x.values.to_numpy() for x in table.column("grams")]
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        common = overlaps(grams, left, right).astype(np.float64)
        n = np.array([len(x) for x in grams], np.float64)
        linked = (common > 0) & (common / (n[left][:, None] + n[right][None, :] - common) >= least)
        if i == j:
            linked = np.triu(linked, 1)
        hubs = [h[h < hub] for h in (x.values.to_numpy() for x in table.column("hubs"))]
        if linked.any() and any(map(len, hubs)):
            linked &= overlaps(hubs, left, right) == 0
        x, y = np.nonzero(linked)
        x, y = left[x], right[y]
        a, b = np.minimum(x, y), np.maximum(x, y)
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
        rows, cuts = [], [*np.flatnonzero(np.diff(a, prepend=-1)), len(a)]
        for s, e in zip(cuts, cuts[1:]):
            name, others = names[a[s]], b[s:e]
            several = many[others]
            rows.append({"c": name, "ids": [names[k] for k in others[~several] if names[k] != name], "nodes": [int(nodes[k]) for k in others[several] if names[k] != name]})
        return pa.Table.from_pylist(rows, pa.schema([("c", pa.string()), ("ids", pa.list_(pa.string())), ("nodes", pa.list_(pa.int64()))]))

    return run


def _links(kept: DataFrame, least: float) -> DataFrame:
    """Links among the classes ``kept`` (node, c, many, grams): c, ids and nodes of greater ones, in one row or several a class."""
    counts = kept.select(F.explode("grams").alias("g")).groupBy("g").agg(F.count("*").alias("k")).where(F.col("k") > FREQUENT)
    found = sorted((r["g"], r["k"]) for r in counts.orderBy(F.desc("k"), "g").limit(LISTED).collect())
    frequent = kept.sparkSession.sparkContext.broadcast((np.array([g for g, _ in found], np.int64), np.array([k for _, k in found], np.int64)))
    prefixes = materialised(kept.mapInArrow(_prefixes(least, frequent), "node bigint, g bigint"))
    hubs = prefixes.groupBy("g").agg(F.min("node").alias("hub"), F.count("*").alias("k")).where("k > 1").select("g", "hub")
    of = materialised(prefixes.join(hubs, "g").groupBy("node").agg(F.collect_set("hub").alias("hubs")))
    each = materialised(of.join(kept.select("node", F.size("grams").alias("n")), "node").select("node", F.explode("hubs").alias("hub"), "n"))
    blocks = F.ceil(F.greatest(F.sum("n") / BLOCK_GRAMS, F.count("*") / BLOCK_CLASSES)).cast("int")
    sized = materialised(each.groupBy("hub").agg(blocks.alias("blocks"), F.count("*").alias("k")))
    # Groups of more classes than that are HOT at most, whatever the table: their rows meet them by broadcast, not in one task.
    many = max(100, each.count() // HOT)
    hot = F.broadcast(sized.where(F.col("k") > many))
    both = each.join(hot, "hub").unionByName(each.join(hot.select("hub"), "hub", "left_anti").join(sized.where(F.col("k") <= many), "hub"))
    dealt = both.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    spread = dealt.select("hub", "node", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    groups = spread.select("hub", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node")
    return groups.join(kept.join(of, "node"), "node").groupBy("hub", "i", "j").applyInArrow(_linked(least), "c string, ids array<string>, nodes array<bigint>")


def similar_sets(propositions: DataFrame, least: float = 0.75, words: int = 5) -> DataFrame:
    """Equivalence sets without a model (G14): propositions linked by a Jaccard share of ``least`` of their word n-grams.

    The model's place-holder for tests and first drafts.  A set is a proposition, the least of its class, with the other ones
    of its class and with the greater classes linked to it: set_id, members.
    """
    small_batches(propositions.sparkSession)
    texts = propositions.select("proposition_id", F.regexp_replace(F.lower("proposition"), r"[^\p{L}\p{N}]+", " ").alias("words"))
    bits = max(2, min(16, (propositions.count() // ROWS_A_BUCKET).bit_length()))
    packed = texts.mapInArrow(_pack(words, bits), "key bigint, portion bigint, ids array<string>, info binary, docs binary, prints binary")
    met = packed.groupBy("key").applyInArrow(_meet, "portion bigint, ids array<string>, info binary, docs binary")
    every = met.groupBy("portion").applyInArrow(_answer(least), "proposition_id string, d1 bigint, d2 bigint, maybe boolean")
    equal = every.groupBy("d1", "d2").agg(F.min("proposition_id").alias("c"), F.collect_set("proposition_id").alias("ids"), F.bool_or("maybe").alias("maybe"))
    classes = materialised(equal.where("c IS NOT NULL").withColumn("node", F.monotonically_increasing_id()))
    wanted = classes.where("maybe").select(F.col("c").alias("proposition_id"), "d1", "d2", "node", "c", (F.size("ids") > 1).alias("many"))
    own = texts.join(wanted, "proposition_id").select("words", "d1", "d2", "node", "c", "many")
    kept = materialised(own.mapInArrow(_sets(words), "node bigint, c string, many boolean, grams array<bigint>").dropDuplicates(["node"]))
    links = materialised(_links(kept, least))
    several = links.select("c", F.explode("nodes").alias("node")).join(classes.where("size(ids) > 1").select("node", "ids"), "node")
    members = links.select("c", "ids").unionAll(several.select("c", "ids")).unionAll(classes.select("c", "ids"))
    listed = members.groupBy(F.col("c").alias("set_id")).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("members"))
    return listed.where("size(members) >= 2").select("set_id", "members")
