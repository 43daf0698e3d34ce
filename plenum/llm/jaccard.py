"""N-gram Jaccard join by prefix trees, exact and without a bound on partners.

A document's set holds the 64-bit hashes of its distinct 5-word shingles.  Documents link when
``100 * |A and B| >= percent * |A or B|``.

1. *Shared shingles.*  A partner shares ``percent`` of a document's set, so a document with fewer shingles that occur
   anywhere else has no partner.  Map tasks deal the shingles' fingerprints, packed by the thousand, over buckets of
   near-equal size; what occurs twice within a task's portion is known to be shared and goes out once for all of them,
   so that a shingle that a third of all documents hold arrives once a portion.  Buckets find what occurs in several
   portions and answer with counts per document.  Fingerprints of 32 bits within a bucket may collide, which keeps a
   document for the exact steps and never drops one.
2. *Copies.*  Equal sets form a class; only the least document of a class goes on.  Step 1 runs again over these, where
   what only copies shared is no longer shared.  At the end rows get what their class got; the classes with most copies, a
   bounded number, are broadcast for that, so that copies of one text don't meet in one task.
3. *Groups.*  In an order of all shingles that is the same for all documents, linked documents share a shingle of their
   prefixes, the first ``n - ceil(percent * n / 100) + 1``.  The order is by hash, but shingles found in over ``FREQUENT``
   prefixes come last, by their number, so that passages that many documents share don't bring these together; at most
   ``LISTED`` of them are broadcast, and any order gives the same result.  Documents with a shingle in their prefixes go
   to the group of the least such document, once for each such group, whatever the number of shingles.
4. *Trie join.*  A group's sets, in one order (common shingles first), are stored in a compressed trie.  Each document
   walks the trie, so that the overlap with a shared path is counted once; a subtree is left when the overlap so far plus
   what can remain on either side is below what its sizes need, or when all of it is already connected with the document.
   Groups of more than ``GROUP_SHINGLES`` shingles are split in blocks by a hash of the document.  First each block is
   joined by itself, then one document of each connected part of each block; that settles a group of near copies at a
   cost in proportion to its size.  Only where a group still has several parts are its blocks joined pair by pair, and
   only documents of different parts are compared.
5. *Components* of the links (a spanning forest of each group's links) by star contraction, see ``graph``.

Sets are compared by 64-bit hashes; two different shingles are taken for one with a chance of about 2**-64 a pair.

Defined cases: null or empty texts, or of white space only, have no shingles, link with nothing and are their own
component; fewer than five words make one shingle; rows that repeat a doc_id each get a row, by their own text, and different
texts of one doc_id are linked only by their texts; rows with a null doc_id link with nothing and have a null component;
texts of any length are taken whole, a text is the least that a task holds; further columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, written
from .graph import components
from .hashing import shingle_sets

PERCENT, WORDS = 75, 5
#: Shingles of a portion that a map task packs at a time; of a group that one task joins.
PORTION, GROUP_SHINGLES = 600_000, 1_500_000
#: Prefixes that make a shingle frequent; how many such shingles are broadcast; how often they are looked for.
FREQUENT, LISTED, ROUNDS = 64, 65_536, 3
#: Documents a bucket, for the number of buckets.
DOCS_A_BUCKET = 1_000
#: Most classes of copies that are broadcast: those of more than 100 rows and one in HOT of all rows.
HOT = 10_000

_PACKED = "key bigint, portion bigint, docs binary, info binary, counts binary, fingerprints binary, repeated binary"
_INFO = np.dtype([("doc_id", "<i8"), ("n", "<i4"), ("shared", "<i4"), ("d1", "<i8"), ("d2", "<i8")])


def _sets_of_text(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    return shingle_sets(batch.column("text"), WORDS)


def _sets_of_bytes(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    return enumerate(np.frombuffer(x.as_py(), np.uint64) for x in batch.column("shingles"))


def set_digest(shingles: np.ndarray) -> tuple[int, int]:
    import xxhash

    d = xxhash.xxh3_128_digest(shingles.tobytes())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _pack(sets: Callable, bits: int):
    """Map side of step 1: for each portion one row with its documents, and a row for each bucket with fingerprints."""

    def portion(name: int, ids: list[int], owned: list[np.ndarray]) -> Iterator[dict]:
        sizes = np.fromiter(map(len, owned), np.int64, len(owned))
        doc, key = np.repeat(np.arange(len(owned)), sizes), np.concatenate(owned) >> np.uint64(32 - bits)
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        same = ordered[1:] == ordered[:-1]
        twice = np.zeros(len(key), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        repeated = np.unique(ordered[1:][same])
        info = np.zeros(len(owned), _INFO)
        info["doc_id"], info["n"], info["shared"] = ids, sizes, np.bincount(doc[twice], minlength=len(owned))
        for k, s in enumerate(owned):
            info["d1"][k], info["d2"][k] = set_digest(s)
        # Keys below zero are no buckets: they carry a portion's own row, each to a group of its own.
        yield {"key": -1 - name, "portion": name, "info": info.tobytes()}
        key, doc = key[~twice], doc[~twice]
        bucket = (key >> np.uint64(32)).astype(np.uint32 if bits > 16 else np.uint16)
        order = np.argsort(bucket, kind="stable")
        bucket, doc, print32 = bucket[order], doc[order], key[order].astype(np.uint32)
        own, more = np.arange(1 << bits), (repeated >> np.uint64(32)).astype(np.int64)
        at, to = np.searchsorted(bucket, own), np.searchsorted(bucket, own, "right")
        at2, to2 = np.searchsorted(more, own), np.searchsorted(more, own, "right")
        repeated = repeated.astype(np.uint32)
        for b in np.flatnonzero((to > at) | (to2 > at2)):
            part = doc[at[b] : to[b]]
            row = {"key": int(b), "portion": name, "fingerprints": print32[at[b] : to[b]].tobytes(), "repeated": repeated[at2[b] : to2[b]].tobytes()}
            if 2 * len(part) < len(owned):
                yield row | {"docs": part.astype(np.uint16).tobytes()}
            else:
                yield row | {"counts": np.bincount(part, minlength=len(owned)).astype(np.uint32).tobytes()}

    names = ["key", "portion", "docs", "info", "counts", "fingerprints", "repeated"]
    types = [pa.int64(), pa.int64(), *[pa.binary()] * 5]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        base, k = (TaskContext.get().partitionId() + 1) << 24, 0
        ids, owned, size = [], [], 0
        for batch in batches:
            every = batch.column("doc_id").to_pylist()
            for i, s in sets(batch):
                ids.append(every[i])
                owned.append(s)
                size += len(s)
                if size >= PORTION or len(ids) == 60_000:
                    yield from portion(base + k, ids, owned)
                    ids, owned, size, k = [], [], 0, k + 1
        if ids:
            yield from portion(base + k, ids, owned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for r in rows(batches):
            held.append(r)
            size += sum(len(v) for v in r.values() if isinstance(v, bytes))
            if size > 4_000_000:
                yield pa.RecordBatch.from_arrays([pa.array([x.get(n) for x in held], t) for n, t in zip(names, types)], names=names)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([x.get(n) for x in held], t) for n, t in zip(names, types)], names=names)

    return run


def _meet(table: pa.Table) -> pa.Table:
    """A bucket: which fingerprints occur in several portions; per portion, how many of each document's."""
    if table.column("key")[0].as_py() < 0:
        return table.select(["portion", "docs", "info", "counts"])
    rows = table.select(["portion", "docs", "counts", "fingerprints", "repeated"]).to_pylist()
    prints = [np.frombuffer(r["fingerprints"], np.uint32) for r in rows]
    more = [np.frombuffer(r["repeated"], np.uint32) for r in rows]
    seen, n = np.unique(np.concatenate([*prints, *more, *more]), return_counts=True)
    shared = seen[n >= 2]
    out = {"portion": [], "docs": [], "info": [], "counts": []}
    for r, p in zip(rows, prints):
        if not len(shared) or not len(p):
            continue
        at = np.minimum(np.searchsorted(shared, p), len(shared) - 1)
        hit = shared[at] == p
        if not hit.any():
            continue
        doc = np.frombuffer(r["docs"], np.uint16) if r["docs"] is not None else np.repeat(np.arange(len(r["counts"]) // 4), np.frombuffer(r["counts"], np.uint32))
        out["portion"].append(r["portion"])
        out["docs"].append(doc[hit].astype(np.uint16).tobytes())
        out["info"].append(None)
        out["counts"].append(None)
    return pa.table(out, pa.schema([("portion", pa.int64()), ("docs", pa.binary()), ("info", pa.binary()), ("counts", pa.binary())]))


def _answer(percent: int):
    def run(table: pa.Table) -> pa.Table:
        """A portion: its documents, each with whether enough of its shingles are shared for it to have a partner."""
        info = np.frombuffer(next(x for x in table.column("info").to_pylist() if x is not None), _INFO)
        shared = info["shared"].astype(np.int64)
        for x in table.column("docs").to_pylist():
            if x is not None:
                shared = shared + np.bincount(np.frombuffer(x, np.uint16), minlength=len(info))
        n = info["n"].astype(np.int64)
        maybe = (n > 0) & (100 * shared >= percent * n)
        return pa.table({"doc_id": info["doc_id"], "n": n, "d1": info["d1"], "d2": info["d2"], "maybe": maybe})

    return run


def shared_enough(df: DataFrame, sets: Callable, percent: int) -> DataFrame:
    """Step 1 over ``df``: doc_id, n (set size), d1 and d2 (digest of the set), maybe (it may have a partner)."""
    bits = max(4, min(16, (df.count() // DOCS_A_BUCKET).bit_length()))
    packed = df.mapInArrow(_pack(sets, bits), _PACKED)
    met = packed.groupBy("key").applyInArrow(_meet, "portion bigint, docs binary, info binary, counts binary")
    return met.groupBy("portion").applyInArrow(_answer(percent), "doc_id bigint, n bigint, d1 bigint, d2 bigint, maybe boolean")


def _kept_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets of the documents that stand for a class; a row that repeats the doc_id with another text is left out."""
    for batch in batches:
        d1, d2, every = batch.column("d1").to_pylist(), batch.column("d2").to_pylist(), batch.column("node").to_pylist()
        ids, sets = [], []
        for i, s in shingle_sets(batch.column("text"), WORDS):
            if set_digest(s) == (d1[i], d2[i]):
                ids.append(every[i])
                sets.append(s.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], names=["doc_id", "shingles"])


def _prefixes(percent: int, frequent=None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number = frequent.value if frequent else (np.empty(0, np.uint64), None)

        def first_of(s: np.ndarray) -> np.ndarray:
            size = len(s) - -(-percent * len(s) // 100) + 1
            if not len(known):
                return s[:size]
            at = np.minimum(np.searchsorted(known, s), len(known) - 1)
            return s[np.lexsort((s, np.where(known[at] == s, number[at], 0)))[:size]]

        for batch in batches:
            first = [first_of(np.frombuffer(x, np.uint64)) for x in batch.column("shingles").to_pylist()]
            ids = np.repeat(np.array(batch.column("doc_id").to_pylist(), np.int64), [len(x) for x in first])
            grams = np.concatenate([*first, np.empty(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(grams)], names=["doc_id", "gram"])

    return run


class Trie:
    """Compressed trie of sorted rank arrays.  A node covers the documents ``lo`` to ``hi`` and the ranks ``at`` to ``to`` of
    their common path; ``least`` and ``most`` are the sizes of its documents.  A leaf ends one past its document's size."""

    def __init__(self, sets: list[np.ndarray]):
        self.lo, self.hi, self.at, self.to, self.kids = [], [], [], [], []
        root = self._node(0, 0)
        path = [root]
        for i, own in enumerate(sets):
            common = self._common(sets[i - 1], own) if i else 0
            last = None
            while self.to[path[-1]] > common:
                last = path.pop()
                self.hi[last] = i
                if self.to[path[-1]] >= common:
                    self.kids[path[-1]].append(last)
                    last = None
            if last is not None:
                fork = self._node(self.lo[last], common)
                self.kids[fork].append(last)
                path.append(fork)
            path.append(self._node(i, len(own) + 1))
        while path:
            self.hi[path[-1]] = len(sets)
            last = path.pop()
            if path:
                self.kids[path[-1]].append(last)
        for n, kids in enumerate(self.kids):
            for k in kids:
                self.at[k] = self.to[n]
        size = np.fromiter(map(len, sets), np.int64, len(sets))
        self.least = [int(size[a:b].min()) for a, b in zip(self.lo, self.hi)]
        self.most = [int(size[a:b].max()) for a, b in zip(self.lo, self.hi)]

    def _node(self, lo: int, to: int) -> int:
        for column, value in ((self.lo, lo), (self.hi, lo), (self.at, 0), (self.to, to), (self.kids, [])):
            column.append(value)
        return len(self.lo) - 1

    @staticmethod
    def _common(a: np.ndarray, b: np.ndarray) -> int:
        m = min(len(a), len(b))
        differ = np.flatnonzero(a[:m] != b[:m])
        return int(differ[0]) if len(differ) else m


def trie_links(ids: np.ndarray, sets: list[np.ndarray], percent: int = PERCENT, parts: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links among the documents: (document, least document of its part).

    ``parts``: labels of documents that are known to be connected.
    """
    grams, code, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(grams), np.int64)
    rank[np.lexsort((grams, -n))] = np.arange(len(grams))
    ranks, cuts = rank[code], np.cumsum([0, *map(len, sets)])
    ordered = [np.sort(ranks[a:b]) for a, b in zip(cuts, cuts[1:])]
    order = sorted(range(len(sets)), key=lambda i: ordered[i].astype(">u4").tobytes())
    ids, ordered = np.asarray(ids)[order], [ordered[i] for i in order]
    trie = Trie(ordered)
    part = np.arange(len(ids)) if parts is None else np.unique(parts, return_inverse=True)[1][order]
    member = np.zeros(len(grams), bool)
    for x, own in enumerate(ordered):
        member[own] = True
        size = len(own)
        stack = [(0, 0)]
        while stack:
            node, common = stack.pop()
            lo, hi = trie.lo[node], min(trie.hi[node], x)
            # A pair is met at the later of its documents; what is connected already needs no second link.
            if lo >= hi or (part[lo:hi] == part[x]).all():
                continue
            least, most = trie.least[node], trie.most[node]
            if 100 * min(size, most) < percent * max(size, least):
                continue
            at = trie.at[node]
            path = ordered[lo][at : trie.to[node]]
            left = size
            if len(path):
                common += int(np.count_nonzero(member[path]))
                left -= int(np.searchsorted(own, path[-1], "right"))
            # |A and B| >= percent / (100 + percent) * (|A| + |B|), for the best document below.
            if (100 + percent) * (common + max(0, min(left, most - at - len(path)))) < percent * (size + least):
                continue
            if trie.kids[node]:
                stack.extend((k, common) for k in trie.kids[node])
            elif 100 * common >= percent * (size + most - common):
                part[part == part[lo]] = part[x]
        member[own] = False
    least = {}
    for k, p in zip(ids.tolist(), part.tolist()):
        least[p] = min(k, least.get(p, k))
    return [(k, least[p]) for k, p in zip(ids.tolist(), part.tolist()) if k != least[p]]


def _join_group(percent: int):
    def run(table: pa.Table) -> pa.Table:
        ids, sets = table.column("doc_id").to_numpy(), [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        links = trie_links(ids, sets, percent, table.column("part").to_numpy()) if len(ids) > 1 else []
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return run


def _ordered_prefixes(kept: DataFrame, percent: int) -> DataFrame:
    """(doc_id, gram) of all prefixes, after frequent shingles were moved to the end of the order."""
    schema, known = "doc_id bigint, gram bigint", {}
    grams = kept.mapInArrow(_prefixes(percent), schema)
    for _ in range(ROUNDS):
        found = grams.groupBy("gram").agg(F.count("*").alias("c")).where(F.col("c") > FREQUENT).orderBy(F.desc("c"), "gram").limit(LISTED).collect()
        new = {r["gram"]: r["c"] for r in found if r["gram"] not in known}
        if not new or len(known) >= LISTED:
            break
        known |= dict(list(new.items())[: LISTED - len(known)])
        keys = np.array(list(known), np.int64).view(np.uint64)
        order = np.argsort(keys)
        shared = kept.sparkSession.sparkContext.broadcast((keys[order], np.array(list(known.values()), np.int64)[order]))
        grams = kept.mapInArrow(_prefixes(percent, shared), schema)
    return grams


def _across_blocks(links: DataFrame, split: DataFrame, sized: DataFrame, joined: Callable) -> DataFrame:
    """Links between the blocks of split groups, besides those within blocks."""

    def parted(known: DataFrame) -> DataFrame:
        part = components(known).select(F.col("node").alias("doc_id"), F.col("component").alias("part"))
        return written(split.join(part, "doc_id", "left").withColumn("part", F.coalesce("part", "doc_id")))

    now = parted(links)
    for_each = now.groupBy("hub", "own", "part").agg(F.min("doc_id").alias("doc_id"))
    # Where even those are too many for a task, the group is as mixed as can be and goes on to the pairs of blocks.
    size = for_each.join(sized.select("doc_id", "n"), "doc_id").groupBy("hub").agg(F.sum("n").alias("n"), F.count("*").alias("c"))
    few = for_each.join(size.where((F.col("n") <= GROUP_SHINGLES) & (F.col("c") > 1)).select("hub"), "hub", "left_semi")
    links = written(links.unionAll(joined(few.select("hub", F.lit(-1).alias("i"), F.lit(-1).alias("j"), "doc_id", "part"))))
    now = parted(links)
    mixed = now.groupBy("hub").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a <> b").select("hub")
    spread = now.join(mixed, "hub", "left_semi").select("hub", "doc_id", "part", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).where("own <> other")
    return links.unionAll(joined(spread.select("hub", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "doc_id", "part")))


def _classes(every: DataFrame) -> tuple[DataFrame, bool]:
    """Distinct sets: d1, d2, doc_id (the least), c (documents), maybe, node; and whether a doc_id stands for several of them.

    ``node`` names a class and has the order of doc_id: the doc_id itself, or a number where ids repeat with other texts.
    """
    found = written(every.where("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("c"), F.bool_or("maybe").alias("maybe")))
    if not found.groupBy("doc_id").count().where("count > 1").limit(1).count():
        return found.withColumn("node", F.col("doc_id")), False
    return written(found.orderBy("doc_id", "d1", "d2").withColumn("node", F.monotonically_increasing_id())), True


def _judged(known: DataFrame, percent: int) -> DataFrame:
    """One row per row of ``known`` (doc_id, text): doc_id, n, d1, d2, component_id, and head: it may stand for its component."""
    every = written(shared_enough(known, _sets_of_text, percent))
    classes, repeat = _classes(every)
    sets = known.join(classes.where("maybe").select("doc_id", "d1", "d2", "node"), "doc_id").select("node", "text", "d1", "d2").mapInArrow(_kept_sets, "doc_id bigint, shingles binary")
    links = _links(written(sets.dropDuplicates(["doc_id"]) if repeat else sets), percent)
    named = classes.join(components(links).withColumnRenamed("node", "_n"), F.col("node") == F.col("_n"), "left").withColumn("part", F.coalesce("component", "node"))
    if repeat:
        named = named.join(classes.select(F.col("node").alias("part"), F.col("doc_id").alias("least")), "part")
    else:
        named = named.withColumn("least", F.col("part"))
    head = F.when(F.col("node") == F.col("part"), F.col("doc_id"))
    named = written(named.select("d1", "d2", "c", F.col("least").alias("component_id"), head.alias("head")))
    # Classes of more copies than that are HOT at most, whatever the table: their rows meet them by broadcast, not in one task.
    many = max(100, every.count() // HOT)
    hot = F.broadcast(named.where(F.col("c") > many))
    full = every.where("n > 0")
    rows = full.join(hot, ["d1", "d2"]).unionByName(full.join(hot.select("d1", "d2"), ["d1", "d2"], "left_anti").join(named.where(F.col("c") <= many), ["d1", "d2"]))
    rows = rows.select("doc_id", "n", "d1", "d2", "component_id", F.coalesce(F.col("doc_id") == F.col("head"), F.lit(False)).alias("head"))
    return rows.unionByName(every.where("n = 0").select("doc_id", "n", "d1", "d2", F.col("doc_id").alias("component_id"), F.lit(True).alias("head")))


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) among sets of different shingles, a spanning forest of each group's."""
    again = shared_enough(sets, _sets_of_bytes, percent).where("maybe").select("doc_id")
    kept = written(sets.join(again, "doc_id", "left_semi"))
    grams = _ordered_prefixes(kept, percent)
    hubs = grams.groupBy("gram").agg(F.min("doc_id").alias("hub"), F.count("*").alias("c")).where("c > 1")
    pairs = written(grams.join(hubs, "gram").select("hub", "doc_id").distinct())
    sized = kept.select("doc_id", "shingles", F.expr("octet_length(shingles) div 8").alias("n"))
    blocks = pairs.join(sized.select("doc_id", "n"), "doc_id").groupBy("hub").agg(F.expr(f"CAST(ceil(sum(n) / {GROUP_SHINGLES}) AS int)").alias("blocks"))
    own = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    dealt = written(pairs.join(blocks, "hub").select("hub", "doc_id", "blocks", own.alias("own")))

    def joined(groups: DataFrame) -> DataFrame:
        """Links within the groups of (hub, i, j, doc_id, part)."""
        return groups.join(sized.select("doc_id", "shingles"), "doc_id").groupBy("hub", "i", "j").applyInArrow(_join_group(percent), "a bigint, b bigint")

    links = written(joined(dealt.select("hub", F.col("own").alias("i"), F.col("own").alias("j"), "doc_id", F.col("doc_id").alias("part"))))
    split = dealt.where("blocks > 1")
    return _across_blocks(links, split, sized, joined) if split.limit(1).count() else links


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    result = _judged(docs.where("doc_id IS NOT NULL"), percent).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    lost = docs.where("doc_id IS NULL").mapInArrow(_only_sizes, "doc_id bigint, n_shingles bigint, component_id bigint")
    return result.unionAll(lost)


def _only_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = pa.array([len(s) for _, s in shingle_sets(batch.column("text"), WORDS)], pa.int64())
        none = pa.nulls(len(n), pa.int64())
        yield pa.RecordBatch.from_arrays([none, n, none], names=["doc_id", "n_shingles", "component_id"])


def _with_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [set_digest(s) for _, s in shingle_sets(batch.column("text"), WORDS)]
        yield pa.RecordBatch.from_arrays([batch.column("row"), *(pa.array([x[k] for x in found], pa.int64()) for k in (0, 1))], names=["row", "d1", "d2"])


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each component, its least; all columns as they were, rows with a null id are kept.

    Where a doc_id repeats, rows are told apart by their sets: texts that differ are documents of their own, and of rows of
    equal id and set the one of the least digest over all columns stays.
    """
    small_batches(docs.sparkSession)
    columns = docs.columns
    own = docs.where("doc_id IS NOT NULL")
    judged = written(_judged(own.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), percent))
    if not judged.groupBy("doc_id").count().where("count > 1").limit(1).count():
        return docs.join(judged.where("NOT head").select("doc_id"), "doc_id", "left_anti").select(*columns)
    every = F.struct(*(F.col(f"`{c}`") for c in columns))
    digests = own.select(F.struct(every.alias("x")).alias("row"), "text")
    marked = digests.mapInArrow(_with_digests, T.StructType([digests.schema["row"], T.StructField("d1", T.LongType()), T.StructField("d2", T.LongType())]))
    heads = judged.where("head").select(F.col("doc_id").alias("_id"), "d1", "d2").distinct()
    kept = marked.withColumn("_id", F.col("row.x.doc_id").cast("bigint")).join(heads, ["_id", "d1", "d2"], "left_semi")
    one = kept.groupBy("_id", "d1", "d2").agg(F.min_by("row", F.sha2(F.to_json("row"), 256)).alias("row"))
    return one.select("row.x.*").unionByName(docs.where("doc_id IS NULL")).select(*columns)
