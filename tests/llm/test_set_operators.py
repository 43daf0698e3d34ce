"""Jaccard join, components, top-k search, WARC archives and the pipeline: contracts, brute force, defined cases."""

import hashlib
import itertools
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from plenum.llm import decontam, graph, jaccard, quality, queries, topk, warc
from test_text_operators import base_spans, brute_force_leaks

SF = "/root/testdata/sf0.001"
DOC = "doc_id bigint, text string"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_force_components(rows):
    """(doc_id, set size, component) of rows with different ids."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            parent[max(find(a), find(b))] = min(find(a), find(b))
    return {(i, len(s), find(i)) for i, s in sets.items()}


def near_copies(rng, n):
    """Families of texts with a word changed here and there, passages in common, exact copies, short texts."""
    words = [f"w{i}" for i in range(300)]
    passage = rng.choices(words, k=30)
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.5 and rows:
            w = rng.choice(rows)[1].split()
            for _ in range(rng.randint(0, 3)):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(words)
        else:
            w = rng.choices(words, k=rng.choice([1, 3, 5, 6, 20, 60])) + (passage if kind > 0.8 else [])
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_jaccard_as_brute_force(spark, seed, monkeypatch):
    rows = near_copies(random.Random(seed), 150)
    if seed == 2:  # several portions, groups in several blocks
        monkeypatch.setattr(jaccard, "PORTION", 300)
        monkeypatch.setattr(jaccard, "GROUP_SHINGLES", 150)
    if seed == 3:  # nearly all shared shingles are frequent, few of them listed
        monkeypatch.setattr(jaccard, "FREQUENT", 1)
        monkeypatch.setattr(jaccard, "LISTED", 50)
    got = {tuple(r) for r in jaccard.jaccard_components(spark.createDataFrame(rows, DOC).repartition(3)).collect()}
    assert got == brute_force_components(rows)


def test_jaccard_cases(spark):
    text = " ".join(f"word{i}" for i in range(40))
    long = " ".join(f"v{i}" for i in range(20_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  b"), (6, text), (7, text + " tail"), (7, text + " tail"), (None, text), (8, long), (9, long + " end"), (10, "the end")]
    df = spark.createDataFrame(rows, DOC).withColumn("n", F.lit(1)).withColumn("component_id", F.lit("own"))
    got = sorted((tuple(r) for r in jaccard.jaccard_components(df).collect()), key=str)
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 36, 6), (7, 37, 6), (7, 37, 6), (None, 36, None), (8, 19_996, 8), (9, 19_997, 8), (10, 1, 10)], key=str)
    left = jaccard.one_of_each(df)
    assert left.columns == df.columns and sorted((r["doc_id"] for r in left.collect()), key=str) == sorted([1, 2, 3, 4, 6, None, 8, 10], key=str)
    assert jaccard.jaccard_components(df.limit(0)).count() == 0 and jaccard.one_of_each(df.limit(0)).count() == 0


def test_jaccard_with_a_text_of_a_million_words(spark):
    huge = " ".join(f"{i:x}" for i in range(1_200_000))
    rows = [(1, huge), (2, huge + " tail"), (3, "a few other words of a short text"), (4, None), (5, "a few other words of a short text")]
    got = {tuple(r) for r in jaccard.jaccard_components(spark.createDataFrame(rows, DOC).repartition(2)).collect()}
    assert got == {(1, 1_199_996, 1), (2, 1_199_997, 1), (3, 4, 3), (4, 0, 4), (5, 4, 3)}


def test_ids_that_repeat_with_other_texts(spark, monkeypatch):
    t, u = " ".join(f"word{i}" for i in range(40)), " ".join(f"other{i}" for i in range(30))
    rows = [(6, t, 1), (7, t + " tail", 2), (7, u, 3), (7, u, 4), (7, "", 5), (8, u, 6), (9, u + " end", 7), (10, t.upper(), 8), (None, t, 9), (11, "", 10)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, mark int").withColumn("row", F.lit("own")).withColumn("d1", F.lit(0)).withColumn("m", F.create_map(F.lit("a"), "mark"))
    got = sorted((tuple(r) for r in jaccard.jaccard_components(df).collect()), key=str)
    assert got == sorted([(6, 36, 6), (7, 37, 6), (7, 26, 7), (7, 26, 7), (7, 0, 7), (8, 26, 7), (9, 27, 7), (10, 36, 6), (None, 36, None), (11, 0, 11)], key=str)
    left = jaccard.one_of_each(df)
    assert left.columns == df.columns
    kept = {(r["doc_id"], r["text"]) for r in left.collect()}
    assert kept == {(6, t), (7, u), (7, ""), (None, t), (11, "")} and left.count() == 5
    # Without repeated ids, and with every class of copies met by broadcast.
    plain = df.where("mark NOT IN (2, 4, 5)")
    assert {(r["doc_id"], r["text"]) for r in jaccard.one_of_each(plain).collect()} == {(6, t), (7, u), (None, t), (11, "")}


def test_hot_copies(spark):
    rng = random.Random(9)
    base = near_copies(rng, 60)
    rows = [(1_000 + i, base[3][1]) for i in range(250)] + [(2_000 + i, "") for i in range(150)] + [(3_000 + i, "x y z") for i in range(120)] + base
    got = {tuple(r) for r in jaccard.jaccard_components(spark.createDataFrame(rows, DOC).repartition(4)).collect()}
    assert got == brute_force_components(rows)


def test_threshold_is_met_exactly(spark):
    # 7 shingles in common of 9 or 10: 77.8 and 70 per cent; 6 of 8: exactly 75.
    base = [f"s{i}" for i in range(11)]
    rows = [(1, " ".join(base)), (2, " ".join(base[1:] + ["x"])), (3, " ".join(["p", *base[:-1], "q"]))]
    sets = {i: shingles(t) for i, t in rows}
    links = {(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(spark.createDataFrame(rows, DOC)).collect()}
    assert links and got == {i: c for i, _, c in brute_force_components(rows)}


def test_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(40)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(40)] + [(200, i) for i in range(201, 260)] + [(300, 300)]
    parent = {x: x for ab in links for x in ab}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame([*links, (None, 1)], "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in parent}
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- top-k ------------------------------------------------------------------------------------------------------------


def brute_force_topk(rows, k=10, every=100):
    ints = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            ints.setdefault(i, []).append([int(np.floor(1024.0 * x)) for x in v])
    out = set()
    for q, vectors in ints.items():
        if q % every == 0:
            for own in vectors:
                scores = sorted({(-sum(a * b for a, b in zip(own, v)), i, tuple(v)) for i, vs in ints.items() if i != q for v in vs})
                out |= {(q, r, i, -s) for r, (s, i, _) in enumerate(scores[:k], 1)}
    return out


@pytest.mark.parametrize("scale", [1.0, 3e5])
def test_topk_as_brute_force(spark, scale):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6) * scale]) for i in range(700)]
    rows += [(700 + i, rows[5][1]) for i in range(60)] + [(800, rows[5][1]), (900, [0.0] * 6)] + [(1000 + i, rows[7][1][:3]) for i in range(3)]
    rows += [(2000, None), (2001, [1.0, None]), (2100, [float("nan")] * 6), (2002, [float("inf")] * 6), (None, [1.0]), (2200, [])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("v", F.lit(1)).withColumn("object", F.lit(2))
    got = {tuple(r) for r in topk.search(df, F.col("vec_id") % 100 == 0, block=4).collect()}
    assert got == brute_force_topk(rows)


def test_topk_with_ties_and_what_tasks_send(spark):
    """Every score of a query ties; a task sends on its best ``k`` objects a query and no more."""
    rows = [(i, [0.0, 0.0]) if i in (0, 100) else (i, [float(i % 7), 1.0 + i]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(5)
    assert {tuple(r) for r in topk.search(df, F.col("vec_id") % 100 == 0).collect()} == brute_force_topk(rows)
    best = topk._Best(3)
    rng = np.random.default_rng(0)
    every = [(q, int(rng.integers(4)), i) for i in range(300) for q in range(5)]
    for k in range(0, len(every), 100):
        q, s, i = zip(*every[k : k + 100])
        best.add(np.array(q), np.array(s), np.array(i), [[x] for x in i])
        assert len(best.q) <= 15
    assert sorted(zip(best.q.tolist(), (-best.total).tolist(), best.least.tolist())) == [x for q in range(5) for x in sorted((q, -s, i) for p, s, i in every if p == q)[:3]]


def test_topk_cases(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id bigint, embedding array<float>")
    assert {tuple(r) for r in topk.search(df, F.col("vec_id") == 0).collect()} == {(0, 1, 1, 1024 * 2048)}
    assert topk.search(df.limit(0), F.lit(True)).count() == 0 and topk.search(df.limit(1), F.lit(True)).count() == 0


# --- WARC -------------------------------------------------------------------------------------------------------------


def test_warc_round_trip_and_order(spark, tmp_path):
    nasty = "é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 40
    rows = [
        (1, "http://a.com/x", None), (2, None, ""), (3, "http://b.a.com/\r\ny", "x" * 1000), (4, "http://a.com/x", "x" * 1000), (5, "http://A.com/x?q#f", "x" * 999), (6, "no scheme", "x" * 999),
        (7, "http://a.com", nasty), (8, "http://a.com", nasty + "\r\n"), (9, "http://z.org", nasty), (4, "http://a.com/x", "x" * 1000), (None, "u://n/", "x" * 1000), (10, "http://big", "<p>y</p>" * 50_000),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit("own")).withColumn("leader", F.lit(1))
    path = str(tmp_path / "warc")
    warc.write_archives(pages.repartition(2), path)
    index = warc.capture_index(warc.read_archives(spark, path))
    got = [tuple(r) for r in index.collect()]
    want = []
    for i, u, h in rows:
        raw = (h or "").encode()
        same = [j for j, _, x in rows if x == h and j is not None]
        leader = max(same) if len(raw) >= 1000 and i is not None else i
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "response" if leader == i else "revisit", None if leader == i else leader))
    assert sorted(((r[2], *r[4:]) for r in got), key=str) == sorted(want, key=str)
    keys = [(r[0], r[1], r[2] or 0) for r in got]
    assert keys == sorted(keys)
    assert warc.url_key("http://WWW.a.com?q=1#f") == "com,a,www)?q=1" and warc.url_key("http://a.com") == "com,a)/"
    empty = str(tmp_path / "empty")
    warc.write_archives(pages.limit(0), empty)
    assert warc.capture_index(warc.read_archives(spark, empty)).count() == 0


def test_records_reject_what_is_cut_off():
    with pytest.raises(ValueError, match="ends within"):
        list(warc.records(iter([b"WARC/1.1\r\nContent-Length: 10", b"abc"])))
    with pytest.raises(ValueError, match="no WARC record"):
        list(warc.records(iter([b"HTTP/1.1 200", b"abc"])))


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree(k):
    rng = random.Random(k)
    runs = [sorted(rng.randrange(30) for _ in range(rng.randint(0, 12))) for _ in range(k)]
    assert list(warc.LoserTree([iter(r) for r in runs], lambda x: x)) == sorted(x for r in runs for x in r)


# --- pipeline ---------------------------------------------------------------------------------------------------------


def test_pipeline_as_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    table = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.train(table, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {r["doc_id"]: r["score"] for r in quality.score(table, model).collect()}
    kept = [(i, t) for i, t in docs if scores[i] >= quality.THRESHOLD]
    assert all(labels.get(i) != 1 or scores[i] >= quality.THRESHOLD for i, _ in docs)
    groups = defaultdict(list)
    for i, _, c in brute_force_components(kept):
        groups[c].append(i)
    stay = {min(g) for g in groups.values()}
    kept = [(i, t) for i, t in kept if i in stay]
    leaks = {d for d, _ in brute_force_leaks(kept, items)}
    kept = dict(x for x in kept if x[0] not in leaks)
    assert rows.keys() == kept.keys() and all(r["round_trip"] for r in rows.values())
    from plenum.llm import bpe
    import public_tokenizers

    ranks = {v: k for k, v in bpe.read_ranks(public_tokenizers.path(queries.VOCABULARY)).items()}
    for i, t in kept.items():
        out = b"".join(ranks[x] for x in rows[i]["ids"]).decode()
        assert base_spans(out) == "" and (out == t or "[SECRET]" in out)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name
    assert decontam.find_leaks(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).columns == ["doc_id", "item_id", "coverage", "run"]


def test_stages_over_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    some = docs.limit(12).collect()
    texts = [r["text"] for r in some]
    extra = [(900_001, None), (900_002, ""), (900_003, " \n"), (900_004, texts[0]), (900_004, texts[0]), (900_004, "other words entirely, of one more short text"), (None, texts[1]), (900_005, "long words " * 30_000)]
    rows = [(r["doc_id"], r["text"]) for r in some] + extra
    odd = spark.createDataFrame(rows, DOC).select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("bigint").alias("n_chars"))
    odd = odd.withColumn("score", F.lit(1)).withColumn("base", F.lit("own")).withColumn("d1", F.lit(2)).withColumn("row", F.array(F.lit(3)))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, SF)
        kept = [(r["doc_id"], r["text"]) for r in out.collect()]
        assert out.columns == odd.columns and {i for i, _ in kept} <= {i for i, _ in rows}, name
        assert stage(spark, odd.limit(0), SF).count() == 0, name
        if name == "n-gram Jaccard join":
            assert sorted(kept, key=str) == sorted({x for x in rows if x != (900_004, texts[0])}, key=str)
        if name == "secret scans":
            assert len(kept) == len(rows)
    coded = corpus_pipeline.STAGES[-1][1](spark, odd, SF).collect()
    assert len(coded) == len(rows) and all(r["round_trip"] for r in coded)
