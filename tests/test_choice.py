"""Social choice, de-duplication, report and evaluation operators: golden cases and properties."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plenum.operators import dedup, evals, report, social_choice, world

ELECTION = {"ACBED": 5, "ADECB": 5, "BEDAC": 8, "CABED": 3, "CAEBD": 7, "CBADE": 2, "DCEBA": 7, "EBADC": 8}
APPROVES = {"P1": "123", "P2": "12", "P3": "456", "P4": "347", "P5": "6"}


def ballots(spark, rankings):
    return spark.createDataFrame([(list(r),) for r in rankings], "ranking array<string>")


def votes(spark, approves):
    return spark.createDataFrame([(f"v{v}", p, True) for p, vs in approves.items() for v in vs], "participant_id string, proposition string, approved boolean")


def test_golden_election(spark):
    df = ballots(spark, [b for b, n in ELECTION.items() for _ in range(n)])
    rows = {r["candidate"]: r for r in social_choice.schulze(df).collect()}
    assert sorted(rows, key=lambda c: rows[c]["rank"]) == list("EACBD")
    assert {c: r["wins"] for c, r in rows.items()} == {"E": 4, "A": 3, "C": 2, "B": 1, "D": 0}
    assert (rows["E"]["strength"], rows["A"]["strength"], rows["D"]["strength"]) == (5, 11, None)
    assert [r["candidate"] for r in social_choice.schulze(df, k=2).orderBy("rank").collect()] == ["E", "A"]


def test_groups_are_apart(spark):
    df = spark.createDataFrame([("x", ["A", "B"]), ("x", ["A", "B"]), ("y", ["B", "A"]), ("z", ["C"])], "topic string, ranking array<string>")
    assert {(r["topic"], r["candidate"], r["rank"]) for r in social_choice.schulze(df, ["topic"]).collect()} == {("x", "A", 1), ("x", "B", 2), ("y", "B", 1), ("y", "A", 2), ("z", "C", 1)}
    assert social_choice.schulze(df.limit(0), ["topic"]).count() == 0


def by_hand(rankings):
    names = sorted({c for r in rankings for c in r})
    d = {(a, b): 0 for a in names for b in names}
    for r in rankings:
        for i, a in enumerate(r):
            for b in r[i + 1 :]:
                d[a, b] += 1
    p = {(a, b): 0 if a == b else d[a, b] - d[b, a] for a in names for b in names}
    for k in names:
        for i in names:
            for j in names:
                if len({i, j, k}) == 3:
                    p[i, j] = max(p[i, j], min(p[i, k], p[k, j]))
    wins = {a: sum(p[a, b] > p[b, a] for b in names if b != a) for a in names}
    return sorted(names, key=lambda c: (wins[c], c), reverse=True)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.permutations("ABCDE").map(lambda p: "".join(p)[: 2 + ord(p[0]) % 4]), min_size=1, max_size=12))
def test_any_order_of_ballots(spark, rankings):
    got = lambda r: [x["candidate"] for x in social_choice.schulze(ballots(spark, r)).orderBy("rank").collect()]
    assert got(rankings) == got(rankings[::-1]) == by_hand(rankings)


def test_proportional_slates(spark):
    df, names = votes(spark, APPROVES), list(APPROVES)
    assert [p for p, _ in social_choice.pav_slate(df, names, 3)] == ["P1", "P3", "P4"]
    assert [p for p, _ in social_choice.pav_slate(df, names, 3, ["P4"])] == ["P4", "P1", "P3"]
    slates = [[p for p, _ in social_choice.pav_slate(df, names, k)] for k in range(1, 6)]
    assert all(b[:-1] == a for a, b in zip(slates, slates[1:]))
    profiles = social_choice._profiles(df)
    score = lambda slate: {r["proposition"]: r["score"] for r in social_choice.pav_scores(profiles, slate).collect()}
    assert (score([])["P1"], score([])["P4"], score(["P1"])["P2"]) == (3.0, 3.0, 1.0)
    # A winner that nobody voted on starts the slate without approval.
    assert social_choice.schulze_pav(ballots(spark, ["XA"]), df, ["X", *names], 2) == [("X", 0.0), ("P1", 3.0)]
    assert [p for p, _ in social_choice.pav_slate(df.limit(0), ["A", "B"], 2)] == ["A", "B"]


def test_greedy_representation(spark):
    df = votes(spark, {"A": "123", "B": "23", "C": "16", "D": "45"})
    assert [p for p, _ in social_choice.greedy_representation(df, list("ABCD"), 3)] == ["A", "D", "C"]
    assert [p for p, _ in social_choice.greedy_representation(votes(spark, {"Other": "123", "B": "1"}), ["Other", "B"], 3)] == ["B"]


def test_approvals(spark):
    df = spark.createDataFrame([("p2", "Prop1", True), ("p2", "Prop2", False), ("p3", "Prop1", False), ("p3", "Prop2", True), ("p3", "Prop2", False), ("p1", "Prop1", None)], "participant_id string, proposition string, approved boolean")
    assert {tuple(r) for r in social_choice.approval_matrix(df, ["Prop1", "Prop2"]).collect()} == {("p2", 1.0, 0.0), ("p3", 0.0, 0.5)}
    assert {tuple(r) for r in social_choice.approval_rates(df).collect()} == {("Prop1", 0.5), ("Prop2", 0.25)}


def test_draft(spark):
    rows = [("A", 0, f"0:{i}", p, i + 1) for i, p in enumerate(["a1_dup", "a2", "a3"])] + [("B", 1, f"1:{i}", p, i + 1) for i, p in enumerate(["b1", "b2_dup", "b3"])]
    df = spark.createDataFrame(rows, "topic string, topic_id int, proposition_id string, proposition string, rank int")
    sets = spark.createDataFrame([("s", ["0:0", "1:1"]), ("alone", ["1:2"])], "set_id string, members array<string>")
    got = dedup.rank_filling(df, sets, 2)
    assert {r["proposition"] for r in got.where("selected").collect()} == {"a1_dup", "a2", "b1", "b3"} and {r["proposition"] for r in got.where("duplicate").collect()} == {"a1_dup", "b2_dup"}
    assert {r["proposition"] for r in dedup.winning_topics(df, sets, 2).where("selected").collect()} == {"a1_dup", "a2", "b1", "b3"}
    assert dedup.has_selected(got) and not dedup.has_selected(got.where("NOT selected"))
    assert dedup.ranking_column(["full_schulze_ranking", "full_pav_ranking"]) == "full_pav_ranking"
    with pytest.raises(ValueError):
        dedup.ranking_column([])
    clash = dedup.draft([{"topic": t, "topic_id": i, "proposition_id": f"{i}:0", "rank": 1, "set_id": "s"} for i, t in enumerate("AB")], 1, judge=lambda g: max(x["proposition_id"] for x in g))
    assert [(r["topic"], r["selected"], r["duplicate"]) for r in clash] == [("A", False, True), ("B", True, True)]


def test_similar_sets_as_brute_force(spark):
    import random

    rng = random.Random(2)
    words = [f"w{i}" for i in range(40)]
    rows = [("0:0", "lower the taxes now"), ("1:0", "Lower the taxes now!"), ("1:1", "more parks"), ("9:9", "..."), *((f"hot:{i}", "one same text of many words that a hundred and more propositions share") for i in range(120))]
    while len(rows) < 220:
        w = rng.choice(rows)[1].split() if rng.random() < 0.6 else rng.choices(words, k=rng.randint(5, 30))
        if rng.random() < 0.7:
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((f"x:{len(rows)}", " ".join(w)))

    def grams(t):
        w = "".join(c if c.isalnum() else " " for c in t.lower()).split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = {i: grams(t) for i, t in rows}
    like = lambda a, b: bool(sets[a]) and len(sets[a] & sets[b]) >= 0.75 * len(sets[a] | sets[b])
    first = {i: min(j for j in sets if sets[j] == sets[i]) for i in sets}
    want = {i: sorted(j for j in sets if like(i, j) and first[j] >= i) for i in sets if sets[i] and first[i] == i}
    got = {r["set_id"]: r["members"] for r in dedup.similar_sets(spark.createDataFrame(rows, "proposition_id string, proposition string")).collect()}
    assert got == {i: m for i, m in want.items() if len(m) > 1} and max(map(len, got.values())) >= 120


def test_overlaps_as_brute_force():
    import random

    import numpy as np

    from plenum.operators import similar

    rng = random.Random(5)
    # Half of each list is from few values, which are counted by products, half from many, which are counted by lists.
    lists = [np.array(sorted({rng.randrange(40) for _ in range(rng.randint(0, 30))} | {rng.randrange(100, 9000) for _ in range(rng.randint(0, 90))}), np.int64) for _ in range(90)]
    left, right = np.arange(0, 50), np.arange(30, 90)
    want = [[len(set(lists[a]) & set(lists[b])) for b in right] for a in left]
    assert similar.overlaps(lists, left, right).tolist() == want
    assert similar.overlaps(lists, left, right[:0]).shape == (50, 0)


def test_similar_sets_in_blocks(spark, monkeypatch):
    """A family of near copies whose group is split, met by several n-grams, with copies of some and one frequent passage."""
    import random

    from plenum.operators import similar

    monkeypatch.setattr(similar, "BLOCK_CLASSES", 7)
    monkeypatch.setattr(similar, "FREQUENT", 3)
    monkeypatch.setattr(similar, "HOT", 1)
    rng = random.Random(7)
    base, passage = [f"b{i}" for i in range(60)], [f"p{i}" for i in range(12)]
    rows = []
    for i in range(150):
        w = base[:]
        for _ in range(i % 3):
            w[rng.randrange(60)] = f"x{i}"
        rows.append((f"n:{i:03}", " ".join(w)))
    rows += [(f"p:{i:03}", " ".join([f"y{i}-{k}" for k in range(30)] + passage)) for i in range(40)] + [("", "..."), ("z", "")]

    def grams(t):
        w = "".join(c if c.isalnum() else " " for c in t.lower()).split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    for least in (0.75, 0.55):
        sets = {i: grams(t) for i, t in rows}
        first = {i: min(j for j in sets if sets[j] == sets[i]) for i in sets}
        like = lambda a, b: bool(sets[a]) and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= least
        want = {i: sorted(j for j in sets if like(i, j) and first[j] >= i) for i in sets if sets[i] and first[i] == i}
        got = {r["set_id"]: r["members"] for r in dedup.similar_sets(spark.createDataFrame(rows, "proposition_id string, proposition string"), least).collect()}
        assert got == {i: m for i, m in want.items() if len(m) > 1} and len(got) > 40


def test_similar_sets_of_long_texts(spark):
    """Texts are split in words once, not once for each of their n-grams."""
    import time

    words = [f"word{i}" for i in range(40_000)]
    rows = [("0:0", " ".join(words)), ("0:1", " ".join(["other", *words[1:]])), ("0:2", " ".join(words[:20_000])), ("0:3", " ".join(reversed(words)))]
    began = time.monotonic()
    got = dedup.similar_sets(spark.createDataFrame(rows, "proposition_id string, proposition string")).collect()
    assert [(r["set_id"], r["members"]) for r in got] == [("0:0", ["0:0", "0:1"])]
    assert time.monotonic() - began < 60


def test_topic_tree_text(spark):
    rows = [(1, "Topic 1", "Opinion 1.1", "Quote 1.1", 0), (1, "Topic 1", "Opinion 1.2", "Quote 1.1", 1), (2, "Topic 1", "Opinion 1.2", "Quote 1.2", 2), (3, "Other", "x", "q", 3)]
    df = spark.createDataFrame(rows, "participant_id bigint, topic string, opinion string, quote string, ord bigint")
    assert report.topic_tree_text(df).first()["text"] == "1. Topic 1 (2 quotes)\n  1. Opinion 1.2 (2 quotes)\n  2. Opinion 1.1 (1 quotes)\n\nTotal number of unique opinions: 2"
    assert sum(r["opinion_quotes"] for r in report.topic_tree(df).collect()) == 3
    assert '"overview":"o"' in report.report_json(report.hierarchy(df), "o").first()["json"]
    assert report.excluded(df, opinions=["Opinion 1.2"]).count() == 2


def test_samples_prefer_unseen_people():
    rows = [{"ord": i, "opinion": o, "participant_id": p, "quote": f"q{i}", "score": s, "place": "ab".index(o)} for i, (o, p, s) in enumerate([("a", 1, 0.1), ("a", 2, 0.9), ("b", 2, 0.8), ("b", 3, 0.2), ("b", 2, 0.7)])]
    # Each round takes one of every opinion, the best score first, people that were not seen before others.
    assert [r["ord"] for r in report.spread(rows, 1, set())] == [1, 3]
    assert [r["ord"] for r in report.spread(rows, 2, set())] == [1, 3, 0, 2]
    assert [r["ord"] for r in report.spread(rows, 9, set())] == [1, 3, 0, 2, 4]
    assert [r["ord"] for r in report.spread(rows, 1, {2, 3})] == [0, 2]


def brute_force_samples(rows, k):
    """The draft over all quotes: topics with more people first, opinions by number with Other last, best scores first."""
    import collections

    topics = collections.defaultdict(list)
    for r in rows:
        topics[r["topic"]].append(r)
    people = lambda own: len({r["participant_id"] for r in own if r["quote"].strip()})
    seen, out = set(), []
    for name, own in sorted(topics.items(), key=lambda x: (-people(x[1]), x[0])):
        number = collections.Counter(r["opinion"] for r in own)
        opinions = sorted(number, key=lambda o: (o == "Other", -number[o], min(r["ord"] for r in own if r["opinion"] == o)))
        picked = []
        for _ in range(k):
            for o in opinions:
                possible = sorted((r for r in own if r["opinion"] == o), key=lambda r: (-r["score"], r["ord"]))
                here = {r["participant_id"] for r in picked}
                for allowed in (lambda r: r["participant_id"] not in seen | here, lambda r: r["participant_id"] not in here, lambda r: r["ord"] not in {x["ord"] for x in picked}):
                    found = next(filter(allowed, possible), None)
                    if found:
                        picked.append(found)
                        seen.add(found["participant_id"])
                        break
        out += [(name, r["opinion"], r["participant_id"], r["quote"], i) for i, r in enumerate(picked, 1)]
    return out


def test_topic_samples_as_brute_force(spark):
    import random

    rng = random.Random(6)
    rows = [{"ord": i, "topic": rng.choice("xyz"), "opinion": rng.choice(["a", "b", "c", "Other"]), "participant_id": rng.choice([1, 2, 3, i % 9, i]), "quote": f"q{i}", "score": rng.randint(0, 9) / 10} for i in range(400)]
    rows += [{"ord": 1_000 + i, "topic": "hot", "opinion": "one", "participant_id": 1, "quote": f"h{i}", "score": 1.0} for i in range(80)]
    df = spark.createDataFrame(rows, "ord bigint, topic string, opinion string, participant_id bigint, quote string, score double")
    for k in (1, 4):
        got = [tuple(r) for r in report.topic_samples(df.drop("score").join(df.select("ord", F.col("score").alias("bridging")), "ord"), k, F.col("bridging")).collect()]
        assert got == brute_force_samples(rows, k)


def test_summaries(spark):
    rows = spark.createDataFrame([("T", "O")], "topic string, opinion string")
    s = spark.createDataFrame([("T", "O", "text")], "topic string, opinion string, summary string")
    assert report.single_summary(rows, s).first()["summary"] == "text"
    for bad in (s.unionAll(s), s.limit(0)):
        with pytest.raises(Exception, match="not one summary"):
            report.single_summary(rows, bad).collect()


def test_evaluation(spark):
    df = spark.createDataFrame([("4", 1), ("n/a", 2), ("3.5", 3)], "score string, n int")
    assert [r["verdict"] for r in evals.judged(df).orderBy("n").collect()] == ["passed", "errored", "failed"]
    nested = spark.createDataFrame([(1, (2, 3))], "a int, metadata struct<a:int,b:int>")
    assert evals.flattened(nested).columns == ["a", "input_a", "b"]
    p = spark.createDataFrame([("T", "O", "p", 9.0)], "topic string, opinion string, proposition string, topic_score double")
    t, o = spark.createDataFrame([("T", "p", 1.0)], "topic string, proposition string, score double"), spark.createDataFrame([("T", "O", "p", 2.0)], "topic string, opinion string, proposition string, score double")
    assert evals.proposition_scores(p, t, o).first().asDict() == {"topic": "T", "opinion": "O", "proposition": "p", "opinion_score": 2.0, "topic_score": 1.0}
    assert [r["valid"] for r in evals.valid_topics(spark.createDataFrame([([("a",), ("b",)],), ([("a",), ("a",)],), ([],)], "topics array<struct<name:string>>")).collect()] == [True, False, False]
    assert "<answer>O</answer>" in evals.judge_prompts(spark.createDataFrame([("T", "O")], "topic string, response string"), evals.METRICS["opinion_quality"]).first()["prompt"]


def test_named_queries(spark):
    jobs = spark.createDataFrame([("t", "ok", 2.0, "abc", 5), ("t", "error", 4.0, "d", 1)], "topic string, status string, seconds double, prompt string, tokens bigint")
    assert world.run_statistics(jobs).first().asDict() == {"topic": "t", "jobs": 2, "failed": 1, "failed_percent": 50.0, "seconds_a_job": 3.0, "characters": 4, "tokens": 6}
    tries = spark.createDataFrame([("topic", "t", 1, [(0, "bad")]), ("topic", "t", 2, [])], "level string, topic string, participant_id int, failed_tries array<struct<attempt_index:int,error_message:string>>")
    assert [r["error_message"] for r in world.failed_tries(tries).collect()] == ["bad"]
    assert world.nested(spark.sql("SELECT named_struct('b', 5) AS a"), "a.b").first()["b"] == 5
    assert world.simulation_results(tries, "combined").columns == ["level", "participant_id", "failed_tries"]
    rate = world.rate_error(F.lit(0.63), F.lit(0.5))
    assert spark.range(1).select(rate.alias("x")).first()["x"] == "13.0%"
