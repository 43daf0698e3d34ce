"""Sources, survey intake, ballots, statements: the documented cases."""

import pytest
from pyspark.sql import functions as F

from plenum.functions import codecs
from plenum.functions import text as T
from plenum.operators import ballots as B
from plenum.operators import basics, batching, intake, statements
from plenum.sources import sinks, tables


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'array<string>' if isinstance(v, list) else 'double'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


def export(tmp_path, header, questions, *rows):
    import csv

    path = tmp_path / "export.csv"
    with path.open("w", newline="") as f:
        csv.writer(f).writerows([header, questions, [""] * len(header), *rows])
    return str(path)


def test_round_1_export(spark, tmp_path):
    header = ["Finished", "Status", "Q1", "Q1FU", "Q2", "Q2FU", "Q3", "Q3FU", "Q1FU_Text", "Q2FU_Text", "Q3FU_Text", "rid", intake.DURATION]
    questions = ["", "", "Q1 text\nmore", "Q1 follow up text", "Q2 text", "Q2 follow up text", "Q3 text", "Q3 follow up text", "Q1 follow up text", "Q2 follow up text", "Q3 follow up text", "", ""]
    row = ["True", "IP Address", "Ans1", "Q1 follow up text", "Ans3", "Q2 follow up text", "Ans5", "Q3 follow up text", "Ans2", "Ans4", "Ans6", "resp1", "123"]
    path = export(tmp_path, header, questions, row, [*row[:1], "Survey Preview", *row[2:]], ["False", *row[1:]])
    df, texts = tables.read_export(spark, path)
    kept = intake.finished(intake.with_respondent_ids(df))
    out = intake.round_1_texts(kept, texts, intake.interleaved(intake.ROUND_1["questions"], intake.ROUND_1["follow_ups"])).collect()
    assert len(out) == 1 and out[0]["participant_id"] == "resp1"
    assert out[0]["survey_text"].startswith("<question>Q1 text</question>\n<response>Ans1</response>\n\n<question>Q1 follow up text</question>\n<response>Ans2</response>")
    assert out[0]["response_text"] == "\n\n".join(f"Response {i}: Ans{i}" for i in range(1, 7))
    many = intake.round_1_texts(kept, texts, ["Q1"], one_line=False).first()["survey_text"]
    assert many.startswith("<question>Q1 text\nmore</question>")
    assert intake.round_1_texts(kept.withColumn("Q1", F.lit(None).cast("string")), texts, ["Q1"], nan=True).first()["response_text"] == "Response 1: nan"


def test_round_2_columns(spark):
    questions = {"question_1": "Topic: T1\n\nOpinion: O1\n\n“Quote 1”\n\nHow would you respond to this quote?", "ranking_1_q_1": "Rank Q1", "ranking_1_q_c": "Rank Comment Q1"}
    df = spark.createDataFrame([("p", "Answer 1", "3", "Rank Comment A1")], "participant_id string, question_1 string, ranking_1_q_1 string, ranking_1_q_c string")
    r = intake.round_2_columns(df, questions, ["question_1"], ["ranking_1_q_1"], ["ranking_1_q_c"]).first()
    assert r["response_text"] == "GOV Response:\nAnswer 1\n\nRanking Response:\nRank Comment A1"
    assert (r["answer_1"], r["question_1"], r["question_1_topic"], r["question_1_opinion"]) == ("Answer 1", "Quote 1", "T1", "O1")
    assert (r["ranking_1_a_1"], r["ranking_1_q_1"], r["ranking_1_a_c"], r["ranking_1_q_c"]) == (3, "Rank Q1", "Rank Comment A1", "Rank Comment Q1")


@pytest.mark.parametrize(("rows", "schema", "want"), [
    ([(0, "fallback_id")], "ord bigint, rdud string", ["fallback_id"]), ([(0, "x")], "ord bigint, y string", ["1"]), ([(0, "a", None), (1, None, "b")], "ord bigint, rid string, rdud string", ["a", "b"]),
    ([(0, "a"), (1, ""), (2, "c")], "ord bigint, rid string", ["1", "2", "3"]),
])
def test_respondent_ids(spark, rows, schema, want):
    assert [r["participant_id"] for r in intake.with_respondent_ids(spark.createDataFrame(rows, schema)).orderBy("ord").collect()] == want


def test_sources_and_sinks(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('Topic,Topic,"Quo,te"\na,b,"x ""y""\nz"\n,c,\n')
    df = tables.read_csv_text(spark, str(path))
    assert df.columns == ["topic", "topic_1", "quo,te", "ord"] and df.orderBy("ord").first()[:3] == ("a", "b", 'x "y"\nz')
    assert tables.header(spark, str(path)) == ["Topic", "Topic_1", "Quo,te"]
    with pytest.raises(ValueError, match="no column nope"):
        tables.read_csv(spark, str(path), ["nope"])
    assert sinks.ordered_columns(spark.createDataFrame([(1, 2, 3)], "z int, opinion int, b int")).columns == ["opinion", "b", "z"]
    assert one(spark, tables.topics_argument(F.col("s")), s=" a, ,b ") == ["a", "b"]
    names, rows = tables.sheet_values('{"values": [["a", "a"], ["1"]]}')
    assert (names, rows) == (["a", "a_1"], [["1", ""]])
    nested = spark.createDataFrame([("t", "o", [("p1",)]), ("t", "n", [])], "topic string, opinion string, propositions array<struct<proposition:string>>")
    assert {r["proposition"] for r in sinks.flat_propositions(nested).collect()} == {"p1", "No propositions found for this opinion."}
    with pytest.raises(ValueError, match="1 rows were skipped"):
        sinks.abort_with_skipped(spark.createDataFrame([("x",)], "a string"), str(tmp_path / "skipped"))
    for kind in ("csv", "jsonl", "text", "parquet"):
        sinks.write_result(spark.range(5), str(tmp_path / kind), kind, 2)
    assert spark.read.parquet(str(tmp_path / "parquet")).count() == 2
    assert tables.additional_context("a") == "a" and tables.additional_context(default="d") == "d"
    with pytest.raises(ValueError):
        tables.additional_context("a", "b")


def test_text_functions(spark):
    assert one(spark, T.joined_responses(F.col("t")), t="<response>Hello</response> <response>World!</response>") == "Hello. World!"
    assert one(spark, T.joined_responses(F.col("t")), t="no tags") == "no tags"
    assert one(spark, T.joined_responses(F.col("t")), t="<response></response><response>a\nb</response>") == "a\nb."
    assert one(spark, T.prompt_item(F.col("t")), t="I <3 you. <quote>q</quote> <unallowed> A&B") == "<item>I &lt;3 you. <quote>q</quote> &lt;unallowed&gt; A&amp;B</item>"
    assert one(spark, T.prompt("Do", F.array().cast("array<string>")), t="") == "<instructions>\nDo\n</instructions>\n\n<data>\n\n</data>"
    assert one(spark, T.without_brackets(F.col("t")), t="[a quote with brackets] and [...] some [s---]") == "a quote with brackets and ... some s---"
    assert [one(spark, T.is_numeric(F.col("t")), t=x) for x in ("1", " 2.5e3 ", "inf", "1d", "1_0", "", None, "x")] == [True, True, True, False, False, False, False, False]
    assert one(spark, T.slug(F.col("t"), 5), t="Ça va? Über 3 mots et plus") == "cavauber3mots" and one(spark, T.slug(F.col("t")), t="!!") == "item"
    assert one(spark, T.clean_markdown(F.col("t")), t="**a** *b*") == "<strong>a</strong> <em>b</em>" and one(spark, T.without_header(F.col("t")), t="## T") == "T"
    assert one(spark, T.labelled_parts(F.col("t")), t="A:\nx\n\nplain\n\nB:\ny:\nz") == ["x", "y:\nz"]
    assert one(spark, T.ranking_topic(F.col("t")), t="Topic: \nFree speech - say") == "Free speech" and one(spark, T.without_ranking_topic(F.col("t")), t="Topic: \nFree speech - say it") == "say it"
    assert (one(spark, T.seconds_of(F.col("t")), t="18s"), one(spark, T.pretty_seconds(F.col("x")), x=3723.9)) == (18.0, "1h 2m 3s")
    assert one(spark, T.sheet_id(F.col("t")), t="https://docs/spreadsheets/d/AbC-1_2/edit#gid=77") == "AbC-1_2" and one(spark, T.sheet_gid(F.col("t")), t="https://x#gid=77") == "77"
    assert one(spark, T.interpolated(F.col("t"), {"a": F.lit(1)}), t="{a}-{b}") == "1-{b}" and one(spark, T.percent_value(F.col("t")), t="63.0%") == 63.0
    assert one(spark, T.single_line_responses(F.col("t")), t="<question>q</question>\n<response>a\nb</response><question>q</question><response>c</response>") == ["c"]


def test_codecs(spark):
    tree = one(spark, codecs.parse_topics(F.col("t")), t="B:y;A; B:x ;B:y;;C:z:w")
    assert [(t["name"], t["subtopics"]) for t in tree] == [("A", []), ("B", ["x", "y"]), ("C", ["z:w"])]
    assert one(spark, codecs.concat_topics(codecs.parse_topics(F.col("t"))), t="B:y;A;B:x") == "A;B:x;B:y"
    deep = one(spark, codecs.parse_topics_deep(F.col("t")), t="Topic A:Subtopic A.1:Theme X;Topic A:Subtopic A.1:Theme Y;Topic C")
    assert [(t["name"], [(s["name"], [x["name"] for x in s["subtopics"]]) for s in t["subtopics"]]) for t in deep] == [("Topic A", [("Subtopic A.1", ["Theme X", "Theme Y"])]), ("Topic C", [])]
    assert [t["name"] for t in one(spark, codecs.parse_topics_deep(F.col("t")), t="Topic A:;Topic B::ThemeY;Topic C")] == ["Topic A", "Topic B", "Topic C"]
    assert one(spark, codecs.lettered(F.col("a")), a=["s1", "s2"]) == {"A": "s1", "B": "s2"}
    with pytest.raises(Exception, match="more than 52"):
        one(spark, codecs.lettered(F.col("a")), a=[str(i) for i in range(53)])
    assert [(r["key"], r["text"]) for r in one(spark, codecs.reusable(F.col("a")), a=["x", "y", "x", "z", "y"])] == [("A", "x"), ("B", "y")]
    assert one(spark, codecs.parse_score(F.col("t")), t='Text {"score": 3, "explanation": "x"}') == 3.0 and one(spark, codecs.parse_score(F.col("t")), t="none") == 0.0
    letters = codecs.lettered(F.array(F.lit("a"), F.lit("b")))
    assert one(spark, codecs.parse_ranking(F.col("t"), letters), t='{"ranking": ["B"]}') is None and one(spark, codecs.parse_ranking(F.col("t"), letters, True), t='{"ranking": ["B", "Z"]}') == ["b"]
    assert one(spark, codecs.parse_votes(F.col("t"), letters, F.array(F.lit("Agree"))), t='{"votes": [{"statement_letter": "A", "vote": "Agree"}]}') is None
    assert [p["statement"] for p in one(spark, codecs.parse_propositions(F.col("t")), t='```json\n["a", " ", "b"]\n```')] == ["a", "b"]
    assert [tuple(p) for p in one(spark, codecs.parse_propositions(F.col("t")), t='[{"statement": "a", "reasoning": "r"}]')] == [("a", "r")] and one(spark, codecs.parse_propositions(F.col("t")), t="bad") == []
    assert one(spark, codecs.first_id(F.col("t")), t="I choose 3:14, not 1:1") == "3:14"
    valid = F.array(F.lit("Climate change"), F.lit("Taxes"))
    assert [one(spark, codecs.repaired_label(F.col("t"), valid), t=x) for x in ("Taxes", " taxes", "Climate changes", "Sports", "Other", None)] == ["Taxes", "Taxes", "Climate change", None, "Other", None]


def test_wide_ballots(spark):
    rows = [("p1", "1", "2", "x", "1"), ("p2", "2", "1", None, "1")]
    df = spark.createDataFrame(rows, "participant_id string, ranking_1_a_1 string, ranking_1_a_2 string, ranking_1_a_c string, ranking_2_a_1 string")
    for c, v in {"ranking_1_topic": "Topic 1", "ranking_1_q_1": "A", "ranking_1_q_2": "B", "ranking_1_q_c": "why?", "ranking_2_topic": "Topic 2", "ranking_2_q_1": "C"}.items():
        df = df.withColumn(c, F.lit(v))
    assert not B.is_processed(df.columns) and B.set_numbers(df.columns) == [1, 2]
    assert {tuple(r) for r in B.ballots(df).select("participant_id", "topic", F.array_join("ranking", "")).collect()} == {("p1", "Topic 1", "AB"), ("p2", "Topic 1", "BA"), ("p1", "Topic 2", "C"), ("p2", "Topic 2", "C")}
    assert B.ballots(df.limit(1), least=2).count() == 0
    record = B.participant_record(df.where("participant_id = 'p2'").withColumns({"question_1": F.lit("Q"), "answer_1": F.lit("A1"), "survey_text": F.lit("first")})).first()["record"]
    assert record.startswith("first\n\n<question>Q</question>\n<response>A1</response>\n\n<ranking topic=\"Topic 1\">\n1. B\n2. A\n</ranking>")


def test_agreement_is_written_back(spark):
    df = spark.createDataFrame([(1, "T", "a", None), (2, "T", "b", "c")], "participant_id bigint, question_1_topic string, answer_1 string, answer_2 string").withColumns({"question_1": F.lit("q"), "question_2": F.lit("q"), "question_2_opinion": F.lit("O")})
    asked = B.agreement_questions(df)
    assert {(r["participant_id"], r["n"], r["about"]) for r in asked.collect()} == {(1, 1, "T"), (2, 1, "T"), (2, 2, "O")}
    scores = spark.createDataFrame([(1, 1, 4.0), (2, 1, 1.5), (2, 2, 2.5)], "participant_id bigint, n int, score double").select("participant_id", "n", B.agreement(F.col("score")).alias("agrees"))
    assert {tuple(r) for r in B.written_back(df, scores).select("participant_id", "answer_1_agrees", "answer_2_agrees").collect()} == {(1, True, None), (2, False, None)}
    assert [one(spark, B.agreement(F.col("s")), s=x) for x in (3.1, 1.9, 2.0, 2.5, 3.0)] == [True, False, None, None, None]


def test_statements(spark):
    schema = "id string, text string, quotes array<struct<id:string,text:string,topic:struct<name:string,subtopics:array<struct<name:string>>>>>"
    df = spark.createDataFrame([("s", "t", [("s-T", "[a quote with brackets] and [...] some [s---]", ("T", [("A",), ("B",)]))])], schema)
    assert {(r["opinion"], r["quote"]) for r in statements.per_opinion(df).collect()} == {("A", "a quote with brackets and ... some s---"), ("B", "a quote with brackets and ... some s---")}
    assert statements.per_quote(df).first()["quote_with_brackets"].startswith("[a quote")
    with pytest.raises(Exception, match="no quotes in statement"):
        statements.per_opinion(df.withColumn("quotes", F.array().cast(df.schema["quotes"].dataType))).collect()
    kept, skipped = statements.split_oversized(df, 3)
    assert (kept.count(), skipped.count()) == (0, 1)
    records = spark.createDataFrame([("1", ["taxes"]), ("2", []), ("3", ["nonsense"]), ("9", ["Taxes"])], "id string, topics array<string>")
    sent = spark.createDataFrame([(str(i),) for i in range(1, 5)], "id string")
    good, again = statements.checked_records(records, sent, ["Taxes"])
    assert {(r["id"], *r["topics"]) for r in good.collect()} == {("1", "Taxes")} and {r["id"] for r in again.collect()} == {"2", "3", "4"}


def test_basics(spark):
    rows = spark.createDataFrame([(i * 3, i % 2) for i in range(20)], "ord bigint, k int")
    assert [r["n"] for r in basics.numbered_rows(rows, "n", chunk=7).orderBy("ord").collect()] == list(range(1, 21))
    a, b = spark.createDataFrame([(1, "x", None), (2, None, "y")], "k int, p string, q string"), spark.createDataFrame([(1, "z", "w"), (3, "v", None)], "k int, p string, q string")
    assert {tuple(r) for r in basics.coalesced([a, b], "k").collect()} == {(1, "x", "w"), (2, None, "y"), (3, "v", None)}
    with pytest.raises(ValueError, match="repeats on the right"):
        basics.validated_one_to_one(a, b.unionAll(b), "k")
    scores = spark.createDataFrame([(1.0, float("nan"), None), (None, None, None)], "a double, b double, c double")
    assert [tuple(r) for r in scores.select(basics.row_mean("abc"), basics.row_max("abc")).collect()] == [(1.0, 1.0), (None, None)]
    assert basics.drop_all_null(scores.na.fill(0, ["a"]).withColumn("a", F.col("a")), ["c"]).count() == 0


def test_batches(spark):
    texts = spark.createDataFrame([(i, "text") for i in range(100)], "ord bigint, text string")
    sizes = [r["count"] for r in batching.token_batches(texts, most=10).groupBy("batch").count().collect()]
    assert sizes == [10] * 10
    assert batching.token_batches(texts.limit(10), tokens=10, most=50).select("batch").distinct().count() == 10
    assert batching.token_batches(spark.createDataFrame([(0, "x" * 999)], "ord bigint, text string"), tokens=10, base=100).collect()[0]["batch"]["n"] == 0
    people = spark.range(100).withColumnRenamed("id", "participant_id")
    assert [batching.sampled(people, s).count() for s in (None, 1.0, 0.5, 10, 150)] == [100, 100, 50, 10, 100]
    for bad in (0, -5):
        with pytest.raises(ValueError):
            batching.sampled(people, bad)
    assert batching.sampled(people, 10).collect() == batching.sampled(people, 10).collect()
    opinions = spark.createDataFrame([("t", "a", 0), ("t", "b", 0)], "topic string, opinion string, size int")
    assert sum(r["allocations"] for r in batching.allocated(opinions, 9).collect()) == 9
    jobs = batching.jury_jobs(people.limit(2), ["a", "b", "c"], 2).collect()
    assert len(jobs) == 4 and {tuple(sorted(j["statements"])) for j in jobs} == {("a", "b"), ("c",)}
