"""Registry of queries and of their SQL, and the projections that stand in for survey tables.

A projection is defined once as a DataFrame and once as a DuckDB CTE.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.basics import ordered_list
from ..session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, *views: str, recursive: bool = False):
    """Registers a query by its function's name; ``views``: the CTEs that its SQL reads."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            body = sql.strip()
            # A body that starts with '+' goes on with views of its own.
            head, body = [VIEWS[v] for v in views], body.removeprefix("+")
            joint = ", " if head and sql.strip().startswith("+") else " "
            lead = f"WITH {'RECURSIVE ' * recursive}" if head or sql.strip().startswith("+") else ""
            ORACLES[f.__name__] = lead + ", ".join(head) + joint + body
        return f

    return add


VIEWS = {
    "pq": """pq AS (SELECT doc_id % 150 AS participant_id, CASE lang WHEN 'es' THEN 'Other' ELSE lang END AS topic,
        CASE source WHEN 'src0' THEN 'Other' ELSE source END AS opinion, text AS quote, doc_id AS ord FROM documents)""",
    "pv": "pv AS (SELECT user_id AS participant_id, event_type AS proposition, value > 20 AS approved FROM events)",
    "pm": "pm AS (SELECT * FROM (SELECT participant_id, proposition, avg(CASE WHEN approved THEN 1.0 ELSE 0.0 END) AS approved FROM pv GROUP BY ALL))",
    "pvs": """pvs AS (SELECT o_custkey AS participant_id, p_brand AS proposition, l_returnflag <> 'R' AS approved
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)""",
    "pb": """pb AS (SELECT user_id AS ballot, event_type AS candidate, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS pos
        FROM events GROUP BY user_id, event_type)""",
    "pb25": """pb25 AS (SELECT o_custkey AS ballot, p_brand AS candidate, row_number() OVER (PARTITION BY o_custkey ORDER BY sum(l_quantity) DESC, p_brand) AS pos
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY o_custkey, p_brand)""",
    "pd": """pd AS (SELECT c_custkey AS participant_id, c_mktsegment AS segment, n_name AS nation, c_custkey AS ord FROM customer JOIN nation ON c_nationkey = n_nationkey)""",
    "pdl": """pdl AS (SELECT participant_id, 'Segment' AS label, segment AS value FROM pd UNION ALL SELECT participant_id, 'Nation', nation FROM pd)""",
    "ps": """turns AS (SELECT * FROM conversations WHERE role <> 'system'),
        ps AS (SELECT conv_id, turn, text AS question, next AS answer FROM (SELECT *, lead(text) OVER w AS next, lead(role) OVER w AS next_role FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'user' AND next_role = 'assistant')""",
    "tagged": """tagged AS (SELECT conv_id, string_agg('<question>' || question || '</question>' || chr(10) || '<response>' || answer || '</response>', chr(10) || chr(10) ORDER BY turn) AS survey_text FROM ps GROUP BY conv_id)""",
    "pmod": """pmod AS (SELECT d.doc_id AS row_id, d.n_chars AS duration, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))""",
    "pw": """pw AS (SELECT o_custkey AS participant_id, o_orderpriority AS priority, count(*) AS n FROM orders GROUP BY ALL)""",
}


def pq(spark: SparkSession, d: str) -> DataFrame:
    """Categorised quotes: the whole texts."""
    return table(spark, d, "documents").select(
        (F.col("doc_id") % 150).alias("participant_id"),
        F.when(F.col("lang") == "es", "Other").otherwise(F.col("lang")).alias("topic"),
        F.when(F.col("source") == "src0", "Other").otherwise(F.col("source")).alias("opinion"),
        F.col("text").alias("quote"),
        F.col("doc_id").alias("ord"),
    )


def pv(spark: SparkSession, d: str) -> DataFrame:
    """Votes, repeated ones too."""
    return table(spark, d, "events").select(F.col("user_id").alias("participant_id"), F.col("event_type").alias("proposition"), (F.col("value") > 20).alias("approved"))


def _sales(spark: SparkSession, d: str, *more: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag", *more)
    joined = lines.join(table(spark, d, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.join(table(spark, d, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))


def pvs(spark: SparkSession, d: str) -> DataFrame:
    """Sparse votes over 25 propositions."""
    return _sales(spark, d).select(F.col("o_custkey").alias("participant_id"), F.col("p_brand").alias("proposition"), (F.col("l_returnflag") != "R").alias("approved"))


def _ranked(counts: DataFrame) -> DataFrame:
    return counts.groupBy("ballot").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "candidate"))), lambda x: x["candidate"]).alias("ranking"))


def pb(spark: SparkSession, d: str) -> DataFrame:
    """Ballots over five candidates."""
    return _ranked(table(spark, d, "events").groupBy(F.col("user_id").alias("ballot"), F.col("event_type").alias("candidate")).agg(F.count("*").alias("n")))


def pb25(spark: SparkSession, d: str) -> DataFrame:
    """Ballots over 25 candidates, of different lengths."""
    return _ranked(_sales(spark, d).groupBy(F.col("o_custkey").alias("ballot"), F.col("p_brand").alias("candidate")).agg(F.sum("l_quantity").alias("n")))


def pd(spark: SparkSession, d: str) -> DataFrame:
    """Participants with demographics."""
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("participant_id"), F.col("c_mktsegment").alias("demo:Segment"), F.col("n_name").alias("demo:Nation"), F.col("c_custkey").alias("ord"))


def ps(spark: SparkSession, d: str) -> DataFrame:
    """Question and answer pairs of conversations."""
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn")
    turns = table(spark, d, "conversations").where("role <> 'system'")
    paired = turns.withColumn("answer", F.lead("text").over(w)).withColumn("_r", F.lead("role").over(w))
    return paired.where("role = 'user' AND _r = 'assistant'").select("conv_id", "turn", F.col("text").alias("question"), "answer")


def tagged(spark: SparkSession, d: str) -> DataFrame:
    """One tagged survey text a conversation."""
    pair = F.concat(F.lit("<question>"), "question", F.lit("</question>\n<response>"), "answer", F.lit("</response>"))
    return ps(spark, d).groupBy("conv_id").agg(F.array_join(ordered_list(pair, "turn"), "\n\n").alias("survey_text"))


def pmod(spark: SparkSession, d: str) -> DataFrame:
    """Rows to moderate."""
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    return docs.join(labels, "doc_id", "left").select(F.col("doc_id").alias("row_id"), F.col("n_chars").alias("duration"), "quality", "toxic")


def pw(spark: SparkSession, d: str) -> DataFrame:
    """Wide ranked sets: each customer's priorities ranked by their number of orders, topics inside the texts."""
    names = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    wide = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("participant_id")).pivot("o_orderpriority", names).agg(F.count(F.lit(1)))
    columns = {}
    for i, n in enumerate(names, 1):
        columns |= {f"ranking_1_q_{i}": F.lit(f"Topic: \nPriority - {n}"), f"ranking_1_a_{i}": (-F.col(f"`{n}`")).cast("string")}
    return wide.select("participant_id", F.col("participant_id").alias("ord"), *(c.alias(k) for k, c in columns.items()))


def digest_share(column: str) -> Column:
    """A number in [0, 1) from a text's digest: the deterministic stand-in for model scores."""
    return F.conv(F.substring(F.md5(F.col(column).cast("binary")), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def digest_share_sql(column: str) -> str:
    return f"(concat('0x', substr(md5({column}), 1, 8))::UBIGINT / 4294967296.0)"
