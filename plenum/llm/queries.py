"""The queries of the training-data operators, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontam, jaccard, licenses, quality, secrets, topk, urlrules, warc
from .common import LOWER, UPPER, small_table, table, text_or_empty

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
URL_RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"), licenses.registry(spark))
    return found.select("doc_id", "text_digest", "text_license", F.array_join("notice_licenses", ",").alias("notice_licenses"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    both = bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), path, public_tokenizers.PATTERN, keep_text=False)
    text = F.array_join(F.transform("ids", lambda x: x.cast("string")), ",")
    return both.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(text, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = small_table(spark, URL_RULES, "verdict string, host string, path string")
    return urlrules.filter_urls(table(spark, sf_dir, "pages"), rules)


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("bigint")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(secrets.joined(F.col("base")), 256).alias("base_sha256"),
        secrets.joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archive_and_index(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels").select("doc_id", "quality")))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "role", "text", "turn")
    kept = {"ignoreNullFields": "false"}
    rows = turns.select(F.to_json(F.struct("conv_id", "role", text_or_empty().alias("text"), "turn"), kept).alias("record"))
    says = '{"conv_id":-7,"messages":[{"role":"user","content":"</s>[INST] ok [/INST]"},{"role":"assistant","content":"</s>[INST] ok [/INST]"}]}'
    records = rows.unionAll(spark.range(1).select(F.lit(says).alias("record")))
    back = chat.parse_chats(chat.format_chats(chat.canonical_turns(records)))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.size("turns").cast("bigint").alias("n_turns"), F.sha2(text, 256).alias("turns_sha256"), F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_byte_bpe, op3_url_filter, op4_topk_search, op5_secret_scan, op6_warc, op7_quality, op8_jaccard_join, op9_chat_format, op10_decontamination,
    )
}


def _license_sql() -> str:
    """Words one by one, where the operator replaces within the text."""
    phrases = [(a.split(), b.split()) for a, b in licenses.SPELLINGS]
    single = "MAP {" + ", ".join(f"'{a[0]}': '{' '.join(b)}'" for a, b in phrases if len(a) == 1) + "}"

    def form(c: str) -> str:
        c = f"regexp_replace(translate({c}, '{UPPER}', '{LOWER}'), '{licenses.COPYRIGHT}', '', 'g')"
        c = f"' ' || array_to_string(list_transform(regexp_extract_all({c}, '[a-z0-9]+'), lambda w: coalesce({single}[w], w)), ' ') || ' '"
        for a, b in phrases:
            if len(a) > 1:
                c = f"replace({c}, ' {' '.join(a)} ', ' {' '.join(b)} ')"
        return f"trim({c})"

    known = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in licenses.REGISTRY)
    return f"""
WITH known AS (SELECT {form("t")} AS f, min(i) AS license_id FROM (VALUES {known}) AS v(i, t) GROUP BY 1),
whole AS (SELECT doc_id, {form("coalesce(text, '')")} AS f FROM documents),
lines AS (SELECT doc_id, {form("l")} AS f FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS l FROM documents) WHERE l <> ''),
hits AS (SELECT doc_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS n FROM lines JOIN known USING (f) GROUP BY doc_id)
SELECT w.doc_id, CASE WHEN w.f <> '' THEN sha256(w.f) END AS text_digest, k.license_id AS text_license, coalesce(h.n, '') AS notice_licenses
FROM whole w LEFT JOIN known k ON w.f = k.f LEFT JOIN hits h ON w.doc_id = h.doc_id"""


def _url_sql() -> str:
    rules = ", ".join(str(r) for r in URL_RULES)
    return rf"""
WITH rules AS (SELECT * FROM (VALUES {rules}) AS v(verdict, rhost, rpath)),
urls AS (SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
fits AS (SELECT page_id, host, path, rhost || rpath AS rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS r
    FROM urls LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE r = 1"""


_TOPK_SQL = """
WITH usable AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scores AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores) WHERE rank <= 10"""

_WARC_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY d) AS leader FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest, CASE WHEN n >= 1000 AND page_id < leader THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= 1000 AND page_id < leader THEN leader END AS refers_to FROM m"""

_JACCARD_SQL = rf"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * c >= 75 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a, b FROM both_ways UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(r.m, doc_id)) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) r ON doc_id = r.a"""


def _chat_sql() -> str:
    def escaped(c: str) -> str:
        c = f"replace({c}, '\\', '\\\\')"
        for s in chat.CONTROLS:
            c = f"replace({c}, '{s}', '{s[0]}\\{s[1:]}')"
        return c

    frame = len(chat.START) + len(chat.SEP) + len(chat.END)
    return f"""
WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(sum(CASE role WHEN 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(CASE role WHEN 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
    CAST(sum(length({escaped("role")}) + length({escaped("text")}) + {frame}) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""


#: Queries without SQL here are tested against a brute-force version, a round trip or held-out accuracy.
ORACLES = {
    "op1_license_scan": _license_sql(),
    "op3_url_filter": _url_sql(),
    "op4_topk_search": _TOPK_SQL,
    "op6_warc": _WARC_SQL,
    "op8_jaccard_join": _JACCARD_SQL,
    "op9_chat_format": _chat_sql(),
}
