"""URL filters by a sort-merge range join of reversed-host keys with nested rules, in DataFrame functions only.

The labels of a host are reversed and each is closed by ``/``, which no host can hold: ``www.example.com`` becomes
``com/example/www/``.  A rule's host key is then a prefix of the keys of its host and all subdomains.  A rule is an interval
in two steps: of all keys that start with its host key, and among these of all paths that start with its path.  At each depth
(number of labels) a url has one key that a rule's host key can equal, its own first labels; so at each depth rules and urls
are sorted together by that key and the path, and intervals are nested or disjoint.

The sweep's stack of active rules is carried by the rule passed last: a rule brings the chain of rules of its host whose paths
it starts with (found by a join of path prefixes, so a chain is as long as the nesting, not as the rules of a host).  Of the
chain of the last rule with the url's key, those whose path the url's path starts with are the rules of that depth that fit.
Over all depths the longest one decides (by host and path together, then by host).

Sweeps run per salt: urls are dealt evenly over salts by a hash of their id and key, whatever their host, and the rules are
repeated for each salt.  So a hot host or domain never meets in one task, and all depths share one shuffle.  Rules that would
be more than ``REPEATED`` rows that way are dealt over fewer salts, with the same result.

Defined cases: null or malformed urls have empty host and path and match nothing; repeated rows each get a verdict;
of equal rules, block wins over allow; rules with a null or empty host or a path that does not start with ``/`` are
refused; urls of any length are judged whole; further columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, shuffle_width

REPEATED = 100_000_000


def url_host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """``b.a`` as ``a/b/``: subdomains follow their domain and start with its key."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "/"), F.lit("/")))


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """Verdict per row of ``pages``: id, host, path, rule, verdict.  ``rules``: (verdict, host, path)."""
    spark = pages.sparkSession
    clean = rules.select("verdict", ascii_lower(F.col("host")).alias("host"), "path").distinct()
    size = clean.agg(
        F.count("*").alias("n"),
        F.max(F.size(F.split("host", r"\."))).alias("depth"),
        F.count_if(F.coalesce(F.col("host"), F.lit("")).isin("") | ~F.coalesce(F.col("path"), F.lit("")).startswith("/") | F.col("verdict").isNull()).alias("bad"),
    ).first()
    if size["bad"]:
        raise ValueError("a rule needs a verdict, a host and a path that starts with '/'")
    salts, depth = max(1, min(shuffle_width(spark), REPEATED // max(1, size["n"]))), size["depth"] or 1
    # Of equal rules 'block' is the greater string and stays.
    kept = clean.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    prefix = F.explode(F.transform(F.sequence(F.lit(1), F.length("path")), lambda n: F.substring("path", F.lit(1), n)))
    within = kept.select("host", "path", prefix.alias("start")).join(kept.select("host", F.col("path").alias("start"), F.col("verdict").alias("v")), ["host", "start"])
    chains = within.groupBy("host", "path").agg(F.array_sort(F.collect_list(F.struct(F.length("start").alias("n"), F.col("start").alias("path"), F.col("v").alias("verdict"), F.concat("host", "start").alias("rule")))).alias("chain"))
    events = chains.select(
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), host_key(F.col("host")).alias("key"), F.col("path"), F.lit(0).alias("kind"), F.size(F.split("host", r"\.")).alias("labels"), "chain"
    )
    urls = pages.select(F.col(id_col).alias("page_id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path")).select(
        F.pmod(F.xxhash64("page_id", "host", "path"), F.lit(salts)).cast("int").alias("salt"), host_key(F.col("host")).alias("key"), F.lit(1).alias("kind"), "page_id", "host", "path"
    )
    swept = events.unionByName(urls, allowMissingColumns=True)
    fits = []
    for d in range(1, depth + 1):
        # The key that a rule of d labels must have: the first d labels of the url's; keys with fewer labels are shorter.
        swept = swept.withColumn(f"key{d}", F.concat(F.substring_index("key", "/", d), F.lit("/")))
        sweep = Window.partitionBy("salt").orderBy(f"key{d}", "path", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        opened = F.struct(F.col("key").alias("open"), "chain")
        swept = swept.withColumn(f"at{d}", F.last(F.when((F.col("kind") == 0) & (F.col("labels") == d), opened), ignorenulls=True).over(sweep))
        active = F.filter(F.col(f"at{d}.chain"), lambda r: F.col("path").startswith(r["path"]))
        fits.append(F.when((F.col(f"at{d}.open") == F.col(f"key{d}")) & (F.size(active) > 0), F.element_at(active, -1)))
    # Depths are in order, so of equally long rules the last has the longer host.
    best = F.aggregate(F.filter(F.array(*fits), lambda r: r.isNotNull()), fits[0] if depth == 1 else F.coalesce(*fits), lambda a, r: F.when(F.length(r["rule"]) >= F.length(a["rule"]), r).otherwise(a))
    return swept.where("kind = 1").select("page_id", "host", "path", best.alias("best")).select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
