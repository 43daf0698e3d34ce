"""Codecs: topic strings, letters for statements, replies of models as structs."""

from __future__ import annotations

import string

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

LETTERS = string.ascii_uppercase + string.ascii_lowercase
_TREE = "array<struct<name:string,subtopics:array<string>>>"


def _entries(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, ";"), lambda x: F.trim(x)), lambda x: x != "")


def _head(x: Column) -> Column:
    return F.trim(F.split_part(x, F.lit(":"), F.lit(1)))


def _tail(x: Column) -> Column:
    return F.trim(F.when(F.instr(x, ":") > 0, F.substring(x, F.instr(x, ":") + 1, F.length(x))).otherwise(""))


def parse_topics(c: Column) -> Column:
    """``T1:O1;T2`` as topics with opinions, both sorted and without repeats, split at the first colon."""
    entries = _entries(c)
    names = F.array_sort(F.array_distinct(F.filter(F.transform(entries, _head), lambda x: x != "")))
    of = lambda n: F.array_sort(F.array_distinct(F.filter(F.transform(F.filter(entries, lambda e: _head(e) == n), _tail), lambda x: x != "")))
    return F.transform(names, lambda n: F.struct(n.alias("name"), of(n).alias("subtopics"))).cast(_TREE)


def concat_topics(c: Column) -> Column:
    """Topics as ``T1:O1;T2``."""
    one = lambda t: F.when(F.size(t["subtopics"]) > 0, F.transform(t["subtopics"], lambda o: F.concat(t["name"], F.lit(":"), o))).otherwise(F.array(t["name"]))
    return F.array_join(F.flatten(F.transform(c, one)), ";")


def parse_topics_deep(c: Column) -> Column:
    """``topic:subtopic:theme`` entries as three levels in order of appearance."""
    entries = _entries(c)
    level = lambda e, k: F.trim(F.split_part(e, F.lit(":"), F.lit(k)))
    distinct = lambda a: F.array_distinct(F.filter(a, lambda x: x != ""))

    def themes(t: Column, s: Column) -> Column:
        own = F.filter(entries, lambda e: (level(e, 1) == t) & (level(e, 2) == s))
        return F.transform(distinct(F.transform(own, lambda e: level(e, 3))), lambda x: F.struct(x.alias("name")))

    def subtopics(t: Column) -> Column:
        own = distinct(F.transform(F.filter(entries, lambda e: level(e, 1) == t), lambda e: level(e, 2)))
        return F.transform(own, lambda s: F.struct(s.alias("name"), themes(t, s).alias("subtopics")))

    return F.transform(distinct(F.transform(entries, lambda e: level(e, 1))), lambda t: F.struct(t.alias("name"), subtopics(t).alias("subtopics")))


def lettered(statements: Column) -> Column:
    """Map of letters to statements; more than 52 are refused."""
    n = F.size(statements)
    letters = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring(F.lit(LETTERS), i, F.lit(1)))
    built = F.map_from_arrays(F.slice(letters, F.lit(1), n), statements)
    return F.when(n <= len(LETTERS), built).otherwise(F.raise_error(F.lit(f"more than {len(LETTERS)} statements")).cast("map<string,string>"))


def reusable(texts: Column, letters: bool = True) -> Column:
    """Texts that occur more than once, in order, as (key, text) with letters or numbers as keys."""
    repeated = F.filter(F.array_distinct(texts), lambda x: F.size(F.filter(texts, lambda y: y == x)) > 1)
    key = lambda i: F.substring(F.lit(LETTERS), i + 1, F.lit(1)) if letters else (i + 1).cast("string")
    return F.transform(repeated, lambda x, i: F.struct(key(i).alias("key"), x.alias("text")))


def json_part(c: Column) -> Column:
    """The JSON of a reply: from its first bracket on, without a closing fence."""
    return F.regexp_replace(F.regexp_extract(c, r"(?s)[\[{].*", 0), r"(?s)\s*```\s*$", "")


def parse_reply(c: Column, schema: str) -> Column:
    """A reply as a struct or array; null where it is no JSON of that schema."""
    return F.from_json(json_part(c), schema, {"mode": "PERMISSIVE"})


def parse_score(c: Column, default: float = 0.0) -> Column:
    """The score of a judge's reply."""
    return F.coalesce(F.try_variant_get(F.try_parse_json(json_part(c)), "$.score", "double"), F.lit(default))


def parse_ranking(c: Column, letters: Column, last_attempt: bool = False) -> Column:
    """Statements in the order of a reply's letters (F23): null unless all are there, but partial on the last attempt."""
    found = F.array_distinct(F.filter(F.transform(parse_reply(c, "ranking ARRAY<STRING>")["ranking"], lambda x: F.try_element_at(letters, F.trim(x))), lambda x: x.isNotNull()))
    return found if last_attempt else F.when(F.size(found) == F.size(F.map_keys(letters)), found)


def parse_votes(c: Column, letters: Column, positive: Column) -> Column:
    """Map of statements to approval (F24); null unless every statement has one vote.  ``positive``: array of votes that approve."""
    votes = parse_reply(c, "votes ARRAY<STRUCT<statement_letter: STRING, vote: STRING>>")["votes"]
    known = F.filter(votes, lambda v: F.map_contains_key(letters, F.trim(v["statement_letter"])))
    distinct = F.array_distinct(F.transform(known, lambda v: F.trim(v["statement_letter"])))
    entries = F.transform(known, lambda v: F.struct(F.element_at(letters, F.trim(v["statement_letter"])), F.array_contains(positive, F.trim(v["vote"]))))
    whole = (F.size(distinct) == F.size(F.map_keys(letters))) & (F.size(known) == F.size(distinct))
    return F.when(whole, F.map_from_entries(entries))


def parse_propositions(c: Column) -> Column:
    """A reply's propositions, as strings or as (statement, reasoning); a bad reply has none."""
    part = json_part(c)
    plain = F.transform(F.from_json(part, "array<string>"), lambda s: F.struct(s.alias("statement"), F.lit(None).cast("string").alias("reasoning")))
    full = F.from_json(part, "array<struct<statement:string,reasoning:string>>")
    good = F.filter(F.when(F.rlike(part, F.lit(r"^\[\s*\{")), full).otherwise(plain), lambda x: F.coalesce(F.trim(x["statement"]) != "", F.lit(False)))
    return F.coalesce(good, F.array().cast("array<struct<statement:string,reasoning:string>>"))


def numbered_lines(c: Column) -> Column:
    """Lines that start with a number and a full stop, without those."""
    lines = F.filter(F.split(c, "\n"), lambda x: F.rlike(x, F.lit(r"^\s*\d+\.\s*\S")))
    return F.transform(lines, lambda x: F.trim(F.regexp_replace(x, r"^\s*\d+\.\s*", "")))


def first_id(c: Column) -> Column:
    """The first ``topic:index`` of a reply."""
    return F.nullif(F.regexp_extract(c, r"(\d+:\d+)", 1), F.lit(""))


@F.pandas_udf(StringType())
def _closest(labels: pd.Series, valid: pd.Series) -> pd.Series:
    from difflib import SequenceMatcher

    def best(label: str | None, names) -> str | None:
        if label is None or names is None:
            return None
        scored = [(SequenceMatcher(None, label.lower().strip(), n.lower().strip()).ratio(), -i, n) for i, n in enumerate(names)]
        top = max(scored, default=(0, 0, None))
        return top[2] if top[0] >= 0.9 else None

    return pd.Series([best(a, b) for a, b in zip(labels, valid)])


def repaired_label(label: Column, valid: Column) -> Column:
    """A label as one of the valid ones: as it is, without case and spaces, or the closest with a ratio of 0.9."""
    loose = F.try_element_at(F.filter(valid, lambda v: F.lower(F.trim(v)) == F.lower(F.trim(label))), F.lit(1))
    return F.when(label == "Other", label).when(F.array_contains(valid, label), label).otherwise(F.coalesce(loose, _closest(label, valid)))
