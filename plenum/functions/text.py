"""Scalar functions over survey texts: column in, column out, inside whole-stage code generation where Spark can."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: What a float looks like; Spark's cast would also take '1d' and Python's float() would take '1_0'.
NUMERIC = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$|^\s*[+-]?(inf|infinity|nan)\s*$"
#: Tags that stay tags when a text goes into a prompt.
PROMPT_TAGS = ("question", "response", "quote")


def null_if_blank(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


def null_tokens(c: Column, tokens: Sequence[str] = ("", "NA", "N/A", "NaN", "nan", "null", "NULL", "None", "n/a", "<NA>")) -> Column:
    """Texts that stand for a missing value become null."""
    return F.when(~c.isin(*tokens), c)


def is_numeric(c: Column) -> Column:
    """Whether a text converts to a float (F37); null is not."""
    return F.coalesce(F.rlike(F.lower(c), F.lit(NUMERIC)), F.lit(False))


def to_number(c: Column) -> Column:
    return F.when(is_numeric(c), F.trim(c).try_cast("double"))


def is_text_response(c: Column) -> Column:
    """A non-blank answer that is no number (P10)."""
    return F.coalesce(F.trim(c) != "", F.lit(False)) & ~is_numeric(c)


def first_line(c: Column) -> Column:
    """F01"""
    return F.split_part(c, F.lit("\n"), F.lit(1))


def topic_opinion_quote(c: Column) -> Column:
    """Topic, opinion and quote of a gallery question (F02); what is not there is null."""
    pattern = r"(?s)Topic:\s*(.*?)\s*\n\s*Opinion:\s*(.*?)\s*\n.*?“(.*?)”"
    part = lambda k: F.nullif(F.regexp_extract(c, pattern, k), F.lit(""))
    return F.struct(part(1).alias("topic"), part(2).alias("opinion"), part(3).alias("quote"))


def ranking_topic(c: Column) -> Column:
    """Topic named in a ranking question."""
    return F.coalesce(F.nullif(F.regexp_extract(c, r"Topic:\s*\n(.*?)\s*-", 1), F.lit("")), F.lit("Unknown Topic"))


def without_ranking_topic(c: Column) -> Column:
    """Ranking question without its topic."""
    return F.regexp_replace(c, r"^Topic:\s*.*?\s*-\s*", "")


def single_line_responses(c: Column) -> Column:
    """Bodies of the question and response pairs; answers of several lines are left out."""
    return F.regexp_extract_all(c, F.lit(r"<question>(.*?)</question>\s*<response>(.*?)</response>"), F.lit(2))


def joined_responses(c: Column) -> Column:
    """All response bodies, each closed by a full stop, as one text; a text without tags as it is."""
    bodies = F.filter(F.transform(F.regexp_extract_all(c, F.lit(r"(?s)<response>(.*?)</response>"), F.lit(1)), lambda x: F.trim(x)), lambda x: x != "")
    closed = F.transform(bodies, lambda x: F.when(F.rlike(x, F.lit(r"[.?!]$")), x).otherwise(F.concat(x, F.lit("."))))
    return F.when(F.contains(c, F.lit("<response>")), F.array_join(closed, " ")).otherwise(c)


def labelled_parts(c: Column) -> Column:
    """Paragraphs ``label:\\nbody``: their bodies."""
    parts = F.filter(F.split(c, "\n\n"), lambda x: F.contains(x, F.lit(":\n")))
    return F.transform(parts, lambda x: F.substring(x, F.instr(x, ":\n") + 2, F.length(x)))


def without_brackets(c: Column) -> Column:
    """F08"""
    return F.translate(c, "[]", "")


def estimated_tokens(c: Column) -> Column:
    """A quarter of the characters."""
    return F.floor(F.coalesce(F.length(c), F.lit(0)) / 4).cast("bigint")


def clean_markdown(c: Column) -> Column:
    """Bold and italics as HTML."""
    return F.regexp_replace(F.regexp_replace(c, r"\*\*(.+?)\*\*", "<strong>$1</strong>"), r"\*(.+?)\*", "<em>$1</em>")


def without_header(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"^#+\s*", ""))


def paragraphs(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, r"\n\s*\n"), lambda x: F.trim(x)), lambda x: x != "")


def prompt_item(c: Column) -> Column:
    """HTML-escaped but for the tags that prompts use, as an ``<item>``."""
    c = F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    for tag in PROMPT_TAGS:
        for a, b in ((f"&lt;{tag}&gt;", f"<{tag}>"), (f"&lt;/{tag}&gt;", f"</{tag}>")):
            c = F.replace(c, F.lit(a), F.lit(b))
    return F.concat(F.lit("<item>"), c, F.lit("</item>"))


def prompt(instructions: str, data: Column, context: str | None = None) -> Column:
    """Instructions, further context and the items of an array."""
    items = F.array_join(F.transform(data, prompt_item), "\n")
    parts = [F.lit(f"<instructions>\n{instructions}\n</instructions>")]
    if context:
        parts.append(F.lit(f"<context>\n{context}\n</context>"))
    return F.concat_ws("\n\n", *parts, F.concat(F.lit("<data>\n"), items, F.lit("\n</data>")))


def clean_quote(c: Column) -> Column:
    """One line without double quotes."""
    return F.replace(F.translate(c, "\n", " "), F.lit('"'), F.lit(""))


def bullets(c: Column) -> Column:
    """An array as ``- a`` lines."""
    return F.array_join(F.transform(c, lambda x: F.concat(F.lit("- "), x)), "\n")


def numbered(c: Column) -> Column:
    """An array as ``1. a`` lines."""
    return F.array_join(F.transform(c, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), "\n")


def interpolated(template: Column, values: Mapping[str, Column]) -> Column:
    """``{name}`` replaced by values."""
    for name, value in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return template


def replaced_literals(c: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Literal replacements, one after another."""
    for a, b in pairs:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def sheet_id(url: Column) -> Column:
    """F32"""
    return F.nullif(F.regexp_extract(url, r"/d/([A-Za-z0-9_-]+)", 1), F.lit(""))


def sheet_gid(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"[#&?]gid=([0-9]+)", 1), F.lit(""))


def seconds_of(c: Column) -> Column:
    """``18s`` as 18."""
    return F.regexp_extract(c, r"^\s*([0-9.]+)s\s*$", 1).try_cast("double")


def pretty_seconds(c: Column) -> Column:
    """Seconds as ``1h 2m 3s``."""
    s = F.floor(c).cast("bigint")
    h, m, r = F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60), F.pmod(s, F.lit(60))
    text = lambda x, unit: F.concat(x.cast("string"), F.lit(unit))
    return F.concat_ws(" ", F.when(h > 0, text(h, "h")), F.when((h > 0) | (m > 0), text(m, "m")), text(r, "s"))


def percent_value(c: Column) -> Column:
    """``63.0%`` as 63.0 (F16)."""
    return F.rtrim(F.trim(c), F.lit("%")).try_cast("double")


def percent_text(c: Column) -> Column:
    """A share as ``63.0%`` (F16)."""
    return F.format_string("%.1f%%", c * 100)


def locale_percent(c: Column) -> Column:
    """A whole percentage; values over 1 are percentages already."""
    return F.concat(F.format_number(F.when(c > 1, c).otherwise(c * 100), 0), F.lit("%"))


@F.pandas_udf(StringType())
def without_accents(texts: pd.Series) -> pd.Series:
    """Canonical decomposition without its combining marks; Spark has no normalisation of its own."""
    import unicodedata

    return texts.map(lambda t: t if t is None else "".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.combining(c)))


def slug(c: Column, first_words: int | None = None) -> Column:
    """Letters and digits of the lower-cased text without accents, at most of its first words; else ``item``."""
    if first_words:
        c = F.array_join(F.slice(F.split(F.trim(c), r"\s+"), 1, first_words), " ")
    kept = F.regexp_replace(without_accents(F.lower(c)), r"[^\p{L}\p{N}]+", "")
    return F.coalesce(F.nullif(kept, F.lit("")), F.lit("item"))
