"""License scans by canonical digest lookup, in DataFrame functions only.

A text is put into canonical form (ASCII case, copyright lines, equivalent spellings, punctuation and white space are
made equal) and its digest is joined with the digests of known licence texts.  Two units are looked up: the entire text
of a document, and each of its paragraphs (lines), so that a notice that ends a page is found as well.

The built-in registry has the notices below and the full texts of ``license_texts`` with their usual variants: titles,
numbered or bulleted clauses, with or without the terms' appendix, one line a paragraph.

A registry is a table ``(license_id, text)``.  It is broadcast only up to ``MAX_BROADCAST`` rows, otherwise the digests
are joined by shuffle.  Rows of documents are never shuffled with their text: only digests that hit are.

Defined cases: a null or empty text, or one without letters or digits, has a null digest and no licence; repeated rows
each get the result of their id; further columns are ignored; an empty table gives an empty result; several licences in a document
are all listed, in order of their id; of licences with equal canonical forms the least id is named; texts of any length are
looked up whole, line by line as well; a registry without rows finds nothing.

Up to ``MAX_ANCHORS`` distinct longest words of the known forms, texts and lines without any of them are not put into
canonical form a second time; beyond, all are: more work for the same result.
"""

from __future__ import annotations

import re
from itertools import product
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, small_table, text_or_empty

MAX_BROADCAST, MAX_ANCHORS = 50_000, 64

# Spellings that licence matching guidelines treat as the same word.
SPELLINGS = (
    ("licence", "license"),
    ("licenced", "licensed"),
    ("sublicense", "sub license"),
    ("noncommercial", "non commercial"),
    ("copyright holder", "copyright owner"),
    ("copyright holders", "copyright owners"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("per cent", "percent"),
    ("wilful", "willful"),
    ("fulfil", "fulfill"),
    ("v", "version"),
    ("ver", "version"),
    ("gnu gpl", "gnu general public license"),
    ("cc by nc", "creative commons attribution non commercial"),
)

# Short licence texts and the notices by which texts name a licence.
REGISTRY = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    ),
)


# Fixed value: a line that claims a copyright, by its sign, a year or a place for one; other lines may begin with the word.
COPYRIGHT = (
    r"(?m)^[ \t]*((©|\(c\)[ \t]*[0-9]{4}|copyright[ \t:]*(©|\(c\)|[0-9]{4}|[\[<{]?(yyyy|year)[\]>}]?))[^\n]*"
    r"|copyright[ \t]+(by[ \t]+)?the[ \t][^\n]*(authors|contributors|developers)\.?[ \t\r]*$)"
)


def canonical(c: Column) -> Column:
    """Canonical form of a text: words of a-z and 0-9 with single spaces; copyright lines are gone."""
    c = ascii_lower(c)
    marked = F.contains(c, F.lit("copyright")) | F.contains(c, F.lit("(c)")) | F.contains(c, F.lit("©"))
    c = F.when(marked, F.regexp_replace(c, COPYRIGHT, "")).otherwise(c)
    # Two blanks between words: each word has its own on both sides, so that neighbours are replaced as well.
    c = F.concat(F.lit(" "), F.trim(F.regexp_replace(c, r"[^a-z0-9]+", "  ")), F.lit(" "))
    for a, b in SPELLINGS:
        c = F.replace(c, F.lit(f" {a.replace(' ', '  ')} "), F.lit(f" {b.replace(' ', '  ')} "))
    return F.trim(F.replace(c, F.lit("  "), F.lit(" ")))


_SINGLE = [(a, b) for a, b in SPELLINGS if " " not in a + b]
#: Words that a phrase becomes, or is made of, may be absent from the text itself.
_PHRASES = sorted({w for a, b in SPELLINGS if " " in a + b for w in (*a.split(), *b.split())})


def anchor(form: Column) -> Column:
    """The longest word of a canonical form that only single words become; null if it has none."""
    own = F.filter(F.split(form, " "), lambda w: ~w.isin(_PHRASES))
    return F.array_max(F.transform(own, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]


def anchors(words: list[str | None]) -> str | None:
    """A pattern that any text with a canonical form of one of these anchors matches, in lower case: each in all its
    spellings.  None if that is too many words to look for, or a form has no anchor."""
    if None in words:
        return None
    spelt = {b: {b, *(x for x, y in _SINGLE if y == b)} for _, b in _SINGLE}
    found = {x for w in words for x in spelt.get(w, {w})}
    return "|".join(sorted(found)) if 0 < len(found) <= MAX_ANCHORS else None


def digest(c: Column) -> Column:
    """Digest of the canonical form; null if nothing is left of the text."""
    form = canonical(c)
    return F.when(form != "", F.sha2(form, 256))


def full_texts() -> list[tuple[str, str]]:
    """(license_id, text) of the full texts, in each of their usual variants."""
    read = {f.stem: f.read_text("utf-8") for f in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}
    found = []

    def short(name: str, titles: tuple[str, ...], bodies: list[str]) -> None:
        found.extend((name, f"{t}\n\n{r}\n\n{b}") for t, r, b in product(("", *titles), ("", "All rights reserved."), bodies))

    short("MIT", ("MIT License", "The MIT License", "The MIT License (MIT)"), [read.pop("MIT")])
    isc = read.pop("ISC")
    short("ISC", ("ISC License", "The ISC License"), [isc, isc.replace("and/or", "and")])
    short("0BSD", ("BSD Zero Clause License", "Zero-Clause BSD"), [isc.replace(", provided that the above\ncopyright notice and this permission notice appear in all copies", "")])
    three = read.pop("BSD-3-Clause")
    two = re.sub(r" \* Neither.*?permission\.\n\n", "", three, flags=re.S)
    for name, n, text in (("BSD-3-Clause", 3, three), ("BSD-2-Clause", 2, two)):
        numbers = iter(range(1, 4))
        numbered = re.sub(r"(?m)^ \* ", lambda _: f"{next(numbers)}. ", text)
        plural = [t.replace("COPYRIGHT OWNER OR", "COPYRIGHT HOLDERS OR") for t in (text, numbered)]
        named = {2: ("Simplified BSD License", "FreeBSD License"), 3: ("New BSD License", "Modified BSD License")}[n]
        short(name, (f"BSD {n}-Clause License", f"The BSD {n}-Clause License", "BSD License", *named), [text, numbered, *plural])
    for name, text in read.items():
        end = re.match(r"(?s).*END OF TERMS AND CONDITIONS", text)
        terms = re.sub(r"\s*END OF TERMS AND CONDITIONS$", "", end[0]) if end else text
        found.extend((name, t) for t in dict.fromkeys((text, end[0] if end else text, terms)))
    return list(dict.fromkeys(found))


def registry(spark: SparkSession) -> DataFrame:
    return small_table(spark, [*REGISTRY, *full_texts()], "license_id string, text string")


def scan_licenses(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``text_digest``, ``text_license`` (of the entire text) and ``notice_licenses`` (of its lines)."""
    forms = known.where("license_id IS NOT NULL").select(canonical(F.col("text")).alias("f")).where("f <> ''")
    words = [r[0] for r in forms.select(anchor(F.col("f"))).distinct().limit(MAX_ANCHORS + 1).collect()]
    pattern = anchors(words)
    known = known.select("license_id", digest(F.col("text")).alias("k")).where("k IS NOT NULL AND license_id IS NOT NULL").distinct()
    known = known.groupBy("k").agg(F.min("license_id").alias("license_id"))
    if known.count() <= MAX_BROADCAST:
        known = F.broadcast(known)
    text = text_or_empty(text_col)
    keyed = docs.select(F.col(id_col).alias("doc_id"), text.alias("t"))
    whole = keyed.select("doc_id", digest(F.col("t")).alias("text_digest"))
    whole = whole.join(known.select(F.col("k").alias("text_digest"), F.col("license_id").alias("text_license")), "text_digest", "left")
    # Texts, then lines, without a word of any known text need no canonical form.
    may = lambda c: F.rlike(ascii_lower(c), F.lit(pattern)) if pattern else F.lit(True)
    lines = keyed.where(may(F.col("t"))).select("doc_id", F.explode(F.split("t", "\n")).alias("line")).where(may(F.col("line")) & (F.col("line") != ""))
    hits = lines.select("doc_id", digest(F.col("line")).alias("k")).join(known, "k").select("doc_id", "license_id").distinct()
    found = hits.groupBy("doc_id").agg(F.array_sort(F.collect_set("license_id")).alias("notice_licenses"))
    found = found.withColumnRenamed("doc_id", "found_in")
    return whole.join(found, F.col("doc_id").eqNullSafe(F.col("found_in")), "left").select(
        "doc_id", "text_digest", "text_license", F.coalesce("notice_licenses", F.array().cast("array<string>")).alias("notice_licenses")
    )
