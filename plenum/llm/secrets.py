"""Secret scans: fixed patterns, and character Markov models of random strings and of ordinary identifiers.

Everything is a DataFrame expression over the text of one row; nothing is shuffled, exploded or collected but the counts
of the models (at most 2 x 69 x 69 rows, whatever the sample).

Patterns give the base spans: matches from left to right without overlap, those that are too short dropped.  Positions are
code points: the lengths of the pieces between the matches and of the matches add up to them.

The models: for each class of the labelled sample, counts of a character after a character with ``SMOOTHING`` added.
Base spans are taken out of the runs of token characters; a part of 20 or more that is left is a ``markov`` span if the
log-likelihood ratio of the two models over its characters is ``margin`` nats or more, and ``rate`` nats a character or
more, so that long names don't add up to a secret.  If it is not, its segments of the highest ratio are taken, each widened
to the next of ``/ = _ -``: those of ``margin`` and ``rate`` or more, and of 20 characters or more once widened, are spans.
So ordinary text around a secret does not hide it.

Defined cases: a null text is empty; an empty text has no spans; repeated rows each get their result; further columns
are ignored; an empty table gives an empty result; a text of any length is scanned whole; spans that tie in their start are
in order of their kind; a sample without rows gives ratios of zero, so no spans are added.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER, text_or_empty

# The base patterns (letters of the first in either case), in order of their kind.
ASSIGN = (
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
RUN_CHARS = 20
RUN = rf"[A-Za-z0-9+/_=-]{{{RUN_CHARS},}}"
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
SMOOTHING = 0.5
MARGIN, RATE = 12.0, 0.5
SAMPLE_ROWS = 20_000

# Words of which the ordinary identifiers of the built-in sample are put together.
WORDS = (
    "get set user name list index value count file path open close read write buffer stream parse format string number array "
    "object class method function handler manager service client server request response error message config option default "
    "update delete create insert select table column row key map filter reduce sort order group join merge split token state "
    "event action view model page session account address payment product customer invoice report total amount price date time "
    "start end first last next previous current parent child node tree graph edge weight score rank test check valid init load "
    "save cache memory thread lock queue stack heap die und eine nicht werden keit ung schaft heit lich verein les pour dans une "
    "elle tion ment eaux que los para ción como mente".split()
)
_SPAN = "array<struct<s:int,k:int,e:int>>"
_PART = "array<struct<s:int,e:int>>"


def _pick(values: list[str], *salt) -> Column:
    """One of the values, by a hash of the row's id and the salt."""
    place = F.pmod(F.xxhash64("id", *(x if isinstance(x, Column) else F.lit(x) for x in salt)), F.lit(len(values)))
    return F.element_at(F.split(F.lit(" ".join(values)), " "), (place + 1).cast("int"))


def _word(j: Column) -> Column:
    """A word, a made-up word (consonants, pairs of them too, and vowels in turn) or a row of any letters."""
    onsets = "b c d f g h j k l m n p q r s t v w x y z ch sh th wl ll gw yn rw ng str schw tt ss rn nt cz".split()
    vowels = "a e i o u y a e i o ou ei au ie".split()
    steps = F.sequence(F.lit(0), F.lit(4))
    made = F.array_join(F.transform(steps, lambda k: F.when(k % 2 == 0, _pick(onsets, j, k)).otherwise(_pick(vowels, j, k))), "")
    letters = F.array_join(F.transform(steps, lambda k: _pick(list(LOWER), "l", j, k)), "")
    kind = F.pmod(F.xxhash64("id", F.lit("w"), j), F.lit(10))
    return F.when(kind < 6, _pick([w for w in WORDS if w.isascii()], j)).when(kind < 9, made).otherwise(letters)


def labelled_sample(spark: SparkSession, rows: int = SAMPLE_ROWS, start: int = 0) -> DataFrame:
    """``(sample, random)``: random strings (base64, letters and digits, capitals and digits), and ordinary identifiers.

    The identifiers are words, made-up words and rows of any letters, in small letters, capitals or both, joined in the usual
    ways; numbers, dates, versions, UUIDs, hexadecimal ids (those that are secrets are base spans) and rulers of one mark.
    """
    digest = F.sha2(F.col("id").cast("string"), 256)
    number = lambda j, n: F.lpad(F.pmod(F.xxhash64("id", F.lit(j)), F.lit(10**n)).cast("string"), n, "0")
    date = F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), F.pmod(F.xxhash64("id", F.lit("d")), F.lit(20_000)).cast("int")), "yyyy-MM-dd")
    made = spark.range(start, start + rows).select(
        "id",
        F.translate(F.base64(F.unhex(F.concat(digest, F.sha2(F.concat(digest, F.lit("x")), 256)))), "=", "").alias("b64"),
        F.transform(F.sequence(F.lit(0), F.lit(4)), _word).alias("w"),
        date.alias("date"),
        F.md5(digest).alias("hex"),
    )
    b64 = F.col("b64")
    random = (
        F.when(F.col("id") % 4 == 0, F.substring(F.regexp_replace(b64, "[+/]", ""), 1, 40))
        .when(F.col("id") % 4 == 1, F.substring(F.regexp_replace(F.upper(b64), "[+/]", ""), 1, 32))
        .when(F.col("id") % 4 == 2, F.substring(F.translate(b64, "+/", "-_"), 1, 43))
        .otherwise(F.substring(b64, 1, 40))
    )
    joined = lambda mark: F.array_join("w", mark)
    titled = F.transform("w", F.initcap)
    day, first, second = F.replace("date", F.lit("-"), F.lit("")), F.get("w", F.lit(0)), F.get("w", F.lit(1))
    uuid = F.concat_ws("-", *(F.substring("hex", a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    styles = [
        F.concat(first, F.array_join(F.slice(titled, 2, 4), "")), F.array_join(titled, ""), joined("_"), joined("-"), joined("/"), joined("."), joined(""),
        F.upper(joined("_")), F.upper(joined("-")), F.upper(joined("")), F.array_join(titled, "-"), F.concat_ws("_", first, second, number("a", 3)), F.concat_ws("-", F.upper(first), F.upper(second), number("b", 4)),
        F.concat(F.initcap(first), F.upper(second), F.initcap(F.get("w", F.lit(2))), number("c", 2)), F.concat_ws("-", day, day, number("e", 4)), F.concat_ws("_", day, number("f", 6), first), F.concat_ws("/", "date", first, number("g", 5)),
        F.concat(F.lit("/"), joined("/"), F.lit("/"), "date"), uuid, F.upper(uuid), uuid, F.substring("hex", 1, 20), F.concat(number("h", 12), number("i", 12)), F.concat_ws("-", *(number(f"n{k}", 4) for k in range(5))),
        F.repeat(_pick(["=", "-", "_", "/", "+", "x", "A", "0"], "r"), 30), F.substring(F.lit(LOWER + "0123456789" + UPPER + LOWER), (F.lit(1) + F.col("id") % 40).cast("int"), F.lit(36)),
    ]
    plain = F.element_at(F.array(*styles), (F.pmod(F.col("id"), F.lit(len(styles))) + 1).cast("int"))
    return made.select(F.explode(F.array(F.struct(random.alias("sample"), F.lit(True).alias("random")), F.struct(plain.alias("sample"), F.lit(False).alias("random")))).alias("x")).select("x.*")


def train(sample: DataFrame) -> list[float]:
    """Log-likelihood ratios: entry ``a * width + b`` is that of character ``b`` after ``a`` (0: the start, or any other)."""
    width = len(ALPHABET) + 1
    coded = sample.where("sample IS NOT NULL AND random IS NOT NULL").select("random", _codes(F.col("sample")).alias("c"))
    pairs = coded.select("random", F.explode(F.arrays_zip(F.concat(F.array(F.lit(0)), "c").alias("a"), F.col("c").alias("b"))).alias("p"))
    counts = {True: [SMOOTHING] * width * width, False: [SMOOTHING] * width * width}
    for row in pairs.where("p.b IS NOT NULL").groupBy("random", "p.a", "p.b").count().collect():
        counts[row["random"]][row["a"] * width + row["b"]] += row["count"]
    ratio = []
    for a in range(width):
        of = {k: v[a * width : (a + 1) * width] for k, v in counts.items()}
        total = {k: sum(v) for k, v in of.items()}
        ratio += [math.log(of[True][b] / total[True]) - math.log(of[False][b] / total[False]) for b in range(width)]
    return ratio


def _codes(c: Column) -> Column:
    return F.transform(F.filter(F.split(c, ""), lambda x: x != ""), lambda x: F.instr(F.lit(ALPHABET), x))


def _let(value: Column, f) -> Column:
    """``f`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _scores(c: Column, ratio: list[float]) -> Column:
    """The log-likelihood ratio of each character."""
    width = len(ALPHABET) + 1
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in ratio)), ",").cast("array<double>")
    return _let(_codes(c), lambda x: F.transform(x, lambda b, i: F.element_at(table, F.coalesce(F.get(x, i - 1), F.lit(0)) * width + b + 1)))


def _sum(scores: Column) -> Column:
    return F.aggregate(scores, F.lit(0.0), lambda a, x: a + x)


def likelihood_ratio(c: Column, ratio: list[float]) -> Column:
    return _sum(_scores(c, ratio))


def _segments(scores: Column, margin: float, rate: float) -> Column:
    """(s, e) of the segments with a sum of ``margin`` or more and a mean of ``rate`` or more: each ends at its highest sum, once
    the sum has fallen by ``margin``."""

    def ended(a: Column, closes: Column) -> Column:
        good = closes & (a["peak"] >= rate * (a["e"] - a["s"]))
        return F.when(good, F.concat(a["out"], F.array(F.struct(a["s"].alias("s"), a["e"].alias("e"))))).otherwise(a["out"])

    def step(a: Column, x: Column) -> Column:
        now, t = a["i"] + 1, a["sum"] + x
        # The best sum since the highest one is what the next segment begins with.
        later = F.greatest(a["later"], F.lit(0.0)) + x
        later_s = F.when(later <= 0, now).otherwise(F.when(a["later"] <= 0, a["i"]).otherwise(a["later_s"]))
        full = a["peak"] >= margin
        closed, sunk, risen = full & (t <= a["peak"] - margin), ~full & (t <= 0), t > a["peak"]
        total = F.when(closed, F.greatest(later, F.lit(0.0))).when(sunk, 0.0).otherwise(t)
        return F.struct(
            now.alias("i"),
            total.alias("sum"),
            F.when(closed, later_s).when(sunk, now).otherwise(a["s"]).alias("s"),
            F.when(closed | sunk | risen, total).otherwise(a["peak"]).alias("peak"),
            F.when(closed | sunk | risen, now).otherwise(a["e"]).alias("e"),
            F.when(closed | sunk | risen, 0.0).otherwise(later).alias("later"),
            F.when(closed | sunk | risen, now).otherwise(later_s).alias("later_s"),
            ended(a, closed).alias("out"),
        )

    zero = lambda n: F.lit(0).alias(n)
    none = lambda n: F.lit(0.0).alias(n)
    first = F.struct(zero("i"), none("sum"), zero("s"), none("peak"), zero("e"), none("later"), zero("later_s"), F.array().cast(_PART).alias("out"))
    return F.aggregate(scores, first, step, lambda a: ended(a, a["peak"] >= margin))


def _random_parts(run: Column, ratio: list[float], margin: float, rate: float) -> Column:
    """(s, e) of what is random in a run: all of it, or its segments widened to the marks around them, those that overlap as one."""

    def widened(cut: Column, x: Column) -> Column:
        part = F.substring(cut, x["s"] + 1, x["e"] - x["s"])
        s = x["s"] + F.length(part) - F.length(F.ltrim(part, F.lit("/")))
        e = x["e"] - F.length(part) + F.length(F.rtrim(part, F.lit("/")))
        before, after = F.substring(cut, F.lit(1), s), F.substring(cut, e + 1, F.length(cut))
        return F.struct((s - F.length(F.substring_index(before, "/", -1))).alias("s"), (e + F.length(F.substring_index(after, "/", 1))).alias("e"))

    def merged(a: Column, x: Column) -> Column:
        joins = F.coalesce(F.get(a, F.size(a) - 1)["e"] > x["s"], F.lit(False))
        last = F.get(a, F.size(a) - 1)
        one = F.struct(last["s"].alias("s"), F.greatest(last["e"], x["e"]).alias("e"))
        return F.when(joins, F.concat(F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))), F.array(one))).otherwise(F.concat(a, F.array(x)))

    def of(scores: Column) -> Column:
        wide = _let(F.translate(run, "=_-", "///"), lambda cut: F.transform(_segments(scores, margin, rate), lambda x: widened(cut, x)))
        parts = F.filter(F.aggregate(wide, F.array().cast(_PART), merged), lambda x: x["e"] - x["s"] >= RUN_CHARS)
        whole = F.array(F.struct(F.lit(0).alias("s"), F.length(run).alias("e")))
        return F.when(_sum(scores) >= F.greatest(F.lit(margin), rate * F.length(run)), whole).otherwise(parts)

    return _let(_scores(run, ratio), of)


def _outside(start: Column, end: Column, spans: Column) -> Column:
    """(s, e), counted from ``start``, of the parts from ``start`` to ``end`` of RUN_CHARS or more that no span touches."""

    def step(a: Column, y: Column) -> Column:
        part = F.array(F.struct((a["at"] - start).alias("s"), (y["s"] - start).alias("e")))
        return F.struct(F.greatest(a["at"], y["e"]).alias("at"), F.when(y["s"] - a["at"] >= RUN_CHARS, F.concat(a["out"], part)).otherwise(a["out"]).alias("out"))

    near = F.filter(spans, lambda y: (y["s"] < end) & (start < y["e"]))
    behind = lambda a: F.when(end - a["at"] >= RUN_CHARS, F.concat(a["out"], F.array(F.struct((a["at"] - start).alias("s"), (end - start).alias("e"))))).otherwise(a["out"])
    return F.aggregate(near, F.struct(start.alias("at"), F.array().cast(_PART).alias("out")), step, behind)


def _matches(text: Column, pattern: str, kind: int, parts) -> Column:
    """Spans of ``parts(match, start, end)`` of the matches, (s, e) counted from the match's start; the whole text is split only
    where the pattern occurs."""
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def step(a: Column, m: Column) -> Column:
        start = a["at"] + F.length(F.element_at(gaps, a["n"] + 1))
        end = start + F.length(m)
        spans = F.transform(parts(m, start, end), lambda x: F.struct((start + x["s"]).alias("s"), F.lit(kind).alias("k"), (start + x["e"]).alias("e")))
        return F.struct((a["n"] + 1).alias("n"), end.alias("at"), F.concat(a["out"], spans).alias("out"))

    first = F.struct(F.lit(0).alias("n"), F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))
    return F.aggregate(found, first, step, lambda a: a["out"])


def _whole_if(keep):
    """All of a match if ``keep(match)`` holds, else nothing of it."""
    return lambda m, start, end: F.when(keep(m), F.array(F.struct(F.lit(0).alias("s"), F.length(m).alias("e")))).otherwise(F.array().cast(_PART))


def _where_found(text: Column, probe: str, spans: Column) -> Column:
    return F.when(F.rlike(text, F.lit(probe)), spans).otherwise(F.array().cast(_SPAN))


def with_spans(docs: DataFrame, ratio: list[float], text_col: str = "text", margin: float = MARGIN, names: tuple[str, str] = ("base", "added"), rate: float = RATE) -> DataFrame:
    """``docs`` with two arrays of (s, k, e), start, index in KINDS and end, in order: the base spans and those added."""
    text, (base, added) = text_or_empty(text_col), names
    found = F.array_sort(
        F.concat(
            _where_found(text, ASSIGN, _matches(text, ASSIGN, 0, _whole_if(lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 6))),
            _where_found(text, ACCESS, _matches(text, ACCESS, 1, _whole_if(lambda m: F.length(m) >= 20))),
            # Only runs of 24 or more are looked for: every text has short ones, and they are dropped anyway.
            _where_found(text, r"[0-9a-f]{24}", _matches(text, r"[0-9a-f]{24,}", 2, _whole_if(lambda m: F.lit(True)))),
        )
    )

    def parts(m: Column, start: Column, end: Column) -> Column:
        free = _outside(start, end, F.col(base))
        inner = lambda p: F.transform(_random_parts(F.substring(m, p["s"] + 1, p["e"] - p["s"]), ratio, margin, rate), lambda x: F.struct((p["s"] + x["s"]).alias("s"), (p["s"] + x["e"]).alias("e")))
        return F.flatten(F.transform(free, inner))

    return docs.withColumn(base, found).withColumn(added, _where_found(text, RUN, _matches(text, RUN, 3, parts)))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(kinds, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def scan_secrets(docs: DataFrame, sample: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """Per row of ``docs``: its id, ``base`` and ``added`` spans."""
    ratio = train(labelled_sample(docs.sparkSession) if sample is None else sample)
    return with_spans(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), ratio, "text", margin).drop("text")


def redact(docs: DataFrame, sample: DataFrame | None = None, text_col: str = "text", mask: str = "[SECRET]", margin: float = MARGIN) -> DataFrame:
    """``docs`` with each secret (spans that overlap count as one) replaced by ``mask``; texts without any stay as they are."""
    columns, names = docs.columns, ("base", "added")
    while set(names) & set(columns):  # the table's own columns stay
        names = tuple(f"{n}_" for n in names)
    ratio = train(labelled_sample(docs.sparkSession) if sample is None else sample)
    found = with_spans(docs, ratio, text_col, margin, names)
    text, (base, added) = F.col(text_col), names

    def step(a: Column, x: Column) -> Column:
        piece = F.concat(F.substring(text, a["at"] + 1, x["s"] - a["at"]), F.lit(mask))
        return F.struct(F.greatest(a["at"], x["e"]).alias("at"), F.when(x["s"] >= a["at"], F.concat(a["out"], piece)).otherwise(a["out"]).alias("out"))

    spans = F.array_sort(F.concat(base, added))
    clean = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text) - a["at"])))
    return found.withColumn(text_col, F.when(F.size(F.concat(base, added)) > 0, clean).otherwise(text)).select(*columns)
