"""Chat formatting: schema fingerprints choose declarative mappings into canonical turns; DataFrame functions only.

A source record is JSON of any layout.  Its fingerprint is the digest of its nested field paths, read per record from the
schema of its variant value, so records of different layouts may share a table.  The strings that are values are taken out
first, and runs of equal elements become one, so what is parsed for the paths is small however long the texts are.  A mapping
says for a fingerprint where the conversation key, the order and the turns are.  Records that no mapping knows, or that are no
JSON, are not guessed at and don't stop the others: ``rejected`` lists them with their fingerprint.

The template writes a turn as ``<|im_start|>role<|im_sep|>text<|im_end|>``.  Within roles and texts a backslash is put
before every backslash and inside every control string (``<|``, ``</s>``, ``[INST]``, ``[/INST]``), so that no text can
close or open a turn; taking away one backslash before each character gives the text back exactly.

The loss mask is the list of spans of assistant texts in the formatted conversation (code points, end exclusive).

A conversation is one output value, so its turns meet in one task; what is shuffled is one row a turn, and conversations
are spread by their key.  Many conversations that are equal are not one group.

Keys are strings, as the records have them.  Defined cases: null text or role is empty; turns that tie in order are sorted by
role and text; repeated rows are repeated turns; rows of a turn with a null key are one conversation, a whole record with a
null key is a conversation of its own (equal ones are one, with repeated turns); null records have no turns and are no
rejects; other columns of the table are ignored; texts of any length that a row can hold are formatted whole; an empty table
gives empty results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_table

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"

# Control strings of common chat templates; a backslash goes after their first character.
CONTROLS = ("<|", "</s>", "<s>", "[INST]", "[/INST]")


def escape(c: Column) -> Column:
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for s in CONTROLS:
        c = F.replace(c, F.lit(s), F.lit(s[0] + "\\" + s[1:]))
    return c


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


@dataclass(frozen=True)
class Layout:
    """How records of one layout become turns.

    ``examples``: JSON records of the layout; their fingerprints are the layout's.  ``schema``: DDL by which records are read.
    ``key`` and ``order``: expressions over the record ``r``; ``turns``: an expression for an array of (role, text).
    ``whole``: a record is a conversation.
    """

    name: str
    examples: tuple[str, ...]
    schema: str
    key: str
    order: str
    turns: str
    whole: bool = True


LAYOUTS = (
    Layout(
        "row per turn",
        ('{"conv_id":1,"role":"user","text":"x","turn":0}',),
        "conv_id STRING, turn BIGINT, role STRING, text STRING",
        "r.conv_id",
        "r.turn",
        "array(struct(r.role AS role, r.text AS text))",
        False,
    ),
    Layout(
        "messages",
        ('{"conv_id":1,"messages":[{"content":"x","role":"user"}]}', '{"conv_id":1,"messages":[]}'),
        "conv_id STRING, messages ARRAY<STRUCT<role: STRING, content: STRING>>",
        "r.conv_id",
        "0",
        "transform(r.messages, m -> struct(m.role AS role, m.content AS text))",
    ),
    Layout(
        "from and value",
        ('{"conv_id":1,"conversations":[{"from":"human","value":"x"}]}', '{"conv_id":1,"conversations":[]}'),
        "conv_id STRING, conversations ARRAY<STRUCT<`from`: STRING, value: STRING>>",
        "r.conv_id",
        "0",
        "transform(r.conversations, m -> struct(CASE m.`from` WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' ELSE m.`from` END AS role, m.value AS text))",
    ),
    Layout(
        "prompt and response",
        ('{"conv_id":1,"prompt":"x","response":"y"}',),
        "conv_id STRING, prompt STRING, response STRING",
        "r.conv_id",
        "0",
        "array(struct('user' AS role, r.prompt AS text), struct('assistant' AS role, r.response AS text))",
    ),
    Layout(
        "instruction, input and output",
        ('{"conv_id":1,"input":"x","instruction":"y","output":"z"}',),
        "conv_id STRING, instruction STRING, input STRING, output STRING",
        "r.conv_id",
        "0",
        "array(struct('user' AS role, concat_ws('\\n\\n', r.instruction, nullif(r.input, '')) AS text), struct('assistant' AS role, r.output AS text))",
    ),
)


def skeleton(record: Column) -> Column:
    """A JSON record with empty strings for its values, and one element for a run of equal flat ones: its paths stay."""
    bare = F.replace(F.replace(record, F.lit("\\\\"), F.lit("")), F.lit('\\"'), F.lit(""))
    empty = F.regexp_replace(bare, r'"(?:([^"]*+)"(?=\s*+:)|[^"]*+")', '"$1"')
    return F.regexp_replace(empty, r"(\{[^{}\[\]]*+\},\s*+)\1++", "$1")


def fingerprint(record: Column) -> Column:
    """Digest of the nested field paths of a JSON record, null if it is none; values that are null count as present."""
    paths = F.schema_of_variant(F.try_parse_json(skeleton(record)))
    # Types of leaves differ between records (a null text is VOID), the paths don't: only names and nesting stay.
    return F.sha2(F.regexp_replace(paths, r"(: )(?!ARRAY<|OBJECT<)[A-Z]+(\([0-9,]+\))?", "$1_"), 256)


def _mapped(records: DataFrame, record_col: str, layouts: tuple[Layout, ...]) -> DataFrame:
    """record, f (fingerprint) and m: key, order, turns and whether the record could not be read; m is null for unknown layouts."""
    known = small_table(records.sparkSession, [(i, e) for i, x in enumerate(layouts) for e in x.examples], "i int, example string")
    printed = records.where(F.col(record_col).isNotNull()).select(F.col(record_col).alias("record"), fingerprint(F.col(record_col)).alias("f"))
    mapped = F.lit(None).cast("struct<conv_id:string,own:bigint,ord:bigint,turns:array<struct<role:string,text:string>>,bad:boolean>")
    # A layout has few examples: their fingerprints are constants of the plan.
    prints: dict[int, list[str]] = {}
    for i, f in known.select("i", fingerprint(F.col("example")).alias("f")).collect():
        prints.setdefault(i, []).append(f)
    for i, x in enumerate(layouts):
        r = f"from_json(record, '{x.schema}, _bad STRING', map('maxStringLen', '{2**31 - 1}', 'columnNameOfCorruptRecord', '_bad'))"
        own = f"CASE WHEN {x.key} IS NULL THEN xxhash64(record) END" if x.whole else "CAST(NULL AS BIGINT)"
        fields = f"CAST({x.key} AS STRING) AS conv_id, {own} AS own, CAST({x.order} AS BIGINT) AS ord, {x.turns} AS turns, r._bad IS NOT NULL AS bad"
        as_struct = F.expr(f"element_at(transform(array({r}), r -> struct({fields})), 1)")
        mapped = F.when(F.col("f").isin(prints.get(i, [])), as_struct).otherwise(mapped)
    return printed.select("record", "f", mapped.alias("m"))


def rejected(records: DataFrame, record_col: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """The records that ``canonical_turns`` leaves out: record, fingerprint (null if it is no JSON)."""
    out = _mapped(records, record_col, layouts).where("m IS NULL OR m.bad")
    return out.select("record", F.col("f").alias("fingerprint"))


def canonical_turns(records: DataFrame, record_col: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """One row per turn of the records of known layouts: conv_id, own, ord, place, role, text."""
    rows = _mapped(records, record_col, layouts).where("NOT m.bad").select("m")
    return rows.select("m.conv_id", "m.own", "m.ord", F.posexplode("m.turns").alias("place", "t")).select(
        "conv_id", "own", "ord", "place", F.coalesce("t.role", F.lit("")).alias("role"), F.coalesce("t.text", F.lit("")).alias("text")
    )


def format_chats(turns: DataFrame) -> DataFrame:
    """Per conversation: conv_id, formatted, loss_mask (array of (start, end))."""
    before = F.concat(F.lit(START), escape(F.col("role")), F.lit(SEP))
    pieces = turns.select("conv_id", "own", "ord", "place", "role", "text", before.alias("before"), escape(F.col("text")).alias("body"))
    w = Window.partitionBy("conv_id", "own").orderBy("ord", "place", "role", "text")
    size = F.length("before") + F.length("body") + len(END)
    placed = pieces.select(
        "conv_id",
        "own",
        F.row_number().over(w).alias("n"),
        (F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.length("body") - len(END)).alias("start"),
        F.length("body").alias("size"),
        (F.col("role") == "assistant").alias("loss"),
        F.concat("before", "body", F.lit(END)).alias("piece"),
    )
    turn = F.array_sort(F.collect_list(F.struct("n", "start", "size", "loss", "piece")))
    grouped = placed.groupBy("conv_id", "own").agg(turn.alias("t"))
    mask = F.transform(F.filter("t", lambda x: x["loss"]), lambda x: F.struct(x["start"].alias("start"), (x["start"] + x["size"]).alias("end")))
    return grouped.select("conv_id", F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("formatted"), mask.alias("loss_mask"))


def parse_chats(formatted: DataFrame) -> DataFrame:
    """Reads the template back: conv_id, turns (array of (role, text)), loss_text (unescaped text under the mask), formatted."""
    marker = lambda s: s.replace("|", r"\|")
    parts = F.slice(F.split("formatted", marker(START)), F.lit(2), F.size(F.split("formatted", marker(START))))
    turn = lambda p: F.struct(
        unescape(F.element_at(F.split(p, marker(SEP)), 1)).alias("role"),
        unescape(F.element_at(F.split(F.element_at(F.split(p, marker(SEP)), 2), marker(END)), 1)).alias("text"),
    )
    under = F.transform("loss_mask", lambda m: unescape(F.substring(F.col("formatted"), (m["start"] + 1).cast("int"), (m["end"] - m["start"]).cast("int"))))
    return formatted.select("conv_id", F.transform(parts, turn).alias("turns"), F.array_join(under, "").alias("loss_text"), "formatted")
