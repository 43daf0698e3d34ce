"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

A rank file (tiktoken form: base64 of a token's bytes, rank) becomes a BPE model: bytes are written as the printable
characters of the byte-level alphabet, and every way to split a token in two tokens is a merge with the token's rank, so
that pieces merge by rank as the rank file says, whatever pair they come from.  A piece that is a token is taken whole.

With offsets, texts go to the library in slices of at most ``SLICE_CHARS`` characters (a longer text alone), so a batch's
encodings are never held together.  Without, a text is split by the pattern first and the library's model merges each
distinct piece once; a worker keeps up to ``PIECES`` pieces' ids.  A worker builds the model once.  Offsets are character offsets: a token that holds a part of a
character spans that character, so neighbouring tokens may share one.

Decoding reverses the byte table: ids become bytes, whatever characters they split; the bytes are the result, and text is
their UTF-8 reading once all tokens are joined.

Defined cases: a null text is empty; an empty text has no ids; a null list of ids decodes to no bytes; an id outside the
vocabulary raises; repeated rows each get their result; other columns are kept as they are, but for
those named ids, starts, ends or decoded, which are replaced; an empty table gives an
empty result; texts of any length are encoded whole.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import small_batches

SLICE_CHARS, PIECES = 400_000, 100_000
#: Characters outside the blocks whose letters and numbers all versions of Unicode agree on: such texts are left to the library.
LATE = "[^\u0000-\u052f\u2000-\u206f\u20a0-\u20bf\u3000-\u30ff\u4e00-\u9fbf\uac00-\ud7a3]"


def byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes are themselves, the others follow from U+0100 on in order."""
    printable = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    shown = {b: chr(b) for b in printable}
    for b in range(256):
        if b not in shown:
            shown[b] = chr(256 + len(shown) - len(printable))
    return shown


@lru_cache(2)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}


@lru_cache(2)
def tokenizer(path: str, pattern: str):
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    ranks, shown = read_ranks(path), byte_alphabet()
    name = {t: "".join(map(shown.__getitem__, t)) for t in ranks}
    merges = [(name[t[:i]], name[t[i:]]) for t in sorted(ranks, key=ranks.get) for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
    built = Tokenizer(models.BPE(vocab={name[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
    built.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return built


class PieceIds(dict):
    """Ids of a piece of the pattern, by the model of the tokenizers library; emptied when it is full."""

    def __init__(self, path: str, pattern: str):
        super().__init__()
        import regex

        self.model, self.pieces = tokenizer(path, pattern).model, regex.compile(pattern).findall
        self.whole, self.late = tokenizer(path, pattern), regex.compile(LATE).search
        self.shown = str.maketrans({chr(b): c for b, c in byte_alphabet().items()})

    def __missing__(self, piece: str) -> list[int]:
        if len(self) >= PIECES:
            self.clear()
        ids = [t.id for t in self.model.tokenize(piece.encode("utf-8").decode("latin-1").translate(self.shown))]
        # Long pieces are rare and large: they are made anew each time.
        if len(piece) <= 64:
            self[piece] = ids
        return ids

    def of(self, text: str) -> list[int]:
        if self.late(text):
            return self.whole.encode(text, add_special_tokens=False).ids
        return list(chain.from_iterable(map(self.__getitem__, self.pieces(text))))


@lru_cache(1)
def piece_ids(path: str, pattern: str) -> PieceIds:
    return PieceIds(path, pattern)


def slices(texts: list[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > SLICE_CHARS:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def _encoder(path: str, pattern: str, column: int, offsets: bool, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for part in slices([t or "" for t in batch.column(column).to_pylist()]):
                encoded = tokenizer(path, pattern).encode_batch(part, add_special_tokens=False) if offsets else []
                ids = [e.ids for e in encoded] if offsets else [*map(piece_ids(path, pattern).of, part)]
                ends = pa.array(np.cumsum([0, *map(len, ids)], dtype=np.int32))
                flat = np.fromiter(chain.from_iterable(ids), np.int32)
                more = [pa.ListArray.from_arrays(ends, pa.array(flat))]
                if offsets:
                    at = np.array([x for e in encoded for x in e.offsets], np.int32).reshape(-1, 2)
                    more += [pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(at[:, k]))) for k in (0, 1)]
                rows = batch.slice(done, len(part))
                done += len(part)
                kept = [c for k, c in enumerate(rows.schema.names) if keep_text or k != column]
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in kept), *more], names=[*kept, "ids", "starts", "ends"][: len(kept) + len(more)])

    return run


def encode(df: DataFrame, path: str, pattern: str, text_col: str = "text", offsets: bool = True, keep_text: bool = True) -> DataFrame:
    """``df`` with ``ids`` and, if ``offsets``, ``starts`` and ``ends``, the character span of each token."""
    small_batches(df.sparkSession)
    new = ["ids", "starts", "ends"] if offsets else ["ids"]
    kept = df.drop(*new)
    schema = T.StructType([*(kept if keep_text else kept.drop(text_col)).schema.fields, *(T.StructField(c, T.ArrayType(T.IntegerType())) for c in new)])
    return kept.mapInArrow(_encoder(path, pattern, kept.columns.index(text_col), offsets, keep_text), schema)


def _decoder(path: str, column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(path)
        table = np.full(max(ranks.values()) + 1, None, object)
        for token, rank in ranks.items():
            table[rank] = token
        known = np.array([t is not None for t in table])
        for batch in batches:
            out = []
            for row in batch.column(column):
                ids = row.values.to_numpy(zero_copy_only=False) if row.is_valid and len(row) else np.empty(0, np.int64)
                if len(ids) and not (known[ids.clip(0, len(table) - 1).astype(np.int64)] & (ids >= 0) & (ids < len(table))).all():
                    raise ValueError("an id is not in the vocabulary")
                out.append(b"".join(table[ids.astype(np.int64)]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "decoded"])

    return run


def decode(df: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``df`` with ``decoded``: the bytes of its ids."""
    kept = df.drop("decoded")
    return kept.mapInArrow(_decoder(path, kept.columns.index(ids_col)), T.StructType([*kept.schema.fields, T.StructField("decoded", T.BinaryType())]))


def round_trip(df: DataFrame, path: str, pattern: str, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``df`` with ``ids`` and the bytes they decode to, ``decoded``: both in one worker, batch by batch."""
    small_batches(df.sparkSession)
    kept = df.drop("ids", "decoded")
    own = kept if keep_text else kept.drop(text_col)
    forth, back = _encoder(path, pattern, kept.columns.index(text_col), False, keep_text), _decoder(path, len(own.columns))
    schema = T.StructType([*own.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())])
    return kept.mapInArrow(lambda batches: back(forth(batches)), schema)
