"""Benchmark decontamination by template canonicalisation.

A text becomes template tokens: lower-cased runs of letters and digits, in which numbers (in figures, or spelled out), the
units after them and names (words with a capital, of any alphabet of two-byte letters, inside a sentence; runs of them as one)
are replaced by typed placeholders.  Names without a capital are plain words.  Windows of 8 template tokens are hash-joined
with the benchmark's windows; so a question asked again with other numbers or names hits the same windows.  Windows of templates with fewer than ``LITERALS`` other tokens say nothing and are left out.

An item has up to three readings, each looked up for itself; a text holds the item if it holds one of them: the template
as at the start of a sentence, the template as inside one (where a capitalised first word is a name), and the plain words
and numbers without placeholders, of which every window counts.  So what stands before an item changes nothing, and items
full of numbers or names are found word for word.

Hits on one diagonal (place in the text less place in the item) are one occurrence.  Its slots must be consistent: a value
of the item always stands for the same value of the text, and different values for different ones; windows with a slot
that breaks what most of the occurrence says are taken back.  A text holds an item if the windows left are ``COVERAGE``
of the reading's, or if they lie side by side over ``RUN`` tokens or more.

The hash table of the benchmark's windows is broadcast in blocks of about ``BLOCK`` windows, whose size is counted while
they are read; a larger benchmark takes several passes over the texts, each written before the next block is read, so that
one block is held at a time.  Texts are never shuffled.

Defined cases: null, empty and wordless texts hold nothing; items without words are in nothing; items with
placeholders alone are found word for word only; an item shorter than a window is looked up whole; repeated rows (of either table) each count; further columns
are kept or ignored; an empty benchmark leaves all texts clean; texts of any length are searched whole.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, small_table, written
from .hashing import _BYTES, _UPPER, STEP, U, in_slices, mix, ngram_hashes, places, powers, run_sums, word_bounds

WINDOW, LITERALS, COVERAGE, RUN = 8, 4, 0.5, 20
BLOCK = 2_000_000

# Words that are units when they follow a number.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons lb lbs pound pounds ounce ounces "
    "ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months "
    "year years percent dollar dollars cent cents euro euros usd eur mph kmh kb mb gb tb w kw v volts watts degrees"
).split()
# Words that are numbers.
SPELLED = (
    "zero two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_STOP = np.zeros(256, bool)
_STOP[[*b".!?\n"]] = True
_INNER = np.zeros(256, bool)
_INNER[[*b".,:/"]] = True
_HYPHEN = np.zeros(256, bool)
_HYPHEN[[*b"- "]] = True
#: Capitals among the letters of two bytes.
_CAPITAL = np.array([chr(c).isupper() for c in range(0x800)])
PLAIN, NUMBER, UNIT, NAME = range(4)
_PLACEHOLDER = mix(np.arange(1, 5, dtype=U) * STEP)


def _hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    own = data[_WORD[data]]
    at = places(starts, ends)
    return mix(run_sums(_BYTES[_UPPER[own]], starts, ends, powers(int(at.max()) + 1 if len(at) else 1)[at]) + STEP)


def _hashes_of(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends, _ = word_bounds(~_WORD[data], np.array([0, len(data)]))
    return np.sort(_hash_words(data, starts, ends))


_UNITS, _SPELLED = _hashes_of(UNITS), _hashes_of(SPELLED)


def _among(known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes


@dataclass
class Templates:
    """Template tokens of many texts: hash, kind, place in the buffer and text number of each."""

    hashes: np.ndarray
    kinds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray


def plain_words(data: np.ndarray, offsets: np.ndarray) -> Templates:
    """All words and numbers as they are, in lower case."""
    starts, ends, text = word_bounds(~_WORD[data], offsets)
    hashes = _hash_words(data, starts, ends) if len(starts) else np.empty(0, U)
    return Templates(hashes, np.full(len(starts), PLAIN), starts, ends, text)


def templates(data: np.ndarray, words: Templates, inside: bool = False) -> Templates:
    """Templates of texts, of which the words are given; ``inside``: as if each text stood inside a sentence."""
    if not len(words.text):
        return words
    hashes, starts, ends, text = words.hashes, words.starts, words.ends, words.text
    at = lambda k: np.where(ends - starts > k, data[np.minimum(starts + k, len(data) - 1)], 0)
    first, second = data[starts], at(1)
    new_text = np.concatenate([[True], text[1:] != text[:-1]])
    gap = np.concatenate([[0], starts[1:] - ends[:-1]])
    stops = np.concatenate([[0], np.cumsum(_STOP[data])])
    begins = (new_text & (not inside)) | ~new_text & (stops[starts] > stops[np.concatenate([[0], ends[:-1]])])
    figures, spelled = (first >= 48) & (first <= 57), _among(_SPELLED, hashes)
    number = figures | spelled
    # A capital, then a small letter or any letter beyond ASCII.
    wide = (first >= 0xC3) & (first <= 0xDF)
    point = ((first & 0x1F).astype(np.int64) << 6) | (second & 0x3F)
    capital, then = (first >= 65) & (first <= 90) | wide & _CAPITAL[np.where(wide, point, 0)], np.where(wide, at(2), second)
    name = capital & ((then >= 97) & (then <= 122) | (then >= 128)) & ~begins & ~spelled
    after = np.concatenate([[False], number[:-1]]) & ~new_text
    unit = after & ~number & _among(_UNITS, hashes)
    kinds = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, PLAIN)))
    # 3.5 and 1,000 are one number, and so is twenty-five; neighbouring names are one name.
    joins, between = np.zeros(len(starts), bool), data[starts[1:] - 1]
    both = np.where(spelled[1:] & spelled[:-1], _HYPHEN[between], ~spelled[1:] & ~spelled[:-1] & _INNER[between])
    joins[1:] = ~new_text[1:] & (kinds[1:] == kinds[:-1]) & ((kinds[1:] == NAME) | (kinds[1:] == NUMBER) & (gap[1:] == 1) & both)
    heads = np.flatnonzero(~joins)
    last = np.concatenate([heads[1:], [len(starts)]]) - 1
    kinds = kinds[heads]
    return Templates(np.where(kinds == PLAIN, hashes[heads], _PLACEHOLDER[kinds]), kinds, starts[heads], ends[last], text[heads])


def _windows(t: Templates, size: int) -> np.ndarray:
    """Windows of ``size`` tokens within one text that have enough literal tokens: (first token, hash)."""
    n = len(t.text) - size + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, U)
    plain = np.concatenate([[0], np.cumsum(t.kinds == PLAIN)])
    good = np.flatnonzero((t.text[:n] == t.text[size - 1 :]) & (plain[size:] - plain[:n] >= min(LITERALS, size)))
    return good, ngram_hashes(t.hashes, size)[good]


class HashTable:
    """Open addressing over 64-bit hashes, all of them placed and probed at once; equal ones lie side by side in ``order``."""

    def __init__(self, hashes: np.ndarray):
        self.order = np.argsort(hashes, kind="stable")
        keys, self.n = np.unique(hashes, return_counts=True)
        self.start = np.cumsum(self.n) - self.n
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = U(64 - bits), np.int64((1 << bits) - 1)
        self.slot, self.keys = np.full(1 << bits, -1, np.int32), keys
        at, left = (keys >> self.shift).astype(np.int64), np.arange(len(keys))
        while len(left):
            free = self.slot[at[left]] < 0
            self.slot[at[left[free]]] = left[free]  # of several that want a slot the last one has it
            left = left[self.slot[at[left]] != left]
            at[left] = (at[left] + 1) & self.mask

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of ``hashes``, place of the equal one in the table's input) for every pair that is equal."""
        left, at = np.arange(len(hashes)), (hashes >> self.shift).astype(np.int64)
        key = np.full(len(hashes), -1, np.int64)
        while len(left):
            slot = self.slot[at]
            taken = slot >= 0
            left, at, slot = left[taken], at[taken], slot[taken]
            same = self.keys[slot] == hashes[left]
            key[left[same]] = slot[same]
            left, at = left[~same], (at[~same] + 1) & self.mask
        hit = np.flatnonzero(key >= 0)
        start, n = self.start[key[hit]], self.n[key[hit]]
        return np.repeat(hit, n), self.order[np.repeat(start, n) + places(start, start + n)]


@dataclass
class Index:
    """Windows of readings of a block of the benchmark by their size: a hash table, the reading and the place in it; ``items``: the
    item number of each reading."""

    sizes: dict[int, tuple[HashTable, np.ndarray, np.ndarray]]
    items: list[int]
    tokens: list[tuple[np.ndarray, list[str]]]
    counts: np.ndarray

    def find(self, size: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(which of ``hashes``, number of the reading, place in it) for every pair that is equal."""
        table, item, place = self.sizes[size]
        at, which = table.find(hashes)
        return at, item[which], place[which]


def _slots(t: Templates, data: np.ndarray, a: int, b: int) -> list[str]:
    return [bytes(data[s:e]).decode("utf-8", "replace").lower() if k != PLAIN else "" for s, e, k in zip(t.starts[a:b], t.ends[a:b], t.kinds[a:b])]


def _index(t: Templates, data: np.ndarray, items: np.ndarray) -> Index:
    at = np.searchsorted(t.text, np.arange(len(items) + 1))
    length = np.diff(at)
    counts, found = np.zeros(len(items), np.int64), {}
    for size in sorted({min(WINDOW, int(n)) for n in length if n}):
        first, hashes = _windows(t, size)
        own = (length[t.text[first]] == size) if size < WINDOW else np.ones(len(first), bool)
        first, hashes = first[own], hashes[own]
        if not len(first):
            continue
        item = t.text[first]
        counts += np.bincount(item, minlength=len(items))
        found[size] = (HashTable(hashes), item, first - at[item])
    tokens = [(t.kinds[a:b], _slots(t, data, a, b)) for a, b in zip(at, at[1:])]
    return Index(found, items.tolist(), tokens, counts)


@dataclass
class Readings:
    """The benchmark's ids, and the indexes of its templates and of its plain words."""

    ids: list[int]
    templates: Index
    words: Index


def build_index(items: list[tuple[int, str]]) -> Readings:
    data = np.frombuffer("\n".join(x or "" for _, x in items).encode("utf-8", "surrogatepass"), np.uint8)
    sizes = np.array([len((x or "").encode("utf-8", "surrogatepass")) + 1 for _, x in items])
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    offsets[-1] = len(data)
    words, every = plain_words(data, offsets), np.arange(len(items))
    start, inside = templates(data, words), templates(data, words, inside=True)
    # Only items that begin with a name inside a sentence have a second template.
    differs = np.zeros(len(items), bool)
    if len(words.text):
        at = np.searchsorted(inside.text, every)
        some = np.flatnonzero(np.diff(np.append(at, len(inside.text))))
        differs[some] = inside.kinds[at[some]] == NAME
    kept = differs[inside.text]
    second = np.cumsum(differs) - 1 + len(items)
    both = Templates(*(np.concatenate([x, y[kept]]) for x, y in zip(vars(start).values(), vars(inside).values())))
    both.text = np.concatenate([start.text, second[inside.text[kept]]])
    return Readings([i for i, _ in items], _index(both, data, np.concatenate([every, every[differs]])), _index(words, data, every))


def consistent(hits: list[tuple[int, int]], size: int, kinds: np.ndarray, item: list[str], text: list[str]) -> set[int]:
    """Places in the item of the windows of one occurrence whose slots agree with the most frequent reading of each value."""
    slots = sorted({(p + k, q + k) for q, p in hits for k in range(size) if kinds[p + k] != PLAIN})
    votes: dict[tuple, Counter] = defaultdict(Counter)
    for p, q in slots:
        votes[kinds[p], item[p]][text[q]] += 1
    # The most frequent reading of each value; a text's value stands for one value of the item only.
    reading, taken = {}, set()
    for key, c in sorted(votes.items(), key=lambda x: (-max(x[1].values()), x[0])):
        free = [(n, v) for v, n in c.items() if (key[0], v) not in taken]
        if free:
            reading[key] = max(free, key=lambda x: (x[0], x[1]))[1]
            taken.add((key[0], reading[key]))
    bad = {p for p, q in slots if reading.get((kinds[p], item[p])) != text[q]}
    return {p for _, p in hits if not any(p + k in bad for k in range(size))}


def _longest(places_hit: set[int], size: int) -> int:
    best = run = 0
    for p in sorted(places_hit):
        run = run + 1 if p - 1 in places_hit else 1
        best = max(best, run)
    return best + size - 1 if best else 0


def _held(t: Templates, data: np.ndarray, index: Index, coverage: float) -> Iterator[tuple[int, int, float, int]]:
    """(text, item number, share of the reading's windows, longest run in tokens) for every reading that a text holds."""
    for size in index.sizes:
        first, hashes = _windows(t, size)
        which, item, place = index.find(size, hashes)
        if not len(which):
            continue
        token = first[which]
        row = t.text[token]
        groups: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        # Few pairs have enough distinct windows before slots are looked at; only these go on.
        key = row * len(index.items) + item
        pair, at = np.unique(key * (1 << 20) + np.minimum(place, (1 << 20) - 1), return_index=True)
        enough, n = np.unique(key[at], return_counts=True)
        need = np.minimum(np.ceil(coverage * index.counts[enough % len(index.items)]), max(1, RUN - size + 1))
        good = np.isin(key, enough[n >= need])
        for r, i, q, p in zip(row[good].tolist(), item[good].tolist(), token[good].tolist(), place[good].tolist()):
            groups[r, i].append((q, p))
        for (r, i), hits in groups.items():
            kinds, values = index.tokens[i]
            lo, hi = min(q for q, _ in hits), max(q for q, _ in hits) + size
            own = _slots(t, data, lo, hi)
            kept: set[int] = set()
            diagonals = defaultdict(list)
            for q, p in hits:
                diagonals[q - p].append((q - lo, p))
            for d in diagonals.values():
                kept |= consistent(d, size, kinds, values, own)
            share, run = len(kept) / int(index.counts[i]), _longest(kept, size)
            if kept and (share >= coverage or run >= RUN):
                yield r, index.items[i], share, run


def matches(column: pa.Array, index: Readings, coverage: float = COVERAGE) -> Iterator[tuple[int, int, float, int]]:
    """(row, item_id, share, run) for every item that a text holds, by the reading of which it holds the most."""
    for base, _, data, offsets in in_slices(column):
        words, best = plain_words(data, offsets), {}
        for t, part in ((templates(data, words), index.templates), (words, index.words)):
            for r, i, share, run in _held(t, data, part, coverage):
                best[r, i] = max(best.get((r, i), (0.0, 0)), (share, run))
        for (r, i), (share, run) in best.items():
            yield base + r, index.ids[i], share, run


def _blocks(benchmark: DataFrame) -> Iterator[tuple[Readings, bool]]:
    """The benchmark's indexes, block by block, and whether it is the only one."""
    held, size, before = [], 0, False
    for row in benchmark.where("item_id IS NOT NULL").select(F.col("item_id").cast("bigint"), "text").toLocalIterator():
        if size >= BLOCK:
            yield build_index(held), False
            held, size, before = [], 0, True
        held.append((row[0], row[1]))
        size += len(row[1] or "") // 4 + 1
    if held:
        yield build_index(held), not before


def find_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, item_id, coverage, run) for every item that a document holds."""
    small_batches(docs.sparkSession)
    schema = "doc_id bigint, item_id bigint, coverage double, run bigint"
    context, out = docs.sparkSession.sparkContext, None
    for index, only in _blocks(benchmark):
        shared = context.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, found = batch.column("doc_id"), list(matches(batch.column("text"), shared.value, coverage))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array([x[0] for x in found], pa.int64())), *(pa.array([x[c] for x in found], kind) for c, kind in ((1, pa.int64()), (2, pa.float64()), (3, pa.int64())))],
                    names=["doc_id", "item_id", "coverage", "run"],
                )

        one = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, schema)
        if only:
            return one
        one = written(one)
        shared.destroy()
        out = one if out is None else out.unionAll(one)
    return small_table(docs.sparkSession, [], schema) if out is None else out


def decontaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """``docs`` without the rows that hold an item, all columns as they were."""
    small_batches(docs.sparkSession)
    columns, context = docs.columns, docs.sparkSession.sparkContext
    for index, only in _blocks(benchmark):
        shared = context.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[[x[0] for x in matches(batch.column("text"), shared.value, coverage)]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
        if not only:
            docs = written(docs)
            shared.destroy()
    return docs.select(*columns)
