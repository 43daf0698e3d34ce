"""Quality classifier: supervised subword embeddings, averaged per document, softmax output, numpy gradient descent.

Features of a text: each of its words (split at white space), the character n-grams of each word between ``<`` and ``>``,
and each pair of neighbouring words (a word after itself counts as one same pair, whatever the word).  Each feature is
hashed to a bucket; a bucket has a learned vector; a document is the mean of its features' vectors.

Training happens in one task on a bounded sample: at most ``max_rows`` labelled rows, chosen by a hash of their id.
Executors count the features of their texts, so that neither texts nor counts go to the driver; counts are taken in the order
of the hash as long as they fit in ``max_features`` (distinct buckets of a text, 4 bytes each).  A row that doesn't fit is left out and the next one is looked at, so
one long text costs itself alone.  Texts are never cut.  The sample, its order and the start values are fixed, so the same
tables give the same model.

Scoring is linear once vectors are averaged, so executors get one number per bucket (vector times the difference of the
two classes' output weights): ``2 ** bits`` floats, a fixed size.  Whole texts are scored, Arrow batch by Arrow batch.

Defined cases: null and empty texts have no features and get the score of the bias alone; labels that are null or not 0
or 1, and labelled rows without a document, are no training rows; repeated rows each get their score; without any
training row, or with one class only, every score is the share of label 1 among them (0.5 without any); further columns
are ignored; an empty table gives an empty result; a text of any length is scored whole, in pieces that end between words
(a word above that size alone); of labelled ids with several documents each is a row, in order of their features.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, written
from .hashing import MIX1, MIX2, STEP, mix, places, powers, word_bounds

BITS, DIM, MIN_N, MAX_N = 18, 8, 3, 5
#: Small samples are gone through more often: at least STEPS batches are taken.
EPOCHS, STEPS, BATCH, RATE = 8, 1_200, 32, 0.5
#: A sampled text's features are kept in 32 bits each, bucket and count.
COUNT_BITS = 14
MOST = np.uint32((1 << COUNT_BITS) - 1)
#: Bounds of the sample: labelled rows, and distinct features of their texts, summed over the rows.
MAX_ROWS, MAX_FEATURES = 6_000, 40_000_000
THRESHOLD = 0.3
#: Characters that are worked on at a time.
SLICE_CHARS = 300_000
SPACES = " \t\n\x0b\x0c\r"
SPACE = re.compile(f"[{SPACES}]")


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text is divisible by 5.  A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def feature_runs(texts: list[str], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of the texts, and the text number of each."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    starts, ends, text = word_bounds((points == 32) | (points >= 9) & (points <= 13), offsets)
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    # Words between marks, each followed by a gap: n-grams that touch a gap belong to no word.
    lengths = ends - starts + 3
    begin = np.cumsum(lengths) - lengths
    symbols = np.zeros(int(lengths.sum()), np.uint64)
    symbols[begin], symbols[begin + lengths - 2] = ord("<"), ord(">")
    inner = places(starts, ends)
    symbols[np.repeat(begin + 1, ends - starts) + inner] = points[np.repeat(starts, ends - starts) + inner]
    owner = np.repeat(text, lengths)
    gap = symbols == 0
    mixed = mix((symbols + np.uint64(1)) * STEP)
    shift = np.uint64(64 - bits)
    place = np.arange(len(symbols)) - np.repeat(begin, lengths)
    words = mix(np.add.reduceat(mixed * powers(int(place.max()) + 1)[place], begin))
    found, of = [words >> shift], [text]
    p = powers(MAX_N, MIX2)
    total, broken = np.zeros(len(symbols), np.uint64), np.zeros(len(symbols), bool)
    for n in range(1, MAX_N + 1):
        m = len(symbols) - n + 1
        if m <= 0:
            break
        total = total[:m] + mixed[n - 1 :] * p[n - 1]
        broken = broken[:m] | gap[n - 1 :]
        if n >= MIN_N:
            whole = np.flatnonzero(~broken)
            found.append(mix(total[whole] + np.uint64(n)) >> shift)
            of.append(owner[whole])
    near = np.flatnonzero(text[1:] == text[:-1])
    a, b = words[near], words[near + 1]
    found.append(mix(np.where(a == b, STEP, a * MIX1 + b * MIX2)) >> shift)
    of.append(text[near])
    return np.concatenate(found).astype(np.int64), np.concatenate(of)


@dataclass
class QualityModel:
    """``vectors``: bucket by dimension; ``output``: dimension by class; ``bias``: by class; ``share``: constant score, if any."""

    vectors: np.ndarray
    output: np.ndarray
    bias: np.ndarray
    bits: int = BITS
    share: float | None = None

    def folded(self) -> tuple[np.ndarray, float]:
        """Per bucket, what a feature adds to the difference of the two classes' logits; and the bias' difference."""
        if self.share is not None:
            return np.zeros(1 << self.bits, np.float32), float(np.log(self.share) - np.log(1 - self.share))
        return (self.vectors @ (self.output[:, 1] - self.output[:, 0])).astype(np.float32), float(self.bias[1] - self.bias[0])


def parts(text: str, bits: int = BITS) -> Iterator[tuple[np.ndarray, int]]:
    """(buckets, sign) of which the sum is a text's features.  A long text is gone through in pieces of whole words: a piece
    begins with the last word before it, for the pair across the border, and that word's own features are taken off again."""
    at, last = 0, ""
    while at < len(text) or not at:
        end = at + SLICE_CHARS
        space = SPACE.search(text, end)
        end = space.start() if space else len(text)
        piece = text[at:end]
        yield feature_runs([f"{last} {piece}"], bits)[0], 1
        if last:
            yield feature_runs([last], bits)[0], -1
        whole = piece.rstrip(SPACES)
        last = whole[max(whole.rfind(c) for c in SPACES) + 1 :] or last
        if end >= len(text):
            break
        at = end


def counted(text: str, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's features, ascending, and how often each occurs."""
    if len(text) <= SLICE_CHARS:
        return np.unique(feature_runs([text], bits)[0], return_counts=True)
    total = np.zeros(1 << bits, np.int64)
    for buckets, sign in parts(text, bits):
        total += sign * np.bincount(buckets, minlength=1 << bits)
    at = np.flatnonzero(total)
    return at, total[at]


def pack(at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Buckets with counts in 32 bits each; a count above MOST is written as several entries of its bucket."""
    again = -(-n // MOST)
    if (again > 1).any():
        more = np.repeat(n, again) - MOST * places(np.zeros(len(n), np.int64), again)
        at, n = np.repeat(at, again), np.minimum(more, MOST)
    return (at.astype(np.uint32) << COUNT_BITS) | n.astype(np.uint32)


def fit(rows: Iterator[tuple[np.ndarray, int]], bits: int = BITS, dim: int = DIM, epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> QualityModel:
    """Stochastic gradient descent over batches of documents (packed features, label); the rate falls linearly to zero."""
    docs, labels, total = [], [], []
    for packed, label in rows:
        docs.append(packed)
        labels.append(int(label))
        total.append(max(1, int((packed & MOST).sum(dtype=np.int64))))
    y = np.array(labels, np.int64)
    rng = np.random.default_rng(seed)
    vectors = np.empty((1 << bits, dim), np.float32)
    for i in range(0, 1 << bits, 1 << 12):
        vectors[i : i + (1 << 12)] = (rng.random((1 << min(12, bits), dim)) - 0.5) / dim
    output, bias = np.zeros((dim, 2), np.float32), np.zeros(2, np.float32)
    if len(set(labels)) < 2:
        return QualityModel(vectors, output, bias, bits, min(max(float(y.mean()) if len(y) else 0.5, 1e-6), 1 - 1e-6))
    a_round = -(-len(docs) // BATCH)
    epochs, step = max(epochs, -(-STEPS // a_round)), 0
    steps = epochs * a_round
    present, place = np.zeros(1 << bits, bool), np.zeros(1 << bits, np.int64)
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for i in range(0, len(docs), BATCH):
            part = order[i : i + BATCH]
            packed = np.concatenate([docs[k] for k in part])
            row = np.repeat(np.arange(len(part)), [len(docs[k]) for k in part])
            at, share = (packed >> COUNT_BITS).astype(np.int64), (packed & MOST) / np.array([total[k] for k in part])[row]
            present[at] = True
            used = np.flatnonzero(present)
            present[used], place[used] = False, np.arange(len(used))
            local, own = place[at], vectors[used]
            per_class = (own @ output).astype(np.float64)
            logits = np.stack([np.bincount(row, share * per_class[local, c], len(part)) for c in (0, 1)], 1) + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(part)), y[part]] -= 1
            p /= 8  # of a batch of 32: larger steps than its mean, as single documents would make
            lr = rate * (1 - step / steps)
            step += 1
            # Gradient of a bucket: for each class the sum over documents of error times the bucket's share of the document.
            g = np.stack([np.bincount(local, share * p[row, c], len(used)) for c in (0, 1)], 1).astype(np.float32)
            vectors[used] = own - np.float32(8 * lr) * (g @ output.T)
            output -= np.float32(lr) * (own.T @ g)
            bias -= lr * p.sum(0).astype(np.float32)
    return QualityModel(vectors, output, bias, bits)


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_rows: int = MAX_ROWS) -> DataFrame:
    """(o, label, h, text) of the labelled rows that may be in the sample: different texts of the first ``max_rows`` labelled
    ids that aren't held out, in order of a hash of the id."""
    chosen = (
        labels.where(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .select("doc_id", F.col(label_col).cast("int").alias("label"), F.xxhash64("doc_id").alias("o"))
        .distinct()
        .orderBy("o", "label")
        .limit(max_rows)
    )
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    return found.select("o", "label", F.xxhash64("text").alias("h"), "text").dropDuplicates(["o", "label", "h"])


def _counter(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, text in enumerate(batch.column("text").to_pylist()):
                own = [batch.column(c).slice(k, 1) for c in ("o", "label", "h")]
                packed = pack(*counted(text, bits))
                yield pa.RecordBatch.from_arrays([*own, pa.array([len(packed)], pa.int64()), pa.array([packed.tobytes()], pa.binary())], names=["o", "label", "h", "size", "packed"])

    return run


def sample_table(docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES) -> DataFrame:
    """(label, packed) of the training sample, in order, as one partition of at most ``max_rows`` rows and 4 * ``max_features`` bytes.

    The driver sees the sizes of the features only.
    """
    small_batches(docs.sparkSession, 200)
    rows = written(training_rows(docs, labels, label_col, max_rows).mapInArrow(_counter(BITS), "o bigint, label int, h bigint, size bigint, packed binary"))
    names, left = [], max_features
    for r in rows.select("o", "label", "h", "size").orderBy("o", "label", "h").limit(max_rows).collect():
        if r["size"] <= left:
            left -= r["size"]
            names.append((r["o"], r["label"], r["h"]))
    chosen = docs.sparkSession.createDataFrame(names, "o bigint, label int, h bigint")
    return rows.join(F.broadcast(chosen), ["o", "label", "h"], "left_semi").coalesce(1).sortWithinPartitions("o", "label", "h").select("label", "packed")


def sample(*args, **kwargs) -> Iterator[tuple[np.ndarray, int]]:
    """(packed features, label) of ``sample_table``."""
    for r in sample_table(*args, **kwargs).toLocalIterator():
        yield np.frombuffer(r["packed"], np.uint32), r["label"]


_MODEL = "vectors binary, output binary, bias binary, share double"


def _fit_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = ((np.frombuffer(x.as_py(), np.uint32), y.as_py()) for batch in batches for x, y in zip(batch.column("packed"), batch.column("label")))
    model = fit(rows)
    arrays = [pa.array([x.tobytes()], pa.binary()) for x in (model.vectors, model.output, model.bias)]
    yield pa.RecordBatch.from_arrays([*arrays, pa.array([model.share], pa.float64())], names=["vectors", "output", "bias", "share"])


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES) -> QualityModel:
    """The model, fitted within one task; only its vectors come to the driver."""
    found = sample_table(docs, labels, label_col, max_rows, max_features).mapInArrow(_fit_task, _MODEL).collect()
    if not found:
        return fit(iter(()))
    r = found[0]
    vectors, output, bias = (np.frombuffer(r[c], np.float32) for c in ("vectors", "output", "bias"))
    return QualityModel(vectors.reshape(-1, DIM), output.reshape(DIM, 2), bias, BITS, r["share"])


def logits(texts: list[str], add: np.ndarray, bias: float, bits: int = BITS) -> np.ndarray:
    out = np.full(len(texts), bias)
    i = 0
    while i < len(texts):  # slices of bounded size; a longer text alone
        j, size = i + 1, len(texts[i])
        if size > SLICE_CHARS:
            total = n = 0
            for buckets, sign in parts(texts[i], bits):
                total, n = total + sign * float(add[buckets].sum(dtype=np.float64)), n + sign * len(buckets)
            out[i] += total / max(1, n)
            i = j
            continue
        while j < len(texts) and size + len(texts[j]) <= SLICE_CHARS:
            size += len(texts[j])
            j += 1
        buckets, of = feature_runs(texts[i:j], bits)
        n = np.bincount(of, minlength=j - i)
        out[i:j] += np.bincount(of, add[buckets], j - i) / np.maximum(n, 1)
        i = j
    return out


def _scorer(shared, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        add, bias = shared.value
        for batch in batches:
            x = logits([t or "" for t in batch.column("text").to_pylist()], add, bias, bits)
            kept = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(1 / (1 + np.exp(-x)))], names=[*kept, "score"])

    return run


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``doc_id`` and ``score``, the probability of label 1, per row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model.folded())
    return docs.select("doc_id", "text").mapInArrow(_scorer(shared, model.bits), "doc_id bigint, score double")


def rejected_removed(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` with a score of ``threshold`` or more, all columns as they were."""
    small_batches(docs.sparkSession)
    shared, columns = docs.sparkSession.sparkContext.broadcast(model.folded()), docs.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = _scorer(shared, model.bits)
        for batch in batches:
            scored = next(run(iter([batch.select(["text"])])))
            yield batch.filter(pa.array(scored.column("score").to_numpy() >= threshold))

    return docs.mapInArrow(keep, docs.schema).select(*columns)
