"""Quality classifier: naive Bayes features in a support vector machine.

Each n-gram of a text is an indicator, hashed to one of 2**20 slots and scaled by the log ratio of the smoothed
counts of its slot in the two classes; a linear hinge-loss model over the scaled, length-normalised indicators is
fitted by dual coordinate descent. N-grams run over words and over word shapes (case, length, signs), so both
vocabulary and typography count. The fit takes at most `per_class` labelled documents of each class, the rest of
the corpus is scored in place: one pass, no shuffle, two tables of 4 MB broadcast whatever the corpus size.

Defined cases: null and empty texts have no features and get the score of the offset alone; without labels of
both classes every score is 0.5; repeated rows are scored alike; null ids are scored and count as not held out; very long texts
are read whole; columns beyond id, text and label, whatever their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadweave.llm.labelled import fold, labelled_sample, logistic, platt
from leadweave.llm.words import IS_WORD, LOWER, U64, batch_slices, column_of, mix, run_keys, runs, string_bytes

BITS = 20
PER_CLASS = 2000
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
# Added to the squared length of a text: the few n-grams of a very short text then decide little.
SHORT = 400.0
_GOLDEN = U64(0x9E3779B97F4A7C15)


def _grams(ids: np.ndarray, text: np.ndarray, longest: int, salt: int):
    """Slots of the 1- to `longest`-grams inside each text."""
    key = mix(ids + U64(salt))
    with np.errstate(over="ignore"):
        for n in range(1, longest + 1):
            if n > 1:
                inside = text[n - 1 :] == text[: len(text) - n + 1]
                key = mix(key[:-1] * _GOLDEN + ids[n - 1 :])
                yield (key[inside] >> U64(64 - BITS)).astype(np.int64), text[n - 1 :][inside]
            else:
                yield (key >> U64(64 - BITS)).astype(np.int64), text


def features(column: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, slot) of every distinct feature of the texts of a slice, in order; only `wanted` slots if given."""
    raw, offsets = string_bytes(column.fill_null(""))
    n_texts = len(offsets) - 1
    word = IS_WORD[raw]
    starts, ends = runs(word, offsets)
    s2, e2 = runs(~word & (raw > 32), offsets)
    kind = np.concatenate([np.ones(len(starts), bool), np.zeros(len(s2), bool)])
    starts, ends = np.concatenate([starts, s2]), np.concatenate([ends, e2])
    order = np.argsort(starts, kind="stable")
    kind, starts, ends = kind[order], starts[order], ends[order]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.searchsorted(offsets, starts, side="right") - 1
    lexical = run_keys(LOWER[raw], starts, ends)
    upper = np.concatenate([[0], np.cumsum((raw >= 65) & (raw <= 90))])
    digit = np.concatenate([[0], np.cumsum((raw >= 48) & (raw <= 57))])
    size = ends - starts
    capitals = upper[ends] - upper[starts]
    case = np.where(capitals == 0, 0, np.where((capitals == size) & (size > 1), 3, np.where(LOWER[raw[starts]] != raw[starts], 1, 2)))
    case = np.where(digit[ends] > digit[starts], 4, case)
    fresh = np.concatenate([[True], text[1:] != text[:-1]])
    line = np.concatenate([[0], np.cumsum(raw == 10)])
    fresh[1:] |= line[starts[1:]] > line[starts[:-1]]
    shape = np.where(kind, (case * 8 + np.minimum(size, 12) // 3 + 1).astype(np.uint64), lexical) * U64(2) + fresh.astype(np.uint64)
    found = [np.zeros(0, np.int64)]
    for ids, longest, salt in ((lexical, 2, 1), (shape, 4, 2)):
        for slot, owner in _grams(ids, text, longest, salt):
            if wanted is not None:
                keep = wanted[slot]
                slot, owner = slot[keep], owner[keep]
            found.append(owner << BITS | slot)
    both = np.unique(np.concatenate(found))
    assert n_texts < 1 << 40
    return both >> BITS, both & ((1 << BITS) - 1)


@dataclass
class Model:
    """`weight` and `square` by slot: contributions to the product with the model and to the squared length."""

    weight: np.ndarray
    square: np.ndarray
    bias: float
    slope: float
    offset: float

    def margins(self, text: np.ndarray, slot: np.ndarray, n: int) -> np.ndarray:
        product = np.bincount(text, self.weight[slot].astype(np.float64), n)
        length = np.bincount(text, self.square[slot].astype(np.float64), n)
        return product / np.sqrt(length + SHORT) + self.bias

    def scores(self, column: pa.Array) -> np.ndarray:
        if not self.slope:
            return np.full(len(column), logistic(np.array([self.offset]))[0])
        text, slot = features(column, self.square > 0)
        return logistic(self.slope * self.margins(text, slot, len(column)) + self.offset)


def log_ratios(rows: list[np.ndarray], label: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """Log ratio of the smoothed relative counts of each slot in class 1 and class 0; 0 where no row has the slot."""
    counts = [smooth + sum((np.bincount(r, minlength=1 << BITS) for r, y in zip(rows, label) if y == k), np.zeros(1 << BITS)) for k in (0, 1)]
    seen = counts[0] + counts[1] > 2 * smooth + 1  # a slot of one document tells nothing
    return np.where(seen, np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum()), 0.0)


def descend(rows: list[np.ndarray], values: list[np.ndarray], label: np.ndarray, cost: np.ndarray, seed: int = 7,
            rounds: int = 20) -> tuple[np.ndarray, float]:
    """Hinge-loss weights and bias by dual coordinate descent, one multiplier per document kept in [0, cost]."""
    sign = np.where(label == 1, 1.0, -1.0)
    w, bias = np.zeros(1 << BITS), 0.0
    alpha = np.zeros(len(rows))
    curve = np.array([v @ v + 1.0 for v in values])
    random = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in random.permutation(len(rows)):
            gradient = sign[i] * (w[rows[i]] @ values[i] + bias) - 1
            new = min(max(alpha[i] - gradient / curve[i], 0.0), cost[i])
            step = (new - alpha[i]) * sign[i]
            if step:
                w[rows[i]] += step * values[i]
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-4:
            break
    return w, bias


def fit(rows: list[np.ndarray], label: np.ndarray, sizes: dict[int, int], cost: float = 1.0) -> Model:
    """Fits on four fifths of the sample and calibrates on the rest, weighted to the class sizes of all labels."""
    number = np.array([(label == 0).sum(), (label == 1).sum()])
    if number.min() < 5:
        return Model(np.zeros(1 << BITS, np.float32), np.zeros(1 << BITS, np.float32), 0.0, 0.0, 0.0)
    rank = np.zeros(len(rows), int)
    for k in (0, 1):
        rank[label == k] = np.arange(number[k])
    test = rank % 5 == 4
    train = np.flatnonzero(~test)
    ratio = log_ratios([rows[i] for i in train], label[train])
    kept = [r[ratio[r] != 0] for r in rows]
    values = [ratio[r] / np.sqrt(ratio[r] @ ratio[r] + SHORT) for r in kept]
    share = number[label[train]] * 2 / number.sum()
    w, bias = descend([kept[i] for i in train], [values[i] for i in train], label[train], cost / share)
    margin = np.array([w[kept[i]] @ values[i] + bias for i in np.flatnonzero(test)])
    weight = np.array([sizes.get(0, 0) / number[0], sizes.get(1, 0) / number[1]])[label[test]]
    slope, offset = platt(margin, label[test].astype(float), weight)
    return Model((w * ratio).astype(np.float32), (ratio * ratio).astype(np.float32), float(bias), slope, offset)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> Model:
    sample, sizes = labelled_sample(docs, labels, label, FOLDS, HELD_OUT, per_class)

    def read(batches):
        for part in batch_slices(batches, "text"):
            text, slot = features(column_of(part, "text"))
            cuts = np.searchsorted(text, np.arange(1, part.num_rows))
            packed = pa.array([x.astype(np.int32).tobytes() for x in np.split(slot, cuts)], pa.binary())
            yield pa.RecordBatch.from_arrays([column_of(part, "doc_id"), column_of(part, "label"), packed], ["doc_id", "label", "slots"])

    id_type = sample.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("label", T.IntegerType()), T.StructField("slots", T.BinaryType())])
    rows = sorted(sample.mapInArrow(read, schema).collect(), key=lambda r: r["doc_id"])  # at most 2 * per_class
    return fit([np.frombuffer(r["slots"], np.int32) for r in rows], np.array([r["label"] for r in rows], int), sizes)


def score_rows(docs: DataFrame, model: Model, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for part in batch_slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([column_of(part, "id"), pa.array(shared.value.scores(column_of(part, "text")))], ["id", "score"])

    pairs = docs.select(docs[id_column].alias("id"), docs[text].cast("string").alias("text"))
    return pairs.mapInArrow(score, T.StructType([T.StructField("id", docs.schema[id_column].dataType), T.StructField("score", T.DoubleType())]))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, per_class: int = PER_CLASS) -> DataFrame:
    """The rows of `docs` that reach the threshold, columns as they were."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, per_class=per_class))
    at = docs.columns.index("text")

    def keep(batches):
        for part in batch_slices(batches, "text"):
            yield part.filter(pa.array(shared.value.scores(part.column(at)) >= threshold))

    return docs.mapInArrow(keep, docs.schema)


def quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    scored = score_rows(docs, train(docs, labels, per_class=per_class))
    return scored.select(
        F.col("id").alias("doc_id"), F.coalesce(fold(F.col("id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
