"""Toxic passages as maximum-scoring segments.

Tokens are words and their beginnings of 4 to 8 bytes, so that unseen forms of a known word are met. A token counts
once a text, since words come in bursts, and once for all texts in which it stands between the same four words: copies, near
copies and shared passages are no further evidence. Tokens whose share differs between the classes by more than the chance
maximum over all words of the sample (likelihood ratio) have their log-odds under a Dirichlet prior whose pseudo-counts
follow their share of the whole corpus, drawn towards zero by the standard error. A word scores as its token with the largest
log-odds either way, less a drift solved so that the mean score of the corpus's words is `MEAN` or less. One linear scan finds
all maximal scoring segments of a text. A segment of score S in a text of n words has the extreme-value expectation
K * n * exp(-lambda * S), with lambda from the score distribution of the corpus and K from clean texts that the token table has
not seen; a text's evidence is the sum over its segments of what their expectation lies below 1, and a logistic curve, fitted
on unseen texts too, turns it into a score.

The token table comes from at most `per_class` labelled texts of each class, three quarters of them; the other quarter
calibrates. Prior counts and score distribution cover all documents. Scoring is one pass without a shuffle; the broadcast
table is bounded by the sample.

Defined cases: null and empty texts have no words, no segments and the score of no evidence; very long texts are read whole,
their expectation grows with their length; without labels of both classes every score is 0.5; repeated rows are scored alike;
null ids are scored and count as not held out; columns beyond id, text and label, whatever their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadweave.llm.labelled import fold, labelled_sample, logistic, platt
from leadweave.llm.words import U64, batch_slices, column_of, mix, run_keys, words_of
from leadweave.session import cut

PER_CLASS = 4000
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
BEGINNINGS = (4, 5, 6, 7, 8)
PRIOR = 0.1  # pseudo-counts of the whole prior, as a share of the sample's texts
MEAN = -0.05  # largest mean score of a word of the corpus
APART, CALIBRATES = 4, 0  # hash parts of the sample; the part that calibrates
EULER = 0.5772156649015329


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) of a sequence; only positive scores are visited one by one."""
    ahead = np.concatenate([[0.0], np.cumsum(scores)])
    out: list[list] = []  # first, last, sum before the segment, sum at its end
    for i in np.flatnonzero(scores > 0):
        now = [int(i), int(i), float(ahead[i]), float(ahead[i + 1])]
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][2] >= now[2]:
                j -= 1
            if j < 0 or out[j][3] >= now[3]:
                out.append(now)
                break
            now = [out[j][0], now[1], out[j][2], now[3]]
            del out[j:]
    return [(a, b, hi - lo) for a, b, lo, hi in out]


def token_keys(words):
    """For the whole word and each beginning: (word number, key), for words longer than the beginning."""
    yield np.arange(len(words.starts)), words.keys()
    size = words.ends - words.starts
    for n in BEGINNINGS:
        at = np.flatnonzero(size > n)
        yield at, run_keys(words.low, words.starts[at], words.starts[at] + n) ^ U64(n)


class Lookup:
    """Numbers of known keys; a small table of leading bits turns most others away."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys  # sorted
        self.lead = np.zeros(1 << 16, bool)
        self.lead[(keys >> U64(48)).astype(np.int64)] = True

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in `keys`, number of the known key) of those that are known."""
        at = np.flatnonzero(self.lead[(keys >> U64(48)).astype(np.int64)])
        number = np.searchsorted(self.keys, keys[at])
        known = self.keys[np.minimum(number, len(self.keys) - 1)] == keys[at] if len(self.keys) else np.zeros(0, bool)
        return at[known], number[known]


@dataclass
class Model:
    known: Lookup
    scores: np.ndarray  # log-odds of the known tokens, drawn towards zero
    drift: float = 0.0
    scale: float = 1.0  # lambda
    log_k: float = 0.0
    slope: float = 0.0
    offset: float = 0.0

    def word_scores(self, words) -> np.ndarray:
        high, low = np.zeros(len(words.starts)), np.zeros(len(words.starts))
        for at, keys in token_keys(words):
            place, number = self.known.find(keys)
            np.maximum.at(high, at[place], self.scores[number])
            np.minimum.at(low, at[place], self.scores[number])
        return np.where(high >= -low, high, low) - self.drift

    def segments(self, column: pa.Array):
        """Per text of a slice: its number of words and its maximal segments."""
        words = words_of(column)
        scores = self.word_scores(words)
        positive = np.concatenate([[0], np.cumsum(scores > 0)])[words.first]
        return words.counts, [maximal_segments(scores[a:b]) if more else []
                              for a, b, more in zip(words.first[:-1], words.first[1:], np.diff(positive) > 0)]

    def evidence(self, n_words: int, segments) -> float:
        base = self.log_k + np.log(max(n_words, 1))
        return sum(max(0.0, self.scale * s - base) for _, _, s in segments)

    def score_texts(self, column: pa.Array) -> np.ndarray:
        counts, found = self.segments(column)
        x = np.array([self.evidence(n, s) for n, s in zip(counts, found)])
        return logistic(self.slope * np.log1p(x) + self.offset)

    def passages(self, n_words: int, segments) -> list[dict]:
        """The significant segments: expectation below 1."""
        base = self.log_k + np.log(max(n_words, 1))
        return [{"first": a, "last": b, "score": s, "expected": float(np.exp(base - self.scale * s))}
                for a, b, s in segments if self.scale * s > base]


def _once(keys: np.ndarray, owner: np.ndarray, rest: np.ndarray | None = None):
    """Each (key, text) once, with the least `rest` of its rows if given."""
    order = np.lexsort((keys, owner) if rest is None else (rest, keys, owner))
    keys, owner = keys[order], owner[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    return (keys[new], owner[new]) if rest is None else (keys[new], owner[new], rest[order][new])


def contexts(words) -> np.ndarray:
    """A key of the two words before and the two after each word, within its text."""
    keys, text = words.keys(), words.text_of
    out = np.zeros(len(keys), np.uint64)
    for step in (-2, -1, 1, 2):
        at = np.arange(len(keys)) + step
        inside = (at >= 0) & (at < len(keys))
        at = np.clip(at, 0, max(len(keys) - 1, 0))
        beside = np.where(inside & (text[at] == text), keys[at], U64(0))
        out = mix(out * U64(0x9E3779B97F4A7C15) + beside)
    return out


def significance(n0, n1, all0: int, all1: int) -> np.ndarray:
    """Signed root of the likelihood ratio of a token's shares of the two classes; positive: more of class 1."""
    n0, n1 = np.asarray(n0, float), np.asarray(n1, float)
    e1 = np.maximum((n0 + n1) * all1 / (all0 + all1), 1e-12)
    e0 = np.maximum((n0 + n1) - e1, 1e-12)
    ratio = sum(np.where(n > 0, n * np.log(np.maximum(n, 1e-12) / e), 0) for n, e in ((n0, e0), (n1, e1)))
    return np.sign(n1 - e1) * np.sqrt(2 * np.maximum(ratio, 0))


def _sample_counts(sample: DataFrame):
    """(keys, texts of class 0, of class 1, size of the classes) of the sample's tokens that tell the classes apart."""

    def count(batches):
        for part in batch_slices(batches, "text"):
            words = words_of(column_of(part, "text"))
            label, owner = np.asarray(column_of(part, "label")), words.text_of
            found = [_once(keys, owner[at]) for at, keys in token_keys(words)]
            for y in (0, 1):
                unique, n = np.unique(np.concatenate([k[label[t] == y] for k, t in found]), return_counts=True)
                unique, n = np.append(unique, U64(0)), np.append(n, (label == y).sum())  # key 0: all texts
                yield pa.RecordBatch.from_arrays(
                    [pa.array(unique.view(np.int64)), pa.array(np.full(len(n), y, np.int32)), pa.array(n.astype(np.int64))], ["key", "label", "n"])
            yield pa.RecordBatch.from_arrays(  # label 2: all words
                [pa.array([0], pa.int64()), pa.array([2], pa.int32()), pa.array([len(words.starts)], pa.int64())], ["key", "label", "n"])

    of = lambda y: F.sum(F.when(F.col("label") == y, F.col("n")).otherwise(0)).alias(f"n{y}")
    rows = sample.mapInArrow(count, "key long, label int, n long").groupBy("key").agg(of(0), of(1), of(2))
    total = rows.filter("key = 0").first()
    all0, all1 = (int(total["n0"]), int(total["n1"])) if total else (0, 0)
    if not all0 or not all1:
        return np.zeros(0, np.uint64), np.zeros(0), np.zeros(0), all0, all1
    least = float(np.sqrt(2 * np.log(max(total["n2"], 2))))
    # as in `significance`, to leave out most tokens before they reach the driver
    e1 = (F.col("n0") + F.col("n1")) * all1 / (all0 + all1)
    part = lambda n, e: F.when(n > 0, n * F.log(n / e)).otherwise(0)
    ratio = 2 * (part(F.col("n0"), F.col("n0") + F.col("n1") - e1) + part(F.col("n1"), e1))
    kept = rows.filter((F.col("key") != 0) & (ratio > 0.99 * least**2)).select("key").toArrow()
    keys = np.sort(np.asarray(kept["key"]).view(np.uint64))
    n0, n1 = _apart_counts(sample, Lookup(keys))
    sure = np.abs(significance(n0, n1, all0, all1)) > least
    return keys[sure], n0[sure], n1[sure], all0, all1


def _apart_counts(sample: DataFrame, known: Lookup) -> tuple[np.ndarray, np.ndarray]:
    """In how many texts of each class each known token stands, texts with the same words around it counted once."""
    shared = sample.sparkSession.sparkContext.broadcast(known)

    def find(batches):
        for part in batch_slices(batches, "text"):
            words = words_of(column_of(part, "text"))
            label, owner, around = np.asarray(column_of(part, "label")), words.text_of, contexts(words)
            for at, keys in token_keys(words):
                place, number = shared.value.find(keys)
                number, text, context = _once(number, owner[at[place]], around[at[place]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number.astype(np.int64)), pa.array(label[text].astype(np.int32)), pa.array(context.view(np.int64))], ["at", "label", "context"])

    rows = sample.mapInArrow(find, "at long, label int, context long").distinct().groupBy("at", "label").agg(F.count(F.lit(1)).alias("n")).toArrow()  # bounded by the table
    out = np.zeros((2, len(known.keys)), np.int64)
    out[np.asarray(rows["label"]), np.asarray(rows["at"])] = np.asarray(rows["n"])
    return out[0], out[1]


def _corpus_counts(docs: DataFrame, known: Lookup) -> tuple[np.ndarray, int]:
    """In how many of all documents each known token stands, and the number of documents."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def count(batches):
        lookup, texts = shared.value, 0
        total = np.zeros(len(lookup.keys), np.int64)
        for part in batch_slices(batches, "text"):
            words = words_of(column_of(part, "text"))
            texts, owner = texts + words.n_texts, words.text_of
            for at, keys in token_keys(words):
                place, number = lookup.find(keys)
                total += np.bincount(np.unique(owner[at[place]] * max(len(total), 1) + number) % max(len(total), 1), minlength=len(total))
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(hit, -1)), pa.array(np.append(total[hit], texts))], ["at", "n"])

    rows = _texts(docs).mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()  # bounded by the table
    at, n = np.asarray(rows["at"]), np.asarray(rows["n"])
    out = np.zeros(len(known.keys), np.int64)
    out[at[at >= 0]] = n[at >= 0]
    return out, int(n[at < 0].sum())


def _score_shares(docs: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The word scores that occur in all documents, in steps of 0.05, and the share of each."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def count(batches):
        total: dict[int, int] = {}
        for part in batch_slices(batches, "text"):
            steps, n = np.unique(np.rint(shared.value.word_scores(words_of(column_of(part, "text"))) / 0.05).astype(np.int64), return_counts=True)
            for a, b in zip(steps.tolist(), n.tolist()):
                total[a] = total.get(a, 0) + b
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["step", "n"])

    rows = _texts(docs).mapInArrow(count, "step long, n long").groupBy("step").agg(F.sum("n").alias("n")).toArrow()  # a few hundred
    n = np.asarray(rows["n"]).astype(float)
    return np.asarray(rows["step"]) * 0.05, n / max(n.sum(), 1)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("text").cast("string").alias("text"))


def token_table(n0, n1, all0: int, all1: int, corpus: np.ndarray, corpus_texts: int) -> np.ndarray:
    """Log-odds of each token from its counts in the two classes and in the corpus, drawn towards zero."""
    prior = PRIOR * (all0 + all1)
    alpha = prior * np.maximum(corpus, n0 + n1) / max(corpus_texts, all0 + all1, 1)
    odds = [np.log((n + alpha) / np.maximum(total + prior - n - alpha, 1e-9)) for n, total in ((n0, all0), (n1, all1))]
    error = np.sqrt(1 / (n0 + alpha) + 1 / (n1 + alpha))
    delta = odds[1] - odds[0]
    return np.sign(delta) * np.maximum(np.abs(delta) - error, 0)


def extreme_scale(scores: np.ndarray, share: np.ndarray) -> float:
    """The positive lambda at which the mean of exp(lambda * score) is 1; 1 if no score is positive (then there is no segment)."""
    mean = lambda x: float(share @ np.exp(np.minimum(x * scores, 300)))
    if not len(scores) or not (scores * (share > 0) > 0).any():
        return 1.0
    lo, hi = 0.0, 1.0
    while mean(hi) < 1:
        lo, hi = hi, hi * 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if mean(mid) < 1 else (lo, mid)
    return hi


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> Model:
    sample, sizes = labelled_sample(docs, labels, label, FOLDS, HELD_OUT, per_class)
    sample = cut(sample, "toxicity-sample")
    part = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(APART))
    keys, n0, n1, all0, all1 = _sample_counts(sample.filter(part != CALIBRATES))
    known = Lookup(keys)
    if not all0 or not all1:
        return Model(known, np.zeros(0))
    corpus, corpus_texts = _corpus_counts(docs, known)
    model = Model(known, token_table(n0, n1, all0, all1, corpus, corpus_texts))
    scores, share = _score_shares(docs, model)
    model.drift = float(max(0.0, share @ scores) - MEAN)
    model.scale = extreme_scale(scores - model.drift, share)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def best(batches):
        for batch in batch_slices(batches, "text"):
            counts, found = shared.value.segments(column_of(batch, "text"))
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "label"), column_of(batch, "unseen"), pa.array(counts.astype(np.int64)),
                 pa.array([[s for _, _, s in f] for f in found], pa.list_(pa.float64()))], ["label", "unseen", "n", "scores"])

    tested = sample.select("label", (part == CALIBRATES).alias("unseen"), "text")
    rows = tested.mapInArrow(best, "label int, unseen boolean, n long, scores array<double>").collect()  # at most 2 * per_class
    unseen = [r for r in rows if r["unseen"]]
    if len({r["label"] for r in unseen}) == 2:  # else the sample is tiny
        rows = unseen
    clean = [model.scale * max(r["scores"], default=0.0) - np.log(max(r["n"], 1)) for r in rows if r["label"] == 0]
    model.log_k = float(np.mean(clean) - EULER)
    y = np.array([r["label"] for r in rows])
    x = np.log1p([model.evidence(r["n"], [(0, 0, s) for s in r["scores"]]) for r in rows])
    number = np.array([(y == 0).sum(), (y == 1).sum()])
    if number.min():
        model.slope, model.offset = platt(x, y.astype(float), np.array([sizes[0] / number[0], sizes[1] / number[1]])[y])
    return model


def score_rows(docs: DataFrame, model: Model, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, score, passages) of every row; passages are word ranges with score and expectation."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))

    def score(batches):
        m = shared.value
        for part in batch_slices(batches, "text"):
            counts, found = m.segments(column_of(part, "text"))
            x = np.array([m.evidence(n, s) for n, s in zip(counts, found)])
            passages = pa.array([m.passages(n, s) for n, s in zip(counts, found)], kind)
            yield pa.RecordBatch.from_arrays(
                [column_of(part, "id"), pa.array(logistic(m.slope * np.log1p(x) + m.offset)), passages], ["id", "score", "passages"])

    pairs = docs.select(docs[id_column].alias("id"), docs[text].cast("string").alias("text"))
    fields = T.StructType.fromDDL("score double, passages array<struct<first: long, last: long, score: double, expected: double>>")
    return pairs.mapInArrow(score, T.StructType([T.StructField("id", docs.schema[id_column].dataType), *fields]))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, per_class: int = PER_CLASS) -> DataFrame:
    """The rows of `docs` that stay below the threshold, columns as they were."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, per_class=per_class))
    at = docs.columns.index("text")

    def keep(batches):
        for part in batch_slices(batches, "text"):
            yield part.filter(pa.array(shared.value.score_texts(part.column(at)) < threshold))

    return docs.mapInArrow(keep, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, predicted and the toxic passages of every document."""
    scored = score_rows(docs, train(docs, labels, per_class=per_class))
    return scored.select(
        F.col("id").alias("doc_id"), F.coalesce(fold(F.col("id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "passages")
