"""A quality classifier: support vectors over naive Bayes features.

Features are indicators of n-grams: runs of one to three bytes, and runs of one to three word shapes
(how a word begins and ends, how long it is, whether it repeats one of the two words before). Each is
scaled by its log-count ratio between the classes; a linear hinge-loss model is then fitted by dual
coordinate descent, and its margins turned into probabilities on
rows that it wasn't fitted to.

Fitted to a bounded sample of labelled rows (`SAMPLE`); every document is scored on its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeops.llm.hashing import mix, parts, word_hashes, word_spans
from lakeops.llm.registry import query, table
from lakeops.llm.workers import release

BITS = 18
SAMPLE = 8_000  # labelled rows that the model is fitted to, at most about
CUT = 0.3

# What a byte is: letter or part of a longer character, digit, sentence mark, other symbol.
KIND = np.full(256, 3, np.uint64)
for _low, _high, _kind in ((48, 57, 1), (65, 90, 0), (97, 122, 0), (128, 255, 0)):
    KIND[_low:_high + 1] = _kind
KIND[[ord(c) for c in ".,;:!?'\"()-"]] = 2


def _hashed(grams: np.ndarray, family: int) -> np.ndarray:
    return (mix(grams * np.uint64(16) + np.uint64(family)) >> np.uint64(64 - BITS)).astype(np.uint32)


def features(text: str | None) -> np.ndarray:
    """The sorted distinct features of a text, as numbers below 2 ** BITS. Long texts are read part by part."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    found: list[np.ndarray] = []
    # The last two words and shapes of the part before go on into the next one.
    known, shape = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    for a, b in parts(data):
        wide = data[max(a - 2, 0):b].astype(np.uint64)
        grams = wide
        for n in (1, 2, 3):
            if len(wide) < n:
                break
            grams = wide if n == 1 else (grams[:-1] << np.uint64(8)) | wide[n - 1:]
            found.append(_hashed(grams, n))
        part = data[a:b]
        begins, ends = word_spans(part)
        if len(begins):
            old, words = len(known), np.concatenate((known, word_hashes(part, begins, ends)))
            again = np.zeros(len(words), np.uint64)
            for back in (2, 1):
                again[back:][words[back:] == words[:-back]] = back
            length = np.minimum(np.log2(ends - begins + 1), 7).astype(np.uint64)
            new = ((KIND[part[begins]] * np.uint64(4) + KIND[part[ends - 1]]) * np.uint64(8) + length) * np.uint64(3) + again[old:] + np.uint64(1)
            shape = np.concatenate((shape, new))
            for n in (1, 2, 3):
                if len(shape) < n:
                    break
                grams = shape if n == 1 else grams[:-1] * np.uint64(512) + shape[n - 1:]
                found.append(_hashed(grams, 8 + n))
            known, shape = words[-2:], shape[-2:]
        if len(found) > 6:
            found = [np.unique(np.concatenate(found))]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint32)


def log_count_ratio(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Of each feature, the log of its smoothed share in class 1 over that in class 0."""
    counts = np.ones((2, 1 << BITS))
    for row, label in zip(rows, labels):
        counts[int(label), row] += 1
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, cost: np.ndarray,
                            epochs: int = 20, seed: int = 0) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear model with the least hinge loss; `cost` of each row bounds its dual."""
    rng = np.random.default_rng(seed)
    weights, bias = np.zeros(1 << BITS), 0.0
    sign = np.where(labels == 1, 1.0, -1.0)
    dual, norm = np.zeros(len(rows)), np.array([v @ v + 1.0 for v in values])
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            gradient = sign[i] * (weights[rows[i]] @ values[i] + bias) - 1.0
            new = min(max(dual[i] - gradient / norm[i], 0.0), cost[i])
            step = (new - dual[i]) * sign[i]
            if step:
                dual[i] = new
                weights[rows[i]] += step * values[i]
                bias += step
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weights, bias


def logistic_fit(margins: np.ndarray, labels: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset that turn margins into probabilities (Newton steps, smoothed targets)."""
    n1, n0 = labels.sum(), (1 - labels).sum()
    goal = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, theta = np.stack([margins, np.ones(len(margins))], axis=1), np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        theta = theta - np.clip(np.linalg.solve(h, x.T @ (p - goal) + 1e-3 * theta), -2, 2)
    return float(theta[0]), float(theta[1])


@dataclass(frozen=True)
class Model:
    """Scores from a text's features; one weight for each of 2 ** BITS."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, found: np.ndarray) -> float:
        return float(self.weights[found].sum() / np.sqrt(max(1, len(found)))) + self.bias

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(features(text)) + self.offset, -30, 30))))


def fit_model(rows: list[np.ndarray], labels: np.ndarray, cost: float = 1.0) -> Model:
    """Fit to four of five rows, calibrate on the fifth. Without both classes, a model of the labels' share."""
    calibrating = np.arange(len(rows)) % 5 == 4
    fitting = [k for k in range(len(rows)) if not calibrating[k]]
    if len(set(labels[fitting])) < 2 or len(set(labels[calibrating])) < 2:
        share = (labels.sum() + 1) / (len(labels) + 2)
        return Model(np.zeros(1 << BITS, np.float32), 0.0, 0.0, float(np.log(share / (1 - share))))
    some, y = [rows[k] for k in fitting], labels[fitting]
    ratio = log_count_ratio(some, y)
    values = [ratio[r] / np.sqrt(max(1, len(r))) for r in some]
    # Both classes weigh the same, however many rows they have.
    each = np.array([len(y) / (2 * (y == 0).sum()), len(y) / (2 * (y == 1).sum())])
    weights, bias = dual_coordinate_descent(some, values, y, cost * each[y.astype(int)])
    model = Model((weights * ratio).astype(np.float32), bias, 1.0, 0.0)
    margins = np.array([model.margin(rows[k]) for k in np.flatnonzero(calibrating)])
    return Model(model.weights, bias, *logistic_fit(margins, labels[calibrating]))


def held_out(id_col: Column) -> Column:
    """Whether no label of this id is learned from: its text's crc32 is a multiple of five."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          sample: int = SAMPLE) -> Model:
    """The model of labels 0 and 1, from at most about `sample` labelled rows that aren't held out.

    The rows are chosen by a hash of their id. Null or other labels, ids labelled both ways, and null
    ids aren't learned from.
    """
    label, key = F.col(f"`{label_col}`"), F.col(f"`{id_col}`")
    known = (labels.where(key.isNotNull() & ~held_out(key) & label.isin(0, 1)).groupBy(key.alias("id"))
             .agg(F.min(label).alias("label"), F.max(label).alias("most")).where("label = most").select("id", "label"))
    share = max(1, -(-known.count() // sample))
    # Bounded by the sample: its ids may go to every task, and its features to the driver.
    chosen = known.where(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(share)) == 0).limit(2 * sample)
    texts = (docs.select(key.alias("id"), F.col(f"`{text_col}`").alias("text")).join(F.broadcast(chosen), "id")
             .select("id", "label", "text"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([
                batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.int64()),
                pa.array([features(t.as_py()).tobytes() for t in batch.column(2)], pa.binary())], names=["id", "label", "found"])
        release()

    got = texts.mapInArrow(extract, "id bigint, label bigint, found binary").toArrow().sort_by([("id", "ascending"), ("found", "ascending")])
    return fit_model([np.frombuffer(f.as_buffer(), np.uint32) for f in got.column("found")], got.column("label").to_numpy())


def score_quality(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT) -> DataFrame:
    """One row per row of `docs`: id, held_out, score (0 to 1) and predicted.

    Null and empty texts have no features and get the score of the bias. Null ids aren't held out;
    repeated rows stay; an empty table gives no rows; only id and text are read.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([model.score(t.as_py()) for t in part.column(1)], pa.float64())],
                                                 names=["id", "score"])
        release()

    scored = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(score, "id bigint, score double")
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score",
                         (F.col("score") >= cut).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", cut: float = CUT) -> DataFrame:
    """The rows whose score is at least `cut`, with all their columns; nothing is joined or shuffled."""
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                yield part.filter(pa.array([model.score(t.as_py()) >= cut for t in part.column(at)], pa.bool_()))
        release()

    return docs.mapInArrow(keep, docs.schema)


@query("op10_quality_classifier")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, train(docs, table(spark, sf_dir, "labels")))
