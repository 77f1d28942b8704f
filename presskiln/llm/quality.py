"""Quality classifier: n-gram indicators scaled by log-count ratios, and a linear hinge-loss model."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presskiln.llm.common import ENCODED_BYTES, SPACED, Words, in_pieces, mix, releasing, ship, sizes_of, texts_of

BUCKETS = 1 << 18
# Labelled rows of each class the linear model is fitted on: those of least hash. The counts
# behind the ratios are taken over all labelled rows.
FITTED_PER_CLASS = 4000
ROUNDS, COST, SMOOTHING = 12, 0.1, 1.0
# Labels of which a table is broadcast at most.
BROADCAST_LABELS = 500_000
# Shares of a text's words that are repeats are told apart in steps of this size.
STEPS = 16


def indicators(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram buckets of every text, one text after another, and where each begins.

    N-grams: words; the last two bytes of a word with those of the next, so that marks on words
    count whatever the words; and, as an n-gram of the text's shape, the share of its words that
    are distinct with the order of its size. Upper and lower case are one. An empty text has none.
    """
    words = Words(texts, SPACED)
    n, texts_n = len(words.hashes), len(texts)
    sizes = np.diff(words.first)
    text = np.repeat(np.arange(texts_n), sizes)
    keys = [np.unique(text * BUCKETS + (words.hashes >> np.uint64(46)).astype(np.int64))]
    distinct = np.bincount(keys[0] // BUCKETS, minlength=texts_n)
    order = np.log2(np.maximum(sizes, 1)).astype(np.int64) // 2
    shape = distinct * STEPS // np.maximum(sizes, 1) * 64 + order
    keys.append((np.arange(texts_n) * BUCKETS + _bucket(shape, 1))[sizes > 0])
    if n > 1:
        data = np.frombuffer(words.data, np.uint8)
        tail = data[words.ends - 1].astype(np.int64) << 8 | data[np.maximum(words.ends - 2, words.starts)]
        inside = np.flatnonzero(text[1:] == text[:-1])
        joint, place = np.unique(tail[inside] << 16 | tail[inside + 1], return_inverse=True)
        keys.append(np.unique(text[inside] * BUCKETS + _bucket(joint, 2)[place]))
    key = np.unique(np.concatenate(keys))
    return key % BUCKETS, np.searchsorted(key, np.arange(texts_n + 1) * BUCKETS)


def _bucket(values: np.ndarray, kind: int) -> np.ndarray:
    return (mix(values.astype(np.uint64) | np.uint64(kind << 40)) >> np.uint64(46)).astype(np.int64)


def dual_descent(rows: list[np.ndarray], scale: np.ndarray, labels: np.ndarray, cost: np.ndarray, rounds: int) -> np.ndarray:
    """Weights (and at the end the bias) of the L1-loss linear machine over rows of indicators
    scaled by ``scale``, by coordinate descent on the dual; ``cost`` bounds each row's dual."""
    weights, dual, rng = np.zeros(len(scale) + 1), np.zeros(len(rows)), np.random.default_rng(1)
    values = [np.append(scale[r], 1.0) for r in rows]
    places = [np.append(r, len(scale)) for r in rows]
    norms = np.array([v @ v for v in values])
    for _ in range(rounds):
        for i in rng.permutation(len(rows)):
            gradient = labels[i] * (weights[places[i]] @ values[i]) - 1
            new = min(max(dual[i] - gradient / norms[i], 0.0), cost[i])
            if new != dual[i]:
                weights[places[i]] += (new - dual[i]) * labels[i] * values[i]
                dual[i] = new
    return weights


@dataclass
class Model:
    """Weight of every bucket, bias, and the slope and offset that turn a margin into a score."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def margins(self, places: np.ndarray, first: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0.0], np.cumsum(self.weights[places])))
        return total[first[1:]] - total[first[:-1]] + self.bias

    def scores(self, texts: list[bytes]) -> np.ndarray:
        margin = self.margins(*indicators(texts)) * self.slope + self.offset
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit(counts: np.ndarray, totals: np.ndarray, rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """The model from texts with each bucket by class (2 x BUCKETS), texts by class, and the rows
    the machine is fitted on with their labels (0 or 1). Without rows of both classes, every score is the
    share of label 1."""
    if len(set(labels.tolist())) < 2:
        share = (totals[1] + 1) / (totals.sum() + 2)
        return Model(np.zeros(BUCKETS), 0.0, 1.0, math.log(share / (1 - share)))
    p, q = counts[1] + SMOOTHING, counts[0] + SMOOTHING
    ratio = np.log((p / p.sum()) / (q / q.sum()))
    ratio[counts.sum(0) < 2] = 0.0
    signs = np.where(labels == 1, 1.0, -1.0)
    share = np.array([(labels == k).sum() for k in (0, 1)])
    cost = np.where(labels == 1, COST * len(labels) / share[1] / 2, COST * len(labels) / share[0] / 2)
    machine = dual_descent(rows, ratio, signs, cost, ROUNDS)
    model = Model(machine[:-1] * ratio, float(machine[-1]))
    margins = np.array([model.weights[r].sum() + model.bias for r in rows])
    model.slope, model.offset = calibrated(margins, labels)
    return model


def calibrated(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through the margins, by Newton steps."""
    spread = margins.std() or 1.0
    x, a, b = margins / spread, 1.0, 0.0
    target = np.where(labels == 1, 1 - 1 / (2 + (labels == 1).sum()), 1 / (2 + (labels == 0).sum()))
    weight = np.where(labels == 1, 0.5 / (labels == 1).mean(), 0.5 / (labels == 0).mean())
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        r, h = weight * (p - target), np.maximum(weight * p * (1 - p), 1e-9)
        g = np.array([r @ x + 1e-3 * a, r.sum()])
        m = np.array([[(h * x) @ x + 1e-3, h @ x], [h @ x, h.sum() + 1e-6]])
        step = np.linalg.solve(m, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return max(a, 1e-6) / spread, b


def held_out(doc_id: str) -> Column:
    """Rows no label is learnt from: crc32 of the doc_id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _pieces(batch: pa.RecordBatch):
    """(first row, indicators) of the texts of a batch, some megabytes at a time."""
    for begin, end in in_pieces(sizes_of(batch["text"]), ENCODED_BYTES):
        yield begin, *indicators(texts_of(batch["text"].slice(begin, end - begin)))


def class_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Texts of each class with each bucket (2 x BUCKETS), and texts of each class, of all rows of
    (text, quality). Each task adds up its own rows; what comes to the driver has fixed size."""

    def count(batches):
        counts, totals = np.zeros((2, BUCKETS), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            labels = np.array(batch["quality"].to_pylist(), np.int64)
            totals += np.bincount(labels, minlength=2)
            for begin, places, first in _pieces(batch):
                owner = labels[begin + np.repeat(np.arange(len(first) - 1), np.diff(first))]
                for k in (0, 1):
                    counts[k] += np.bincount(places[owner == k], minlength=BUCKETS)
        used = np.flatnonzero(counts.any(0))
        columns = [np.append(used, -1), np.append(counts[0, used], totals[0]), np.append(counts[1, used], totals[1])]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["bucket", "n0", "n1"])

    summed = rows.mapInArrow(releasing(count), "bucket long, n0 long, n1 long").groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    table = summed.toArrow()
    bucket, n0, n1 = (table[c].to_numpy() for c in ("bucket", "n0", "n1"))
    counts, totals = np.zeros((2, BUCKETS)), np.zeros(2)
    known = bucket >= 0
    counts[0, bucket[known]], counts[1, bucket[known]] = n0[known], n1[known]
    if (~known).any():
        totals[:] = n0[~known][0], n1[~known][0]
    return counts, totals


def train(docs: DataFrame, labels: DataFrame, per_class: int = FITTED_PER_CLASS) -> Model:
    """Fit on texts of ``docs`` with a ``quality`` of 0 or 1 in ``labels``, held-out ids left out.

    Log-count ratios come from all labelled rows. The machine is fitted on at most ``per_class``
    labelled ids of each class, those whose ids have the least hash: a documented bound, the same
    at every size. Null ids and other label values are left out; an id with two labels counts twice.
    """
    ship(docs.sparkSession)
    known = labels.where("doc_id is not null and quality in (0, 1)").where(~held_out("doc_id")).select("doc_id", F.col("quality").cast("int").alias("quality"))
    texts = docs.select("doc_id", "text")
    # Few labels are broadcast, 16 bytes each; with more, both sides are shuffled.
    few = known.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS
    counts, totals = class_counts(texts.join(F.broadcast(known) if few else known, "doc_id").select("text", "quality"))
    order = (F.xxhash64("doc_id"), "doc_id")
    chosen = known.where("quality = 0").orderBy(*order).limit(per_class).unionByName(known.where("quality = 1").orderBy(*order).limit(per_class))

    def rows_of(batches):
        for batch in batches:
            cells = []
            for _, places, first in _pieces(batch):
                cells += [places[a:b].astype(np.int32).tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["quality"], pa.array(cells, pa.binary())], ["doc_id", "quality", "places"])

    # At most 2 * per_class ids: a bound that does not grow.
    fitted = texts.join(F.broadcast(chosen), "doc_id").mapInArrow(releasing(rows_of), "doc_id long, quality int, places binary").toArrow().to_pylist()
    fitted.sort(key=lambda r: (r["doc_id"], r["quality"], r["places"]))
    rows = [np.frombuffer(r["places"], np.int32).astype(np.int64) for r in fitted]
    return fit(counts, totals, rows, np.array([r["quality"] for r in fitted], np.int64))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Columns of ``docs`` (with a ``text``) and ``score`` in 0 to 1, higher where label 1 is
    likelier. Null and empty texts are scored by the bias alone; repeated rows stay; a column
    named score is replaced. One pass without a shuffle."""
    ship(docs.sparkSession)
    names = [c for c in docs.columns if c != "score"]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            column = batch["text"]
            scores = [shared.value.scores(texts_of(column.slice(a, b - a))) for a, b in in_pieces(sizes_of(column), ENCODED_BYTES)]
            more = pa.array(np.concatenate(scores) if scores else np.zeros(0))
            yield pa.RecordBatch.from_arrays([batch[n] for n in names] + [more], [*names, "score"])

    schema = docs.select(*names).withColumn("score", F.lit(0.0).cast("double")).schema
    return docs.select(*names).mapInArrow(releasing(run), schema)


def op4_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
