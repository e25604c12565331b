"""Quality classifier: a linear support vector machine on naive Bayes features.

Features are indicators of words, word pairs and byte trigrams, and of the
steps of two repetition rates (distinct words, equal neighbours), hashed to
``SLOTS``. Each is scaled by its class log-count ratio, rows get unit length,
and a hinge-loss model is fitted by dual coordinate descent on a bounded,
documented sample of labelled rows (``SAMPLE`` ids of either class). A
held-out fifth of the sample gives the logistic calibration of the margin, so
that scores are probabilities at the classes' true rates. Scoring reads whole
texts in Arrow tasks; the weights sent to them have a fixed size.

Defined results: a NULL or empty text has no feature and scores by the
intercept alone; without labelled rows of both classes every score is 0.5;
equal texts get equal scores; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from customer360.llm.sampling import fold, sampled_ids
from customer360.llm.textnum import chunks, distinct, mix, ngram_hashes, utf8, word_hashes

SAMPLE = 3000
SLOTS = 1 << 18
COST = 1.0
EPOCHS = 20
ALPHA = 1.0
SEED = 5


def features(column: pa.Array) -> list[np.ndarray]:
    """Distinct feature slots of every row."""
    raw, off = utf8(column)
    h, w = word_hashes(raw, off)
    pairs = ngram_hashes(h, 2)
    b = raw.astype(np.int64)
    tri = ((b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * 0x9E3779B1 >> 11 & (SLOTS - 1)).astype(np.int32) if len(b) > 2 else np.zeros(0, np.int32)
    mask = np.uint64(SLOTS - 1)
    one, two = (h & mask).astype(np.int32), (mix(pairs) & mask).astype(np.int32)
    scratch = np.zeros(SLOTS, np.int32)
    out = []
    for p, q, a, z in zip(off[:-1].tolist(), off[1:].tolist(), w[:-1].tolist(), w[1:].tolist(), strict=True):
        words = distinct(one[a:z], scratch)
        extra = [int(8 * len(words) / (z - a))] if z > a else []
        if z - a > 1:
            extra += [16 + int(4 * np.log2(1 + (one[a : z - 1] == one[a + 1 : z]).mean() * 15))]
        out.append(distinct(np.concatenate((words, two[a : max(a, z - 1)], tri[p : max(p, q - 2)], np.array(extra, np.int32))), scratch))
    return out


class QualityModel:
    """Feature weights (ratio times hinge weight), intercept and calibration."""

    def __init__(self, rows: list[np.ndarray], labels: np.ndarray, folds: np.ndarray, common: float):
        self.ready = len(np.unique(labels)) == 2
        if not self.ready:
            return
        held = folds == 0
        if min(((labels == c) & (held == f)).sum() for c in (0, 1) for f in (False, True)) < 5:
            held = np.zeros(len(labels), bool)
        learn = np.flatnonzero(~held)
        count = [np.bincount(np.concatenate([rows[i] for i in learn if labels[i] == c]), minlength=SLOTS) + ALPHA for c in (0, 1)]
        ratio = np.log(count[1] / count[1].sum()) - np.log(count[0] / count[0].sum())
        self.weight = self._descend([rows[i] for i in learn], np.where(labels[learn] == 1, 1.0, -1.0), ratio)
        use = np.flatnonzero(held) if held.any() else learn
        m = np.array([self.margin(rows[i]) for i in use])
        self._calibrate(m, labels[use], np.where(labels[use] == 0, common, 1.0))

    def _descend(self, rows: list[np.ndarray], sign: np.ndarray, ratio: np.ndarray) -> np.ndarray:
        """Dual coordinate descent for 0.5 |w|^2 + sum cost_i max(0, 1 - y_i w x_i);
        either class has half the cost. The last weight is the intercept."""
        rng = np.random.default_rng(SEED)
        n = len(rows)
        values = [ratio[r] for r in rows]
        values = [v / max(1e-9, np.sqrt((v**2).sum())) for v in values]
        cost = COST * n * np.where(sign > 0, 0.5 / max(1, (sign > 0).sum()), 0.5 / max(1, (sign < 0).sum()))
        w, b, dual = np.zeros(SLOTS), 0.0, np.zeros(n)
        for _ in range(EPOCHS):
            worst = 0.0
            for i in rng.permutation(n):
                g = sign[i] * (values[i] @ w[rows[i]] + b) - 1
                new = min(max(dual[i] - g / 2, 0.0), cost[i])  # the diagonal is 2: unit row and intercept
                step = new - dual[i]
                if step:
                    dual[i] = new
                    w[rows[i]] += step * sign[i] * values[i]
                    b += step * sign[i]
                    worst = max(worst, abs(step))
            if worst < 1e-3:
                break
        self.square, self.intercept = (ratio**2).astype(np.float32), b
        return (w * ratio).astype(np.float32)

    def margin(self, slots: np.ndarray) -> float:
        return float(self.weight[slots].sum() / max(1e-9, np.sqrt(self.square[slots].sum())) + self.intercept)

    def _calibrate(self, m: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        """Weighted logistic fit of the label on the margin, by Newton steps."""
        self.slope, self.shift = 1.0, 0.0
        x = np.stack((m, np.ones(len(m))), 1)
        t = np.zeros(2)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ t, -30, 30)))
            g = x.T @ (weight * (p - y)) + 1e-2 * t
            step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2), g)
            t -= step
            if np.abs(step).max() < 1e-6:
                break
        self.slope, self.shift = float(t[0]), float(t[1])

    def scores(self, column: pa.Array) -> np.ndarray:
        if not self.ready:
            return np.full(len(column), 0.5)
        m = np.array([self.margin(r) for r in features(column)])
        return 1 / (1 + np.exp(-np.clip(self.slope * m + self.shift, -500, 500)))


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = SAMPLE) -> QualityModel:
    """Fit on the sample; its ids (bounded) are broadcast to one scan of ``docs``."""
    ids, common = sampled_ids(labels, label, per_class)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id").select("text", "label", fold().alias("fold"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            slots = [np.sort(r).tobytes() for r in features(b.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array(slots, pa.binary()), b.column("label"), b.column("fold")], ["slots", "label", "fold"])

    made = rows.mapInArrow(run, "slots binary, label int, fold int")
    # Rows that repeat a sampled doc_id must not outgrow the bound.
    table = made.orderBy(F.xxhash64("slots", "label"), "slots").limit(2 * per_class).toArrow()
    table = table.sort_by([("slots", "ascending"), ("label", "ascending"), ("fold", "ascending")])
    rows_ = [np.frombuffer(x.as_buffer(), np.int32) for x in table.column("slots")]
    return QualityModel(rows_, table.column("label").to_numpy().astype(np.int64), table.column("fold").to_numpy(), common)


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id and score (0 to 1, higher: label 1 likelier) of every row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(shared.value.scores(b.column("text")), pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {id_type}, score double")
