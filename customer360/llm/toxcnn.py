"""Toxicity: a convolutional text classifier trained in numpy.

Words (runs of letters and digits, lower-cased) are hashed to embedding rows. Filters of several
widths run over the word vectors, their maxima over the whole text feed a
logistic output. Every labelled row takes part: word counts, letter pairs and
thresholds are Spark aggregates over all of them, and in each of ``EPOCHS`` passes every
shard of about ``SHARD_ROWS`` rows takes AdaGrad steps from the same network, whose next
state is the mean of the shards' changes. The driver holds the network alone, of bounded
size. Scoring runs in Arrow tasks over whole texts, from tables in which each
filter tap is multiplied into the embedding beforehand.

Thresholds are calibrated by language on a held-out fifth of the labelled rows, on a
log-odds grid (``GRID`` cells a unit). The language is guessed from the text alone (letter
pairs against the profiles of the languages that have 20 labelled rows and one in 10,000),
so that lang is no input of a score; the score is the output's log-odds less the
threshold's, so 0.5 is every language's threshold.

Defined results: a NULL or empty text is scored like a text of unknown
words; words never seen in training have a zero vector; without labelled
rows of both classes every score is 0; repeated rows get equal scores.
"""

from __future__ import annotations

import copy
import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from customer360.llm.decontam import words
from customer360.llm.sampling import fold, labelled_ids
from customer360.llm.textnum import chunks, utf8
from customer360.plans import checkpoint_dir, release_unreachable, remove_stored

#: Labelled ids of a shard.
SHARD_ROWS = 4096
SLOTS = 1 << 20
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 4
EPOCHS = 3
RATE = 0.05
BATCH = 64
#: Texts added to either class's count of a word.
PRIOR = 3.0
SEED = 11
#: Units of summed letter-pair shares and network changes.
FINE = 1 << 24
CHANGE = 1 << 22
#: Log-odds grid of the thresholds: cells a unit, and its largest absolute value.
GRID = 1024
LIMIT = 64


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(embedding slots of the words, word offsets of the rows)."""
    h, w = words(*utf8(column))
    return (h >> np.uint64(44)).astype(np.int32) % SLOTS, w


def _pairs(column: pa.Array) -> np.ndarray:
    """Share of every letter-pair class (1024) per row; rows without letters are 0."""
    raw, off = utf8(column)
    low = raw | 32
    sym = np.where((low >= 97) & (low <= 122), low - 96, np.where(raw >= 128, 27 + (raw & 3), 0)).astype(np.int64)
    out = np.zeros((len(off) - 1, 1024), np.float32)
    for i, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True)):
        if b - a > 1:
            n = np.bincount(sym[a : b - 1] * 32 + sym[a + 1 : b], minlength=1024).astype(np.float32)
            n[0] = 0
            out[i] = n / max(1.0, n.sum())
    return out


class TextCNN:
    """Hashed embeddings, filters of several widths, max pooling, logistic output."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.slots = np.zeros(0, np.int32)
        self.vec = np.zeros((1, DIM), np.float32)  # row 0: unknown words
        self.filt = {k: rng.normal(0, 0.1, (k, FILTERS, DIM)).astype(np.float32) for k in WIDTHS}
        for k in WIDTHS:
            self.filt[k][:, :, 0] += 1.0 / k  # dimension 0 starts as a class ratio
        self.bias = {k: np.full(FILTERS, 0.01, np.float32) for k in WIDTHS}
        self.out = np.full(len(WIDTHS) * FILTERS, 0.2, np.float32)
        self.shift = np.float32(-1.0)

    def _pool(self, taps: dict, rows: np.ndarray, w: np.ndarray, where: bool = False):
        """Maxima per row and filter of the rectified responses (rows x filters);
        with ``where``, the word position of each maximum (-1: no word). A
        window that hangs over a text's end sees zero vectors there."""
        n, gap = len(w) - 1, max(WIDTHS) - 1
        start = w[:-1] + gap * np.arange(n)
        padded = np.zeros(len(rows) + gap * n + gap, rows.dtype)
        size = np.diff(w)
        padded[np.arange(len(rows)) + np.repeat(gap * np.arange(n), size)] = rows
        full = np.flatnonzero(size)
        cut = np.stack((start[full], start[full] + size[full]), 1).ravel()
        best = np.zeros((n, len(WIDTHS) * FILTERS), np.float32)
        arg = np.full(best.shape, -1, np.int64) if where else None
        m = len(padded) - gap
        for c, k in enumerate(WIDTHS):
            for f in range(FILTERS):
                v = taps[k][0][f][padded[:m]]
                for t in range(1, k):
                    v += taps[k][t][f][padded[t : m + t]]
                v += self.bias[k][f]
                j = c * FILTERS + f
                if len(full):
                    best[full, j] = np.maximum.reduceat(np.append(v, np.float32(0)), cut)[::2]
                    if where:
                        for r in full:
                            arg[r, j] = w[r] + int(np.argmax(v[start[r] : start[r] + size[r]]))
        return np.maximum(best, 0), arg

    def _taps(self) -> dict:
        return {k: [np.ascontiguousarray(self.filt[k][t] @ self.vec.T) for t in range(k)] for k in WIDTHS}

    def logits(self, rows: np.ndarray, w: np.ndarray, taps: dict | None = None) -> np.ndarray:
        pooled, _ = self._pool(taps or self._taps(), rows, w)
        return pooled @ self.out + self.shift

    def start(self, slots: np.ndarray, held: np.ndarray, total: np.ndarray, seed: int = SEED) -> None:
        """Vectors of the sorted ``slots``. ``held``: texts of either class that
        hold the word; ``total``: texts of either class."""
        self.slots = slots
        self.vec = np.random.default_rng(seed).normal(0, 0.01, (len(slots) + 1, DIM)).astype(np.float32)
        # Dimension 0: smoothed log ratio of the texts of either class that hold the word.
        share = [(h + PRIOR) / (max(1, n) + PRIOR) for h, n in zip(held, total, strict=True)]
        self.vec[1:, 0] = np.log(share[1] / share[0])
        self.vec[0] = 0

    def state(self) -> dict:
        """Fresh sums of squared gradients."""
        state = {"vec": np.full_like(self.vec, 1e-2), "out": np.full_like(self.out, 1e-2), "shift": 1e-2}
        return state | {("f", k): np.full_like(self.filt[k], 1e-2) for k in WIDTHS} | {("b", k): np.full_like(self.bias[k], 1e-2) for k in WIDTHS}

    def fit(self, texts: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, batch: int = BATCH, seed: int = SEED) -> None:
        """AdaGrad on the logistic loss over texts in memory; classes count alike."""
        rng = np.random.default_rng(seed)
        slots = np.unique(np.concatenate(texts)) if texts else np.zeros(0, np.int32)
        held, total = np.zeros((2, len(slots)), np.int64), np.bincount(labels, minlength=2)
        for t, y in zip(texts, labels, strict=True):
            held[y, np.searchsorted(slots, np.unique(t))] += 1
        self.start(slots, held, total, seed)
        texts = [self.rows_of(t).astype(np.int32) for t in texts]
        state, weight = self.state(), class_weights(total)
        for _ in range(epochs):
            for part in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // batch)):
                self.step([texts[i] for i in part], labels[part], weight, state, rate)

    def step(self, texts: list[np.ndarray], labels: np.ndarray, weight: np.ndarray, state: dict, rate: float) -> None:
        """One AdaGrad step on a batch of embedding rows; ``weight``: of either class."""
        rows = np.concatenate(texts)
        w = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        # Position 0 stands for the padding.
        pooled, arg = self._pool(self._taps_of(rows), np.arange(1, len(rows) + 1), w, where=True)
        z = pooled @ self.out + self.shift
        g = ((1 / (1 + np.exp(-z)) - labels) * weight[labels] / len(texts)).astype(np.float32)
        back = g[:, None] * self.out * (pooled > 0) * (arg >= 0)
        self._step(self.out, state, "out", pooled.T @ g + 1e-4 * self.out, rate)
        state["shift"] += float(g.sum()) ** 2
        self.shift -= np.float32(rate * g.sum() / np.sqrt(state["shift"]))
        dvec: dict = {}
        size = np.diff(w)
        for c, k in enumerate(WIDTHS):
            d, p = back[:, c * FILTERS : (c + 1) * FILTERS], arg[:, c * FILTERS : (c + 1) * FILTERS]
            r, f = np.nonzero(d)
            df = np.zeros_like(self.filt[k])
            for t in range(k):
                ok = p[r, f] + t < w[r] + size[r]
                rr, ff = r[ok], f[ok]
                word = rows[p[rr, ff] + t]
                np.add.at(df[t], ff, d[rr, ff][:, None] * self.vec[word])
                dvec.setdefault(t, []).append((word, d[rr, ff][:, None] * self.filt[k][t][ff]))
            self._step(self.filt[k], state, ("f", k), df + 1e-4 * self.filt[k], rate)
            db = np.zeros_like(self.bias[k])
            np.add.at(db, f, d[r, f])
            self._step(self.bias[k], state, ("b", k), db, rate)
        word = np.concatenate([x for v in dvec.values() for x, _ in v])
        grad = np.concatenate([x for v in dvec.values() for _, x in v])
        if len(word):
            at, inv = np.unique(word, return_inverse=True)
            total = np.zeros((len(at), DIM), np.float32)
            np.add.at(total, inv, grad)
            state["vec"][at] += total**2
            self.vec[at] -= rate * total / np.sqrt(state["vec"][at])
            self.vec[0] = 0

    def dense(self) -> np.ndarray:
        """Everything but the word vectors, in rows of ``DIM`` values."""
        flat = np.concatenate([*(self.filt[k].ravel() for k in WIDTHS), *(self.bias[k] for k in WIDTHS), self.out, [self.shift]])
        return np.pad(flat, (0, -len(flat) % DIM)).reshape(-1, DIM)

    def add_dense(self, change: np.ndarray) -> None:
        """Add rows laid out like those of :meth:`dense`."""
        at, flat = 0, change.ravel()
        for x in (*(self.filt[k] for k in WIDTHS), *(self.bias[k] for k in WIDTHS), self.out):
            x += flat[at : at + x.size].reshape(x.shape).astype(np.float32)
            at += x.size
        self.shift += np.float32(flat[at])

    def _taps_of(self, rows: np.ndarray) -> dict:
        v = np.concatenate((np.zeros((1, DIM), np.float32), self.vec[rows])).T
        return {k: [self.filt[k][t] @ v for t in range(k)] for k in WIDTHS}

    @staticmethod
    def _step(x: np.ndarray, state: dict, key, grad: np.ndarray, rate: float) -> None:
        state[key] += grad**2
        x -= rate * grad / np.sqrt(state[key])

    def rows_of(self, slots: np.ndarray) -> np.ndarray:
        """Embedding rows of hashed words; 0 where training never saw the slot."""
        if not len(self.slots):
            return np.zeros(len(slots), np.int64)
        at = np.minimum(np.searchsorted(self.slots, slots), len(self.slots) - 1)
        return np.where(self.slots[at] == slots, at + 1, 0)


class Detector:
    """A trained network with language profiles and thresholds."""

    def __init__(self, net: TextCNN | None, langs: list[str], profiles: np.ndarray, cuts: np.ndarray):
        self.net, self.langs, self.profiles, self.cuts = net, langs, profiles, cuts
        self._lookup = self._known = None

    def __getstate__(self):
        return self.__dict__ | {"_lookup": None, "_known": None}

    def language(self, column: pa.Array) -> np.ndarray:
        return np.argmax(_pairs(column) @ self.profiles.T, axis=1) if len(self.langs) else np.zeros(len(column), np.int64)

    def margins(self, column: pa.Array) -> np.ndarray:
        """Log-odds above the threshold of the guessed language."""
        if self._lookup is None:
            self._lookup = np.zeros(SLOTS, np.int32)
            self._lookup[self.net.slots] = np.arange(1, len(self.net.slots) + 1)
            self._known = self.net._taps()
        slots, w = _ids(column)
        return self.net.logits(self._lookup[slots], w, self._known) - self.cuts[self.language(column)]


def class_weights(total: np.ndarray) -> np.ndarray:
    """Weights by which the classes count alike and a row counts 1 on average."""
    return 0.5 / np.maximum(1, total) * total.sum()


def _cut(counts: np.ndarray) -> float:
    """Log-odds threshold of the best F1, halfway between its neighbours, from
    the rows of class 0 and 1 (columns) in each cell of the log-odds grid."""
    cell = np.flatnonzero(counts.sum(axis=1))[::-1]
    z = (cell + 0.5) / GRID - LIMIT
    hits, wrong = np.cumsum(counts[cell, 1]), np.cumsum(counts[cell, 0])
    f1 = 2 * hits / (hits + wrong + max(1, hits[-1]))
    i = int(np.argmax(f1))
    return float((z[i] + (z[i + 1] if i + 1 < len(z) else z[i] - 1)) / 2)


def _cuts(found: pa.Table, langs: int) -> np.ndarray:
    """Thresholds by guessed language from rows (guess, cell, n0, n1)."""
    guess, cell, n0, n1 = (found.column(c).to_numpy() for c in ("guess", "cell", "n0", "n1"))

    def grid(on: np.ndarray) -> np.ndarray:
        out = np.zeros((2 * LIMIT * GRID, 2), np.int64)
        np.add.at(out, cell[on], np.stack((n0[on], n1[on]), 1))
        return out

    middle = _cut(grid(np.ones(len(guess), bool)))
    cuts = np.full(max(1, langs), middle)
    for k in np.unique(guess[n1 > 0]).tolist() if langs else []:
        counts = grid(guess == k)
        other, n = counts.sum(axis=0)
        if n >= 10 and other >= 10:  # shrunk towards the threshold of all
            cuts[k] = (n * _cut(counts) + 20 * middle) / (n + 20)
    return cuts


def training_rows(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> DataFrame:
    """text, label, lang, fold and shard of every document with a label. Rows meet
    their labels by a shuffle into shards of about ``SHARD_ROWS`` labelled ids,
    each in the order of hashed ids; a bitmap of the labelled ids, of bounded
    size, keeps other texts out of it."""
    lab = labelled_ids(labels, label)
    n = lab.count()
    bits = min(27, max(16, (8 * n).bit_length()))
    # As text: ids of either table may be numbers of another width.
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << bits))
    cells = lab.select(place.alias("place")).selectExpr("place >> 5 as cell", "1L << int(place & 31) as bit")
    found = cells.groupBy("cell").agg(F.bit_or("bit").alias("bits")).toArrow()
    bitmap = np.zeros(1 << (bits - 5), np.uint32)
    bitmap[found.column("cell").to_numpy()] = found.column("bits").to_numpy().astype(np.uint32)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.column("place").to_numpy()
            keep = shared.value[at >> 5] >> (at & 31).astype(np.uint32) & np.uint32(1)
            yield b.select(["doc_id", "text", "lang"]).filter(pa.array(keep.astype(bool)))

    rows = docs.where("doc_id is not null").select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), place.alias("place"))
    rows = rows.mapInArrow(run, f"doc_id {id_type}, text string, lang string")
    shards = max(1, -(-n // SHARD_ROWS))
    rows = rows.repartition(shards, "doc_id").join(lab.repartition(shards, "doc_id"), "doc_id")
    rows = rows.sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"), "text", "lang")
    return rows.select("text", "label", "lang", fold().alias("fold"), F.spark_partition_id().alias("shard"))


def _counts(rows: DataFrame, held: bool, langs: list[str]) -> pa.Table:
    """Sums over all rows: (-1, slot, texts of class 0, of class 1 that hold the
    word) of the rows that train, (language, letter pair, share, 0) of all."""
    index = {v: i for i, v in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_, shares = np.zeros((2, SLOTS), np.int64), {}
        for b in chunks(batches):
            slots, w = _ids(b.column("text"))
            pairs = _pairs(b.column("text"))
            for i, (y, lang, f) in enumerate(zip(b.column("label").to_pylist(), b.column("lang").to_pylist(), b.column("fold").to_pylist(), strict=True)):
                if f or not held:
                    words_[y, np.unique(slots[w[i] : w[i + 1]])] += 1
                if lang in index:
                    shares.setdefault(index[lang], np.zeros(1024, np.int64))
                    shares[index[lang]] += np.round(pairs[i] * FINE).astype(np.int64)
        slot = np.flatnonzero(words_.any(axis=0))
        parts = [(-1, slot, words_[0, slot], words_[1, slot])] + [(k, np.arange(1024), v, np.zeros(1024, np.int64)) for k, v in shares.items()]
        for k, at, x, y in parts:
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k), pa.int32()), pa.array(at, pa.int32()), pa.array(x), pa.array(y)], ["lang", "at", "x", "y"])

    made = rows.select("text", "label", "lang", "fold").mapInArrow(run, "lang int, at int, x long, y long")
    return made.groupBy("lang", "at").agg(F.sum("x").alias("x"), F.sum("y").alias("y")).toArrow()


def _mean_change(rows: DataFrame, net: TextCNN, weight: np.ndarray, rate: float) -> pa.Table:
    """One pass of every shard over its rows, from ``net`` on: the mean change of
    each word's vector over the shards that changed it, and of all else (negative
    slots), by their rows. Changes are summed as integers, in any order alike."""
    shared = rows.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, lookup = shared.value, np.zeros(SLOTS, np.int32)
        lookup[base.slots] = np.arange(1, len(base.slots) + 1)
        shard = own = state = None
        n, texts, labels = 0, [], []

        def step() -> None:
            own.step(texts, np.array(labels), weight, state, rate)
            texts.clear()
            labels.clear()

        def change() -> pa.RecordBatch:
            if texts:
                step()
            moved = own.vec - base.vec
            at = np.flatnonzero(moved.any(axis=1))
            dense = own.dense() - base.dense()
            slot = np.concatenate((base.slots[at - 1], -1 - np.arange(len(dense))))
            value = np.round(np.clip(np.concatenate((moved[at], dense)), -500, 500) * CHANGE).astype(np.int32)
            columns = [slot.astype(np.int32), np.full(len(slot), n, np.int32), *value.T]
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], ["slot", "n", *(f"v{i}" for i in range(DIM))])

        for b in chunks(batches):
            slots, w = _ids(b.column("text"))
            for i, (y, s) in enumerate(zip(b.column("label").to_pylist(), b.column("shard").to_pylist(), strict=True)):
                if s != shard:
                    if own is not None:
                        yield change()
                    own, shard, n = copy.deepcopy(base), s, 0
                    state = own.state()
                texts.append(lookup[slots[w[i] : w[i + 1]]])
                labels.append(y)
                n += 1
                if len(texts) == BATCH:
                    step()
        if own is not None:
            yield change()

    values = [f"v{i}" for i in range(DIM)]
    made = rows.select("text", "label", "shard").mapInArrow(run, f"slot int, n int, {', '.join(f'{v} int' for v in values)}")
    total = made.groupBy("slot").agg(F.sum(F.col("n").cast("long")).alias("n"), *(F.sum(F.col("n").cast("long") * F.col(v)).alias(v) for v in values))
    found = total.select("slot", *((F.col(v) / F.col("n") / CHANGE).cast("float").alias(v) for v in values)).toArrow()
    shared.destroy()
    return found


def _grid(rows: DataFrame, model: Detector) -> pa.Table:
    """Rows of either class by guessed language and cell of the log-odds grid."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            z = shared.value.margins(b.column("text"))
            cell = np.clip(np.floor((z + LIMIT) * GRID), 0, 2 * LIMIT * GRID - 1).astype(np.int32)
            guess = shared.value.language(b.column("text")).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(guess), pa.array(cell), b.column("label")], ["guess", "cell", "label"])

    made = rows.select("text", "label").mapInArrow(run, "guess int, cell int, label int")
    found = made.groupBy("guess", "cell").agg(F.count_if(F.col("label") == 0).alias("n0"), F.count_if(F.col("label") == 1).alias("n1")).toArrow()
    shared.destroy()
    return found


def fit_detector(rows: DataFrame, seed: int = SEED) -> Detector:
    """Train on every row of ``rows`` (text, label, lang, fold, shard)."""
    nobody = Detector(None, [], np.zeros((0, 1024), np.float32), np.zeros(1))
    size = np.zeros((2, 2), np.int64)  # by held (fold 0) and label
    for r in rows.groupBy((F.col("fold") == 0).cast("int").alias("held"), "label").count().collect():
        size[r["held"], r["label"]] = r["count"]
    if not size.sum(axis=0).all():
        return nobody
    held = bool((size >= 5).all())
    named = rows.where("lang <> ''").groupBy("lang").count().where(F.col("count") >= max(20, size.sum() / 10_000))
    named = {r["lang"]: r["count"] for r in named.collect()}
    langs = sorted(named)
    counts = _counts(rows, held, langs)
    lang, at, x, y = (counts.column(c).to_numpy() for c in ("lang", "at", "x", "y"))
    profiles = np.zeros((len(langs), 1024))
    profiles[lang[lang >= 0], at[lang >= 0]] = x[lang >= 0] / FINE
    profiles = np.log(profiles / np.array([named[v] for v in langs]).reshape(-1, 1) + 1e-5).astype(np.float32)
    word = np.flatnonzero(lang < 0)
    word = word[np.argsort(at[word])]
    total = size[0] if held else size.sum(axis=0)
    net = TextCNN(seed)
    net.start(at[word], np.stack((x[word], y[word])), total, seed)
    learn = rows.where("fold <> 0") if held else rows
    for epoch in range(EPOCHS):
        change = _mean_change(learn, net, class_weights(total), RATE / (1 + epoch))
        slot, value = change.column("slot").to_numpy(), np.stack([change.column(f"v{i}").to_numpy() for i in range(DIM)], 1)
        net.vec[net.rows_of(slot[slot >= 0])] += value[slot >= 0]
        dense = net.dense() * 0
        dense[-1 - slot[slot < 0]] = value[slot < 0]
        net.add_dense(dense)
        release_unreachable(rows.sparkSession)  # the pass's shuffle and broadcast
    plain = Detector(net, langs, profiles, np.zeros(max(1, len(langs))))
    return Detector(net, langs, profiles, _cuts(_grid(rows.where("fold = 0") if held else rows, plain), len(langs)))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> bytes:
    """A detector, pickled, fitted on all documents with labels. They are stored in
    the shared checkpoint folder while the passes over them run."""
    spark = docs.sparkSession
    folder = f"{checkpoint_dir(spark)}/toxicity-{uuid.uuid4()}"
    try:
        training_rows(docs, labels, label).write.option("compression", "zstd").parquet(folder)
        release_unreachable(spark)  # the shuffled texts
        return pickle.dumps(fit_detector(spark.read.parquet(folder)))
    finally:
        remove_stored(spark, folder)


class _Model:
    """A broadcast detector, unpickled once in each worker that asks for it."""

    def __init__(self, spark, model: bytes):
        self.broadcast = spark.sparkContext.broadcast(model)
        self._detector = None

    def __getstate__(self):
        return {"broadcast": self.broadcast, "_detector": None}

    def detector(self) -> Detector:
        if self._detector is None:
            self._detector = pickle.loads(self.broadcast.value)
        return self._detector

    def margins(self, texts: pa.Array) -> np.ndarray:
        """Log-odds above the threshold of every text."""
        rows = pa.RecordBatch.from_arrays([texts], ["text"])
        net = self.detector().net
        out = [np.full(b.num_rows, -np.inf) if net is None else self.detector().margins(b.column("text")) for b in chunks(iter([rows]))]
        return np.concatenate(out).astype(np.float64) if out else np.zeros(0)


def score_texts(docs: DataFrame, detector: bytes) -> DataFrame:
    """doc_id and score (0 to 1; 0.5 is the threshold) of every row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    model = _Model(docs.sparkSession, detector)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            margins = model.margins(b.column("text"))
            score = np.where(np.isneginf(margins), 0.0, 1 / (1 + np.exp(-np.clip(margins, -500, 500))))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(score, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {id_type}, score double")


def toxicity(docs: DataFrame, train_docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of ``docs`` by a detector fitted on ``train_docs`` with ``labels``."""
    return score_texts(docs, train(train_docs, labels))


def drop_toxic(docs: DataFrame, train_docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` (all columns) whose score stays below 0.5. The scan keeps rows in
    place: texts are scored by a column expression, without a join."""
    model = _Model(docs.sparkSession, train(train_docs, labels))

    @F.arrow_udf("double")
    def margin(texts: pa.Array) -> pa.Array:
        return pa.array(model.margins(texts), pa.float64())

    return docs.where(margin(F.col("text").cast("string")) < 0)
