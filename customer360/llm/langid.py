"""Language identification by interpolated Kneser-Ney character models.

Letters are lower-cased and folded to 63 symbols (a-z keep their own, others
share 37 by code point); runs of anything else are one boundary symbol. Four
symbols make a 24-bit key, so a model has at most 2**24 keys whatever the
corpus. Counts are gathered from every training text in Arrow tasks and
summed by Spark per (language, key). The models are sorted key arrays with
one column of log probabilities per language; keys that a language lacks hold
its interpolated back-off value. A text's language has the lowest
cross-entropy per symbol.

Rejection is calibrated by length: each language's surprisal has a mean and a
spread over its own counts; a text of n symbols is rejected when its
cross-entropy exceeds mean + Z * spread / sqrt(n) + MARGIN.

Defined results: NULL text, or text without letters, is ``und`` with score 0;
ties go to the alphabetically first language; without training rows all texts
are ``und``; equal texts get equal answers; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from customer360.llm.textnum import chunks, utf8

ORDER = 4
BITS = 6
SYMBOLS = 1 << BITS
Z, MARGIN = 4.0, 0.5
UNKNOWN = "und"
_FOLD: list[np.ndarray] = []


def _symbol(cp: int) -> int:
    c = chr(cp)
    if not c.isalpha():
        return 0
    low = ord(c.lower()[0])
    return low - 96 if 97 <= low <= 122 else 27 + low % 37


def symbols(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(4-symbol keys, row of each) of the rows' texts; each text ends in a boundary."""
    if not _FOLD:
        _FOLD.append(np.array([0 if 0xD800 <= c < 0xE000 else _symbol(c) for c in range(1 << 16)], np.uint8))
    raw, off = utf8(column)
    joined = np.insert(raw, off[1:], 10)
    cp = np.frombuffer(joined.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    ends = off[1:] + np.arange(1, len(off))
    row = np.repeat(np.arange(len(ends)), np.diff(np.concatenate(([0], np.cumsum((joined & 0xC0) != 0x80)[ends - 1]))))
    wide = cp >> 16 > 0
    sym = _FOLD[0][np.where(wide, 0, cp)]
    if wide.any():
        sym[wide] = [_symbol(int(c)) for c in cp[wide]]
    del cp
    keep = sym > 0
    keep[1:] |= sym[:-1] > 0
    x, row = sym[keep].astype(np.int32), row[keep]
    key = x.copy()
    for back in range(1, ORDER):
        prev = np.zeros_like(x)
        prev[back:] = np.where(row[back:] == row[:-back], x[:-back], 0)
        key |= prev << (BITS * back)
    return key, row


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, key, n) over all texts with a language."""
    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for b in chunks(batches):
            key, row = symbols(b.column("text"))
            code = b.column("lang").dictionary_encode()
            which = code.indices.to_numpy()[row]
            for i, name in enumerate(code.dictionary.to_pylist()):
                k, n = np.unique(key[which == i], return_counts=True)
                if name in held:
                    k, inv = np.unique(np.concatenate((held[name][0], k)), return_inverse=True)
                    n = np.bincount(inv, np.concatenate((held[name][1], n))).astype(np.int64)
                held[name] = (k, n)
        for name, (k, n) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(k), pa.string()), pa.array(k.astype(np.int32)), pa.array(n.astype(np.int64))], ["lang", "key", "n"])

    return rows.mapInArrow(run, "lang string, key int, n bigint").groupBy("lang", "key").agg(F.sum("n").alias("n"))


class LanguageModels:
    """Interpolated Kneser-Ney models of all languages over shared key arrays."""

    def __init__(self, table: pa.Table):
        langs = np.array(table.column("lang").to_pylist(), dtype=object)
        keys, n = table.column("key").to_numpy().astype(np.int64), table.column("n").to_numpy().astype(np.float64)
        self.langs = sorted(set(langs))
        which = np.searchsorted(np.array(self.langs, dtype=object), langs) if len(langs) else np.zeros(0, np.int64)
        union = np.unique(keys)
        count = np.zeros((len(union), len(self.langs)))
        count[np.searchsorted(union, keys), which] = n
        levels = [(union, count)]
        for order in range(ORDER - 1, 0, -1):  # continuation counts: distinct left neighbours
            k, c = levels[0]
            low, inv = np.unique(k & ((1 << BITS * order) - 1), return_inverse=True)
            cont = np.zeros((len(low), len(self.langs)))
            np.add.at(cont, inv, c > 0)
            levels.insert(0, (low, cont))
        self.keys, self.prob, self.ctx, self.back = [], [], [], []
        below = None
        for order, (k, c) in enumerate(levels, 1):
            ctx, inv = np.unique(k >> BITS, return_inverse=True)
            ones, twos = (c == 1).sum(0), (c == 2).sum(0)
            d = np.clip(ones / np.maximum(1, ones + 2 * twos), 0.1, 0.9)
            total, kinds = np.zeros((len(ctx), c.shape[1])), np.zeros((len(ctx), c.shape[1]))
            np.add.at(total, inv, c)
            np.add.at(kinds, inv, c > 0)
            back = np.where(total > 0, d * kinds / np.maximum(total, 1), 1.0)
            lower = np.full(c.shape, 1 / SYMBOLS) if below is None else below[np.searchsorted(self.keys[-1], k & ((1 << BITS * (order - 1)) - 1))]
            p = np.maximum(c - d, 0) / np.maximum(total[inv], 1) + back[inv] * lower
            below = p
            self.keys.append(k)
            self.prob.append(np.log(p).astype(np.float32))
            self.ctx.append(ctx)
            self.back.append(np.log(back).astype(np.float32))
        share = count / np.maximum(1, count.sum(0))
        self.mean = -(share * self.prob[-1]).sum(0)
        self.spread = np.sqrt(np.maximum((share * self.prob[-1].astype(np.float64) ** 2).sum(0) - self.mean**2, 0))
        self._index: np.ndarray | None = None

    def __getstate__(self):
        return self.__dict__ | {"_index": None}

    def _missing(self, key: np.ndarray, order: int) -> np.ndarray:
        """Log probabilities of keys of ``order`` symbols that may be unseen."""
        if order == 0:
            return np.full((len(key), len(self.langs)), -np.log(SYMBOLS), np.float32)
        k = self.keys[order - 1]
        at = np.minimum(np.searchsorted(k, key), len(k) - 1)
        seen = k[at] == key
        out = np.empty((len(key), len(self.langs)), np.float32)
        out[seen] = self.prob[order - 1][at[seen]]
        lost = key[~seen]
        if len(lost):
            c = self.ctx[order - 1]
            at = np.minimum(np.searchsorted(c, lost >> BITS), len(c) - 1)
            weight = np.where((c[at] == lost >> BITS)[:, None], self.back[order - 1][at], 0)
            out[~seen] = weight + self._missing(lost & ((1 << BITS * (order - 1)) - 1), order - 1)
        return out

    def classify(self, column: pa.Array) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
        """(language, score, cross-entropy, rejected) of every row."""
        rows = len(column)
        key, row = symbols(column)
        n = np.bincount(row, minlength=rows)
        letters = np.bincount(row, key & (SYMBOLS - 1) > 0, rows)
        if not self.langs:
            return [UNKNOWN] * rows, np.zeros(rows), np.zeros(rows), np.ones(rows, bool)
        if self._index is None:  # positions in the sorted array, by key
            self._index = np.full(1 << BITS * ORDER, -1, np.int32)
            self._index[self.keys[-1]] = np.arange(len(self.keys[-1]), dtype=np.int32)
        at = self._index[key]
        logp = self.prob[-1][at]
        lost = np.flatnonzero(at < 0)
        if len(lost):
            logp[lost] = self._missing(key[lost].astype(np.int64), ORDER)
        some = np.flatnonzero(n)
        entropy = np.zeros((rows, len(self.langs)))
        entropy[some] = -np.add.reduceat(logp, np.searchsorted(row, some), axis=0, dtype=np.float64) / n[some][:, None]
        best = np.argmin(entropy, 1)
        low = entropy[np.arange(rows), best]
        with np.errstate(over="ignore"):
            score = 1 / np.exp(-np.clip((entropy - low[:, None]) * np.minimum(n, 100)[:, None], 0, 500)).sum(1)
        none = letters == 0
        limit = self.mean[best] + Z * self.spread[best] / np.sqrt(np.maximum(n, 1)) + MARGIN
        return [UNKNOWN if u else self.langs[i] for u, i in zip(none, best, strict=True)], np.where(none, 0, score), low, none | (low > limit)


def fit_languages(docs: DataFrame) -> LanguageModels:
    """Models from all rows with text and lang. At most 2**24 keys a language
    reach the driver, however many texts there are."""
    return LanguageModels(gram_counts(docs).toArrow())


def identify(docs: DataFrame, models: LanguageModels) -> DataFrame:
    """doc_id, lang_pred, score, cross_entropy (nats a symbol) and rejected of every row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            lang, score, entropy, rejected = shared.value.classify(b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(entropy, pa.float64()), pa.array(rejected, pa.bool_())],
                ["doc_id", "lang_pred", "score", "cross_entropy", "rejected"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {id_type}, lang_pred string, score double, cross_entropy double, rejected boolean")
