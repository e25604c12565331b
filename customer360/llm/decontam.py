"""Benchmark decontamination by BM25 over an inverted index of test items.

Test items are the indexed documents; every passage of every training text
is a query. Items are cut into shards of ``SHARD_ITEMS``, so that the index a
task has unpacked has a proven bound; shards are built in a task each, and the one pass
over the corpus takes every chunk through all of them. Number of items, mean length
and document frequencies are those of all
items, so results do not depend on the shards. Inside a shard:

* Items are grouped by length class (a power of two words, L); passages are
  windows of 2 L words every L words, so any L consecutive words lie whole
  in one of them.
* Impacts are BM25 term weights divided by the item's threshold, ``theta``
  times its score against itself: an item is retrieved when they sum to 1.
* An item's lightest terms, up to ``SLACK`` in sum, are non-essential: they
  enter every bound as a constant, and only essential terms have postings.
  Items stand in blocks of ``BLOCK`` with a maximal impact per term. A
  passage skips a block whose bound stays below 1; in the others it skips
  items by their own bounds, and the rest are scored in full.
* A retrieved item is verified on word trigrams of the passage: question
  (up to the last sentence or line) and answer (the rest) must both be
  covered by half, or the whole item by 0.6.

Nothing is capped: all passages are queries and all items above the
threshold are returned.

Defined results: NULL or empty texts and items without words give no rows;
repeated rows give repeated findings; other columns are ignored; an empty
benchmark or corpus gives an empty result.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from customer360.llm.skew import free_name
from customer360.llm.textnum import chunks, ngram_hashes, span_hashes, utf8
from customer360.plans import cut_lineage

SHARD_ITEMS = 4096
BLOCK = 4
THETA = 0.5
K1, B = 1.2, 0.75
GRAM = 3
PART_COVER, WHOLE_COVER = 0.5, 0.6
#: What an item's non-essential terms may sum to (its threshold is 1).
SLACK = 0.75

#: Word characters: ASCII letters and digits and every non-ASCII byte.
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[65:91] = WORD[97:123] = True
WORD[128:] = True


def words(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of alphanumeric words, word offsets of the rows)."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    w = WORD[raw]
    a, z = w.copy(), w.copy()
    a[1:] &= ~w[:-1] | edge[1:n]
    z[:-1] &= ~w[1:] | edge[1:n]
    s, e = np.flatnonzero(a), np.flatnonzero(z) + 1
    return span_hashes(raw, s, e), np.searchsorted(s, off)


def _split(text: str) -> tuple[str, str]:
    """(question, answer): the answer is the last sentence or line."""
    body = text.rstrip()
    cut = max(body.rfind(x, 0, max(0, len(body) - 1)) for x in ("\n", ". ", "? ", "! "))
    return (body[: cut + 1], body[cut + 1 :]) if cut > 0 else (body, "")


class Index:
    """One shard: BM25 impacts, block maxima and the trigrams to verify.

    ``among``: number of all items with words, their mean length, and the sorted
    terms of this shard with their document frequencies; None if this shard
    holds all items."""

    def __init__(self, items: list[tuple], theta: float = THETA, among: tuple | None = None):
        raw, off = utf8(pa.array([t for _, t in items], pa.string()))
        h, w = words(raw, off)
        size = np.diff(w)
        self.ids = [i for i, _ in items]
        self.size = size
        order = [int(i) for i in np.argsort(size, kind="stable") if size[i]]
        self.level = np.zeros(len(items), np.int64)
        self.level[size > 0] = np.ceil(np.log2(size[size > 0])).astype(np.int64)
        # Blocks hold items of one length class.
        self.block_items: list[list[int]] = []
        for i in order:
            last = self.block_items[-1] if self.block_items else None
            if last and len(last) < BLOCK and self.level[last[0]] == self.level[i]:
                last.append(i)
            else:
                self.block_items.append([i])
        self.terms, inverse = np.unique(h, return_inverse=True)
        item = np.repeat(np.arange(len(items)), size)
        pair, tf = np.unique(inverse.astype(np.int64) * len(items) + item, return_counts=True)
        term, item = pair // max(1, len(items)), pair % max(1, len(items))
        df = np.bincount(term, minlength=len(self.terms))
        n = len(order)
        mean = max(1.0, size[size > 0].mean() if n else 1.0)
        if among:
            n, mean, known, counts = among
            df = counts[np.searchsorted(known, self.terms)]
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        impact = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[item] / mean))
        impact /= np.maximum(theta * np.bincount(item, impact, len(items))[item], 1e-12)
        self.vector = [None] * len(items)
        by = np.argsort(item, kind="stable")
        ends = np.searchsorted(item[by], np.arange(len(items) + 1))
        for i in order:
            at = by[ends[i] : ends[i + 1]]
            self.vector[i] = (term[at], impact[at])
        # An item's essential terms: the heaviest ones, such that the others sum to SLACK at most.
        by = np.lexsort((-impact, item))
        running = np.cumsum(impact[by]) - np.concatenate(([0.0], np.cumsum(np.bincount(item, impact, len(items)))))[item[by]]
        total = np.bincount(item, impact, len(items))
        essential = np.zeros(len(impact), bool)
        essential[by] = total[item[by]] - (running - impact[by]) > SLACK
        self.rest = np.bincount(item[~essential], impact[~essential], len(items))
        self.block_of = np.zeros(len(items), np.int64)
        for k, members in enumerate(self.block_items):
            self.block_of[members] = k
        blocks = max(1, len(self.block_items))
        self.block_rest = np.zeros(blocks)
        np.maximum.at(self.block_rest, self.block_of[order], self.rest[order])
        t, i, v = term[essential], item[essential], impact[essential]
        key, at = np.unique(t * blocks + self.block_of[i], return_inverse=True)
        top = np.zeros(len(key))
        np.maximum.at(top, at, v)
        ends = np.arange(len(self.terms) + 1)
        self.postings = {}
        for level in sorted({int(self.level[i]) for i in order}):
            bl = np.isin(key % blocks, self.block_of[[x for x in order if self.level[x] == level]])
            il = self.level[i] == level
            self.postings[level] = (
                (np.searchsorted((key // blocks)[bl], ends), (key % blocks)[bl], top[bl]),
                (np.searchsorted(t[il], ends), i[il], v[il]))
        self.parts = []
        for _, text in items:
            grams = []
            for part in _split(text or ""):
                p, _ = words(*utf8(pa.array([part])))
                grams.append(np.unique(ngram_hashes(p, min(GRAM, len(p)))) if len(p) else np.zeros(0, np.uint64))
            self.parts.append(grams)

    def search(self, h: np.ndarray, w: np.ndarray) -> Iterator[tuple]:
        """(row, item, score, first word, last word, question cover, answer cover)
        of every verified passage of the rows' words."""
        if not len(self.terms) or not len(h):
            return
        at = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        term = np.where(self.terms[at] == h, at, -1)
        size = np.diff(w)
        row = np.repeat(np.arange(len(size)), size)
        known = np.flatnonzero(term >= 0)
        for level, (by_block, by_item) in self.postings.items():
            length = 1 << level
            cells = np.concatenate(([0], np.cumsum(-(-size // length) + 1)))  # one empty cell between rows
            cell = cells[row[known]] + (known - w[row[known]]) // length
            # One entry for a term of a cell.
            pair = np.unique(cell * len(self.terms) + term[known])
            cell, word = pair // len(self.terms), pair % len(self.terms)
            live = _passages(cell, word, by_block, self.block_rest)
            if not len(live):
                continue
            on = np.isin(cell, live // len(self.block_rest)) | np.isin(cell - 1, live // len(self.block_rest))
            hits = _passages(cell[on], word[on], by_item, self.rest)
            c, i = hits // len(self.rest), hits % len(self.rest)
            for c, i in zip(c.tolist(), i.tolist(), strict=True):
                r = int(np.searchsorted(cells, c, "right")) - 1
                a = int(w[r]) + (c - int(cells[r])) * length
                yield from self._score(r, max(a, int(w[r])), min(a + 2 * length, int(w[r + 1])), i, term, h, w)

    def _score(self, r: int, a: int, z: int, i: int, term, h, w) -> Iterator[tuple]:
        t, impact = self.vector[i]
        score = float(impact[np.isin(t, term[a:z])].sum())
        if score < 1:
            return
        grams = np.concatenate([ngram_hashes(h[a:z], n) for n in range(1, GRAM + 1)])  # shorter parts are one shorter gram
        q, s = self.parts[i]
        covers = [float(np.isin(p, grams).mean()) if len(p) else 1.0 for p in (q, s)]
        whole = (covers[0] * len(q) + covers[1] * len(s)) / max(1, len(q) + len(s))
        if min(covers) >= PART_COVER or whole >= WHOLE_COVER:
            yield r, i, score, a - int(w[r]), z - int(w[r]), covers[0], covers[1]


def _passages(cell: np.ndarray, word: np.ndarray, postings: tuple, rest: np.ndarray) -> np.ndarray:
    """Keys (first cell * len(rest) + target) of the two-cell passages whose
    summed postings and ``rest`` of the target reach 1."""
    start, target, weight = postings
    many = start[word + 1] - start[word]
    at = np.flatnonzero(many)
    many = many[at]
    if not len(at):
        return np.zeros(0, np.int64)
    stop = np.cumsum(many)
    pick = np.repeat(start[word[at]] - (stop - many), many) + np.arange(stop[-1])
    key, inv = np.unique(np.repeat(cell[at], many) * len(rest) + target[pick], return_inverse=True)
    mass = np.bincount(inv, weight[pick])
    # A passage may begin in the cell of a posting or in the cell before it.
    first = np.unique(np.concatenate((key, key - len(rest))))
    first = first[first >= 0]

    def of(k: np.ndarray) -> np.ndarray:
        p = np.minimum(np.searchsorted(key, k), len(key) - 1)
        return np.where(key[p] == k, mass[p], 0)

    return first[of(first) + of(first + len(rest)) + rest[first % len(rest)] >= 1 - 1e-9]


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, size, terms) of every item: its number of words and distinct words."""
    for b in chunks(batches):
        h, w = words(*utf8(b.column("text")))
        terms = [np.unique(h[a:z]).view(np.int64) for a, z in zip(w[:-1].tolist(), w[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("shard"), pa.array(np.diff(w).astype(np.int64)), pa.array(terms, pa.list_(pa.int64()))], ["shard", "size", "terms"])


def _frequencies(items: DataFrame) -> tuple[int, float, DataFrame]:
    """Number of items with words, their mean length, and (shard, term, df) of
    every term of a shard, df counted over the items of all shards."""
    rows = cut_lineage(items.select("shard", "text").mapInArrow(_item_words, "shard int, size bigint, terms array<bigint>"))
    n, total = rows.where("size > 0").agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    terms = rows.select("shard", F.explode("terms").alias("term"))
    held = terms.groupBy("shard", "term").agg(F.count("*").alias("here"))
    df = held.groupBy("term").agg(F.sum("here").alias("df"))
    return n, max(1.0, total / n if n else 1.0), cut_lineage(held.select("shard", "term").join(df, "term"))


def _shards(items: DataFrame, theta: float) -> list[bytes]:
    """The index of every shard (``items`` with a shard number), pickled: built in a
    task each, from its items and the statistics of all of them."""
    n, mean, held = _frequencies(items)

    def build(part: pa.Table, terms: pa.Table) -> pa.Table:
        if not part.num_rows:
            return pa.table({"index": pa.array([], pa.binary())})
        term = terms.column("term").to_numpy().view(np.uint64)
        order = np.argsort(term)
        rows = list(zip(part.column("item_id").to_pylist(), part.column("text").to_pylist(), strict=True))
        index = Index(rows, theta, (n, mean, term[order], terms.column("df").to_numpy()[order]))
        return pa.table({"index": pa.array([pickle.dumps(index)], pa.binary())})

    built = items.groupBy("shard").cogroup(held.groupBy("shard")).applyInArrow(build, "index binary")
    return [bytes(r["index"]) for r in built.toLocalIterator()]


def find_leaks(docs: DataFrame, benchmark: DataFrame, theta: float = THETA, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """One row per (document row, item) whose passage is verified: doc_id,
    item_id, score (BM25 as a share of the item's threshold), n_passages,
    first_word and last_word of the best passage, question_cover, answer_cover.

    One scan of ``docs``, however many items there are: the words of a chunk are
    hashed once and go through the shards one after another, one index unpacked at a time."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text"))
    shards = max(1, -(-items.count() // shard_items))
    id_type, item_type = docs.schema["doc_id"].dataType, items.schema["item_id"].dataType
    arrow_item = to_arrow_type(item_type)
    schema = (f"doc_id {id_type.simpleString()}, item_id {item_type.simpleString()}, score double, n_passages int, first_word int, last_word int, "
              "question_cover double, answer_cover double")
    items = items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)).cast("int"))
    packed = [spark.sparkContext.broadcast(x) for x in _shards(cut_lineage(items), theta)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = pickle.loads(packed[0].value) if len(packed) == 1 else None
        for b in chunks(batches):
            spans = words(*utf8(b.column("text")))
            for shard in packed:
                index = only or pickle.loads(shard.value)
                found: dict[tuple[int, int], list] = {}
                for r, i, score, a, z, q, s in index.search(*spans):
                    best = found.setdefault((r, i), [set(), None])
                    best[0].add(a)
                    rank = (q + s, score, -a)
                    if best[1] is None or rank > best[1][0]:
                        best[1] = (rank, (score, a, z, q, s))
                if not found:
                    continue
                keys = sorted(found)
                best = [found[x][1][1] for x in keys]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(pa.array([r for r, _ in keys], pa.int64())), pa.array([index.ids[i] for _, i in keys], arrow_item),
                     pa.array([x[0] for x in best], pa.float64()), pa.array([len(found[x][0]) for x in keys], pa.int32()),
                     pa.array([x[1] for x in best], pa.int32()), pa.array([x[2] for x in best], pa.int32()),
                     pa.array([x[3] for x in best], pa.float64()), pa.array([x[4] for x in best], pa.float64())],
                    ["doc_id", "item_id", "score", "n_passages", "first_word", "last_word", "question_cover", "answer_cover"])

    return docs.mapInArrow(run, schema)


def remove_leaks(docs: DataFrame, benchmark: DataFrame, theta: float = THETA) -> DataFrame:
    """``docs`` (all columns) without the rows that hold a verified passage."""
    text, row = F.col("text").cast("string"), free_name("row_key", docs)
    keyed = docs.withColumn(row, F.xxhash64("doc_id", text))
    leaky = find_leaks(keyed.select(F.col(row).alias("doc_id"), text.alias("text")), benchmark, theta).select(F.col("doc_id").alias(row)).distinct()
    return keyed.join(leaky, row, "left_anti").drop(row)
