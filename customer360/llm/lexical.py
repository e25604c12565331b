"""Ranked lexical search of all documents by bag deduplication.

For every item (a stated query) the ``top`` highest-scoring documents, scores in
whole numbers. Most of a document does not matter to any item, and many
documents look alike to all of them:

1. One scan of the texts restricts every document to the vocabulary of the
   items: its number of terms, and the numbers and frequencies of the terms that
   some item has. The same rows give N, L and the document frequencies.
2. Documents with the same term-frequency vector and the same length class ``m``
   have the same score for every item. They are hashed and grouped, and the
   vectors of equal hashes are compared by the grouping itself; each class is
   scored once.
3. Items are dealt into blocks and classes into slices of bounded size, and each
   block meets each slice in one task: postings of the block's terms are
   multiplied out for the slice's classes, and the best ``top`` classes of every
   item go on. A class counts by its smallest doc_id, so a document among the
   best ``top`` is always in one of the best ``top`` classes.
4. Only the classes that are left are expanded into members, ``top`` smallest
   ids each, and ranked by score and doc_id.

The vocabulary reaches the scan in blocks of ``VOCAB_BLOCK`` terms, one after
another within the one pass. A class that holds a third of all documents is
one row after partial aggregation, and its members are found by
:func:`customer360.llm.skew.join_groups`.

Defined results: a NULL or empty text has no terms, counts for nothing and is in
no ranking; an item without terms, or whose terms no document has, gives no
rows; items that repeat both item_id and text are one, those that repeat only
the item_id are searched for separately; a document that is repeated is
counted and ranked as often as it is there; a NULL doc_id comes before others of
its score; empty tables give no rows; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from customer360.llm.decontam import words
from customer360.llm.skew import join_groups
from customer360.llm.textnum import chunks, utf8
from customer360.plans import cut_lineage

TOP = 20
#: Terms of one vocabulary block (8 bytes each) in a scanning task.
VOCAB_BLOCK = 1 << 22
#: Items of one block and classes of one slice.
ITEM_BLOCK = 2048
SLICE_ROWS = 8192
#: Scores held at once by a scoring task (classes x items), and postings multiplied out at once.
SCORE_CELLS = 1 << 20
EXPAND_CELLS = 1 << 22

# Fixed values of the score.
SCALE, K_TENTHS, B_PERCENT, WEIGHT_SCALE = 1_000_000_000, 12, 25, 1000

_VECTOR = "n bigint, terms binary, tfs binary"


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, term, copies) of every item, the term as its hash."""
    for b in chunks(batches):
        h, w = words(*utf8(b.column("text")))
        known, which = np.unique(h, return_inverse=True)
        row = np.repeat(np.arange(b.num_rows), np.diff(w))
        pair, n = np.unique(row * max(1, len(known)) + which, return_counts=True)
        item = b.column("item").to_numpy()[pair // max(1, len(known))]
        term = known[pair % max(1, len(known))]
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(term.view(np.int64)), pa.array(n.astype(np.int64))], ["item", "term", "copies"])


def _restricted(block, at: int, last: bool):
    """Adds the terms of one vocabulary block (broadcast sorted hashes, the first
    one numbered ``at``) to the vectors; the text goes after the ``last`` block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = block.value
        for b in chunks(batches):
            rows = b.num_rows
            h, w = words(*utf8(b.column("text")))
            near = np.minimum(np.searchsorted(vocab, h), len(vocab) - 1)
            hit = np.flatnonzero(vocab[near] == h)
            row = np.searchsorted(w, hit, "right") - 1
            pair, tf = np.unique(row.astype(np.int64) * len(vocab) + near[hit], return_counts=True)
            ends = np.searchsorted(pair, np.arange(1, rows + 1) * len(vocab)).tolist()
            term = (pair % len(vocab) + at).astype("<u4").tobytes()
            tf = tf.astype("<u4").tobytes()
            old = zip(b.column("terms").to_pylist(), b.column("tfs").to_pylist(), strict=True)
            spans = list(zip([0, *ends[:-1]], ends, strict=True))
            made = [((t or b"") + term[4 * x : 4 * y], (f or b"") + tf[4 * x : 4 * y]) for (t, f), (x, y) in zip(old, spans, strict=True)]
            cols = [b.column("doc_id"), pa.array(np.diff(w).astype(np.int64)), pa.array([t for t, _ in made], pa.binary()), pa.array([f for _, f in made], pa.binary())]
            names = ["doc_id", "n", "terms", "tfs"]
            yield pa.RecordBatch.from_arrays(cols if last else [*cols, b.column("text")], names if last else [*names, "text"])

    return run


def term_vectors(docs: DataFrame, vocab: np.ndarray, block: int = VOCAB_BLOCK) -> DataFrame:
    """doc_id, n (number of terms), terms and tfs (little-endian unsigned 32-bit
    numbers of the document's terms in the sorted hashes ``vocab``, and their
    frequencies) of every row, in one scan of the texts."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.lit(None).cast("binary").alias("terms"), F.lit(None).cast("binary").alias("tfs"))
    if not len(vocab):
        vocab = np.zeros(1, np.uint64)  # a term that, but for its number, no document matters by
    for at in range(0, len(vocab), block):
        last = at + block >= len(vocab)
        part = docs.sparkSession.sparkContext.broadcast(vocab[at : at + block])
        out = out.mapInArrow(_restricted(part, at, last), f"doc_id {id_type}, {_VECTOR}" + ("" if last else ", text string"))
    return out


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, df) of the vectors of a batch."""
    for b in batches:
        term, n = np.unique(np.frombuffer(b"".join(b.column("terms").to_pylist()), "<u4"), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(term.astype(np.int64)), pa.array(n.astype(np.int64))], ["term", "df"])


def _scored(classes: dict[str, np.ndarray | list], post: dict[str, np.ndarray], items: int, top: int):
    """(item, class, score) rows: at least the ``top`` best classes of every item.

    ``post``: start and stop of each term's postings, and their items, copies and weights."""
    kept = [np.zeros(0, np.int64)] * 3
    bar = np.zeros(items, np.int64)  # the score of an item's top-th best class so far
    rows = len(classes["m"])
    step = max(1, SCORE_CELLS // max(1, items))
    for a in range(0, rows, step):
        z = min(rows, a + step)
        term = np.frombuffer(b"".join(classes["terms"][a:z]), "<u4").astype(np.int64)
        tf = np.frombuffer(b"".join(classes["tfs"][a:z]), "<u4").astype(np.int64)
        row = np.repeat(np.arange(z - a), [len(t) // 4 for t in classes["terms"][a:z]])
        gain = SCALE * tf // (1000 * tf + K_TENTHS * classes["m"][a:z][row])
        first, size = post["start"][term], post["stop"][term] - post["start"][term]
        score = np.zeros((z - a) * items, np.int64)
        cut = np.concatenate(([0], np.cumsum(size)))
        at = 0
        while at < len(term):  # bounded pieces of the multiplied-out postings
            end = max(at + 1, int(np.searchsorted(cut, cut[at] + EXPAND_CELLS, "right")) - 1)
            n = size[at:end]
            which = np.repeat(first[at:end] - (cut[at:end] - cut[at]), n) + np.arange(cut[end] - cut[at])
            value = np.repeat(gain[at:end], n) * post["weight"][which]
            cell = np.repeat(row[at:end] * items, n) + post["item"][which]
            value *= post["copies"][which]
            # Sums of halves stay below 2**53, so they are exact in doubles.
            for part, shift in ((value & 0xFFFFFF, 0), (value >> 24, 24)):
                score += np.bincount(cell, part, len(score)).astype(np.int64) << shift
            at = end
        score = score.reshape(z - a, items)
        c, i = np.nonzero((score > 0) & (score >= bar))
        kept = [np.concatenate(x) for x in zip(kept, (i, c + a, score[c, i]), strict=True)]
        # Of each item the best ``top`` stay; classes are in the order of their smallest ids.
        order = np.lexsort((kept[1], -kept[2], kept[0]))
        kept = [x[order] for x in kept]
        nth = np.arange(len(order)) - np.searchsorted(kept[0], kept[0])
        full = nth == top - 1
        bar[kept[0][full]] = kept[2][full]
        kept = [x[nth < top] for x in kept]
    return kept


def _tile(top: int):
    """One block of items against one slice of classes."""

    def run(classes: pa.Table, posts: pa.Table) -> pa.Table:
        names = ["item", "cid", "lead", "score"]
        if not classes.num_rows or not posts.num_rows:
            return pa.Table.from_arrays([pa.array([], pa.int64()), pa.array([], pa.int64()), classes.column("lead").slice(0, 0), pa.array([], pa.int64())], names)
        classes = classes.take(pc.sort_indices(classes, [("lead", "ascending"), ("cid", "ascending")], null_placement="at_start"))
        term, item, copies, weight = (posts.column(c).to_numpy() for c in ("number", "item", "copies", "weight"))
        order = np.argsort(term, kind="stable")
        term = term[order]
        own, item = np.unique(item[order], return_inverse=True)
        rows = {"m": classes.column("m").to_numpy(), "terms": classes.column("terms").to_pylist(), "tfs": classes.column("tfs").to_pylist()}
        high = 1 + max(int(term[-1]), max((int(np.frombuffer(t, "<u4").max(initial=0)) for t in rows["terms"]), default=0))
        spans = np.searchsorted(term, np.arange(high + 1))
        post = {"start": spans[:-1], "stop": spans[1:], "item": item, "copies": copies[order], "weight": weight[order]}
        i, c, score = _scored(rows, post, len(own), top)
        c = pa.array(c)
        return pa.Table.from_arrays([pa.array(own[i]), classes.column("cid").take(c), classes.column("lead").take(c), pa.array(score)], names)

    return run


def search(docs: DataFrame, items: DataFrame, top: int = TOP, vocab_block: int = VOCAB_BLOCK, item_block: int = ITEM_BLOCK, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the ``top`` best documents of
    each item (item_id, text) with a score above 0."""
    id_type, item_type = (t.schema[c].dataType for t, c in ((docs, "doc_id"), (items, "item_id")))
    asked = items.select("item_id", F.col("text").cast("string").alias("text")).distinct()
    asked = cut_lineage(asked.withColumn("item", F.monotonically_increasing_id()))
    bags = cut_lineage(asked.select("item", "text").mapInArrow(_item_terms, "item bigint, term bigint, copies bigint"))
    # The sorted term hashes of the stated queries, 8 bytes each.
    vocab = np.sort(bags.select("term").distinct().toArrow().column("term").to_numpy().view(np.uint64))

    seen = cut_lineage(term_vectors(docs, vocab, vocab_block))
    n_docs, length = seen.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    seen = seen.where(F.octet_length("terms") > 0).withColumn("m", F.lit(100 - B_PERCENT).cast("long") + F.expr(f"({B_PERCENT}L * n * {n_docs}L) div {max(1, length)}L"))

    df = seen.select("terms").mapInArrow(_frequencies, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(WEIGHT_SCALE * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    numbers = docs.sparkSession.createDataFrame(pa.table({"term": vocab.view(np.int64), "number": np.arange(len(vocab), dtype=np.int64)}))
    weights = df.select(F.col("term").alias("number"), weight.alias("weight"))
    posts = bags.join(numbers, "term").join(weights, "number").select("item", "number", "copies", "weight")

    # Classes: equal hashes meet, and the grouping compares the vectors themselves.
    key = F.xxhash64("m", "terms", "tfs")
    classes = seen.groupBy(key.alias("hash"), "m", "terms", "tfs").agg(F.count("*").alias("members"), F.min(F.struct("doc_id")).alias("lead"))
    classes = cut_lineage(classes.withColumn("cid", F.monotonically_increasing_id()).withColumn("lead", F.col("lead.doc_id")))
    total, found = classes.agg(F.coalesce(F.sum("members"), F.lit(0)), F.count("*")).first()
    blocks, slices = max(1, -(-asked.count() // item_block)), max(1, -(-found // slice_rows))

    dealt = F.pmod(F.xxhash64("cid"), F.lit(slices)).cast("int").alias("slice")
    left = classes.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), dealt, "cid", "lead", "m", "terms", "tfs")
    right = posts.select(F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), "item", "number", "copies", "weight")
    schema = f"item bigint, cid bigint, lead {id_type.simpleString()}, score bigint"
    best = left.groupBy("block", "slice").cogroup(right.groupBy("block", "slice")).applyInArrow(_tile(top), schema)
    order = [F.col("score").desc(), F.col("lead").asc_nulls_first(), "cid"]
    best = cut_lineage(best.withColumn("nth", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("nth") <= top).drop("nth"))

    # Members of the classes that are left, found by hash and told apart by vector.
    wanted = classes.join(best.select("cid").distinct(), "cid", "left_semi").select("hash", "cid", "members", F.col("m").alias("m_"), F.col("terms").alias("terms_"), F.col("tfs").alias("tfs_"))
    met = join_groups(seen.withColumn("hash", key), wanted, "hash", "members", total)
    same = (F.col("m") == F.col("m_")) & (F.col("terms") == F.col("terms_")) & (F.col("tfs") == F.col("tfs_"))
    first_ids = Window.partitionBy("cid").orderBy(F.col("doc_id").asc_nulls_first())
    members = met.where(same).select("cid", "doc_id", F.row_number().over(first_ids).alias("nth")).where(F.col("nth") <= top)
    ranked = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    out = best.select("item", "cid", "score").join(members, "cid").withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    return out.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: The search of ``documents`` for ``benchmark`` in DuckDB SQL.
ORACLE = f"""
WITH q AS (SELECT row_number() OVER () AS item, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)),
d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({_LOWER}, '{_TERM}') AS t FROM documents),
s AS (SELECT count(*) AS n_docs, sum(len(t)) AS total FROM d WHERE len(t) > 0),
tf AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(t) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor({WEIGHT_SCALE} * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY term, n_docs),
m AS (SELECT row, doc_id, {100 - B_PERCENT} + ({B_PERCENT} * len(t) * n_docs) // total AS m FROM d, s WHERE len(t) > 0),
i AS (SELECT item, term, count(*) AS copies FROM (SELECT item, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM q) GROUP BY ALL),
r AS (SELECT item, row, doc_id, CAST(sum(copies * w * (({SCALE} * tf) // (1000 * tf + {K_TENTHS} * m))) AS BIGINT) AS score
  FROM i JOIN w USING (term) JOIN tf USING (term) JOIN m USING (row) GROUP BY ALL),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o JOIN q USING (item) WHERE rank <= {TOP}"""
