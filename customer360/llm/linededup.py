"""Near-duplicate lines by a segment-partition edit join.

A line is a maximal run of text between line feeds. Lines of ``min_chars`` or
more code points take part. Equal lines are one vertex (64-bit hash of the
bytes). Two different lines link when their edit distance is at most ``tau``,
which grows with the length of the shorter one (``CLASSES``); classes of lines
are the connected components of the links.

The join is exact. In each length class, a line gives ``tau + 1`` disjoint
segments of one width, the first half placed from the line's start, the others
from its end (the index rows). ``tau`` edits leave one of them unchanged, and
one that lies, counted from its end of the line, no further off than the
segments before it are many. So a line probes with the substrings at those
places, in its own class and in the one below if a partner may be there; neither needs
the partner's length. Keys held by one line only are
dropped. Each key's members are first verified against the index line that
shares most of its segments, and merged; then only pairs of different merged groups are formed, so a
large group of copies is never expanded into all pairs. Lengths and the parities of character
and character-pair counts, of which an edit flips few bits, discard most pairs
inside the joins. Distances of the others come from a diagonal band of 2 tau + 1 cells kept as bit vectors, advanced for many pairs
at once.

Of every class the first occurrence in the corpus (smallest doc_id, then
text hash, then line number) stays; the others are removed.

Defined results: NULL text has no lines and stays NULL; shorter lines are
never removed; a NULL doc_id sorts first; identical rows are treated alike;
an empty table gives no rows; other columns pass through unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from customer360.llm.components import connected_components
from customer360.llm.skew import free_name
from customer360.llm.textnum import chunks, mix, powers, utf8
from customer360.plans import cut_lineage

#: Length classes: from so many code points (of the shorter line) on, so many
#: edits. More edits for long lines (up to 16 were tried) pair the variants of a
#: passage that differ by a word with one another: README has the figures. A line has about (tau + 1)^2 / 2 keys.
#: A class is cut into steps of a quarter more length, with segments of their own width.
CLASSES = ((16, 1), (24, 2), (1024, 3))
MIN_CHARS = 16
#: Rows of a key before its pairs are salted.
KEY_ROWS = 512
#: Cells (pairs x code points) verified at once.
BAND_CELLS = 1 << 22

#: Line numbers in a table of wanted lines that is broadcast (counted before).
BROADCAST_LINES = 500_000

_MARKS = ["m0", "m1", "m2"]
_U = np.uint64


class Lines:
    """Code points of a chunk of texts, cut into lines, with substring hashes."""

    def __init__(self, column: pa.Array):
        raw, off = utf8(column)
        self.cp = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        chars = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
        edge = chars[off]
        feeds = np.flatnonzero(self.cp == 10)
        start = np.concatenate((edge[:-1], feeds + 1))
        stop = np.concatenate((edge[1:], feeds))
        row = np.concatenate((np.arange(len(off) - 1), np.searchsorted(edge, feeds, "right") - 1))
        # A row's first line ends at its first feed; its last line starts after its last one.
        order = np.lexsort((start, row))
        self.row, self.start = row[order], start[order]
        end = edge[1:][self.row]
        after = np.concatenate((self.start[1:], [0]))
        same = np.concatenate((self.row[1:] == self.row[:-1], [False])) if len(self.row) else np.zeros(0, bool)
        self.stop = np.where(same, after - 1, end)
        del stop
        first = np.searchsorted(self.row, np.arange(len(off) - 1))
        self.number = np.arange(len(self.row)) - first[self.row]
        self.n = self.stop - self.start
        p, self.inv = powers(len(self.cp) + 1)
        with np.errstate(over="ignore"):
            self.sum = np.zeros(len(self.cp) + 1, _U)
            np.cumsum((self.cp.astype(_U) * _U(0x9E3779B97F4A7C15) + _U(0x7F4A7C15)) * p[: len(self.cp)], out=self.sum[1:])

    def hash(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sum[b] - self.sum[a]) * self.inv[a] + (b - a).astype(_U))


def _occurrences(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            x = Lines(b.column("text"))
            use = np.flatnonzero(x.n >= min_chars)
            row = pa.array(x.row[use])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(row), b.column("rk").take(row), pa.array(x.number[use].astype(np.int32)), pa.array(x.hash(x.start[use], x.stop[use]).view(np.int64))],
                ["doc_id", "rk", "line_no", "line"])

    return run


def tau_of(n: np.ndarray, classes=CLASSES) -> np.ndarray:
    """Edits that a pair may differ by whose shorter line has ``n`` code points; -1 below the classes."""
    return np.array([-1, *(t for _, t in classes)])[np.searchsorted([least for least, _ in classes], n, "right")]


def _steps(classes) -> list[tuple[int, int, int, int]]:
    """(least, end, tau, width of a segment) of every step of the classes."""
    out = []
    for c, (least, tau) in enumerate(classes):
        last = classes[c + 1][0] if c + 1 < len(classes) else 1 << 40
        while least < last:
            end = min(last, least + max(tau, least // 4))
            out.append((least, end, tau, least // (tau + 1)))
            least = end
    return out


def _keys(classes):
    """(key, line, indexed) rows: a line's own segments, and its probes for partners
    that are no longer than it is."""
    steps = _steps(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, _U)
        for b in chunks(batches):
            x = Lines(b.column("text"))
            use = np.flatnonzero(x.n >= classes[0][0])
            line, at = np.unique(x.hash(x.start[use], x.stop[use]), return_index=True)
            new = ~np.isin(line, seen, assume_unique=True)
            line, use = line[new], use[at[new]]
            seen = np.concatenate((seen, line))
            keys, indexed, rows = [], [], []
            size = x.n[use]
            for c, (least, end, tau, width) in enumerate(steps):
                here = np.flatnonzero((size >= least) & (size < end + tau))
                if not len(here):
                    continue
                start, n, own = x.start[use[here]], size[here], size[here] < end
                half = (tau + 2) // 2
                for i in range(tau + 1):
                    off, place = (i, i * width) if i < half else (tau - i, n - (tau - i + 1) * width)
                    for shift in range(-off, off + 1):
                        a = place + shift
                        ok = (a >= 0) & (a + width <= n)
                        s = (start + a)[ok]
                        with np.errstate(over="ignore"):
                            keys.append(mix(x.hash(s, s + width) + _U(c * 64 + i + 1) * _U(0x9FB21C651E98DF25)))
                        indexed.append(own[ok] & (shift == 0))
                        rows.append(line[here][ok])
            if len(line):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(rows).view(np.int64)),
                                                  pa.array(np.concatenate(indexed))], ["key", "line", "indexed"])

    return run


def _parities(cp: np.ndarray) -> np.ndarray:
    """Parities of the counts of hashed characters (64 bits) and of hashed
    character pairs (128 bits). One edit changes two bits of the first and four
    of the second at most."""
    one = np.bincount((mix(cp) >> _U(58)).astype(np.int64), minlength=64) & 1
    two = np.bincount((mix(cp[:-1].astype(_U) << _U(32) | cp[1:]) >> _U(57)).astype(np.int64), minlength=128) & 1
    return np.packbits(np.concatenate((one, two)).astype(np.uint8)).view(np.int64)


def _near(l: str, r: str, classes):
    """Condition that lengths and parities allow the pair's number of edits."""
    n, m = F.col(f"{l}.n"), F.col(f"{r}.n")
    shorter = F.least(n, m)
    tau = F.lit(-1)
    for least, t in classes:
        tau = F.when(shorter >= least, t).otherwise(tau)
    one, *two = (F.bit_count(F.col(f"{l}.{m}").bitwiseXOR(F.col(f"{r}.{m}"))) for m in _MARKS)
    return (F.abs(n - m) <= tau) & (one <= 2 * tau) & (two[0] + two[1] <= 4 * tau)


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(line, content) of the wanted line numbers, with lengths and parities."""
    for b in chunks(batches):
        x = Lines(b.column("text"))
        want = b.column("numbers").to_pylist()
        first = np.searchsorted(x.row, np.arange(len(want)))
        at = np.array([first[i] + k for i, w in enumerate(want) for k in w], np.int64)
        part = [x.cp[s:e] for s, e in zip(x.start[at].tolist(), x.stop[at].tolist(), strict=True)]
        marks = np.array([_parities(p) for p in part], np.int64).reshape(-1, 3)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x.hash(x.start[at], x.stop[at]).view(np.int64)), pa.array([p.tobytes().decode("utf-32-le") for p in part], pa.string()), pa.array(x.n[at].astype(np.int32)),
             *(pa.array(marks[:, i]) for i in range(3))],
            ["line", "content", "n", *_MARKS])


def _inner(a: np.ndarray, b: np.ndarray, tau: int) -> tuple[np.ndarray, np.ndarray]:
    """The two without most of their common start and end, which no edit needs to touch."""
    spare = min(len(a), len(b)) - 2 * tau - 2
    if spare <= 0:
        return a, b
    m = min(len(a), len(b))
    differ = np.flatnonzero(a[:m] != b[:m])
    front = min(spare, int(differ[0]) if len(differ) else m)
    differ = np.flatnonzero(a[::-1][:m] != b[::-1][:m])
    back = min(spare - front, int(differ[0]) if len(differ) else m)
    return a[front : len(a) - back], b[front : len(b) - back]


def within(a: list[np.ndarray], b: list[np.ndarray], tau: int) -> np.ndarray:
    """For every pair of code point arrays: is the edit distance at most tau?

    Bit d of a vector stands for the cell on diagonal d - tau of the band; the
    distance is followed down the lowest diagonal to the last row, then along it."""
    pairs = [_inner(x, y, tau) if abs(len(x) - len(y)) <= tau else (x, y) for x, y in zip(a, b, strict=True)]
    a, b = [x for x, _ in pairs], [y for _, y in pairs]
    out = np.zeros(len(a), bool)
    la, lb = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
    todo = np.flatnonzero(np.abs(la - lb) <= tau)
    todo = todo[np.argsort(np.maximum(la, lb)[todo], kind="stable")]
    full, top = _U((1 << (2 * tau + 1)) - 1), _U(2 * tau)
    at = 0
    while at < len(todo):
        size = int(max(la[todo[at]], lb[todo[at]]))
        ids = todo[at : at + max(1, BAND_CELLS // (size + 2 * tau + 1))]
        widest = int(max(la[ids].max(), lb[ids].max()))
        if widest > 2 * size + 64:  # keep the padding of a group small
            longest = np.maximum(la[ids], lb[ids])
            ids = ids[longest <= 2 * size + 64]
            widest = int(max(la[ids].max(), lb[ids].max()))
        at += len(ids)
        # One row per code point position, so that a step reads rows in order.
        left = np.full((widest + 2 * tau + 1, len(ids)), 0xFFFFFFFF, np.uint32)
        right = np.full((widest, len(ids)), 0xFFFFFFFE, np.uint32)
        for k, i in enumerate(ids.tolist()):
            left[tau : tau + len(a[i]), k] = a[i]
            right[: len(b[i]), k] = b[i]
        m, n = la[ids], lb[ids]
        up = np.full(len(ids), full & ~_U((1 << tau) - 1), _U)
        down = np.zeros(len(ids), _U)
        far = np.full(len(ids), tau, np.int64)
        for j in range(widest):
            x = np.zeros(len(ids), _U)
            for d in range(2 * tau + 1):
                x |= (left[j + d] == right[j]).astype(_U) << _U(d)
            zero = ((((x & up) + up) ^ up) | x | down) & full
            plus = (down | ~(zero | up)) & full
            minus = zero & up
            on = j < m - tau
            far += np.where(on & (j < n), ((zero >> top) & _U(1)) == 0, 0)
            last = (m - 1 - j + tau).clip(0, 63).astype(_U)  # the bit of the last row in this column
            along = ~on & (j < n)
            far += np.where(along, ((plus >> last) & _U(1)).astype(np.int64) - ((minus >> last) & _U(1)).astype(np.int64), 0)
            up = (minus | ~((zero >> _U(1)) | plus)) & full
            down = (zero >> _U(1)) & plus
        out[ids] = far <= tau
    return out


def _check(classes):
    """Keeps the (a, b) rows whose contents are within their number of edits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(i, 2000) for i in range(0, whole.num_rows, 2000)):
                left, right = ([np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in b.column(c).to_pylist()] for c in ("x", "y"))
                tau = tau_of(np.array([min(len(p), len(q)) for p, q in zip(left, right, strict=True)], np.int64), classes)
                keep = np.zeros(len(left), bool)
                for t in np.unique(tau[tau >= 0]).tolist():
                    on = np.flatnonzero(tau == t)
                    keep[on] = within([left[i] for i in on], [right[i] for i in on], t)
                yield b.select(["a", "b"]).filter(pa.array(keep))

    return run


def _verified(pairs: DataFrame, texts: DataFrame, classes) -> DataFrame:
    x = pairs.join(texts.select(F.col("line").alias("a"), F.col("content").alias("x")), "a")
    both = x.join(texts.select(F.col("line").alias("b"), F.col("content").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(_check(classes), "a bigint, b bigint")


def _row_key() -> F.Column:
    return F.xxhash64("doc_id", "text")


def line_occurrences(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, rk, line_no, line) of every line that takes part."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", _row_key().alias("rk")).mapInArrow(_occurrences(min_chars), f"doc_id {id_type}, rk bigint, line_no int, line bigint")


def line_links(docs: DataFrame, first: DataFrame, classes=CLASSES) -> DataFrame:
    """(node, root) of every line in a class of two or more different lines.
    ``first``: (line, rk, line_no) of one occurrence of each line."""
    rows = docs.select("text").mapInArrow(_keys(classes), "key bigint, line bigint, indexed boolean")
    by_key = Window.partitionBy("key")
    shared = rows.select("*", F.min("line").over(by_key).alias("lo"), F.max("line").over(by_key).alias("hi"), F.max("indexed").over(by_key).alias("any"))
    shared = cut_lineage(shared.where("any and lo <> hi").groupBy("key", "line").agg(F.max("indexed").alias("indexed")))

    want = first.join(shared.select("line").distinct(), "line", "left_semi").groupBy("rk").agg(F.sort_array(F.collect_set("line_no")).alias("numbers"))
    want = cut_lineage(want)
    small = (want.agg(F.sum(F.size("numbers") + 1)).first()[0] or 0) <= BROADCAST_LINES
    texts = docs.select("text", _row_key().alias("rk")).join(F.broadcast(want) if small else want, "rk").select("text", "numbers")
    texts = cut_lineage(texts.mapInArrow(_fetch, "line bigint, content string, n int, m0 bigint, m1 bigint, m2 bigint").dropDuplicates(["line"]))
    marks = texts.select("line", "n", *_MARKS)

    # The lead of a key is the line most of whose segments others hold: the one that
    # copies were made from. Index lines of a key have equally many segments.
    own = shared.where("indexed").select("key", "line")
    held = own.join(own.groupBy("line").agg(F.count("*").alias("share")), "line")
    lead = held.groupBy("key").agg(F.max(F.struct("share", "line")).alias("top")).select("key", F.col("top.line").alias("b"))
    star = shared.join(lead, "key").where("line <> b").select(F.col("line").alias("a"), "b").distinct()
    x, y = marks.alias("x"), marks.alias("y")
    star = star.join(x, F.col("a") == F.col("x.line")).join(y, F.col("b") == F.col("y.line")).where(_near("x", "y", classes)).select("a", "b")
    star = cut_lineage(star)
    links = cut_lineage(_verified(star, texts, classes))
    merged = connected_components(links)

    across = shared.join(merged.withColumnRenamed("node", "line"), "line", "left").withColumn("grp", F.coalesce("root", "line")).drop("root")
    across = across.select("*", F.min("grp").over(by_key).alias("lo"), F.max("grp").over(by_key).alias("hi"), F.count("*").over(by_key).alias("c"))
    across = across.where("lo <> hi").withColumn("salts", F.ceil(F.col("c") / KEY_ROWS).cast("int")).drop("lo", "hi", "c").join(marks, "line")
    l = across.where("indexed").withColumn("salt", F.pmod(F.xxhash64("line"), F.col("salts")).cast("int")).alias("l")
    r = across.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).alias("r")
    once = ~F.col("r.indexed") | (F.col("l.line") > F.col("r.line"))  # two index rows meet both ways
    pairs = l.join(r, (F.col("l.key") == F.col("r.key")) & (F.col("l.salt") == F.col("r.salt")) & once & (F.col("l.grp") != F.col("r.grp")) & _near("l", "r", classes))
    pairs = pairs.select(F.greatest("l.line", "r.line").alias("a"), F.least("l.line", "r.line").alias("b")).distinct()
    tried = star.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    more = cut_lineage(_verified(pairs.join(tried, ["a", "b"], "left_anti"), texts, classes))
    return connected_components(merged.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))


def line_classes(docs: DataFrame, classes=CLASSES, min_chars: int = MIN_CHARS) -> DataFrame:
    """Every participating line: doc_id, rk, line_no, class (smallest line hash
    of its class) and keep (true for the first occurrence of the class)."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    seen = cut_lineage(line_occurrences(docs, min_chars))
    first = cut_lineage(seen.groupBy("line").agg(F.min(F.struct("doc_id", "rk", "line_no")).alias("at")))
    roots = line_links(docs, first.select("line", "at.rk", "at.line_no"), classes)
    named = first.join(roots.withColumnRenamed("node", "line"), "line", "left").withColumn("class", F.coalesce("root", "line"))
    best = named.groupBy("class").agg(F.min("at").alias("best"))
    named = named.select("line", "class").join(best, "class")
    here = F.struct("doc_id", "rk", "line_no")
    return seen.join(named, "line").select("doc_id", "rk", "line_no", "class", here.eqNullSafe(F.col("best")).alias("keep"))


def line_report(docs: DataFrame, classes=CLASSES, min_chars: int = MIN_CHARS) -> DataFrame:
    """Per document row: doc_id, n_lines, n_removed, removed (line numbers) and
    classes (class of every participating line, in line order)."""
    lines = line_classes(docs, classes, min_chars).groupBy("rk").agg(F.sort_array(F.collect_set(F.struct("line_no", "class", "keep"))).alias("lines"))
    docs = docs.select("doc_id", _row_key().alias("rk"), F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).alias("n_lines"))
    lines = lines.select("rk", F.transform(F.filter("lines", lambda x: ~x["keep"]), lambda x: x["line_no"]).alias("removed"), F.col("lines.class").alias("classes"))
    out = docs.join(lines, "rk", "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return out.select("doc_id", "n_lines", F.size(removed).alias("n_removed"), removed.alias("removed"), F.coalesce("classes", F.array().cast("array<bigint>")).alias("classes"))


def _later_copies(docs: DataFrame) -> DataFrame:
    """(rk, copy) of every row whose text a smaller doc_id holds as well."""
    rows = docs.select(_row_key().alias("rk"), F.struct("doc_id").alias("id"), F.xxhash64("text").alias("t1"), F.length("text").alias("t2")).where("t2 > 0")
    lead = rows.groupBy("t1", "t2").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("n")).where(~F.col("lo").eqNullSafe(F.col("hi")))
    later = rows.join(lead, ["t1", "t2"]).where(~F.col("id").eqNullSafe(F.col("lo")))
    return later.select("rk", F.lit(True).alias("copy")).distinct()


def dedup_lines(docs: DataFrame, classes=CLASSES, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` without repeated lines: all columns kept, n_chars (if there)
    recounted. A document that loses lines goes if no non-blank line is left of
    it, or if its whole text is that of a smaller doc_id, which holds its shorter
    lines too."""
    key, lost, kept, copy = (free_name(x, docs) for x in ("row_key", "lost_lines", "kept_lines", "is_copy"))
    gone = line_classes(docs, classes, min_chars).where("not keep").groupBy("rk").agg(F.collect_set("line_no").alias("lines"))
    gone = gone.join(_later_copies(docs), "rk", "left").select(F.col("rk").alias(key), F.col("lines").alias(lost), F.col("copy").alias(copy))
    out = docs.withColumn(key, _row_key()).join(gone, key, "left")
    rest = F.filter(F.split("text", "\n", -1), lambda _, i: ~F.array_contains(lost, i))
    out = out.withColumn(kept, F.when(F.col(lost).isNotNull(), rest))
    blank = ~F.exists(kept, lambda x: x.rlike(r"\S"))
    out = out.where(F.col(kept).isNull() | ~(blank | F.coalesce(copy, F.lit(False))))
    out = out.withColumn("text", F.when(F.col(lost).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(lost).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select([F.col(f"`{c}`") for c in docs.columns])
