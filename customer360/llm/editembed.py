"""Document fingerprints by randomised edit embedding.

A shared random walk reads a text once: at step j the character under the
head is written out and the head moves on if the random bit of (j, character)
is set. Edits then shift the written string only until the walks meet again,
so edit distance becomes Hamming distance. Random bits repeat after
``PERIOD`` steps, and characters share 255 hashed classes. A walk is advanced
for many texts at once, one character of each per step.

The fingerprint keeps the written characters at pseudo-random steps: those
whose hash has at least ``level`` trailing zero bits, the level growing with
the text's length so that about ``SAMPLES`` to twice as many remain. Samples
of neighbouring levels are nested, so texts of different lengths compare on
the steps they share. Likeness is the share of equal samples; steps past one
text's end count as unequal.

Near documents are found by bands and verified (``near_classes``). A band is a
few sampled characters at fixed places of the ascending samples. Bands come in
tiers that reach further into the samples, up to the whole fingerprint, and a
fingerprint gives those that it is long enough for, so that neighbours in length
share all but the last; one whose text is just short of the next
level gives the bands of that level as well. Equal fingerprints are one
vertex. The vertices of a band key are verified against the smallest of them and
merged; then only pairs of different merged groups are formed. Verification is the
likeness of the whole fingerprints; ``near_pairs`` goes on to the edit distance of the texts.

Defined results: a NULL or empty text has the fingerprint of the empty
string, whose likeness is 1 to itself and 0 to any other; equal texts have
equal fingerprints; the next document follows by doc_id, then text (NULL ids
first, the last wraps to the first; a single row follows itself); a class is named
by its smallest doc_id, NULL if no member has one; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from customer360.llm.components import connected_components
from customer360.llm.skew import join_groups
from customer360.llm.textnum import chunks, mix, stream
from customer360.plans import cut_lineage

SAMPLES = 128
PERIOD = 4096
#: Characters walked at once.
WALK_CHARS = 8 << 20
#: Tiers of bands: tier t reaches a quarter of SAMPLES further than the one before.
TIERS, TIER_BANDS, BAND_SAMPLES = 5, 6, 6
#: Likeness from which two fingerprints are near.
LEAST = 0.8
#: Rows of a band key before its pairs are salted.
KEY_ROWS = 512

_STAY: list[np.ndarray] = []
_STEPS: list = []


def _stay() -> np.ndarray:
    """Steps that a character class spends under the head from each step on."""
    if not _STAY:
        bits = (mix(stream(7, 256 * PERIOD)) & np.uint64(1)).astype(bool).reshape(256, PERIOD)
        bits[:, -1] = True
        out = np.zeros((256, PERIOD), np.uint8)
        run = np.zeros(256, np.int64)  # the last bit of the period is always set
        for j in range(PERIOD - 1, -1, -1):
            run = np.where(bits[:, j], 1, run + 1)
            out[:, j] = run
        _STAY.append(out.ravel())
    return _STAY[0]


def _sampled(level: int, end: int) -> np.ndarray:
    """Sampled steps below ``end`` at a level, ascending."""
    if not _STEPS or _STEPS[0] < end:
        size = max(1 << 18, 1 << int(end).bit_length())
        h = mix(np.arange(size, dtype=np.uint64) + np.uint64(0x51ED2701))
        zeros = np.zeros(size, np.uint8)
        for b in range(40):
            zeros[(h & np.uint64((1 << (b + 1)) - 1)) == 0] = b + 1
        _STEPS[:] = [size, zeros, {}]
    if level not in _STEPS[2]:
        _STEPS[2][level] = np.flatnonzero(_STEPS[1] >= level)
    at = _STEPS[2][level]
    return at[: np.searchsorted(at, end)]


def classes(text: str) -> np.ndarray:
    """Hashed character classes 1 to 255."""
    cp = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    return (mix(cp) % np.uint64(255)).astype(np.uint8) + np.uint8(1)


def walk(texts: list[np.ndarray], begin: np.ndarray) -> list[np.ndarray]:
    """First step of every character, and the step after the last, per text;
    ``begin`` has the step at which each text's head starts."""
    stay = _stay()
    size = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-size, kind="stable")
    longest = int(size.max(initial=0))
    width = np.searchsorted(-size[order], -np.arange(longest), "left")  # texts longer than i
    base = np.concatenate(([0], np.cumsum(width)))
    chars = np.zeros(base[-1], np.int32)
    for c, k in enumerate(order.tolist()):
        chars[base[: size[k]] + c] = texts[k]
    chars <<= 12
    path = np.zeros(base[-1], np.int32)
    step = begin[order].astype(np.int32)
    for i in range(longest):
        a, z = base[i], base[i + 1]
        s = step[: z - a]
        path[a:z] = s
        s += stay.take(chars[a:z] | (s & (PERIOD - 1)))
    out: list = [None] * len(texts)
    for c, k in enumerate(order.tolist()):
        out[k] = np.append(path[base[: size[k]] + c], step[c])
    return out


def _print(n: int, path: np.ndarray, chars: np.ndarray) -> tuple[int, np.ndarray]:
    """(level, sampled classes) of a walked text."""
    level = max(0, (2 * n // SAMPLES).bit_length() - 1)
    at = _sampled(level, int(path[-1]))
    return level, chars[np.searchsorted(path, at, "right") - 1]


def to_text(level: int, samples: np.ndarray) -> str:
    return f"{level:02x}" + samples.tobytes().hex()


def likeness(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    """Share of equal samples on the steps of the coarser level."""
    level = max(a[0], b[0])
    x, y = (s if l == level else _coarser(l, s, level) for l, s in (a, b))
    n = max(len(x), len(y))
    m = min(len(x), len(y))
    return float((x[:m] == y[:m]).sum() / n) if n else float(len(a[1]) == len(b[1]))


def _coarser(level: int, samples: np.ndarray, to: int) -> np.ndarray:
    """The samples that remain at a higher level."""
    at = _steps_of(level, len(samples))  # makes or extends the table that the next line reads
    return samples[_STEPS[1][at] >= to]


def _steps_of(level: int, count: int) -> np.ndarray:
    end = 1 << 18
    while len(at := _sampled(level, end)) < count:
        end *= 2
    return at[:count]


def fingerprints(texts: list[str]) -> list[tuple[int, np.ndarray]]:
    """(level, samples) of every text."""
    chars = [classes(t) for t in texts]
    paths = walk(chars, np.zeros(len(texts), np.int64))
    return [_print(len(c), p, c) for c, p in zip(chars, paths, strict=True)]


def _report(rows: list[tuple], follow: str) -> list[tuple]:
    """Result rows of consecutive (doc_id, text) rows followed by text ``follow``."""
    texts = [t for _, t in rows]
    after = texts[1:] + [follow]
    chars = [classes(t) for t in texts]
    chars.append(classes(follow))
    paths = walk(chars, np.zeros(len(chars), np.int64))
    prints = [_print(len(c), p, c) for c, p in zip(chars, paths, strict=True)]
    # The edited text shares its first half, and so its walk, with the text.
    keep = [len(t) - len(t) // 2 for t in texts]
    tails = [chars[i + 1][: len(t) // 2] for i, t in enumerate(texts)]
    ends = walk(tails, np.array([paths[i][k] for i, k in enumerate(keep)], np.int64))
    out = []
    for i, ((doc_id, t), k) in enumerate(zip(rows, keep, strict=True)):
        edited = t[:k] + after[i][: len(t) // 2]
        c = np.concatenate((chars[i][:k], tails[i]))
        e = _print(len(c), np.concatenate((paths[i][:k], ends[i])), c)
        out.append((doc_id, len(t), hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest(), to_text(*prints[i]), to_text(*e),
                    likeness(prints[i], e), likeness(prints[i], prints[i + 1])))
    return out


def _ordered(docs: DataFrame) -> DataFrame:
    """Rows dealt into doc_id ranges, in order inside each; the first rows of a
    range are also sent to the range before it, marked ``halo``."""
    spark = docs.sparkSession
    # Ranges of ids need numbers: texts go by their first bytes, which keep their order.
    if docs.schema["doc_id"].dataType.simpleString() == "string":
        number = F.conv(F.rpad(F.substring(F.hex(F.encode("doc_id", "UTF-8")), 1, 12), 12, "0"), 16, 10).cast("double")
    else:
        number = F.col("doc_id").cast("double")
    key = F.coalesce(number, F.lit(float("-inf")))
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), key.alias("key"))
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    finite = docs.where("key > double('-infinity')").select("key")
    cuts = sorted(set(finite.approxQuantile("key", [i / parts for i in range(1, parts)], 0.2 / parts))) if finite.limit(1).count() else []
    if cuts:
        ranges = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="key", outputCol="part")
        docs = ranges.transform(docs)
    else:
        docs = docs.withColumn("part", F.lit(0.0))
    firsts = sorted((r["part"], r["key"]) for r in docs.groupBy("part").agg(F.min("key").alias("key")).collect())  # one row a range
    before = [(p, k, firsts[i - 1][0]) for i, (p, k) in enumerate(firsts)]
    table = spark.createDataFrame(before, "part double, first double, prev double")
    here = F.struct(F.col("part").alias("to"), F.lit(False).alias("halo"))
    there = F.struct(F.col("prev").alias("to"), F.lit(True).alias("halo"))
    sent = docs.join(F.broadcast(table), "part").withColumn("at", F.explode(F.when(F.col("key") == F.col("first"), F.array(here, there)).otherwise(F.array(here))))
    rows = sent.select("doc_id", "text", F.col("at.to").alias("to"), F.col("at.halo").alias("halo"))
    return rows.repartition(parts, "to").sortWithinPartitions("to", "halo", "doc_id", "text")


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    schema = f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(rows: list, follow: str, types: pa.Schema) -> pa.RecordBatch:
            cols = list(zip(*_report(rows, follow), strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], types.field("doc_id").type), pa.array(cols[1], pa.int64()), *(pa.array(c, pa.string()) for c in cols[2:5]),
                 *(pa.array(c, pa.float64()) for c in cols[5:7])], names)

        held: list[tuple] = []
        size, part, types = 0, None, None
        for b in batches:
            types = b.schema
            for doc_id, text, to, halo in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "to", "halo")), strict=True):
                if held and to != part:  # a range without a halo row: it wrapped to itself
                    yield made(held, held[0][1], types)
                    held, size = [], 0
                if halo:
                    if held:
                        yield made(held, text, types)
                        held, size = [], 0
                    part = to
                    continue
                if size > WALK_CHARS and held:
                    yield made(held, text, types)
                    held, size = [], 0
                held.append((doc_id, text))
                size += len(text)
                part = to
        if held:
            yield made(held, held[0][1], types)

    return _ordered(docs).mapInArrow(run, schema)


def _picks() -> list[np.ndarray]:
    """The sample places of every tier's bands (bands x places)."""
    out = []
    for t in range(TIERS):
        reach = np.uint64(SAMPLES + t * SAMPLES // 4)
        out.append((stream(20 + t, TIER_BANDS * BAND_SAMPLES) % reach).astype(np.int64).reshape(TIER_BANDS, BAND_SAMPLES))
    return out


def band_keys(n: int, level: int, samples: np.ndarray) -> np.ndarray:
    """64-bit band keys of the fingerprint of a text of ``n`` characters."""
    views = [(level, samples)]
    # Texts a little longer may lie one level up: the samples that remain there.
    if (2 * (n + n // 16 + 1) // SAMPLES).bit_length() - 1 > level:
        views.append((level + 1, _coarser(level, samples, level + 1)))
    out = []
    for at, x in views:
        count = len(x)
        padded = np.zeros(SAMPLES * 2, np.uint64)
        padded[: min(count, 2 * SAMPLES)] = x[: 2 * SAMPLES]
        for t, pick in enumerate(_picks()):
            if t and count < SAMPLES + t * SAMPLES // 4:
                break
            with np.errstate(over="ignore"):
                word = (padded[pick] * (stream(10, BAND_SAMPLES) | np.uint64(1))).sum(1, dtype=np.uint64)
                out.append(mix(word + mix(np.arange(TIER_BANDS, dtype=np.uint64) + np.uint64((at * TIERS + t) * TIER_BANDS))))
    return np.concatenate(out)


def from_text(fingerprint: str) -> tuple[int, np.ndarray]:
    """(level, samples) of :func:`to_text`."""
    return int(fingerprint[:2], 16), np.frombuffer(bytes.fromhex(fingerprint[2:]), np.uint8)


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, node) of every vertex."""
    for b in batches:
        keys = [band_keys(n, *from_text(f)) for n, f in zip(b.column("n").to_pylist(), b.column("fingerprint").to_pylist(), strict=True)]
        node = np.repeat(b.column("node").to_numpy(), [len(k) for k in keys])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(node)], ["key", "node"])


def _alike(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [likeness(from_text(x), from_text(y)) >= least for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist(), strict=True)]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _links(vertices: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """Verified pairs (a, b) of vertices (node, n, fingerprint) that connect all near
    ones, and (node, root) of their components."""
    keys = vertices.select("node", "n", "fingerprint").mapInArrow(_banded, "key bigint, node bigint")
    by_key = Window.partitionBy("key")
    shared = keys.select("*", F.min("node").over(by_key).alias("lo"), F.max("node").over(by_key).alias("hi")).where("lo <> hi")
    shared = cut_lineage(shared.select("key", "node", "lo").distinct())

    def verified(pairs: DataFrame) -> DataFrame:
        x, y = (vertices.select(F.col("node").alias(e), F.col("fingerprint").alias(f)) for e, f in (("a", "x"), ("b", "y")))
        both = pairs.join(x, "a").join(y, "b")
        return cut_lineage(both.select("a", "b", "x", "y").mapInArrow(_alike(least), "a bigint, b bigint"))

    star = cut_lineage(shared.where("node <> lo").select(F.col("node").alias("a"), F.col("lo").alias("b")).distinct())
    links = verified(star)
    merged = connected_components(links)
    across = shared.drop("lo").join(merged, "node", "left").withColumn("grp", F.coalesce("root", "node")).drop("root")
    across = across.select("*", F.min("grp").over(by_key).alias("lo"), F.max("grp").over(by_key).alias("hi"), F.count("*").over(by_key).alias("c"))
    across = across.where("lo <> hi").withColumn("salts", F.ceil(F.col("c") / KEY_ROWS).cast("int"))
    l = across.withColumn("salt", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int")).alias("l")
    r = across.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).alias("r")
    same = (F.col("l.key") == F.col("r.key")) & (F.col("l.salt") == F.col("r.salt")) & (F.col("l.grp") != F.col("r.grp")) & (F.col("l.node") > F.col("r.node"))
    pairs = l.join(r, same).select(F.col("l.node").alias("a"), F.col("r.node").alias("b")).distinct()
    more = verified(pairs.join(star, ["a", "b"], "left_anti"))
    links = links.unionByName(more)
    return links, connected_components(links)


def _vertices(prints: DataFrame) -> DataFrame:
    """Distinct fingerprints: node, fingerprint, n, the smallest doc_id and the rows that have it."""
    once = prints.groupBy("fingerprint").agg(F.min("n_chars").alias("n"), F.min("doc_id").alias("least"), F.count("*").alias("members"))
    return cut_lineage(once.withColumn("node", F.xxhash64("fingerprint")))


def near_classes(prints: DataFrame, least: float = LEAST) -> DataFrame:
    """``prints`` (with doc_id, n_chars, fingerprint) plus near_id: the smallest doc_id
    that verified pairs connect with the row."""
    vertices = _vertices(prints)
    _, roots = _links(vertices, least)
    named = vertices.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    total, distinct = named.agg(F.coalesce(F.sum("members"), F.lit(0)), F.count("*")).first()
    named = cut_lineage(named.select("fingerprint", "members", "least", "root"))
    smallest = named.groupBy("root").agg(F.min("least").alias("near_id"), F.count("*").alias("vertices"))
    found = join_groups(named, smallest, "root", "vertices", distinct).select("fingerprint", "members", "near_id")
    return join_groups(prints, cut_lineage(found), "fingerprint", "members", total).select(*prints.columns, "near_id")


def print_rows(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars and fingerprint of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            texts = b.column("text").to_pylist()
            made = [to_text(*p) for p in fingerprints(texts)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(made, pa.string())], ["doc_id", "n_chars", "fingerprint"])

    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(run, f"doc_id {kind}, n_chars bigint, fingerprint string")


def edits_of(n: int) -> int:
    """Edits that two texts may differ by whose shorter one has ``n`` characters."""
    return max(2, n // 20)


def edit_distance_within(a: str, b: str, tau: int) -> bool:
    """Whether the edit distance is at most ``tau``, by a diagonal band of numpy rows."""
    x, y = (np.frombuffer(t.encode("utf-32-le", "replace"), np.uint32) for t in (a, b))
    if abs(len(x) - len(y)) > tau:
        return False
    m = min(len(x), len(y))
    differ = np.flatnonzero(x[:m] != y[:m])
    front = int(differ[0]) if len(differ) else m
    x, y = x[front:], y[front:]
    m = min(len(x), len(y))
    differ = np.flatnonzero(x[::-1][:m] != y[::-1][:m])
    back = int(differ[0]) if len(differ) else m
    x, y = x[: len(x) - back], y[: len(y) - back]
    if not len(x) or not len(y):
        return max(len(x), len(y)) <= tau
    # Row i of the table, at the columns i - tau .. i + tau.
    far, step = tau + 1, np.arange(2 * tau + 1)
    row = np.where(step - tau >= 0, step - tau, far)
    row = np.where(step - tau <= len(y), row, far)
    padded = np.full(len(y) + 3 * tau + 2, 0xFFFFFFFF, np.uint32)
    padded[tau : tau + len(y)] = y
    for i in range(1, len(x) + 1):
        column = i + step - tau
        # Cell (i, j) stands at place j - i + tau; (i - 1, j - 1) at the same one, (i - 1, j) one on.
        new = np.minimum(row + (padded[i - 1 : i + 2 * tau] != x[i - 1]), np.append(row[1:], far) + 1)
        new = np.where(column == 0, i, np.where((column < 0) | (column > len(y)), far, new))
        new = np.minimum.accumulate(new - step) + step  # insertions along the row
        row = np.minimum(new, far)
        if row.min() > tau:
            return False
    return bool(row[len(y) - len(x) + tau] <= tau)


def near_pairs(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """(a, b) doc_ids of near texts, representatives of equal texts alone: pairs
    that connect all near classes, whose edit distance the texts allow (:func:`edits_of`)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).where("doc_id is not null")
    vertices = _vertices(cut_lineage(print_rows(docs)))
    links, _ = _links(vertices, least)
    ids = vertices.select("node", F.col("least").alias("id"))
    pairs = links.join(ids.select(F.col("node").alias("a"), F.col("id").alias("p")), "a").join(ids.select(F.col("node").alias("b"), F.col("id").alias("q")), "b")
    pairs = cut_lineage(pairs.select("p", "q"))
    x = pairs.join(docs.select(F.col("doc_id").alias("p"), F.col("text").alias("x")), "p")
    both = x.join(docs.select(F.col("doc_id").alias("q"), F.col("text").alias("y")), "q")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [edit_distance_within(x, y, edits_of(min(len(x), len(y)))) for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("p"), b.column("q")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("p", "q", "x", "y").mapInArrow(verify, f"a {kind}, b {kind}").distinct()
