"""Exact n-gram Jaccard self-join of documents, reduced to link components.

A document's set is its distinct five-word shingles (64-bit hashes). Two
documents link when 100 * |A n B| >= 80 * |A u B|. The join is exact:

1. One pass gives every document its set's size, a digest (equal sets become
   one vertex) and hashed bitmaps (512 bits, and twice the size and up), each
   bit the parity of the shingles that hash to it, and counts shingles into a fixed number of
   hash buckets. A shingle that only one of two sets holds flips one bit, so
   ``(|A| + |B| - popcount(a ^ b)) / 2`` bounds the overlap from above.
2. A linking pair shares a shingle among each one's first
   ``n - ceil(0.8 n) + 1`` shingles in any common order; rarest bucket first
   keeps these lists apart. They are emitted per partition once per distinct
   set, and only shingles held by two different sets go on.
3. The holders of a shingle lead to the one of them whose own
   list is shared most (a star, not all pairs: the text that copies were made
   from is shared whole); each is verified against the lead it shares most
   shingles with, and verified links merge most copies.
4. What remains are shingles shared across merged groups. They are joined in
   tiles of a shingle (frequent ones by size band and salt, too), in which
   sizes and the short bitmaps discard pairs; of the distinct pairs left, the
   long bitmaps discard more, and the others meet in an exact intersection of
   sorted arrays.

Only pairs of vertices from different merged groups are ever formed, so
copies are not expanded into all pairs, and no link that joins two groups is
lost.

Defined results: a NULL, empty or wordless text has n_shingles 0 and its own
doc_id as component; a row with a NULL doc_id takes part by its text (its
component_id is NULL if no linked row has an id); rows repeated with one
doc_id are separate texts; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from customer360.llm.components import connected_components
from customer360.llm.skew import free_name, join_groups
from customer360.llm.textnum import CHUNK_BYTES, chunks, mix, shingle_sets, utf8
from customer360.plans import cut_lineage

SHINGLE_WORDS = 5
MIN_PERCENT = 80
SHORT = 512  # bits
BUCKETS = 1 << 17
#: Rows of one side of a tile before it is salted.
TILE_ROWS = 512
#: Largest table of wanted rows that is broadcast (counted before).
BROADCAST_ROWS = 500_000

_BITS = [f"w{i}" for i in range(SHORT // 64)]
_U = np.uint64


def _vertex(s: np.ndarray) -> int:
    """64-bit digest of a sorted set, as a signed integer."""
    with np.errstate(over="ignore"):
        v = mix(mix(s ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U) + _U(len(s)))
    return int(v.view(np.int64))


def _bitmap(s: np.ndarray) -> np.ndarray:
    """Parity of the shingles per bit, in words of 64: the power of two from
    twice the set's size on, so that it never fills up, SHORT bits at least."""
    width = max(SHORT, 1 << (2 * len(s) - 1).bit_length())
    return np.packbits(np.bincount((s >> _U(40)).astype(np.int64) % width, minlength=width).astype(np.uint8) & 1).view(np.int64)


def _fold(bits: np.ndarray, words: int) -> np.ndarray:
    """A bitmap as it would be with ``words`` words."""
    return np.bitwise_xor.reduce(bits.reshape(-1, words), axis=0)


def _signatures(k: int, id_type: pa.DataType):
    """Rows per document, and one row per task with shingle counts per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(BUCKETS, np.int64)
        none = pa.nulls(1, pa.int64())
        for b in chunks(batches):
            sets = shingle_sets(*utf8(b.column("text")), k)
            n = len(sets)
            bits = [_bitmap(s) if len(s) else np.zeros(SHORT // 64, np.int64) for s in sets]
            short = np.stack([_fold(b, SHORT // 64) for b in bits])
            count += np.bincount((np.concatenate(sets) >> _U(20)).astype(np.int64) % BUCKETS, minlength=BUCKETS)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("rk"), pa.array([len(s) for s in sets], pa.int64()), pa.array([_vertex(s) if len(s) else None for s in sets], pa.int64()),
                 *(pa.array(short[:, i]) for i in range(SHORT // 64)), pa.array([r.tobytes() for r in bits], pa.binary()), pa.nulls(n, pa.list_(pa.int32())), pa.nulls(n, pa.list_(pa.int64()))], names)
        hit = np.flatnonzero(count)
        if len(hit):
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, id_type), none, none, none, *[none] * (SHORT // 64), pa.nulls(1, pa.binary()),
                 pa.array([hit.astype(np.int32)], pa.list_(pa.int32())), pa.array([count[hit]], pa.list_(pa.int64()))], names)

    names = ["doc_id", "rk", "n_shingles", "node", *_BITS, "bits", "buckets", "counts"]
    return run


def _prefixes(k: int, percent: int, counts: np.ndarray):
    """(token, node, n_shingles) of the first shingles in rarest-first order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in chunks(batches):
            token, node, size = [], [], []
            for s in shingle_sets(*utf8(b.column("text")), k):
                if not len(s) or (v := _vertex(s)) in seen:
                    continue
                seen.add(v)
                n = len(s)
                first = n - -(-percent * n // 100) + 1
                rarity = counts[(s >> _U(20)).astype(np.int64) % BUCKETS]
                token.append(s[np.argsort(rarity, kind="stable")[:first]])
                node.append(v)
                size.append(n)
            if token:
                per = [len(t) for t in token]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(token).view(np.int64)), pa.array(np.repeat(np.array(node, np.int64), per)),
                     pa.array(np.repeat(np.array(size, np.int64), per))], ["token", "node", "n_shingles"])

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, text): the compressed text of vertex ``a`` for each of its wanted
    rows. A text is a fraction of its 8-byte shingle hashes, and those are made
    again where two texts meet."""
    codec = pa.Codec("zstd", compression_level=1)
    for b in batches:
        sizes, bodies = [], []
        for t in b.column("text"):
            raw = t.as_buffer()
            sizes.append(raw.size)
            bodies.append(codec.compress(raw, asbytes=True))
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(bodies, pa.binary()), pa.array(sizes, pa.int64())], ["a", "b", "body", "size"])


def _unpacked(bodies: pa.Array, sizes: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) in pieces of bounded size."""
    codec, at, part, held = pa.Codec("zstd"), 0, [], 0
    for i, (body, size) in enumerate(zip(bodies, sizes.to_pylist(), strict=True)):
        part.append(codec.decompress(body.as_buffer(), size, asbytes=True))
        held += size
        if held >= CHUNK_BYTES:
            yield at, pa.array(part, pa.binary())
            at, part, held = i + 1, [], 0
    if part:
        yield at, pa.array(part, pa.binary())


def _intersect(k: int, percent: int):
    """Keeps the (a, b) rows whose sorted arrays of shingles reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, q = None, np.zeros(0, _U)  # rows come by b: its array serves the rows in turn
        for b in batches:
            keep, ends = [], b.column("b").to_pylist()
            for at, texts in _unpacked(b.column("x"), b.column("nx")):
                for i, p in enumerate(shingle_sets(*utf8(texts), k), at):
                    if ends[i] != last:
                        [(_, text)] = _unpacked(b.column("y").slice(i, 1), b.column("ny").slice(i, 1))
                        last, q = ends[i], shingle_sets(*utf8(text), k)[0]
                    small, large = (p, q) if len(p) <= len(q) else (q, p)
                    both = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
                    keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _wanted(docs: DataFrame, want: DataFrame) -> DataFrame:
    """Compressed texts for ``want`` (rk, a, b), read again instead of being
    stored for the whole corpus. Up to BROADCAST_ROWS rows (24 bytes each) are
    broadcast, counted first; more are joined by a shuffle."""
    small = want.count() <= BROADCAST_ROWS
    found = docs.join(F.broadcast(want) if small else want, "rk").select("text", "a", "b")
    return found.mapInArrow(_packed, "a bigint, b bigint, body binary, size bigint")


def _verified(docs: DataFrame, pairs: DataFrame, keys: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link. ``keys``: (node, rk) of one row with each set.
    The text of ``a`` travels to that of ``b``."""
    x = _wanted(docs, cut_lineage(pairs.join(keys, F.col("a") == F.col("node")).select("rk", "a", "b")))
    ends = pairs.select("b").distinct().join(keys, F.col("b") == F.col("node"))
    y = _wanted(docs, cut_lineage(ends.select("rk", F.col("b").alias("a"), "b"))).dropDuplicates(["b"])
    y = y.select("b", F.col("body").alias("y"), F.col("size").alias("ny"))
    both = x.select("a", "b", F.col("body").alias("x"), F.col("size").alias("nx")).join(y, "b")
    return both.mapInArrow(_intersect(k, percent), "a bigint, b bigint")


def _bounded(pairs: DataFrame, near: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes and long bitmaps allow the threshold."""
    p, q = (near.select(F.col("node").alias(e), F.col("n_shingles").alias(f"n{e}"), F.col("bits").alias(f"bits_{e}")) for e in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            differ = np.zeros(b.num_rows, np.int64)
            for i, (x, y) in enumerate(zip(b.column("bits_a"), b.column("bits_b"), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)
                n = min(len(x), len(y))
                differ[i] = np.bitwise_count(_fold(x, n) ^ _fold(y, n)).sum()
            both = b.column("na").to_numpy() + b.column("nb").to_numpy()
            top = (both - differ) // 2
            yield b.select(["a", "b"]).filter(pa.array(100 * top >= percent * (both - top)))

    return pairs.join(p, "a").join(q, "b").select("a", "b", "na", "nb", "bits_a", "bits_b").mapInArrow(run, "a bigint, b bigint")


def _tile_pair(percent: int):
    """Rows l and r of a tile that may link: other groups, l the smaller set (or
    of the smaller vertex), sizes and short bitmaps within the threshold."""
    n, m = F.col("l.n_shingles"), F.col("r.n_shingles")
    differ = sum((F.bit_count(F.col(f"l.{w}").bitwiseXOR(F.col(f"r.{w}"))) for w in _BITS), F.lit(0))
    top = F.floor((n + m - differ) / 2)
    order = (n < m) | ((n == m) & (F.col("l.node") < F.col("r.node")))
    return (F.col("l.group") != F.col("r.group")) & order & (100 * n >= percent * m) & (100 * top >= percent * (n + m - top))


def link_components(docs: DataFrame, k: int = SHINGLE_WORDS, percent: int = MIN_PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest linked doc_id) per row."""
    return _linked(docs, k, percent).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, k: int = SHINGLE_WORDS, percent: int = MIN_PERCENT) -> DataFrame:
    """``docs`` (all columns) with the smallest doc_id of each component; of
    identical rows one stays. Components without any doc_id stay whole."""
    row = free_name("row_key", docs)
    keep = _linked(docs, k, percent).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("rk").alias(row)).distinct()
    keyed = docs.withColumn(row, F.xxhash64("doc_id", F.col("text").cast("string")))
    return keyed.join(keep, row, "left_semi").dropDuplicates([row]).drop(row)


def _linked(docs: DataFrame, k: int, percent: int) -> DataFrame:
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    docs = docs.select("*", F.xxhash64("doc_id", "text").alias("rk"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, rk bigint, n_shingles bigint, node bigint, " + ", ".join(f"{w} bigint" for w in _BITS) + ", bits binary, buckets array<int>, counts array<bigint>"
    first = cut_lineage(docs.mapInArrow(_signatures(k, to_arrow_type(docs.schema["doc_id"].dataType)), schema))
    sigs = first.where("buckets is null")
    counts = np.zeros(BUCKETS, np.int64)
    cells = first.where("buckets is not null").select(F.inline(F.arrays_zip(F.col("buckets").alias("bucket"), F.col("counts").alias("n"))))
    table = cells.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # BUCKETS rows at most
    counts[table.column("bucket").to_numpy()] = table.column("n").to_numpy()

    once = sigs.where("node is not null").groupBy("node").agg(
        F.min("rk").alias("rk"), F.first("n_shingles").alias("n_shingles"), F.first("bits").alias("bits"), *[F.first(w).alias(w) for w in _BITS])

    # Shingles of the prefix lists that two different sets hold.
    rows = docs.mapInArrow(_prefixes(k, percent, counts), "token bigint, node bigint, n_shingles bigint")
    by_token = Window.partitionBy("token")
    shared = rows.select("*", F.min("node").over(by_token).alias("lo"), F.max("node").over(by_token).alias("hi"))
    shared = cut_lineage(shared.where("lo <> hi").select("token", "node", "n_shingles").distinct())

    near = cut_lineage(once.join(shared.select("node").distinct(), "node", "left_semi"))
    keys = near.select("node", "rk")

    # Stars: the holders of a shingle against the one that is shared most.
    first_of = F.col("n_shingles") - F.ceil(F.col("n_shingles") * percent / 100) + 1
    weight = shared.groupBy("node").agg((F.count("*") / F.max(first_of)).alias("share"))
    held = shared.select("token", "node").join(weight, "node")
    lead = held.groupBy("token").agg(F.max(F.struct("share", "node")).alias("top")).select("token", F.col("top.node").alias("b"))
    # Of a holder's leads the one it shares most with; what it shares with others is left to the tiles.
    met = shared.join(lead, "token").where("node <> b").groupBy(F.col("node").alias("a"), "b").agg(F.count("*").alias("n"))
    star = met.groupBy("a").agg(F.max(F.struct("n", "b")).alias("top")).select("a", F.col("top.b").alias("b"))
    star = cut_lineage(_bounded(star, near, percent))
    links = cut_lineage(_verified(docs, star, keys, k, percent))
    merged = connected_components(links)

    # Tiles: shingles that reach over merged groups; frequent ones are dealt by size
    # band and salt as well.
    across = shared.join(merged, "node", "left").withColumn("group", F.coalesce("root", "node")).drop("root")
    across = across.select("*", F.min("group").over(by_token).alias("lo"), F.max("group").over(by_token).alias("hi"), F.count("*").over(by_token).alias("c"))
    across = across.where("lo <> hi").drop("lo", "hi")
    # Only these rows carry bitmaps.
    across = cut_lineage(across).join(near.select("node", *_BITS), "node")
    band = F.floor(F.log(F.col("n_shingles").cast("double")) / float(np.log(100 / percent + 0.01)))
    often = across.where(F.col("c") > 8 * TILE_ROWS).withColumn("band", band).withColumn("salts", F.ceil(F.col("c") / TILE_ROWS).cast("int"))
    left = often.withColumn("tile", F.explode(F.array(F.col("band"), F.col("band") + 1))).withColumn("salt", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int"))
    right = often.withColumn("tile", F.col("band")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    pairs = None
    for l, r, keys_ in ((across.where(F.col("c") <= 8 * TILE_ROWS), across.where(F.col("c") <= 8 * TILE_ROWS), ["token"]), (left, right, ["token", "tile", "salt"])):
        same = [F.col(f"l.{k_}") == F.col(f"r.{k_}") for k_ in keys_]
        found = l.alias("l").join(r.alias("r"), [*same, _tile_pair(percent)]).select(F.col("l.node").alias("a"), F.col("r.node").alias("b"))
        pairs = found if pairs is None else pairs.unionByName(found)
    pairs = cut_lineage(_bounded(pairs.distinct(), near, percent))
    more = cut_lineage(_verified(docs, pairs, keys, k, percent))

    roots = connected_components(merged.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
    # One row per set up to here; its members meet the outcome, however many they are.
    sets = sigs.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("members"))
    sets = cut_lineage(sets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    distinct, total = sets.agg(F.count("*"), F.coalesce(F.sum("members"), F.lit(0))).first()
    least = sets.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("sets"))
    sets = cut_lineage(join_groups(sets, least, "root", "sets", distinct).select("node", "members", "component_id"))
    rows = sigs.select("doc_id", "rk", "n_shingles", "node")
    found = join_groups(rows.where("node is not null"), sets, "node", "members", total).select("doc_id", "rk", "n_shingles", "component_id")
    alone = rows.where("node is null").select("doc_id", "rk", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.unionByName(alone)
