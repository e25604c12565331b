"""Merkle manifest of a dataset: leaves, roots and proofs by a slot pivot.

Every row is a leaf: the SHA-256 of its columns, each written as byte count,
colon and value (``-`` for NULL). Within a group (lang), leaves stand in the
order of doc_id and every ``fanout`` consecutive nodes become their parent, the
SHA-256 of their hex digests; what remains alone is the group's subroot. The
subroots, ordered by group, make a tree of the same kind, whose top is the root.

A level is one aggregation. The node at place p is the child number p mod
fanout of the parent at p div fanout; conditional aggregates spread a parent's
children into ``fanout`` columns (partial aggregation folds whole runs before the
shuffle). The columns concatenated make the parent's digest; without the
own column they are a child's siblings. On the way down, each parent hands
every child its own path, headed by the child's siblings; the last step spreads
the parents of the leaves into the leaves, with what they carried along, so
leaves are never joined.

Places come from a range shuffle: rows are sorted within the range partitions,
numbered there, and shifted by the sizes of the partitions before them. A group
that holds most rows spans many partitions, and all later steps are dealt by
(group, place).

Defined results: NULL is a group of its own, before all others; a NULL
doc_id comes first; rows that repeat a doc_id are ordered by their digest, and
identical rows are leaves of their own; an empty table gives no rows; other
columns do not matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from customer360.llm.exactdedup import _UPPER
from customer360.plans import cut_lineage

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Runs (one per group and range partition, some 60 bytes) that are broadcast,
#: counted before; more are joined by a shuffle.
BROADCAST_RUNS = 200_000

_PATH = "array<struct<left:string,right:string>>"


def leaf_hash(*values: Column) -> Column:
    """SHA-256 (lower-case hex) of the values, each ``-`` or byte count, colon, value."""
    texts = [v.cast("string") for v in values]
    parts = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path (siblings left and right, level by level) give."""
    return F.aggregate(path, leaf, lambda h, x: F.sha2(F.concat(x["left"], h, x["right"]), 256))


def proof_hash(path: Column) -> Column:
    """SHA-256 of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""), 256)


def _placed(nodes: DataFrame, fanout: int) -> tuple[DataFrame, int]:
    """``nodes`` (grp, sort, hash, load) as (grp, place, height, hash, load), and
    the largest height: the number of levels above the leaves of a group."""
    # The last key tells identical rows apart, whose order does not matter.
    nodes = cut_lineage(nodes).withColumn("tie", F.monotonically_increasing_id())
    keys = ["grp", "sort", "hash", "tie"]
    rows = nodes.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("nth", F.monotonically_increasing_id())
    rows = cut_lineage(rows.select("grp", "nth", F.shiftright("nth", 33).alias("part"), "hash", "load"))
    runs = rows.groupBy("grp", "part").agg(F.min("nth").alias("first"), F.count("*").alias("size"))
    by_group = Window.partitionBy("grp")
    before = F.sum("size").over(by_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    n = F.sum("size").over(by_group)
    height = reduce(lambda a, b: a + b, [(n > F.lit(fanout**k)).cast("int") for k in range(1, 62) if fanout**k < 2**62], (n > 1).cast("int"))
    runs = cut_lineage(runs.select("grp", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), height.alias("height")))
    count, top = runs.agg(F.count("*"), F.max("height")).first()
    rows = rows.join(F.broadcast(runs) if count <= BROADCAST_RUNS else runs, ["grp", "part"])
    return rows.select("grp", (F.col("nth") + F.col("shift")).alias("place"), "height", "hash", "load"), top or 0


def _parents(nodes: DataFrame, fanout: int, load: bool) -> DataFrame:
    """(grp, place, height, hash, s0.., and l0.. with ``load``) of the next level.
    The one node of a group that ends there keeps its digest."""
    slot = F.pmod("place", F.lit(fanout))
    spread = [F.max(F.when(slot == i, F.col("hash"))).alias(f"s{i}") for i in range(fanout)]
    if load:
        spread += [F.first(F.when(slot == i, F.col("load")), ignorenulls=True).alias(f"l{i}") for i in range(fanout)]
    up = nodes.groupBy("grp", F.floor(F.col("place") / fanout).alias("place"), "height").agg(*spread)
    digest = F.sha2(F.concat(*[F.coalesce(f"s{i}", F.lit("")) for i in range(fanout)]), 256)
    return up.withColumn("hash", F.when(F.col("height") == 0, F.col("s0")).otherwise(digest))


def _grown(nodes: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """The parent tables of all levels, and (grp, hash) of every group's top."""
    nodes, height = _placed(nodes, fanout)
    tables = [cut_lineage(_parents(nodes, fanout, True))]
    for level in range(1, height):
        tables.append(cut_lineage(_parents(tables[-1].where(F.col("height") > level), fanout, False)))
    tops = [t.where(_ends(level)).select("grp", "hash") for level, t in enumerate(tables, 1)]
    return tables, reduce(DataFrame.unionByName, tops)


def _ends(level: int) -> Column:
    """Whether the parents of this level are the tops of their groups."""
    return F.greatest(F.col("height"), F.lit(1)) == level


def _handed_down(tables: list[DataFrame], start: DataFrame, fanout: int) -> DataFrame:
    """(hash, load, path, seed) of every leaf. ``start``: (grp, path, seed) of the tops."""
    above = None
    for level in range(len(tables), 0, -1):
        t = tables[level - 1]
        known = t.where(_ends(level)).join(start, "grp")
        if above is not None:
            known = known.unionByName(t.where(~_ends(level)).join(above, ["grp", "place"]))
        children = []
        for i in range(fanout):
            left, right = (F.concat(F.lit(""), *[F.coalesce(f"s{j}", F.lit("")) for j in side]) for side in (range(i), range(i + 1, fanout)))
            own = F.array(F.struct(left.alias("left"), right.alias("right")))
            path = F.when(F.col("height") == 0, F.col("path")).otherwise(F.concat(own, F.col("path")))
            last = [F.col(f"l{i}").alias("load")] if level == 1 else []
            children.append(F.struct((F.col("place") * fanout + i).alias("place"), F.col(f"s{i}").alias("hash"), path.alias("path"), *last))
        some = F.filter(F.array(*children), lambda c: c["hash"].isNotNull())
        above = known.select("grp", "seed", F.inline(some))
        if level > 1:
            above = above.drop("hash")
    return above.select("hash", "load", "path", "seed")


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "lang", order: str = "doc_id", carry: dict[str, Column] | None = None, fanout: int = FANOUT) -> DataFrame:
    """Per row: the ``order`` column, the columns of ``carry`` (expressions of a
    row of ``docs``), leaf, subroot, root and path (the siblings left and right of
    each node from the leaf to the root)."""
    text = F.col(group).cast("string")
    load = F.struct(F.col(order), *[c.alias(n) for n, c in (carry or {}).items()])
    # '' for NULL, '=' and the value for others: bytewise order, NULL first.
    grp = F.when(text.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), text))
    nodes = docs.select(grp.alias("grp"), F.col(order).alias("sort"), leaf_hash(*[F.col(c) for c in fields]).alias("hash"), load.alias("load"))
    tables, subroots = _grown(nodes, fanout)
    heads = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("sort"), "hash", F.struct("grp").alias("load"))
    top_tables, root = _grown(heads, fanout)
    none = F.array().cast(_PATH)
    top = _handed_down(top_tables, root.select("grp", none.alias("path"), F.struct(F.col("hash").alias("root")).alias("seed")), fanout)
    start = cut_lineage(top.select(F.col("load.grp").alias("grp"), "path", F.struct(F.col("hash").alias("subroot"), F.col("seed.root").alias("root")).alias("seed")))
    return _handed_down(tables, start, fanout).select("load.*", F.col("hash").alias("leaf"), "seed.subroot", "seed.root", "path")


def manifest_report(docs: DataFrame) -> DataFrame:
    """Leaf, roots and proof of every document, and the check of its copy, in which
    the text is lower-cased (A-Z) where 3 divides the id's CRC-32."""
    touched = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    lowered = F.translate(F.col("text").cast("string"), _UPPER, _UPPER.lower())
    copy = F.when(touched, leaf_hash(*[lowered if c == "text" else F.col(c) for c in FIELDS]))
    rows = manifest(docs, carry={"copy": copy})
    folded = rows.withColumn("folded_root", fold(F.coalesce("copy", "leaf"), F.col("path")))
    return folded.select("doc_id", "leaf", "subroot", "root", proof_hash(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql_level(name: str, below: str, rows: str, k: int) -> tuple[str, str]:
    """CTEs of one level: its nodes, and the rows' folds and siblings after it."""
    nodes = f"""{name} AS (SELECT g, p, h, count(*) OVER (PARTITION BY g) AS c FROM (
  SELECT g, p // {FANOUT} AS p, CASE WHEN c = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY p)) END AS h FROM {below} GROUP BY g, p // {FANOUT}, c))"""
    before = rows if k == 1 else f"{rows}_{k - 1}"
    walk = f"""{rows}_{k} AS (SELECT r.n, r.g, r.p // {FANOUT} AS p,
  CASE WHEN b.c = 1 THEN r.f ELSE sha256(string_agg(CASE WHEN b.p = r.p THEN r.f ELSE b.h END, '' ORDER BY b.p)) END AS f,
  r.s || coalesce(string_agg(b.h, '' ORDER BY b.p) FILTER (b.p <> r.p), '') AS s
  FROM {before} r JOIN {below} b ON r.g = b.g AND r.p // {FANOUT} = b.p // {FANOUT} GROUP BY r.n, r.g, r.p, r.f, r.s, b.c)"""
    return nodes, walk


def oracle(levels: int = 8, top_levels: int = 4) -> str:
    """The report of ``documents`` in DuckDB SQL, for trees of so many levels at most."""
    def field(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode(CAST({c} AS VARCHAR))) || ':' || {c} END"

    low = f"translate(text, '{_UPPER}', '{_UPPER.lower()}')"
    leaf = " || ".join(field(c) for c in FIELDS)
    copy = " || ".join(field(c) if c != "text" else field(low) for c in FIELDS)
    step = "list_reduce(list_concat([xor(c, b)], CAST(range(8) AS BIGINT[])), lambda r, i: xor(r >> 1, 3988292384 * (r & 1)))"
    crc = f"xor(list_reduce(list_concat([4294967295], list_transform(range(length(CAST(doc_id AS VARCHAR))), lambda i: CAST(ord(substr(CAST(doc_id AS VARCHAR), i + 1, 1)) AS BIGINT))), lambda c, b: {step}), 4294967295)"
    parts = [f"d AS (SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS g, sha256({leaf}) AS h, CASE WHEN {crc} % 3 = 0 THEN sha256({copy}) END AS x FROM documents)",
             "named AS (SELECT *, row_number() OVER (ORDER BY g, doc_id NULLS FIRST, h) AS n, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS p FROM d)",
             "leaves AS (SELECT n, g, p, coalesce(x, h) AS f, '' AS s FROM named)",
             "n0 AS (SELECT g, p, h, count(*) OVER (PARTITION BY g) AS c FROM named)"]
    for k in range(1, levels + 1):
        parts += _sql_level(f"n{k}", f"n{k - 1}", "leaves", k)
    parts += [f"sub AS (SELECT g AS lang, h, row_number() OVER (ORDER BY encode(g)) - 1 AS p FROM n{levels})",
              "t0 AS (SELECT 0 AS g, p, h, count(*) OVER () AS c FROM sub)",
              f"tops AS (SELECT r.n, 0 AS g, sub.p, r.f, r.s FROM leaves_{levels} r JOIN sub ON r.g = sub.lang)"]
    for k in range(1, top_levels + 1):
        parts += _sql_level(f"t{k}", f"t{k - 1}", "tops", k)
    return ("WITH " + ",\n".join(parts) + f"""
SELECT doc_id, named.h AS leaf, sub.h AS subroot, t.h AS root, sha256(s) AS proof_sha256, f AS folded_root, f = t.h AS verified
FROM named JOIN tops_{top_levels} USING (n) JOIN sub ON sub.lang = named.g CROSS JOIN t{top_levels} t""")
