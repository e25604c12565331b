"""Exact dedup, Merkle manifest, ranked search: brute force, planted cases, edge rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from customer360.llm import exactdedup, lexical, merkle, skew
from customer360.plans.inspect import plan_text

SF = "/root/testdata/sf0.01"
# Names that the operators use inside, as columns of the input.
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, survives string, digest string, bitmap_row string, hash string, grp string, `odd.name` int"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    pool = ["alpha", "beta", "Gamma", "dé", "x1", "the", "of"]
    base = [" ".join(rng.choice(pool) for _ in range(rng.choice([1, 3, 9, 90, 400]))) for _ in range(60)]
    texts = base + base[:25] + [t.upper() for t in base[3:9]] + ["É", "é", "K", "K", "k", "", None, " ", "\n", "word " * 30000]
    texts += [base[0][:-1] + "z", "a" * 300 + "b", "a" * 300 + "c", "a" * 300 + "B"] + ["one text of many"] * 40
    out = [(i * 7 % 1009, t, rng.choice(["en", "de", None, "en", "zz" if i == 5 else "en"]), rng.choice(["a", None]), None if t is None else len(t), "x", "x", "x", "x", "x", 1) for i, t in enumerate(texts)]
    out += [out[4], out[4], (None, "no id", "en", "s", 5, *["x"] * 5, 2), (None, "No id", None, "s", 5, *["x"] * 5, 3), (out[9][0], "same id, other text", "en", "s", 1, *["x"] * 5, 4)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def empty(spark, df):
    return spark.createDataFrame([], df.schema)


def norm(t):
    return (t or "").translate(UPPER)


def expected_groups(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[norm(r[1])].append(r[0])
    return {t: (max((i for i in g if i is not None), default=None), len(g)) for t, g in groups.items()}


def test_exact_dedup_is_the_grouping_by_text(spark, docs, rows):
    groups = expected_groups(rows)
    want = Counter((r[0], *groups[norm(r[1])], r[0] == groups[norm(r[1])][0], sha(norm(r[1]))) for r in rows)
    got = exactdedup.copy_groups(docs, digest_all=True).select("doc_id", "keep_id", "group_size", "kept", "digest").collect()
    assert Counter(map(tuple, got)) == want
    # Texts alone by length or prefix are not read to the end, and have no digest.
    lean = {(r["doc_id"], r["digest"]) for r in exactdedup.copy_groups(docs, prefix=8).collect()}
    assert lean >= {(r[0], sha(norm(r[1]))) for r in rows if groups[norm(r[1])][1] > 1} and any(d is None for _, d in lean)


@pytest.mark.parametrize("prefix", [1, 256])
def test_exact_dedup_keeps_one_row_of_each_text(spark, docs, rows, prefix):
    groups = expected_groups(rows)
    out = exactdedup.drop_copies(docs, prefix)
    assert out.columns == docs.columns
    assert Counter((r["doc_id"], norm(r["text"])) for r in out.collect()) == Counter({(g[0], t): 1 for t, g in groups.items()})
    assert exactdedup.drop_copies(empty(spark, docs)).count() == 0 == exactdedup.copy_groups(empty(spark, docs)).count()


def test_crowded_bitmaps_change_no_result(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(exactdedup, "MOST_BITS", 4)
    groups = expected_groups(rows)
    got = exactdedup.copy_groups(docs, prefix=2).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"]) for r in got) == Counter((r[0], *groups[norm(r[1])]) for r in rows)


def test_exact_dedup_reads_whole_texts_of_survivors_only(spark, docs):
    marked, flag = exactdedup.surviving(docs)
    alone = {r["text"] for r in marked.where(~F.col(flag)).collect()}
    assert alone and not {norm(t) for t in alone} & {t for t, n in Counter(norm(r["text"]) for r in docs.collect()).items() if n > 1}
    plan = plan_text(marked, "simple")
    assert "Python" not in plan and "Arrow" not in plan and "SortMergeJoin" not in plan  # texts are never shuffled


@pytest.mark.parametrize("heavy", [1, 3, 10_000])
def test_join_groups(spark, heavy):
    facts = spark.createDataFrame([(k, n, "f%d" % k) for k, n in ((0, 70), (1, 29), (2, 1))], "k int, n int, f string")
    left = facts.select("k", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("row"))
    out = skew.join_groups(left, facts, "k", "n", 100, heavy)
    assert Counter((r["k"], r["f"]) for r in out.collect()) == Counter({(0, "f0"): 70, (1, "f1"): 29, (2, "f2"): 1})
    assert skew.free_name("a", spark.createDataFrame([], "A int, a_ int")) == "a__"


def fields(r, text):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], text))


def tree(leaves, k):
    """(top, siblings [(left, right)] of each leaf), level by level."""
    level, paths, at = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        for i, p in enumerate(at):
            run = level[p // k * k : p // k * k + k]
            paths[i].append(("".join(run[: p % k]), "".join(run[p % k + 1 :])))
            at[i] = p // k
        level = [sha(*level[a : a + k]) for a in range(0, len(level), k)]
    return level[0], paths


def expected_manifest(rows, k):
    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r[2]].append(r)
    langs = sorted(by_lang, key=lambda v: (v is not None, (v or "").encode()))
    parts = []
    for v in langs:
        group = sorted(by_lang[v], key=lambda r: (r[0] is not None, r[0] or 0, sha(fields(r, r[1]))))
        parts.append((group, *tree([sha(fields(r, r[1])) for r in group], k)))
    root, tops = tree([p[1] for p in parts], k)
    out = []
    for (group, subroot, paths), above in zip(parts, tops, strict=True):
        for r, path in zip(group, paths, strict=True):
            path = path + above
            leaf = sha(fields(r, r[1]))
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            f = sha(fields(r, r[1].translate(UPPER))) if hit and r[1] is not None else leaf
            for left, right in path:
                f = sha(left, f, right)
            out.append((r[0], leaf, subroot, root, sha(*[x for p in path for x in p]), f, f == root))
    return Counter(out)


def test_merkle_manifest(spark, docs, rows):
    got = merkle.manifest_report(docs)
    want = expected_manifest(rows, merkle.FANOUT)
    assert Counter(map(tuple, got.collect())) == want
    assert any(not r[-1] for r in want) and any(r[-1] for r in want)
    assert merkle.manifest_report(empty(spark, docs)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 513])
def test_merkle_heights_and_proofs(spark, n):
    """One group around each change of height; every path folds to the root."""
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit(None).cast("string").alias("lang"), F.lit(1).alias("n_chars"), F.col("id").cast("string").alias("text"))
    out = merkle.manifest(df.repartition(3))
    assert out.where(merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")).count() == n
    height = 0
    while 8**height < n:
        height += 1
    assert {len(r["path"]) for r in out.collect()} == {height}
    rows = [(i, str(i), None, "s", 1) for i in range(n)]
    assert {r["root"] for r in out.collect()} == {next(iter(expected_manifest(rows, 8)))[3]}


def test_merkle_other_fanout_and_many_groups(spark):
    rows = [(i, "t%d" % i, "g%02d" % (i % 23), None, i) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: (r["leaf"], r["subroot"], r["root"]) for r in merkle.manifest(df, fanout=3).collect()}
    assert got == {r[0]: r[1:4] for r in expected_manifest(rows, 3)}


def terms(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", norm(t))


def expected_ranks(docs, items, top):
    bags = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n_docs, total = sum(n > 0 for _, _, n in bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = Counter()
    for item, text in set(items):
        scored = []
        for i, bag, n in bags:
            m = 75 + (25 * n * n_docs) // max(1, total)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 12 * m)) for t in terms(text) if bag[t])
            if s > 0:
                scored.append((-s, i is not None, i or 0, i))
        out.update((item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:top], 1))
    return out


@pytest.mark.parametrize("options", [{}, {"top": 3, "vocab_block": 3, "item_block": 2, "slice_rows": 7}])
def test_ranked_search(spark, docs, rows, options):
    items = [("i%d" % k, t) for k, t in enumerate(["alpha beta the", "GAMMA gamma dé of", "x1", "nothing here", "", None, "one text of many " * 3, "beta", "word the of"])]
    items += [items[0], ("i1", "another text of one id: alpha")]
    frame = spark.createDataFrame([(*x, "e", 1) for x in items], "item_id string, text string, item string, term int").repartition(3)
    got = lexical.search(docs, frame, **options)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = expected_ranks([r[:2] for r in rows], items, options.get("top", 20))
    # Identical rows with equal scores share their ranks' places.
    assert Counter(map(tuple, got.collect())) == want and len(want) > 20


def test_ranked_search_of_empty_tables(spark, docs):
    items = spark.createDataFrame([("a", "alpha")], "item_id string, text string")
    assert lexical.search(empty(spark, docs), items).count() == 0
    assert lexical.search(docs, empty(spark, items)).count() == 0
    assert lexical.search(docs, items.withColumn("text", F.lit("zzz"))).count() == 0


def test_classes_hold_documents_of_equal_vectors_only(spark):
    """Copies over many ids count once each and are ranked by id; order and other words do not matter."""
    texts = [(k, "alpha beta junk%d" % k if k % 2 else "beta filler alpha") for k in range(60)]
    docs = spark.createDataFrame(texts, "doc_id int, text string").repartition(7)
    items = spark.createDataFrame([(1, "alpha"), (2, "beta beta")], "item_id int, text string")
    got = lexical.search(docs, items)
    assert Counter(map(tuple, got.collect())) == expected_ranks(texts, [(1, "alpha"), (2, "beta beta")], 20)
    assert [r["doc_id"] for r in got.where("item_id = 1").orderBy("rank").collect()] == list(range(20))
