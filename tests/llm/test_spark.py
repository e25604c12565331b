"""The operators as Spark jobs: brute force, planted cases, edge rows, pipeline."""

from __future__ import annotations

import hashlib
import pathlib
import pickle
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from customer360.llm import decontam, editembed, htmltext, langid, licenses, linededup, nbsvm, ngramjoin, packing, toxcnn
from customer360.llm.components import connected_components
from customer360.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"
TINY = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, rk string, node string, score string, `odd.name` int"


def words(rng, n, pool=300):
    return ["%s%d" % (rng.choice(["ka", "lo", "mi"]), rng.randrange(pool)) for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    """(doc_id, text): copies, near copies, shared passages, short, long and empty texts, NULLs."""
    rng = random.Random(7)
    base = [words(rng, rng.choice([3, 8, 40, 120])) for _ in range(40)]
    passage = words(rng, 60)
    out = [" ".join(w) for w in base]
    out += [out[5]] * 4 + [out[6].upper()]
    for k in range(12):  # near copies of a long text, of differing likeness
        w = list(base[next(i for i, b in enumerate(base) if len(b) == 120)])
        for _ in range(1 + k // 3):
            w[rng.randrange(len(w))] = "edit%d" % rng.randrange(99)
        out.append(" ".join(w))
    out += [" ".join(words(rng, 10) + passage + words(rng, 10)) for _ in range(6)]
    out += ["", None, "   \n\t ", "single", "single", " ".join(words(rng, 9000))]
    out += ["first line of this text here\n" + " ".join(words(rng, 20)), "first line of this text hare\nand something else, quite long"]
    return list(enumerate(out, 3))


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", "s", None if t is None else len(t), "rk", "node", "score", 1) for i, t in texts]
    rows += [rows[0], (None, "a row without any id but with words", None, None, 1, "", "", "", 2)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components(rows, linked):
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(rows):
        for j, b in rows[:n]:
            if linked(a, b):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i, _ in rows}


def empty(spark, df):
    return spark.createDataFrame([], df.schema)


def test_connected_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + k) for k in range(50)] + [(200 + rng.randrange(40), 200 + rng.randrange(40)) for _ in range(30)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = components(sorted({(x, x) for e in edges for x in e}), lambda a, b: (a, b) in set(edges) or (b, a) in set(edges))
    assert got == {k: v for k, v in want.items() if any(k in e and e[0] != e[1] for e in edges)}


def test_ngram_join(spark, docs, texts):
    want_set = [(i, shingles(t)) for i, t in texts]
    want = components(want_set, lambda a, b: bool(a and b) and 100 * len(a & b) >= 80 * len(a | b))
    rows = ngramjoin.link_components(docs).collect()
    assert len(rows) == len(texts) + 2
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] is not None}
    assert got == {i: (len(s), want[i]) for i, s in want_set}
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None]
    kept = ngramjoin.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)) == sorted(i for i, c in want.items() if i == c)
    assert kept.where("doc_id is null").count() == 1
    assert ngramjoin.link_components(empty(spark, docs)).count() == 0


def test_packing(spark, docs, texts):
    out = packing.pack_documents(docs, with_ids=True).collect()
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    by_doc = {}
    for r in out:
        if r["doc_id"] not in (None, texts[0][0]):
            by_doc.setdefault(r["doc_id"], []).append(r)
    for i, t in texts[1:]:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        pieces = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [x for r in pieces for x in r["ids"]] == ids and [r["piece"] for r in pieces] == list(range(len(pieces)))
        assert all(r["length"] == 2048 for r in pieces[1:]) and [r["start"] for r in pieces] == np.cumsum([0] + [r["length"] for r in pieces[:-1]]).tolist()
        assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in pieces)
    ends = Counter()
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert ends[r["sequence_id"]] == r["offset"]
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 2048 and len(ends) <= sum(ends.values()) / 2048 + 1
    assert packing.pack_documents(empty(spark, docs)).count() == 0
    for texts_ in ([(1, None)], [(1, ""), (2, "")]):  # batches without any word
        got = packing.pack_documents(spark.createDataFrame(texts_, "doc_id int, text string")).collect()
        assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == [(i, 0, 0, 1, zlib.crc32(bytes(4))) for i, _ in texts_]
    # Many pieces of one length, numbered in several groups.
    many = spark.range(500).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(700).cast("long").alias("length"))
    got = packing.pack_pieces(many, rank_group=7).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == 500 and len({r["sequence_id"] for r in got}) == 250


def test_line_dedup(spark, docs, texts):
    lines = [((i, n), x) for i, t in texts for n, x in enumerate((t or "").split("\n")) if len(x) >= linededup.MIN_CHARS]
    same = sorted({x for _, x in lines})

    def near(a, b):
        tau = int(linededup.tau_of(np.array([min(len(a), len(b))]))[0])
        if abs(len(a) - len(b)) > tau:
            return False
        enc = [np.frombuffer(x.encode("utf-32-le"), np.uint32) for x in (a, b)]
        return bool(linededup.within([enc[0]], [enc[1]], tau)[0])

    cls = components(list(enumerate(same)), near)
    first = {}
    for at, x in lines:
        first.setdefault(cls[same.index(x)], at)
    want = {at: first[cls[same.index(x)]] == at for at, x in lines}
    got = {(r["doc_id"], r["line_no"]): r["keep"] for r in linededup.line_classes(docs).where("doc_id is not null").collect()}
    assert got == want
    assert any("first line of this text hare" == x and not want[at] for at, x in lines)
    out = linededup.dedup_lines(docs)
    assert out.columns == docs.columns
    kept = {r["doc_id"]: r["text"] for r in out.where("doc_id is not null").collect()}
    for i, t in texts:
        left = [x for n, x in enumerate((t or "").split("\n")) if want.get((i, n), True)]
        mine = [k for (d, _), k in want.items() if d == i]
        if not mine or any(mine):
            assert kept[i] == (None if t is None else "\n".join(left))
        else:
            assert i not in kept
    report = {r["doc_id"]: r for r in linededup.line_report(docs).where("doc_id is not null").collect()}
    assert all(r["n_removed"] == len(r["removed"]) == sum(not k for (d, _), k in want.items() if d == i) for i, r in report.items())
    assert linededup.line_report(empty(spark, docs)).count() == linededup.dedup_lines(empty(spark, docs)).count() == 0


def edited(rng, line, edits):
    x = list(line)
    for _ in range(edits):
        at = rng.randrange(len(x) + 1)
        kind = rng.choice("ids")
        if kind == "i" or at == len(x):
            x.insert(at, rng.choice("abcxyz "))
        elif kind == "d":
            del x[at]
        else:
            x[at] = rng.choice("abcxyz ")
    return "".join(x)


def test_line_links_at_every_class_border(spark):
    """Pairs of lines around each class border, some with as many edits as are allowed and one more, against plain distances."""
    rng = random.Random(9)
    pool = [*"abcdefghijklmnop ", "word ", "and "]
    lines = []
    for least, tau in linededup.CLASSES:
        for size in (least - 1, least, least + 1, least + tau, least - tau):
            base = "".join(rng.choice(pool) for _ in range(size))[:size].replace("\n", " ")
            lines += [base, *(edited(rng, base, e) for e in (1, tau - 1, tau, tau, tau + 1) if e > 0)]
    # Edits gathered at one end, a replaced word in a long passage, and a common start.
    long = " ".join(rng.choice(["green", "river", "stone", "cloud"]) + str(rng.randrange(99)) for _ in range(60))
    cut = long.split(" ")
    lines += [long, "zq" + long, long + "zq", " ".join([*cut[:30], cut[30][0] + "xx" + cut[30][3:], *cut[31:]]), long[:200] + "q" * 300, long[:200] + "w" * 300, "x" * 19, "x" * 18 + "y"]
    lines = sorted({x for x in lines if x.strip()})
    df = spark.createDataFrame([(i, "\n".join(lines[i::7])) for i in range(7)], "doc_id int, text string").repartition(4)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    def near(a, b):
        tau = int(linededup.tau_of(np.array([min(len(a), len(b))]))[0])
        if tau < 0 or abs(len(a) - len(b)) > tau:
            return False
        if Counter(a) != Counter(b) and sum((Counter(a) - Counter(b)).values()) > tau:
            return False
        return distance(a, b) <= tau

    cls = components(list(enumerate(lines)), near)
    first = {}
    for i in range(7):
        for n, x in enumerate(lines[i::7]):
            if len(x) >= linededup.MIN_CHARS:
                first.setdefault(cls[lines.index(x)], (i, n))
    got = {(r["doc_id"], r["line_no"]): r["keep"] for r in linededup.line_classes(df).collect()}
    want = {(i, n): first[cls[lines.index(x)]] == (i, n) for i in range(7) for n, x in enumerate(lines[i::7]) if len(x) >= linededup.MIN_CHARS}
    assert got == want
    assert sum(not k for k in want.values()) > 30
    assert len({cls[lines.index(x)] for x in (long, "zq" + long, long + "zq", " ".join([*cut[:30], cut[30][0] + "xx" + cut[30][3:], *cut[31:]]))}) == 1


def test_line_dedup_with_clashing_columns(spark):
    names = ["__gone", "__kept", "row_key", "lost_lines", "kept_lines", "is_copy", "rk", "lines", "copy"]
    df = spark.createDataFrame([(1, "one line of a text to see\nrest", *names), (2, "one line of a text to see\nother", *names)], "doc_id int, text string, " + ", ".join(f"{n} string" for n in names))
    out = linededup.dedup_lines(df)
    assert out.columns == df.columns and {r["doc_id"]: r["text"] for r in out.collect()} == {1: "one line of a text to see\nrest", 2: "other"}
    assert all(r[n] == n for r in out.collect() for n in names)


def test_line_dedup_keeps_short_lines(spark):
    head = "A heading that several documents share"
    rows = [(1, head + "\nand its text, which is long enough"), (2, head + "\nroses red\nviolets blue\n"), (3, head + "\n \n"), (4, head + "\nroses red\nviolets blue\n"),
            (5, "短い行\n" + head), (6, "short\nshort"), (7, "short\nshort"), (None, "nothing of this is found elsewhere")]
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in linededup.dedup_lines(spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id int, text string, n_chars int")).collect()}
    want = dict(rows) | {2: "roses red\nviolets blue\n", 5: "短い行"}
    assert got == {i: (t, len(t)) for i, t in want.items() if i not in (3, 4)}


def test_decontamination(spark, docs, texts):
    bench = spark.createDataFrame([(1, next(t for _, t in texts if t and len(t.split()) == 40)), (2, None), (3, ""), (4, "no such words are found in any row at all")], "item_id int, text string")
    found = decontam.find_leaks(docs, bench).collect()
    want = {i for i, t in texts if t and bench.first()["text"].lower() in t.lower()}
    assert {r["doc_id"] for r in found} == want and {r["item_id"] for r in found} == {1}
    sharded = decontam.find_leaks(docs, bench, shard_items=1)
    assert {(r["doc_id"], r["item_id"]) for r in sharded.collect()} == {(r["doc_id"], r["item_id"]) for r in found}
    clean = decontam.remove_leaks(docs, bench)
    assert clean.columns == docs.columns and clean.count() == docs.count() - len([i for i in want]) - (texts[0][0] in want)
    assert decontam.find_leaks(docs, empty(spark, bench)).count() == decontam.find_leaks(empty(spark, docs), bench).count() == 0


def test_shards_give_the_scores_of_one_index(spark):
    rng = random.Random(8)
    items = [(i, " ".join(words(rng, rng.randint(6, 30), 40)) + ". " + " ".join(words(rng, 3, 40))) for i in range(40)] + [(98, ""), (99, None)]
    rows = []
    for i, t in items[:40]:
        w = t.split()
        for _ in range(len(w) // 10):
            w[rng.randrange(len(w))] = "other"
        rows.append((i, " ".join(words(rng, 20, 40) + w + words(rng, 20, 40))))
    corpus, bench = spark.createDataFrame(rows, "doc_id int, text string"), spark.createDataFrame(items, "item_id int, text string")
    one = sorted(map(tuple, decontam.find_leaks(corpus, bench).collect()))
    assert len(one) > 20 and sorted(map(tuple, decontam.find_leaks(corpus, bench, shard_items=9).collect())) == one


def test_many_items_are_one_pass_over_the_corpus(spark, tmp_path):
    from customer360.plans.inspect import plan_text

    texts = [(i, " ".join(f"w{(i * 7 + k) % 5000}" for k in range(30))) for i in range(9000)]
    spark.createDataFrame(texts[:300], "doc_id int, text string").write.parquet(str(tmp_path / "d"))
    corpus, bench = spark.read.parquet(str(tmp_path / "d")), spark.createDataFrame(texts, "item_id int, text string")
    found = decontam.find_leaks(corpus, bench)  # three shards
    assert plan_text(found, "simple").count("FileScan") == 1
    assert {r["doc_id"] for r in found.where("doc_id = item_id").collect()} == set(range(300))


def test_fingerprints(spark, docs, texts):
    rows = {}
    for r in editembed.fingerprint_report(docs).collect():
        rows.setdefault(r["doc_id"], []).append(r)
    order = sorted([(i, t or "") for i, t in texts] + [(texts[0][0], texts[0][1])], key=lambda x: (x[0], x[1]))
    order = [(None, "a row without any id but with words"), *order]
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        want = hashlib.sha256(edited.encode()).hexdigest()
        assert want in {r["edited_sha256"] for r in rows[i]}
        assert all(r["n_chars"] == len(t) for r in rows[i])
        assert all(r["fingerprint"] == editembed.to_text(*editembed.fingerprints([t])[0]) for r in rows[i])
    assert editembed.fingerprint_report(empty(spark, docs)).count() == 0
    one = editembed.fingerprint_report(docs.where("doc_id = 10")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1
    near = {r["doc_id"]: r["near_id"] for r in editembed.near_classes(editembed.fingerprint_report(docs)).collect() if r["doc_id"] is not None}
    copies = [i for i, t in texts if t == texts[5][1]]
    assert {near[i] for i in copies} == {min(copies)} and len(near) == len(texts)
    assert editembed.near_classes(editembed.print_rows(empty(spark, docs))).count() == editembed.near_pairs(empty(spark, docs)).count() == 0
    named = docs.where("doc_id is not null").withColumn("doc_id", F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 4, "0")))
    assert [r["n_chars"] for r in editembed.fingerprint_report(named).orderBy("doc_id", "edited_sha256").collect()] == [len(t) for i, t in order[1:]]


def test_near_classes_against_all_pairs(spark):
    """Inserted characters at every length, level borders included, and replaced parts: recall of the likeness over all pairs."""
    rng = random.Random(6)
    texts = []
    for size in (20, 60, 63, 64, 65, 127, 128, 500, 1000, 1023, 1024, 2000, 2047, 3000, 4000, 4095, 4096, 6000, 8191, 8192):
        base = "".join(rng.choice("abcdefgh ijklmno") for _ in range(size))
        for _ in range(3):
            at = rng.randrange(size)
            texts += [base[:at] + "z" + base[at:], base[:at] + base[at + 1 :]]
        at = rng.randrange(max(1, size - size // 15))
        texts += [base, base, base[:at] + "".join(rng.choice("qrstuv") for _ in range(size // 15)) + base[at + size // 15 :]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(4)
    prints = editembed.fingerprints(texts)
    alike = {(i, j) for i in range(len(texts)) for j in range(i) if editembed.likeness(prints[i], prints[j]) >= editembed.LEAST}
    near = {r["doc_id"]: r["near_id"] for r in editembed.near_classes(editembed.print_rows(docs)).collect()}
    want = components(list(enumerate(range(len(texts)))), lambda a, b: (a, b) in alike or (b, a) in alike)
    assert len(alike) > 300 and sum(near[i] == near[j] for i, j in alike) >= 0.97 * len(alike)
    assert all(want[near[i]] == want[i] for i in near)  # nothing is linked that likeness does not connect
    pairs = {(r["a"], r["b"]) for r in editembed.near_pairs(docs).collect()}
    assert pairs and all(editembed.edit_distance_within(texts[a], texts[b], editembed.edits_of(min(len(texts[a]), len(texts[b])))) for a, b in pairs)


@pytest.mark.parametrize("tau", [1, 3, 12])
def test_wide_band_edit_distance(tau):
    rng = random.Random(tau)
    for _ in range(150):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 40)))
        b = edited(rng, a or "x", rng.randrange(0, 2 * tau + 3))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        assert editembed.edit_distance_within(a, b, tau) == (row[-1] <= tau), (a, b)


def test_language_and_labels(spark, docs):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    lab = spark.read.parquet(f"{SF}/labels.parquet")
    for name, col, least in (("op1_quality", "quality", 0.95), ("op10_toxicity", "toxic", 0.9)):
        got = QUERIES[name](spark, SF).join(lab, "doc_id").where("held_out")
        n, right = got.agg(F.count("*"), F.sum((F.col("predicted") == F.col(col)).cast("int"))).first()
        assert n > 50 and right / n >= least, name
    got = QUERIES["op5_language_id"](spark, SF).join(d.select("doc_id", "lang"), "doc_id").where("held_out")
    n, right = got.agg(F.count("*"), F.sum((F.col("lang_pred") == F.col("lang")).cast("int"))).first()
    assert right / n > 0.95
    none = lab.where("false")
    assert nbsvm.score_quality(docs, nbsvm.fit_quality(docs, none)).where("score = 0.5").count() == docs.count()
    assert toxcnn.toxicity(docs, docs, none).where("score = 0").count() == docs.count()
    assert toxcnn.drop_toxic(docs, docs, none).count() == docs.count()
    models = langid.fit_languages(docs)
    seen = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs, models).collect()}
    assert set(seen.values()) == {"en", "und"}
    assert langid.identify(docs, langid.fit_languages(empty(spark, docs))).where("lang_pred <> 'und'").count() == 0
    model = nbsvm.fit_quality(d, lab)
    scores = {r["doc_id"]: r["score"] for r in nbsvm.score_quality(docs, model).collect()}
    assert all(0 <= s <= 1 for s in scores.values())


def test_labels_of_held_out_rows_are_not_read(spark):
    lab = spark.read.parquet(f"{TINY}/labels.parquet")
    d = spark.read.parquet(f"{TINY}/documents.parquet")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    flipped = lab.withColumn("toxic", F.when(fold == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r["doc_id"]: r["score"] for r in toxcnn.toxicity(d, d, x.where(fold != 0)).collect()} for x in (lab, flipped))
    assert a == b


def test_component_rounds_release_the_rounds_before(spark, monkeypatch):
    """A round's checkpoint goes while later rounds run, and with it what the driver holds of it."""
    from customer360.llm import components as module
    from customer360.plans import checkpoint_dir, cut_lineage, release_unreachable

    checkpoint_dir(spark)  # sets one if there is none
    folder = pathlib.Path(checkpoint_dir(spark).removeprefix("file:"))
    release_unreachable(spark)
    kept, known = [], set(folder.glob("rdd-*"))

    def cut(frame):
        out = cut_lineage(frame)
        until = time.time() + 5  # the cleaner has a thread of its own
        while (n := len(set(folder.glob("rdd-*")) - known)) > 3 and time.time() < until:
            time.sleep(0.1)
        kept.append(n)
        return out

    monkeypatch.setattr(module, "cut_lineage", cut)
    rng = random.Random(3)
    names = rng.sample(range(10_000), 400)
    roots = connected_components(spark.createDataFrame(list(zip(names, names[1:], strict=False)), "a long, b long"))
    assert {r["root"] for r in roots.collect()} == {min(names)} and roots.count() == 400
    assert len(kept) > 5 and max(kept) <= 3, kept


def test_every_labelled_row_trains_the_detector(spark, monkeypatch):
    """Words and letters beyond any bounded number of labelled rows reach the model,
    whose counts are those of a plain loop; shards of any size learn alike."""
    n = 5400
    ids = spark.range(n).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    rank = F.row_number().over(Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id")))
    lab = ids.withColumn("late", rank > 2600).cache()
    word = F.when(F.col("toxic") == 0, "calm").when(F.col("late"), "zork").otherwise("bile")
    text = F.concat_ws(" ", F.lit("the river"), F.concat(F.lit("w"), (F.col("doc_id") % 97).cast("string")), word, F.lit("runs"))
    lang = F.when(F.col("doc_id") == 7, None).otherwise("en")
    docs = lab.select("doc_id", F.when(F.col("doc_id") == 8, None).otherwise(text).alias("text"), lang.alias("lang"))
    docs = docs.unionByName(docs.where("doc_id in (3, 4)")).unionByName(docs.limit(5).withColumn("doc_id", F.lit(None).cast("long")))
    slots = {w: int(toxcnn._ids(pa.array([w]))[0][0]) for w in ("calm", "bile", "zork", "river")}
    rows = toxcnn.training_rows(docs, lab.drop("late"))
    assert rows.count() == n + 2
    want = {r["w"]: (r["a"], r["b"]) for r in rows.where("fold <> 0").select("label", F.explode(F.array_distinct(F.split("text", " "))).alias("w"))
            .groupBy("w").agg(F.count_if(F.col("label") == 0).alias("a"), F.count_if(F.col("label") == 1).alias("b")).collect()}
    got = {(r["lang"], r["at"]): (r["x"], r["y"]) for r in toxcnn._counts(rows, True, ["en"]).to_pylist()}
    assert all(got[-1, slots[w]] == want[w] for w in slots) and want["zork"][1] > 50
    assert sum(v for (k, _), (v, _) in got.items() if k == 0) == pytest.approx(n * toxcnn.FINE, rel=1e-4)  # two rows repeat, a lang and a text are NULL
    models = []
    for size in (4096, 700):
        monkeypatch.setattr(toxcnn, "SHARD_ROWS", size)
        model = toxcnn.train(docs, lab.drop("late"))
        assert model == toxcnn.train(docs, lab.drop("late")), "another run, another model"
        detector = pickle.loads(model)
        assert detector.net.rows_of(np.array([slots["zork"]]))[0] > 0
        margins = detector.margins(pa.array(["the river w5 zork runs", "the river w5 bile runs", "the river w5 calm runs", None]))
        assert margins[0] > 0 and margins[1] > 0 and margins[2] < 0 and margins[3] < 0, (size, margins)
        models.append(detector)
    assert models[0].langs == ["en"] and (models[0].profiles == models[1].profiles).all()
    lab.unpersist()


def test_toxicity_threshold_of_counted_rows():
    rng = np.random.default_rng(2)
    cells = rng.integers(0, 2 * toxcnn.LIMIT * toxcnn.GRID, 40)
    counts = np.zeros((2 * toxcnn.LIMIT * toxcnn.GRID, 2), np.int64)
    counts[cells] = rng.integers(0, 5, (40, 2)) + [0, 1]
    z = (np.arange(len(counts)) + 0.5) / toxcnn.GRID - toxcnn.LIMIT

    def f1(cut):
        hits, wrong = counts[z > cut].sum(axis=0)[::-1]
        return 2 * hits / (hits + wrong + counts[:, 1].sum())

    assert f1(toxcnn._cut(counts)) == pytest.approx(max(f1(c - 1e-6) for c in z[cells]))


def test_pages(spark):
    pages = spark.createDataFrame([(1, "u", "<body><article><p>a &amp; b</article>", 7), (2, None, None, 7), (None, "v", "", 7), (1, "u", "<body><article><p>a &amp; b</article>", 7)],
                                  "page_id bigint, url string, html string, text int")
    got = sorted(((r["page_id"] or 0, r["url"] or "", r["text"], r["n_chars"]) for r in htmltext.extract_pages(pages).collect()))
    assert got == [(0, "v", "", 0), (1, "u", "a & b", 5), (1, "u", "a & b", 5), (2, "", "", 0)]
    assert htmltext.extract_pages(pages.where("false")).count() == 0


def test_licences(spark):
    import duckdb

    rows = [
        ("/a/LICENSE.md", "MIT License text\nReleased under the MIT License.\n"), ("/a/b/x.py", "no notice"), ("/a/b/c/y.py", "# Licensed under the Apache License, Version 2.0.\ncode"),
        ("/z/q.txt", "Released under the ISC License.\nbody"), ("/z/r.txt", "body\nmore"), ("/z/k/s.txt", "x"), ("/none.txt", "license"), ("/n.txt", None), ("/e.txt", ""),
        ("/a/b/x.py", "no notice"), ("/a/b/GPL.txt", "This work is licensed under the GNU General Public License, version 3."),
    ]
    files = spark.createDataFrame([(p, t, i) for i, (p, t) in enumerate(rows)] + [(None, "Released under the MIT License.", 99)], "path string, text string, license_dir int")
    got = {(r["path"], r["license_dir"]): (r["license"], r["basis"], r["license_path"]) for r in licenses.scan_licenses(files).collect()}
    assert len(got) == len(rows) + 1
    assert got[("/a/LICENSE.md", 0)][:2] == ("MIT", "own") and got[("/a/b/x.py", 1)] == ("MIT", "inherited", "/a/LICENSE.md")
    assert got[("/a/b/c/y.py", 2)][:2] == ("Apache-2.0", "own") and got[("/z/r.txt", 4)] == (None, "none", None) and got[(None, 99)][:2] == ("MIT", "own")
    first = {r["path"]: (r["license"], r["basis"], r["license_path"]) for r in licenses.scan_licenses(files, first_line_files=True).collect()}
    assert first["/z/k/s.txt"] == ("ISC", "inherited", "/z/q.txt") and first["/none.txt"] == (None, "none", None) and first["/a/b/x.py"][0] == "GPL-3.0"
    con = duckdb.connect()
    con.execute("CREATE TABLE fx (doc_id INT, path VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO fx VALUES (?, ?, ?)", [(i, p, t) for i, (p, t) in enumerate(rows)])
    want = {r[1]: (r[2], r[4], r[5]) for r in con.execute(licenses.oracle("SELECT * FROM fx")).fetchall()}
    assert {p: v for p, v in first.items() if p} == want
    assert licenses.scan_licenses(files.where("false")).count() == 0


def test_wrapped_headers_and_licence_files(spark):
    """Notices wrapped over comment lines, at any line of a file and any width, against the SQL; near misses are left alone."""
    import textwrap

    import duckdb

    code = "\n".join(f"value_{i} = compute({i}) + other_{i % 7}" for i in range(40))
    long = {name: body for name, body in licenses.TEMPLATES if len(body.split()) > 35}
    rows = []
    for name, body in long.items():
        for width, sign, before in ((72, "# ", 0), (60, " * ", 1), (40, "// ", 3), (76, "", 9)):
            head = "\n".join(f"{sign}intro {i}" for i in range(before))
            rows.append((f"/{name}/{width}.src", "\n".join(x for x in (head, textwrap.indent(textwrap.fill(body, width), sign), code) if x), name))
    rows += [("/gpl/LICENSE", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n" + "Some of the preamble\n" * 60, "GPL-3.0"),
             ("/gpl/src/main.c", code, "GPL-3.0"), ("/clean/a.txt", "\n".join(["You may use the software and the files", "without a copy of the notice in them"] * 20), None),
             ("/clean/b.txt", code, None), ("/clean/c.txt", "License\nVersion 2 of the text", None)]
    files = spark.createDataFrame([(i, p, t) for i, (p, t, _) in enumerate(rows)], "doc_id int, path string, text string").repartition(3)
    got = {r["path"]: (r["license"], r["score"], r["basis"], r["license_path"]) for r in licenses.scan_licenses(files, first_line_files=True).collect()}
    assert {p: v[0] for p, v in got.items()} == {p: want for p, _, want in rows}
    assert got["/gpl/src/main.c"][2:] == ("inherited", "/gpl/LICENSE") and all(got[p][2] == "own" for p, _, _ in rows[: 4 * len(long)])
    con = duckdb.connect()
    con.execute("CREATE TABLE fx (doc_id INT, path VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO fx VALUES (?, ?, ?)", [(i, p, t) for i, (p, t, _) in enumerate(rows)])
    assert got == {r[1]: tuple(r[2:6]) for r in con.execute(licenses.oracle("SELECT * FROM fx")).fetchall()}


def test_licence_query_matches_its_oracle(spark):
    from oracle_check import compare, duck

    ok, msg = compare(spark, SF, "op2_license_scan", duck(SF))
    assert ok, msg
    assert set(ORACLE_SQL) <= set(QUERIES)


def test_pipeline(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "ngram_jaccard_join", "decontamination", "best_fit_packing"]
    out = P.run(spark, TINY).cache()
    ids = {r["doc_id"] for r in out.select("doc_id").distinct().collect()}
    assert ids <= {r["doc_id"] for r in docs.select("doc_id").collect()} and len(ids) > 100
    bench = [r["text"] for r in spark.read.parquet(f"{TINY}/benchmark.parquet").collect()]
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    leaks = {i for i, t in text.items() if any(b in t for b in bench)}
    assert leaks and not leaks & ids
    copies = {}
    for i, t in sorted(text.items()):
        copies.setdefault(t, []).append(i)
    assert all(not set(c[1:]) & ids for c in copies.values())
    step = docs
    for _, stage in P.STAGES[:2]:
        step = stage(spark, step, TINY)
        assert step.columns == docs.columns
    assert step.where(F.length("text") != F.col("n_chars")).count() == 0


def test_source_guards():
    lib = pathlib.Path(linededup.__file__).parent
    for path in [*lib.glob("*.py"), lib.parent.parent / "corpus_pipeline.py"]:
        source = path.read_text()
        assert not re.search(r"localCheckpoint|crossJoin|\.rdd\.", source), path
    native = (lib / "licenses.py").read_text()
    assert not re.search(r"udf|mapIn|applyIn|pandas|pyarrow", native)
