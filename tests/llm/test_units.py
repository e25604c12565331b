"""The operators' task-side parts against brute force, without Spark."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from customer360.llm import decontam, editembed, htmltext, langid, linededup, nbsvm, packing, textnum, toxcnn

SP = r"[^\x20\x09-\x0D]+"


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


TEXTS = ["", None, "one", "Two WORDS", "a b c d e", "a b c d e f a b c d e", "É à\tb\nc  d\x0be", "x " * 40, "naïve café " * 9, " lead", "trail "]


def test_shingle_sets_match_python_sets():
    got = textnum.shingle_sets(*textnum.utf8(pa.array(TEXTS)))
    for t, s in zip(TEXTS, got, strict=True):
        w = re.findall(SP, low(t))
        want = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        assert len(s) == len(want)
        assert (np.diff(s.astype(object)) > 0).all()
    # Case folds, word borders count, equal words hash alike.
    a, b, c = textnum.shingle_sets(*textnum.utf8(pa.array(["A b C d E", "a B c D e", "ab c d e f"])))
    assert a.tolist() == b.tolist() != c.tolist()


def test_chunks_cover_all_rows():
    b = pa.RecordBatch.from_arrays([pa.array(["x" * 10] * 25 + ["y" * 100])], ["text"])
    parts = list(textnum.chunks(iter([b]), limit=30))
    assert [t for p in parts for t in p.column("text").to_pylist()] == b.column("text").to_pylist()
    assert max(p.num_rows for p in parts) <= 3


def lev(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        c = [i]
        for j, y in enumerate(b, 1):
            c.append(min(p[j] + 1, c[-1] + 1, p[j - 1] + (x != y)))
        p = c
    return p[-1]


@pytest.mark.parametrize("tau", [1, 2, 3])
def test_banded_edit_distance(tau):
    rng = random.Random(tau)
    a, b = [], []
    for _ in range(400):
        x = [rng.choice("abcé") for _ in range(rng.randint(8 * (tau + 1), 50))]
        y = x[:]
        for _ in range(rng.randint(0, tau + 2)):
            k, o = rng.randrange(len(y)), rng.random()
            if o < 0.33:
                y[k] = "z"
            elif o < 0.66:
                del y[k]
            else:
                y.insert(k, "z")
        a.append("".join(x))
        b.append("".join(y))
    code = [[np.frombuffer(s.encode("utf-32-le"), np.uint32) for s in side] for side in (a, b)]
    assert linededup.within(code[0], code[1], tau).tolist() == [lev(x, y) <= tau for x, y in zip(a, b, strict=True)]


def test_lines_match_split():
    texts = ["a\nbé\n", "", None, "x", "\n\nq", "é\nü"]
    x = linededup.Lines(pa.array(texts))
    got = {}
    for r, k, s, e in zip(x.row, x.number, x.start, x.stop, strict=True):
        got.setdefault(int(r), {})[int(k)] = x.cp[s:e].tobytes().decode("utf-32-le")
    for i, t in enumerate(texts):
        assert [got[i][k] for k in range(len(got[i]))] == (t or "").split("\n")


def test_word_tokenizer_equals_whole_text_encoding():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.default_tokenizer())
    w = packing.WordTokenizer(packing.default_tokenizer())
    rng = random.Random(3)
    parts = ["a", "B", " ", " ", " ", "\n", "é", "\u00a0", "　", "1", "23", ".", "--", "_", "'s", "'", "'ll", "x'", "日", "\t", "<|endoftext|>", "\r", " the", "\u2009", "\x00", "\x1c", "\x7f", "\x0b", "½", "²", "ˈ", "\U0001f600", "\u0301"]
    texts = ["", "a", " ", "a ", "a  b", None, "\n", "b \n c", "a1b2 c3", " ", "x"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(6000)]
    for at in range(0, len(texts), 700):
        part = texts[at : at + 700]
        for t, ids in zip(part, w.encode(pa.array(part)), strict=True):
            assert ids.tolist() == plain.encode(t or "", add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("texts", [[None], [""], [None, "", None], [], ["", "a", ""], [" "]])
def test_batches_without_words(texts):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.default_tokenizer())
    w = packing.WordTokenizer(packing.default_tokenizer())
    assert [x.tolist() for x in w.encode(pa.array(texts, pa.string()))] == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_piece_cache_starts_afresh(monkeypatch):
    monkeypatch.setattr(packing, "WORD_CACHE", 50)
    w = packing.WordTokenizer(packing.default_tokenizer())
    for k in range(20):
        texts = ["w%d x%d-%d" % (k, j, k) for j in range(30)]
        assert [x.tolist() for x in w.encode(pa.array(texts))] == [w.tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_texts_longer_than_a_chunk_hash_alike(monkeypatch):
    raw = np.frombuffer(("some words again " * 400).encode(), np.uint8)
    want = textnum.word_hashes(raw, np.array([0, len(raw)]))[0]
    monkeypatch.setattr(textnum, "CHUNK_BYTES", 64)
    monkeypatch.setattr(textnum, "_POW", [])
    assert (textnum.word_hashes(raw, np.array([0, len(raw)]))[0] == want).all() and sum(len(p) for p in textnum._POW) == 0


def test_added_tokens_are_encoded_as_the_vocabulary_loads():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.default_tokenizer())
    w = packing.WordTokenizer(packing.default_tokenizer())
    texts = ["foo <|endoftext|> bar", "<|endoftext|>", "a<|endoftext|>b c", "no <|end", "oftext|> token", None, "x <|endoftext|><|endoftext|>", "plain words", "<|endof", "text|> y", "<<|endoftext|>"]
    for t, ids in zip(texts, w.encode(pa.array(texts)), strict=True):
        assert ids.tolist() == plain.encode(t or "", add_special_tokens=False).ids
    assert w.encode(pa.array(texts))[0].tolist() == [21943, 220, 50256, 2318]


def test_bin_plans_use_every_piece_once_and_fit():
    rng = np.random.default_rng(1)
    for cap, n in ((50, 400), (2048, 3000), (10, 1)):
        sizes = rng.integers(1, cap + 1, n)
        counts = np.bincount(sizes, minlength=cap + 1)
        plan = packing.plan_bins(counts)
        used = np.zeros(cap + 1, np.int64)
        for times, members in plan:
            assert sum(k * c for k, c in members) <= cap
            for k, c in members:
                used[k] += times * c
        assert used.tolist() == counts.tolist()
        assert sum(t for t, _ in plan) <= math.ceil(sizes.sum() / cap) * 11 / 9 + 1
    assert packing.plan_bins(np.zeros(5, np.int64)) == []


def test_two_fit_replaces_the_smallest():
    # Greedy takes 6 + 3 and leaves 1; 6 + (2 + 2) fills the bin of 10.
    counts = np.zeros(11, np.int64)
    counts[[6, 3, 2]] = [1, 1, 2]
    assert packing.plan_bins(counts)[0] == (1, [(6, 1), (2, 2)])


def test_leak_search_finds_what_a_plain_scan_finds():
    rng = random.Random(4)
    words = ["w%d" % i for i in range(400)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(15, 60))) + ".") for i in range(60)] + [(99, ""), (98, None)]
    texts = []
    for d in range(80):
        t = [rng.choice(words) for _ in range(rng.randint(0, 400))]
        if d % 4 == 0:
            t[len(t) // 2 : len(t) // 2] = items[d % 60][1].split()
        texts.append(" ".join(t).upper() if d % 8 == 0 else " ".join(t))
    index = decontam.Index(items)
    got = {(r, i) for r, i, *_ in index.search(*decontam.words(*textnum.utf8(pa.array(texts + ["", None]))))}
    want = {(r, i) for r, t in enumerate(texts) for i, (_, x) in enumerate(items) if x and x.rstrip(".").lower() in t.lower()}
    assert want <= got and len(got - want) <= 1
    assert list(decontam.Index([]).search(*decontam.words(*textnum.utf8(pa.array(["a b"]))))) == []


def test_bounds_of_the_leak_index_lose_nothing():
    rng = random.Random(6)
    words = ["w%d" % i for i in range(60)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(5, 30)))) for i in range(40)]
    index = decontam.Index(items)
    h, w = decontam.words(*textnum.utf8(pa.array([" ".join(rng.choice(words) for _ in range(300)) for _ in range(5)])))
    at = np.minimum(np.searchsorted(index.terms, h), len(index.terms) - 1)
    term = np.where(index.terms[at] == h, at, -1)
    scored = set()
    keep = index._score
    index._score = lambda r, a, z, i, *x: scored.add((r, a - int(w[r]), i)) or iter(())
    list(index.search(h, w))
    index._score = keep
    for r in range(5):
        for i, (t, impact) in enumerate(index.vector):
            size = 1 << int(index.level[i])
            for a in range(int(w[r]), int(w[r + 1]), size):
                if impact[np.isin(t, term[a : min(a + 2 * size, int(w[r + 1]))])].sum() >= 1:
                    assert (r, a - int(w[r]), i) in scored


def test_kneser_ney_sums_to_one_and_tells_languages():
    de = ["der hund und die katze schlafen nicht gern im garten"] * 5
    en = ["the dog and the cat do not like to sleep in the garden"] * 5
    tab = []
    for lang, ts in (("de", de), ("en", en)):
        k, n = np.unique(langid.symbols(pa.array(ts))[0], return_counts=True)
        tab.append(pa.table({"lang": [lang] * len(k), "key": k.astype("int32"), "n": n}))
    m = langid.LanguageModels(pa.concat_tables(tab))
    for key in (m.keys[3][7], 63 << 18 | 5 << 12 | 9 << 6):
        p = np.exp(m._missing(((int(key) >> 6) << 6 | np.arange(64)).astype(np.int64), 4)).sum(0)
        assert np.allclose(p, 1, atol=1e-4)
    lang, score, _, rejected = m.classify(pa.array(["die katze und der garten", "the cat sleeps", "", None, "12 !", "zzqx jjkk wwvv"]))
    assert lang[:5] == ["de", "en", "und", "und", "und"]
    assert (score[:2] > 0.5).all() and (score[2:5] == 0).all()
    assert rejected.tolist()[2:] == [True] * 4 and not m.classify(pa.array(de[:1] + en[:1]))[3].any()
    empty = langid.LanguageModels(pa.table({"lang": pa.array([], pa.string()), "key": pa.array([], pa.int32()), "n": pa.array([], pa.int64())}))
    assert empty.classify(pa.array(["abc"]))[0] == ["und"]


def test_symbols_do_not_cross_rows():
    key, row = langid.symbols(pa.array(["ab", "", "c d"]))
    one, _ = langid.symbols(pa.array(["c d"]))
    assert key[row == 2].tolist() == one.tolist() and not (row == 1).any()


PAGE = """<html><head><title>x</title></head><body><header><h1>Site</h1></header><div id="menu"><a href=/>Home</a> <a>B</a></div>
<div class="cookie-notice">We use cookies</div><div class="wrap"><div class="content"><h2>Head</h2><p>Some long paragraph text with <a href=x>a link</a>
inside it, and more words.</p><div>Another block &amp; entity &lt;b&gt; caf&eacute;</div><ul><li>One item<li>Two item</ul><p>Final&nbsp;paragraph of the text, long.</p>
<div class="comments"><p>Reader says hi and this is a long comment text by a reader of the page.</p></div></div>
<div class="sidebar"><p>Side words here</p></div></div><form><input name=a>Search</form><footer>(c) me</footer><script>var t="</p>";</script></body></html>"""


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""), ("", ""), ("<html><body></body></html>", ""), ("plain text", "plain text"), ("<p>un<b>cl", "uncl"), ('<a title="x>y <p>z', "y z"),
        (PAGE, "Head Some long paragraph text with a link inside it, and more words. Another block & entity <b> café One item Two item Final paragraph of the text, long."),
        ("<body><nav><a>m</a></nav><article><h1>T</h1><p>a<br>b</p><aside>no</aside><p>c <i>d</i>e</p></article><footer>f</footer>", "T a b c de"),
        ("<body><!-- ad --><p>a</p><!-- open", "a"),
    ],
)
def test_main_text(page, want):
    assert htmltext.main_text(page) == want


LONG = "A long paragraph of the main text that goes on for quite some words. " * 4
TEXT = " ".join(LONG.split())


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f'<body><div style="overflow:hidden"><article><p>{LONG}</article></div>', TEXT),
        (f'<body><div aria-hidden="false"><article><p>{LONG}</article></div>', TEXT),
        (f"<body><div data-note='is hidden class=ad'><article><p>{LONG}</article></div>", TEXT),
        (f'<body><article><p>{LONG}<p aria-hidden="true">no<p hidden>no<p style="display: none">no</article>', TEXT),
        (f'<body><article><p>{LONG}<p><a href="/w?id=search">link</a> end</article>', f"{TEXT} link end"),
        (f'<body><div class="layout has-sidebar"><article><p>{LONG}</article><div class="left-sidebar">no</div></div>', TEXT),
        (f'<body><article><h2 id="search-algorithms">A</h2><h2 id="search">B</h2><section id="related-work"><p>{LONG}</section></article>', f"A B {TEXT}"),
        (f'<body><div class="sidebar"><article><p>{LONG}</article></div><p>x</p>', TEXT),
        (f'<body><div class="widget"><main><p>{LONG}</main></div><p>x</p>', TEXT),
        (f"<body><form id=page><p>{LONG}</p><p>{LONG}</p><div class=site-footer>no</div></form>", f"{TEXT} {TEXT}"),
        (f'<body><article><p>{LONG}</article><div class="comments"><article><p>{LONG * 3}</article></div><div class="related-posts"><p>{LONG * 3}</div>', TEXT),
        (f"<body><article><p>Short.</article><footer>{LONG}</footer>", "Short."),
    ],
)
def test_marks_leave_the_main_text(page, want):
    assert htmltext.main_text(page) == want


def paragraphs(name, n):
    return [f"{name} paragraph {i} {TEXT}" for i in range(n)]


def html_of(texts):
    return "".join(f"<p>{t}</p>" for t in texts)


FIRST, SECOND = paragraphs("One", 3), paragraphs("Two", 5)
BOTH = " ".join(["Head", *FIRST, "Sub", *SECOND])
LINKS = "<ul>" + "<li><a href=/x>Some linked words of a list</a>" * 6 + "</ul>"


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f"<body><div id=content><h1>Head</h1><div>{html_of(FIRST)}</div><div><h2>Sub</h2>{html_of(SECOND)}</div></div>", BOTH),
        (f"<body>{LINKS}<div id=content><h1>Head</h1><div>{html_of(FIRST)}</div><h2>Sub</h2><div>{html_of(SECOND)}</div></div>{LINKS}<footer>f</footer>", BOTH),
        (f"<body>{LINKS}<h1>Head</h1><section>{html_of(FIRST)}</section>{LINKS}<h2>Sub</h2><section>{html_of(SECOND)}</section>{LINKS}", BOTH),
        (f"<body><div><div><h1>Head</h1><div>{html_of(FIRST)}</div></div><div class=ad>{LONG}</div></div><div><div>Sub {html_of(SECOND)}</div></div>", BOTH),
        (f"<body><div id=c><div class=s><p>Short one.</div><div class=s>{html_of(FIRST * 4)}</div></div><div id=r><p>Beside.</div>", " ".join(["Short one.", *FIRST * 4])),
        (f"<body><div id=c><section id=a><p>Short one.</section><section id=b>{html_of(FIRST * 4)}</section></div>", " ".join(["Short one.", *FIRST * 4])),
        (f"<body>{LINKS}<article><h1>Head</h1>{html_of(FIRST)}</article><div>{LINKS}</div><article><h2>Sub</h2>{html_of(SECOND)}</article>", BOTH),
        (f"<body><div><p>{TEXT}</p></div><div>{html_of(FIRST)}</div><div>{html_of(SECOND)}</div><div>(c) me</div>", " ".join([*FIRST, *SECOND])),
    ],
)
def test_main_text_of_sectioned_pages(page, want):
    assert htmltext.main_text(page) == want


def slow_walk(text):
    """The edit embedding, one step at a time."""
    stay, chars, j, path = editembed._stay(), editembed.classes(text), 0, []
    for c in chars.tolist():
        path.append(j)
        j += int(stay[c * editembed.PERIOD + (j % editembed.PERIOD)])
    return path + [j]


def test_walks_and_fingerprints():
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdé \n") for _ in range(n)) for n in (0, 1, 5, 300, 3000, 700)]
    for t, p in zip(texts, editembed.walk([editembed.classes(t) for t in texts], np.zeros(len(texts), np.int64)), strict=True):
        assert p.tolist() == slow_walk(t)
    a, b = editembed.fingerprints([texts[4], texts[4][:1500] + "!" + texts[4][1500:]])
    c, e = editembed.fingerprints([texts[5], ""])
    assert editembed.likeness(a, a) == 1 and editembed.likeness(a, b) > 0.8 > 0.6 > editembed.likeness(a, c)
    assert editembed.likeness(e, e) == 1 and editembed.likeness(e, a) == 0
    assert 128 <= len(a[1]) <= 300
    rows = editembed._report([(i, t) for i, t in enumerate(texts)], texts[0])
    for i, t in enumerate(texts):
        h = len(t) // 2
        after = texts[(i + 1) % len(texts)]
        edited = t[: len(t) - h] + after[:h]
        p, q, r = editembed.fingerprints([t, edited, after])
        assert rows[i][1] == len(t) and rows[i][3] == editembed.to_text(*p) and rows[i][4] == editembed.to_text(*q)
        assert rows[i][5] == editembed.likeness(p, q) and rows[i][6] == editembed.likeness(p, r)


def test_quality_features_are_distinct_and_model_learns():
    good = ["the cat sat on mat number %d today" % i for i in range(60)]
    bad = ["THE!! CAT!! SAT!! %d ###" % i for i in range(60)]
    rows = nbsvm.features(pa.array(good + bad + ["", None]))
    assert all(len(set(r.tolist())) == len(r) for r in rows) and len(rows[-1]) == len(rows[-2]) == 0
    y = np.array([1] * 60 + [0] * 60)
    m = nbsvm.QualityModel(rows[:120], y, np.arange(120) % 5, 1.0)
    s = m.scores(pa.array(["the cat sat on mat number 99 today", "THE!! DOG!! ###", "", None]))
    assert s[0] > 0.5 > s[1] and s[2] == s[3] and ((s >= 0) & (s <= 1)).all()
    assert nbsvm.QualityModel([], np.zeros(0, int), np.zeros(0, int), 1.0).scores(pa.array(["a"])).tolist() == [0.5]


def test_pooling_equals_plain_convolution():
    net = toxcnn.TextCNN(3)
    rng = np.random.default_rng(0)
    net.vec = np.concatenate((np.zeros((1, toxcnn.DIM)), rng.normal(size=(20, toxcnn.DIM)))).astype(np.float32)
    sizes = [0, 1, 2, 7, 30]
    rows = rng.integers(0, 21, sum(sizes))
    w = np.concatenate(([0], np.cumsum(sizes)))
    best, arg = net._pool(net._taps(), rows, w, where=True)
    for r in range(len(sizes)):
        x = np.concatenate((net.vec[rows[w[r] : w[r + 1]]], np.zeros((2, toxcnn.DIM), np.float32)))
        for c, k in enumerate(toxcnn.WIDTHS):
            for f in range(toxcnn.FILTERS):
                v = [sum(net.filt[k][t][f] @ x[i + t] for t in range(k)) + net.bias[k][f] for i in range(sizes[r])]
                assert best[r, c * toxcnn.FILTERS + f] == pytest.approx(max([0, *v]), abs=1e-4)
                if v and max(v) > 0:
                    assert arg[r, c * toxcnn.FILTERS + f] == w[r] + int(np.argmax(v))


UNCLOSED = {
    "start tags": "<a " * 350_000, "declarations": "<!" * 500_000, "brackets": "<" * 1_000_000, "brackets before a comment": "<" * 1_000_000 + "<!--", "quotes": "<a \"' >" * 150_000,
    "odd quotes": "<a x=\"y' " * 100_000 + ">", "nesting": "<div>" * 100_000 + "</b>" * 200_000, "own elements": "<x-y>t " * 130_000, "stray ends": "<b><div>" + "<i>" * 150_000 + "</b>" * 150_000,
    "raw ends": "<svg></svg " * 90_000, "comments": "<!--" * 250_000, "list": "<ul>" + "<li>x" * 200_000, "table": "<table>" + "<tr><td>x" * 100_000, "end tags": "</a " * 250_000,
    "classes": "<body><div>" + "".join(f"<div class=c{i}>some words here</div>" for i in range(30_000)) + "</div>", "comb": "<body>" + "<div><p>some words are here and more</p>" * 30_000,
}


@pytest.mark.parametrize("kind", sorted(UNCLOSED))
def test_time_grows_with_the_page_alone(kind):
    """A megabyte of what never closes: seconds at most, where a second look at the rest of the page for every tag takes hours."""
    import time

    start = time.process_time()
    htmltext.main_text(UNCLOSED[kind])
    assert time.process_time() - start < 5


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<p>one <a <b>two</b>", "one two"), ("<p>one <a href=\"x>two", "one two"), ("<p title='a>b'>one", "one"), ("<p>a < b <!-- c > d", "a < b"), ("<p>x<!--", "x"),
        ("<p>x<!-->y", "x"), ("<!doctype html><?pi?><p>x", "x"), ("<a \"'>t<a '\">u", "u"), ("<script>x</script y>z", "z"), ("<title>x</title", ""), ("<p>1 <2 <b>3", "1 <2 3"),
        ("<b><div>x</b>y</div>", "xy"), ("<table><tr><td>a<td>b<tr><td>c</table>d", "a b c d"), ("<ul><li>a<ul><li>b</ul><li>c</ul>", "a b c"), ("<p>a<div>b<p>c</div>d", "a b c d"),
    ],
)
def test_unclosed_and_crossed_elements(page, want):
    assert htmltext.main_text(page) == want


def test_dual_descent_against_a_plain_solver():
    """The hinge-loss model against many sweeps over dense rows in plain order: same margins, no duality gap to speak of."""
    rng = np.random.default_rng(2)
    good, bad = ([" ".join(rng.choice([f"{c}{k}" for k in range(40)] + ["the", "of"], 25)) for _ in range(40)] for c in "ab")
    rows = [np.sort(r) for r in nbsvm.features(pa.array(good + bad[:25]))]
    y = np.array([1] * 40 + [0] * 25)
    model = nbsvm.QualityModel(rows, y, np.ones(65, int), 1.0)
    count = [np.bincount(np.concatenate([r for r, c in zip(rows, y) if c == k]), minlength=nbsvm.SLOTS) + nbsvm.ALPHA for k in (0, 1)]
    ratio = np.log(count[1] / count[1].sum()) - np.log(count[0] / count[0].sum())
    used = np.unique(np.concatenate(rows))
    x = np.zeros((65, len(used) + 1))
    for i, r in enumerate(rows):
        x[i, np.searchsorted(used, r)] = ratio[r] / np.sqrt((ratio[r] ** 2).sum())
    x[:, -1] = 1
    sign, cost = np.where(y == 1, 1.0, -1.0), nbsvm.COST * 65 * np.where(y == 1, 0.5 / 40, 0.5 / 25)
    dual = np.zeros(65)
    for _ in range(400):
        for i in range(65):
            w = (dual * sign) @ x
            dual[i] = min(max(dual[i] - (sign[i] * (x[i] @ w) - 1) / (x[i] @ x[i]), 0), cost[i])
    w = (dual * sign) @ x
    primal = 0.5 * w @ w + (cost * np.maximum(0, 1 - sign * (x @ w))).sum()
    assert primal - (dual.sum() - 0.5 * w @ w) < 1e-3 * primal
    margins = np.array([model.margin(r) for r in rows])
    assert np.abs(margins - x @ w).max() < 0.02
    found = 0.5 * ((model.weight[used] / np.where(ratio[used] == 0, 1, ratio[used])) ** 2).sum() + 0.5 * model.intercept**2 + (cost * np.maximum(0, 1 - sign * margins)).sum()
    assert found < 1.05 * primal


def test_language_models_against_plain_kneser_ney():
    """Probabilities of seen and unseen grams against the recursion written out over dictionaries."""
    texts = {"aa": ["the cat sat on the mat", "a hat that the rat had"], "bb": ["der hund und die katze", "das haus und der garten"], "cc": ["x"]}
    tables = []
    for lang, ts in texts.items():
        k, n = np.unique(langid.symbols(pa.array(ts))[0], return_counts=True)
        tables.append(pa.table({"lang": [lang] * len(k), "key": pa.array(k.astype(np.int32)), "n": pa.array(n.astype(np.int64))}))
    model = langid.LanguageModels(pa.concat_tables(tables))

    def gram(key, order):
        return tuple(key >> langid.BITS * b & (langid.SYMBOLS - 1) for b in range(order - 1, -1, -1))

    rng = random.Random(1)
    for j, (lang, table) in enumerate(zip(sorted(texts), tables)):
        level = {langid.ORDER: {gram(k, langid.ORDER): n for k, n in zip(table.column("key").to_pylist(), table.column("n").to_pylist())}}
        for order in range(langid.ORDER - 1, 0, -1):
            left = {}
            for g in level[order + 1]:
                left.setdefault(g[1:], set()).add(g[0])
            level[order] = {g: len(x) for g, x in left.items()}
        discount = {}
        for order, counts in level.items():
            ones, twos = (sum(c == v for c in counts.values()) for v in (1, 2))
            discount[order] = min(max(ones / max(1, ones + 2 * twos), 0.1), 0.9)

        def p(g):
            if not g:
                return 1 / langid.SYMBOLS
            counts, d = level[len(g)], discount[len(g)]
            ctx = [c for x, c in counts.items() if x[:-1] == g[:-1]]
            if not ctx:
                return p(g[1:])
            return max(counts.get(g, 0) - d, 0) / sum(ctx) + d * len(ctx) / sum(ctx) * p(g[1:])

        keys = [int(k) for t in tables for k in rng.sample(t.column("key").to_pylist(), min(12, t.num_rows))] + [rng.randrange(1 << 24) for _ in range(20)]
        got = model._missing(np.array(keys, np.int64), langid.ORDER)[:, j]
        assert np.allclose(got, [math.log(p(gram(k, langid.ORDER))) for k in keys], atol=1e-4), lang
        ctx = next(iter(level[langid.ORDER]))[:-1]
        assert sum(p((*ctx, x)) for x in range(langid.SYMBOLS)) == pytest.approx(1)


def test_network_steps_follow_the_gradient():
    """One training step on one batch, undone to its gradient, against differences of the loss."""
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 30, rng.integers(3, 12)).astype(np.int32) for _ in range(16)]
    labels = np.array([0, 1] * 8)
    base, stepped = toxcnn.TextCNN(3), toxcnn.TextCNN(3)
    base.fit(texts, labels, epochs=0, batch=100)
    stepped.fit(texts, labels, epochs=1, rate=1e-3, batch=100)
    w = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    rows = base.rows_of(np.concatenate(texts))

    def loss():
        z = base.logits(rows, w).astype(np.float64)
        fit = np.log1p(np.exp(-np.where(labels == 1, z, -z))).mean()
        return fit + 0.5e-4 * (float((base.out.astype(np.float64) ** 2).sum()) + sum(float((f.astype(np.float64) ** 2).sum()) for f in base.filt.values()))

    checked = 0
    for name, old, new in [("out", base.out, stepped.out), ("vec", base.vec, stepped.vec), *[(f"filter {k}", base.filt[k], stepped.filt[k]) for k in toxcnn.WIDTHS],
                           *[(f"bias {k}", base.bias[k], stepped.bias[k]) for k in toxcnn.WIDTHS]]:
        ratio = -(new.astype(np.float64) - old) / 1e-3
        gradient = 0.1 * ratio / np.sqrt(np.maximum(1 - ratio**2, 1e-9))  # AdaGrad starts from 1e-2
        largest = np.argsort(-np.abs(gradient).ravel())[:6]
        for at in largest.tolist():
            flat, keep = old.reshape(-1), old.reshape(-1)[at]
            if name == "vec" and at < toxcnn.DIM:
                continue  # row 0 stays zero
            h = np.float32(2e-3)
            flat[at] = keep + h
            up = loss()
            flat[at] = keep - h
            down = loss()
            flat[at] = keep
            slope = (up - down) / (2 * float(h))
            assert gradient.reshape(-1)[at] == pytest.approx(slope, rel=0.1, abs=2e-3), (name, at)
            checked += 1
    assert checked > 30


def test_likeness_needs_no_walk_before(monkeypatch):
    """A worker that only compares fingerprints has no tables yet."""
    a, b = editembed.fingerprints(["x" * 63 + "abcdefgh" * 60, "y" + "x" * 63 + "abcdefgh" * 70])
    want, keys = editembed.likeness(a, b), editembed.band_keys(543, *a).tolist()
    monkeypatch.setattr(editembed, "_STEPS", [])
    assert editembed.likeness(a, b) == want
    monkeypatch.setattr(editembed, "_STEPS", [])
    assert editembed.band_keys(543, *a).tolist() == keys
