"""BPE, toxicity, HTML, language model, licences and the pipeline."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from sensorflow.llm import bpe, html_text, licenses, maxent, toxicity

DIR = "/root/testdata/sf0.001"


def texts(spark, n=60):
    return [r.text for r in spark.read.parquet(f"{DIR}/documents.parquet").orderBy("doc_id").limit(n).collect()]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(bpe.default_path())


ODD = [None, "", "   ", "\n\t", "don't WE'LL 'S's I'd'd", "ΑΣ ΣΑΣ.", "a<|endoftext|>b <|ENDOFTEXT|> <|startoftext|><|endoftext|>",
       "<|end", " x\x85y\x1cz w", "1234½ 漢字 🤣🤣!!?? é Ǆ İstanbul", "\U0001E6D0 x ͸y", "ab" * 3000, "!?" * 2000, "\x00\x01a"]


def test_bpe_equals_the_library(spark, library):
    every = texts(spark) + ODD
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(every)], "doc_id bigint, text string, ids string")
    ids = {r.doc_id: list(r.ids) for r in bpe.encode(df, bpe.default_path()).collect()}
    back = {r.doc_id: r.decoded for r in bpe.decode(bpe.encode(df, bpe.default_path()), bpe.default_path()).collect()}
    short = {r.doc_id: r for r in bpe.digest(df, bpe.default_path()).collect()}
    for i, t in enumerate(every):
        want = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(want, skip_special_tokens=False)
        assert ids[i] == want and back[i] == decoded
        assert short[i].n_tokens == len(want)
        assert short[i].ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert short[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert bpe.digest(df.limit(0), bpe.default_path()).count() == 0


def test_bpe_speculation_agrees_with_exact_merging():
    with open(bpe.default_path(), "rb") as f:
        b = bpe.WordBpe(f.read())
    rnd = random.Random(1)
    words = ["".join(rnd.choice("abcdefghinorstéü'") for _ in range(rnd.randint(1, 14))) for _ in range(3000)]
    b.learn(words)
    assert all(b.words[w] == b.exact(w) for w in words)
    kept = sum(tuple(b.propose(b.spell(w))) == b.words[w] for w in words)
    assert 0 < kept < len(words)  # some proposals stand, some fail


def test_toxicity_on_the_held_out_fold(spark):
    d = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    got = toxicity.op7_toxicity(spark, d).collect()
    assert len(got) == spark.read.parquet(f"{d}/documents.parquet").count()
    test = [r for r in got if r.held_out and r.doc_id in labels]
    for r in got[:200]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5)
    hit = sum(r.predicted and labels[r.doc_id] for r in test)
    assert hit >= 0.9 * sum(labels[r.doc_id] for r in test)
    assert sum(r.predicted and not labels[r.doc_id] for r in test) <= 0.02 * len(test)


def test_toxicity_of_odd_rows(spark):
    rows = [(i, f"you idiot number {'abc'[i % 3]}" if i % 4 == 0 else "a fine day by the sea", "s", 1.0) for i in range(200)]
    rows += [(None, "you idiot", "s", 1.0), (500, None, "s", 1.0), (501, "", None, 1.0), (502, "sea " * 50_000, "s", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, score double")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)] + [(501, None), (None, 1), (7, 0)], "doc_id bigint, toxic int")
    m = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, m).collect()}
    assert len(got) == len(rows) and got[None].predicted == 1 and not got[None].held_out
    assert got[4].predicted == 1 and got[5].predicted == got[500].predicted == got[501].predicted == got[502].predicted == 0
    clean = toxicity.clean(docs, m)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {i for i, r in got.items() if not r.predicted}
    none = toxicity.train(docs, labels.limit(0))
    assert {r.predicted for r in toxicity.score(docs, none).collect()} == {0}
    assert toxicity.score(docs.limit(0), m).count() == 0


def test_score_of_many_texts_is_the_formula():
    """Bias, weights and all pairs of factors, term by term."""
    rng = np.random.default_rng(0)
    rnd = random.Random(4)
    vocabulary = [a + b + "ing" for a in "abcde" for b in "pqrstuvw"]
    at = np.unique([b for w in vocabulary[:30] for b in toxicity.buckets(w.encode())])
    m = toxicity.Machine(at, rng.normal(0, 1, len(at)), rng.normal(0, 0.5, (len(at), toxicity.FACTORS)), -0.3)
    every = ["", "unknown words"] + [" ".join(rnd.choices(vocabulary, k=rnd.randrange(1, 12))) for _ in range(300)]
    place = {b: i for i, b in enumerate(at.tolist())}
    got = m.score(iter(every))
    for text, p in zip(every, got):
        own = sorted({place[b] for w in set(text.split()) for b in toxicity.buckets(w.encode()) if b in place})
        raw = m.bias + sum(m.weight[i] for i in own)
        raw += sum(float(m.factor[i] @ m.factor[j]) for x, i in enumerate(own) for j in own[x + 1:])
        assert abs(p - 1 / (1 + math.exp(-raw))) < 1e-9


def test_fit_learns_a_pair_that_weights_cannot():
    """Label 1 if both of two terms occur or neither does; each alone tells nothing."""
    rng = np.random.default_rng(0)
    rows = [np.flatnonzero([1, a, b]).astype(np.int32) for a, b in rng.integers(0, 2, (20_000, 2))]
    label = np.array([int((1 in r) == (2 in r)) for r in rows])
    first = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    m = toxicity.fit(np.arange(3), np.concatenate(rows), first, label, np.ones(20_000))
    raw, _ = m.raw(np.array([0, 1, 2, 0, 1, 0, 2, 0]), np.array([0, 3, 5, 7]), 4, np.arange(4))
    assert raw[0] > max(raw[1], raw[2]) and raw[3] > max(raw[1], raw[2])


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1><nav><ul><li><a href=1>Home</a></li><li><a href=2>About us</a></li></ul></nav></header>
<div class="cookie-notice">We use cookies on this site, click to accept them all.</div>
<article><h1>Title &amp; more</h1><p>First   paragraph
says <b>something</b> with <a href=x>a link</a>&nbsp;inside it.<p>Short.<div class=ad>Buy it now, it is cheap.</div>
<ul><li>One point</li><li>Two</li></ul><p>Last one<br>here. <script>var t="</p>";</script></p>
<section id="comments"><h3>Comments</h3><div class="comment"><p>A really long comment by a reader of the page, yes.</p></div></section>
</article><aside><h2>Related</h2><p>Another story with a long teaser that goes on.</p></aside>
<form><label>Mail</label><input><button>Go</button></form><footer>&copy; us</footer></body></html>"""


def test_main_text_of_pages(spark):
    want = "Title & more\nFirst paragraph says something with a link inside it.\nShort.\nOne point\nTwo\nLast one here."
    assert html_text.main_text(PAGE) == want
    assert html_text.main_text("") == "" and html_text.main_text("<nav><a>x</a></nav>") == ""
    assert html_text.main_text("<div>" * 20_000 + "deep text" + "<p>x" * 3000) == "deep text" + "\nx" * 3000
    assert html_text.main_text("just a text &lt;b&gt;") == "just a text <b>"
    rows = [(1, "u", PAGE), (2, None, None), (3, "v", ""), (1, "u", PAGE), (4, "w", "<article><p>" + "word " * 100_000),
            (5, "z", "<p" + "<" * 1000)]
    df = spark.createDataFrame([(i, u, h, "c") for i, u, h in rows], "page_id bigint, url string, html string, text string")
    got = html_text.extract(df).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert by[1].text == want and by[1].n_chars == len(want) and by[2].text == by[3].text == "" and by[4].n_chars == 499_999
    assert html_text.extract(df.limit(0)).count() == 0


def test_pages_of_the_table_give_their_articles(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{DIR}/pages.parquet").collect()}
    import html as H
    for r in html_text.op2_html_extraction(spark, DIR).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        parts = [" ".join(H.unescape(re.sub(r"<[^>]*>", "", p.replace("<br>", " "))).split()) for p in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def brute_cut(gain, smooth):
    n = len(gain)
    best = None
    for m in range(1 << n):
        c = [m >> i & 1 for i in range(n)]
        cost = sum(max(g, 0) if not c[i] else max(-g, 0) for i, g in enumerate(gain)) + sum(w for (i, j), w in smooth.items() if c[i] != c[j])
        best = cost if best is None else min(best, cost)
    return best


def test_cuts_are_minimal():
    rnd = random.Random(2)
    for _ in range(200):
        n = rnd.randint(1, 9)
        gain = [rnd.randint(-20, 20) for _ in range(n)]
        smooth = {(i, j): rnd.randint(0, 15) for i in range(n) for j in range(i + 1, n) if rnd.random() < 0.5}
        c = html_text.minimum_cut(gain, smooth)
        cost = sum(max(g, 0) if not c[i] else max(-g, 0) for i, g in enumerate(gain)) + sum(w for (i, j), w in smooth.items() if c[i] != c[j])
        assert cost == brute_cut(gain, smooth)


def test_lm_base_scores_are_exact_and_the_model_is_better(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(90001, None), (90002, ""), (None, "the of the"), (90003, "qqq the qqq"), (90003, "qqq the qqq")],
                                "doc_id bigint, text string")
    rows = docs.union(odd)
    got = maxent.score(rows.selectExpr("*", "'x' AS word", "1 AS k1", "2 AS n")).collect()
    data = [(r.doc_id, (r.text or "").encode().lower().split()) for r in rows.collect()]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, ws in data if not held(i) for w in [*ws, None])
    n, v = sum(c.values()), len(c)
    by = {}
    for i, ws in data:
        by[i] = (held(i), len(ws) + 1, sum(w in c for w in ws) + 1, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in [*ws, None]))
    assert len(got) == len(data)
    model = base = 0.0
    for r in got:
        want = by[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (*want[:3], n)
        assert abs(r.base_score - want[3]) < 1e-6 * max(1, abs(want[3]))
        if r.held_out:
            model, base = model + r.score, base + r.base_score
    assert model > base and base < 0
    assert maxent.score(rows.limit(0)).count() == 0


def test_lm_tail_counts_arrive_by_the_join(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "a a b " + f"w{i % 7} x{i}") for i in range(60)] + [(100 + i, "a b w1 x3") for i in range(9)],
                                 "doc_id bigint, text string")
    want = {r.doc_id: r for r in maxent.score(docs).collect()}
    monkeypatch.setattr(maxent, "HEAD", 3)
    monkeypatch.setattr(maxent, "SINGLES", 1)
    got = {r.doc_id: r for r in maxent.score(docs).collect()}
    for i, r in want.items():
        assert got[i].n_known == r.n_known and abs(got[i].base_score - r.base_score) < 1e-9


def lm_model(bits_tokens=1 << 18, seed=0):
    rng = np.random.default_rng(seed)
    m = maxent.Model({}, 0, {b"the": 0, b"of": 1}, {b"ed": 31, b"ng": 32}, rng.integers(1, 90, maxent.LEAVES).astype(float), 5, bits_tokens, 9)
    m.weights = m.first_weights() + rng.normal(size=m.first_weights().shape).astype(np.float32)
    return m


def test_lm_probabilities_sum_to_one():
    m = lm_model()
    n = maxent.LEAVES
    every = np.arange(n, dtype=np.int64)
    alone = (every // maxent.WAYS < maxent.SINGLES) | (every // maxent.WAYS == maxent.END_CLASS)
    for words, classes in (((5, 9), (3, 40)), ((maxent.START_HASH, 77), (63, 31))):
        found = maxent.features(*[tuple(np.full(n, x, np.uint64) for x in pair) for pair in (words, classes)])
        p = np.exp(maxent.log_paths(m.weights, found, every, m.bits))
        # a single token or an end is its whole class: one of its eight paths counts
        assert abs(p[~alone | (every % maxent.WAYS == 0)].sum() - 1) < 1e-5


def test_lm_gradient_is_that_of_the_likelihood():
    m = lm_model()
    m.weights = m.weights.astype(np.float64)
    found, path, _ = maxent.encode([b"the cat moved of the walking cat".split(), [], b"cat cat".split()], maxent.Memo(m))
    g, n = np.zeros_like(m.weights), np.zeros(len(m.weights), np.int64)
    maxent.add_gradient(g, n, m.weights, found, path, m.bits)
    used = np.flatnonzero(n)
    assert len(used) > 20 and not g[n == 0].any()
    for row in used[::3]:
        for j in (0, 5):
            moved = []
            for by in (1e-5, -1e-5):
                w = m.weights.copy()
                w[row, j] += by
                moved.append(-maxent.log_paths(w, found, path, m.bits).sum())
            assert abs((moved[0] - moved[1]) / 2e-5 - g[row, j]) < 1e-5


def test_lm_scores_equal_a_plain_walk_over_the_tokens():
    """Every token on its own, in plain integers and floats, against the sparse batches."""
    m = lm_model()
    mask = (1 << 64) - 1

    def mix(x):
        x = (x ^ x >> 32) * 0x9E3779B97F4A7C15 & mask
        return x ^ x >> 29

    def word(w):
        path = maxent.END_CLASS * 8 if w is None else m.path_of(w)
        return (maxent.START_HASH if w is None else xxhash.xxh32_intdigest(w)), path

    def walk(words):
        total, (skip, far), (before, near) = 0.0, word(None), word(None)
        for h, path in [*map(word, words), word(None)]:
            c = path // 8
            found = [mix(before * 8 + 1), mix(mix(before * 8 + 2) + skip & mask), mix(skip * 8 + 3), mix((far // 8 * 64 + near // 8) * 8 + 4)]
            ways = [(0, c // 8, found), (1 + c // 8, c % 8, found)]
            if c >= maxent.SINGLES and c != maxent.END_CLASS:
                ways.append((9 + c, path % 8, found[:2]))
            for node, outcome, own in ways:
                x = m.weights[(1 << m.bits) + node].astype(float)
                for f in own:
                    x = x + m.weights[((f + mix(node + 1) & mask) * 0xBF58476D1CE4E5B9 & mask) >> 64 - m.bits]
                total += x[outcome] - math.log(sum(math.exp(v) for v in x))
            skip, far, before, near = before, near, h, path
        return total

    lines = [b"the cat moved of the walking cat", b"", b"of of of", b"\xc3\xa9t\xc3\xa9 zz"]
    found, path, index = maxent.encode([t.split() for t in lines], maxent.Memo(m))
    got = np.bincount(index, maxent.log_paths(m.weights, found, path, m.bits), len(lines))
    assert np.allclose(got, [walk(t.split()) for t in lines], atol=1e-4)


def test_lm_hears_word_order(spark):
    """Two words of one class change places: the text scores apart, and the order that was read scores higher."""
    docs = spark.createDataFrame([(i, "salt and zzpepper go " + "bread and zzbutter go " * 3) for i in range(300)], "doc_id bigint, text string")
    probe = [(1000 + i, t) for i, t in enumerate(["bread and zzbutter go", "zzbutter and bread go"])]
    got = {r.doc_id: r for r in maxent.score(docs.union(spark.createDataFrame(probe, docs.schema))).collect()}
    assert got[1000].base_score == pytest.approx(got[1001].base_score) and got[1000].score > got[1001].score + 0.1


def test_lm_takes_long_texts_and_counts_every_training_text(spark, monkeypatch):
    monkeypatch.setattr(maxent, "BLOCK_BYTES", 100)
    docs = spark.createDataFrame([(1, "word " * 50_000), (2, None), (3, "x" * 300_000), (None, "a b"), (None, "a b")], "doc_id bigint, text string")
    got = sorted((r.n_tokens, r.n_known) for r in maxent.score(docs).collect())
    assert [n for n, _ in got] == [1, 2, 3, 3, 50_001] and all(math.isfinite(r.score) for r in maxent.score(docs).collect())


def brute_licenses(files, threshold=licenses.THRESHOLD):
    words = lambda t: [w for w in re.split("[^a-z0-9]+", t.lower()) if w]
    bags = [Counter(words(t)) for _, t in licenses.TEMPLATES]
    df = Counter(w for b in bags for w in b)
    idf = lambda w: 1.0 if w in licenses.COMMON else math.log((1 + len(bags)) / (1 + df[w])) + 1
    norm = lambda b: math.sqrt(sum((n * idf(w)) ** 2 for w, n in b.items()))
    is_file = lambda p: bool(p and re.search(licenses.LICENSE_FILE, p))
    own = {}
    for f, _, path, text in files:
        units = (text or "").split("\n") + re.split(r"\n[ \t\r]*\n", text or "") + ([text or ""] if is_file(path) else [])
        best = None
        for u in units:
            b = Counter(words(u))
            for k, t in enumerate(bags):
                if b and (x := round(sum(n * t[w] * idf(w) ** 2 for w, n in b.items()) / norm(b) / norm(t), 9)) >= threshold:
                    best = max(best or (0, 0), (x, -k))
        own[f] = best
    folder = lambda p: (p or "").rpartition("/")[0]
    given = {}
    for f, repo, path, _ in files:
        if own[f] and is_file(path):
            key, cand = (repo or "", folder(path)), (-own[f][0], licenses.TEMPLATES[-own[f][1]][0])
            given[key] = min(given.get(key, cand), cand)
    out = {}
    for f, repo, path, _ in files:
        mine = licenses.TEMPLATES[-own[f][1]][0] if own[f] else None
        d, where, lic = folder(path), None, mine
        while mine is None:
            if (repo or "", d) in given:
                where, lic = d, given[repo or "", d][1]
                break
            if not d:
                break
            d = folder(d)
        out[f] = (mine, where, lic)
    return out


def test_licences_equal_brute_force(spark):
    mit = licenses.TEMPLATES[1][1]
    files = [(1, "r", "LICENSE", mit), (2, "r", "a/b/c.py", "x = 1"), (3, "r", "a/LICENSE.md", "Licensed under the Apache License, Version 2.0."),
             (4, "r", "a/b/d.py", "# Released under the MIT License.\ncode of the thing"), (5, "r", "z.py", None), (6, "q", "z.py", ""),
             (7, None, "COPYING", "This work is licensed under the GNU General Public License, version 3."), (8, None, "k/x", "of the and"),
             (9, "r", None, "text " * 20_000), (10, "r", "a/b/e/f/g.c", "the license of a work is public"), (11, "", "m/n", "a"),
             (12, "r", "a/b/NOTICE", "Licensed under CC BY-NC 4.0."), (13, "r", "a/b/e/h", " "), (14, "s", "deep/er/x", "y")]
    df = spark.createDataFrame([(*f, "x") for f in files], "file bigint, repo string, path string, content string, unit string")
    got = {r.file: (r.own_license, r.license_dir, r.license) for r in licenses.scan(df).collect()}
    assert got == brute_licenses(files)
    assert licenses.scan(df.limit(0)).count() == 0
    twice = licenses.scan(df.union(df.where("file = 4")))
    assert twice.where("file = 4 and license = 'MIT'").count() == 2


def test_licences_of_the_table(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    files = [(r.file, r.repo, r.path, r.content) for r in licenses.file_tree(docs).collect()]
    got = {r.doc_id: (r.own_license, r.license_dir, r.license) for r in licenses.op9_license_scan(spark, DIR).collect()}
    assert got == brute_licenses(files)


def test_pipeline_stages(spark):
    import corpus_pipeline as p
    from sensorflow.llm import exact_dedup, mixing, simhash
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    at = docs
    for k, (name, stage) in enumerate(p.STAGES):
        out = stage(spark, at, DIR)
        if k < len(p.STAGES) - 1:
            assert out.columns == docs.columns
        rows = out.collect()
        ids = Counter(r.doc_id for r in rows)
        if k == 0:
            bad = {r.doc_id for r in toxicity.op7_toxicity(spark, DIR).collect() if r.predicted}
            assert set(ids) == {r.doc_id for r in docs.collect()} - bad
        elif k == 1:
            assert set(ids) == {r.keep_id for r in exact_dedup.dedup(at).collect()}
        elif k == 2:
            assert set(ids) == {r.component_id for r in simhash.near_dedup(at).collect()}
        elif k == 3:
            plan, _ = mixing.mix(at, __import__("pyspark").sql.functions.array("source"))
            assert ids == Counter({r.doc_id: r.copies for r in plan.collect() if r.copies})
        else:
            assert ids == Counter(r.doc_id for r in at.collect())
        at = spark.createDataFrame(rows, out.schema)
    assert p.run(spark, DIR).count() == sum(ids.values())
    assert [n for n, _ in p.STAGES][0] == "toxicity" and p.ORACLE_SQL is None


def test_ids_and_classes_count_as_whole_names():
    long = "A paragraph of the article that goes on for a while and says what its heading has promised to the reader."
    ids = ["social-impact", "related-work", "privacy", "search-results", "reply-to-critics", "comments-on-method", "feedback"]
    page = "<article>" + "".join(f'<section id="{i}"><h2 id="{i}">On {i}</h2><p>{long}</p></section>' for i in ids)
    page += f'<p class="byline">By A. Writer</p><div class="footnotes"><p>{long}</p></div><div class="related-work"><p>{long}</p></div></article>'
    want = [x for i in ids for x in (f"On {i}", long)] + ["By A. Writer", long, long]
    assert html_text.main_text(page) == "\n".join(want)
    furniture = ["sidebar-left", "site-footer", "cookie-banner", "siteFooter", "related-posts", "share-buttons", "ad-728x90", "nav"]
    for name in furniture:
        assert html_text.main_text(f'<article><p>{long}</p></article><div class="x {name}"><p>{long}</p></div>') == long
        assert html_text.main_text(f'<article><p>{long}</p></article><div id="{name}"><p>{long}</p></div>') == long


@pytest.mark.parametrize("tag", ["button", "select", "object", "svg", "template", "noscript"])
def test_an_element_without_end_loses_no_article(tag):
    long = "A paragraph of the article that goes on for a while and says what its heading has promised to the reader."
    article = f"<article><h1>Title</h1><p>{long}</p><p>{long}</p></article>"
    for page in (f"<body><{tag}>Go{article}", f"<body><div><{tag} class=x>Go</div>{article}",
                 f"<body><{tag}>Go {article}<div><{tag}>Off</{tag}></div>"):
        got = html_text.main_text(page).split("\n")
        assert [x for x in got if x not in ("Go", "Off")] == ["Title", long, long] and "Off" not in got
    inside = f"<article><p>One <{tag}>x <b>y</b></{tag}>two {long}</p><p>{long}</p></article>"
    assert html_text.main_text(inside) == f"One two {long}\n{long}"
    assert html_text.main_text(f"<article><p>{long}</p><{tag}><div>Go</div><p>on</p></{tag}><p>{long}</p></article>") == f"{long}\n{long}"


def test_formulas_are_text():
    page = ("<article><p>So <math><semantics><mrow><mi>E</mi><mo>=</mo><mi>m</mi></mrow><annotation>E=m</annotation>"
            "</semantics></math> holds for bodies at rest, and nothing else is needed here.</p></article>")
    assert html_text.main_text(page) == "So E=m holds for bodies at rest, and nothing else is needed here."
    assert html_text.main_text("<article><p>As <math><mi>x</mi> is unended here.</p><p>More text.</p></article>") == "As x is unended here.\nMore text."


def test_training_learns_a_pair_whose_words_are_neutral_alone(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(3000):  # label 1 if both of a pair or neither occur, so that each alone says nothing
        a, b = rnd.random() < 0.5, rnd.random() < 0.5
        text = ["zorblat"] * a + ["quimper"] * b + [rnd.choice(["sun", "sea", "hill", "tree"]) for _ in range(4)]
        rnd.shuffle(text)
        rows.append((i, " ".join(text), int(a == b)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    m = toxicity.train(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    got = [r for r in toxicity.score(df.select("doc_id", "text"), m).collect() if r.held_out]
    assert len(got) > 400
    assert sum(r.predicted == rows[r.doc_id][2] for r in got) >= 0.95 * len(got)
