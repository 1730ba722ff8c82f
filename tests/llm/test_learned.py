"""The operators that run in Python workers: against libraries, brute force, round trips and held-out labels."""

import hashlib
import random
import re
import subprocess
import sys
import time
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from gridwarden.llm import bpe, gru, html_main, language, ngram_join, queries, toxicity
from gridwarden.llm.common import pieces, table
from gridwarden.llm.components import connected_components
from gridwarden.llm.hashing import WordHasher

SF_DIR = "/root/testdata/sf0.001"
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingle_set(text):
    own = words(text)
    n = min(5, len(own))
    return {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own else set()


def brute_classes(texts):
    """Class and links of each text by comparing all that share a shingle."""
    sets, holders = [shingle_set(t) for t in texts], defaultdict(list)
    for i, own in enumerate(sets):
        for shingle in own:
            holders[shingle].append(i)
    root, links = list(range(len(texts))), Counter()

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, own in enumerate(sets):
        common = Counter(j for shingle in own for j in holders[shingle] if j > i)
        for j, n in common.items():
            if n >= 0.8 * (len(own) + len(sets[j]) - n):
                links[i] += 1
                links[j] += 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(texts))], [links[i] for i in range(len(texts))]


# --- BPE ------------------------------------------------------------------------------------


def test_bpe_equals_the_library():
    library, own = Tokenizer.from_file(WORD_BPE), bpe.load_vocabulary(WORD_BPE)
    make = random.Random(4)
    alphabet = "abcdefghijk stlrevmd'''  \n\t0123!?.,-éÉΣσς́ßİ日本語\U0001f600‍\x1c\x85"
    texts = ["", "It's a TEST", "ΑΣ ΑΣ.", "a<|endoftext|>b<|startoftext|>", "x" * 5000]
    texts += ["".join(make.choice(alphabet) for _ in range(make.randrange(80))) for _ in range(400)]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert bpe.encode(text, own).tolist() == ids, text
        assert bpe.decode(np.array(ids, np.int64), own) == library.decode(ids, skip_special_tokens=False)


def test_bpe_long_text_in_slabs(monkeypatch):
    own, text = bpe.load_vocabulary(WORD_BPE), "some words, that repeat " * 500
    whole = bpe.encode(text, own).tolist()
    monkeypatch.setattr(bpe, "BATCH_CHARS", 100)
    monkeypatch.setattr(bpe, "SLAB_WORDS", 7)
    monkeypatch.setattr(bpe, "CACHED_WORDS", 2)
    assert bpe.encode(text, own).tolist() == whole


def test_bpe_rows(spark):
    docs = spark.createDataFrame([(1, "hi there", 5), (None, None, 6), (2, "", 7), (1, "hi there", 5)], "doc_id long, text string, ids long")
    out = bpe.with_tokens(docs, WORD_BPE, decoded=True)
    rows = sorted(out.collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    assert [len(r.ids) for r in rows] == [2, 2, 0, 0] and rows[0].decoded == "hi</w> there</w>" and rows[3].decoded == ""
    assert bpe.with_tokens(docs.limit(0), WORD_BPE).count() == 0


# --- Near duplicates --------------------------------------------------------------------------


def test_bands_reach_the_recall():
    bands, rows = ngram_join.bands_and_rows(0.8, 0.999, 128)
    assert bands * rows <= 128 and 1 - (1 - 0.8**rows) ** bands >= 0.999


def test_word_hashes_agree_however_texts_are_cut():
    texts = ["One, two; THREE", "", None, "é" * 50, "one two three", " ".join(f"w{i}" for i in range(3000))]
    hasher = WordHasher()
    found = list(hasher.texts(texts))
    assert [len(f) for f in found] == [len(words(t)) for t in texts]
    assert found[0].tolist() == found[4].tolist() and len(set(found[5].tolist())) == 3000
    assert hasher.long_text(texts[5].encode()).tolist() == found[5].tolist()


def varied(make, base, changes):
    own = base.split()
    for _ in range(changes):
        own[make.randrange(len(own))] = f"n{make.randrange(10**6)}"
    return " ".join(own)


@pytest.mark.parametrize("block", [1024, 7])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_TEXTS", block)
    make = random.Random(2)
    texts = []
    for group in range(6):
        base = " ".join(f"g{group}w{make.randrange(300)}" for _ in range(150))
        texts += [varied(make, base, make.randrange(4)) for _ in range(make.choice([1, 2, 40]))]
    texts += [texts[0], texts[0].upper() + "!", "one two", "one two", "one two three"]
    make.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    classes, links = brute_classes(texts)
    found = ngram_join.near_duplicates(docs).collect()
    named = defaultdict(list)
    for row in found:
        named[bytes(row["class"])].append(row.doc_id)
    mine = {i: min(ids) for ids in named.values() for i in ids}
    assert [mine[i] for i in range(len(texts))] == classes
    assert {r.doc_id: r.n_links for r in found} == dict(enumerate(links))
    kept = ngram_join.one_of_each(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(classes))


def test_near_duplicate_edges(spark):
    rows = [(1, None, 1, 1), (2, "", 1, 1), (3, "...", 1, 1), (4, "a b", 1, 1), (4, "a b", 1, 1), (None, "a b", 1, 1), (5, "A, b", 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, goes__x long, times long")
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert len(found) == 4 and {(1, None), (2, ""), (3, "...")} < set(found)
    assert ngram_join.one_of_each(docs.limit(0)).count() == 0
    result = ngram_join.near_duplicates(docs).where("doc_id <= 3").collect()
    assert all(r["class"] is None and r.n_links == 0 for r in result)


def test_components(spark):
    make = random.Random(3)
    pairs = [(make.randrange(200), make.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 360)] + [(7, 7)]
    root = {n: n for pair in pairs for n in pair}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {n: find(n) for n in root if find(n) != n}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- Toxicity -----------------------------------------------------------------------------------


def test_gradients_are_those_of_the_loss():
    hasher, make = WordHasher(), np.random.default_rng(0)
    found = gru.Words([b"some words of a text here", b"other words"], hasher)
    net = gru.Network(found.hashes[:4])
    for name in net.p:
        net.p[name] = net.p[name].astype(np.float64)
    vectors = make.normal(size=(len(found.hashes), gru.WORD_DIM + gru.CHAR_DIM))
    index, mask = make.integers(0, len(vectors), (5, 2)), np.array([[1, 1], [1, 1], [1, 0], [1, 0], [1, 0]], bool)
    target, weight = np.array([1.0, 0.0]), np.array([1.0, 2.0])

    def loss():
        rows = {s: (vectors @ net.p[f"x{s}"] + net.p[f"c{s}"])[index] for s in "fb"}
        states = np.concatenate([net.scan(s, rows[s], mask, False)[0] for s in "fb"], axis=2)
        z = net.pooled(states, mask)[0]
        return (weight * (np.logaddexp(0, z) - target * z)).sum() / weight.sum()

    grads, dv = net.gradients(vectors, index, mask, target, weight)
    for name in ("v", "w", "c", "xf", "uf", "cf", "xb", "ub", "cb"):
        flat, at = net.p[name].reshape(-1), make.integers(net.p[name].size)
        before = flat[at]
        flat[at] = before + 1e-4
        up = loss()
        flat[at] = before - 1e-4
        down = loss()
        flat[at] = before
        assert abs((up - down) / 2e-4 - np.asarray(grads[name]).reshape(-1)[at]) < 2e-3, name
    before = vectors[index[0, 0], 0]
    vectors[index[0, 0], 0] = before + 1e-4
    up = loss()
    vectors[index[0, 0], 0] = before - 1e-4
    assert abs((up - loss()) / 2e-4 - dv[index[0, 0], 0]) < 2e-3


def test_all_windows_are_scored():
    begin, text = gru.windows_of(np.array([0, 5, 5, 5 + 33, 38 + 100]))
    assert text.tolist() == [0, 2, 2, 3, 3, 3, 3, 3, 3]
    assert begin.tolist() == [0, 5, 21, 38, 54, 70, 86, 102, 118]


def test_words_in_groups_are_the_same():
    make = random.Random(1)
    texts = [" ".join(make.choice(["ab", "été", "x1", "Q"]) + str(make.randrange(50)) for _ in range(make.randrange(40))).encode() for _ in range(200)]
    one, many = gru.Words(texts, WordHasher()), gru.Words.of_many(texts, WordHasher(), size=500)
    assert all(np.array_equal(getattr(one, name), getattr(many, name)) for name in vars(one))


@pytest.fixture(scope="module")
def toxic_model():
    make = random.Random(1)
    common = ["".join(make.choice("aeioulnrst") for _ in range(make.randint(2, 8))) for _ in range(400)]
    bad = ["zxqword", "kvjterm", "qqxslur"]

    def text(toxic):
        own = [make.choice(common) for _ in range(make.randint(10, 200))]
        for _ in range(max(2, len(own) // 25) if toxic else 0):
            own.insert(make.randrange(len(own)), make.choice(bad) + make.choice(["", "a", "en"]))
        return " ".join(own)

    toxic = np.array([i % 2 for i in range(600)], np.float32)
    patched = pytest.MonkeyPatch()
    patched.setattr(toxicity, "FIRST_STEPS", 60)
    patched.setattr(toxicity, "ROUNDS", ((60, 0.006),))
    model = toxicity.Model([text(t) for t in toxic], toxic, 0.2)
    patched.undo()
    return model, text


def test_toxicity_learns_and_handles_odd_texts(toxic_model, monkeypatch):
    model, text = toxic_model
    fresh = [text(i % 2) for i in range(100)]
    scores = model.scores(fresh, WordHasher())
    assert ((scores >= 0.3) == np.array([i % 2 for i in range(100)], bool)).mean() > 0.95
    odd = model.scores([None, "", "...", fresh[1], fresh[1]], WordHasher())
    assert (odd[:3] < 0.3).all() and odd[0] == odd[1] and odd[3] == odd[4]
    long = " ".join(fresh[::2])
    monkeypatch.setattr(toxicity, "BATCH_BYTES", 2000)
    assert model.scores([long + " " + " ".join(fresh[1::2])], WordHasher())[0] > model.scores([long], WordHasher())[0]
    again = toxicity.Model.of_plain(model.plain())
    assert again.scores(fresh[:5], WordHasher()).tolist() == model.scores(fresh[:5], WordHasher()).tolist()


def test_toxicity_query(spark):
    rows = queries.queries()["op1_toxicity"](spark, SF_DIR).collect()
    docs = table(spark, SF_DIR, "documents").count()
    assert len(rows) == docs
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a", 3.0), (None, None, 4.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert sorted(r.score for r in toxicity.with_scores(docs, labels).collect()) == [0, 0]
    kept = toxicity.clean_documents(docs, labels)
    assert sorted(r.score for r in kept.collect()) == [3.0, 4.0]
    assert toxicity.clean_documents(docs.limit(0), labels).count() == 0


# --- Language -------------------------------------------------------------------------------------


def test_language_fuses_evidence(spark):
    docs = spark.createDataFrame(
        [(i, "the of and thing with" if i % 2 else "der die das und nicht", "en" if i % 2 else "de", "s") for i in range(40)]
        + [(98, None, "en", None), (99, "", None, "s")],
        "doc_id long, text string, lang string, source string",
    )
    pages = spark.createDataFrame(
        [(i, "http://a.b.de/x", "<html lang='DE'><p>der die das</p></html>") for i in range(30)]
        + [(100, "http://a.b.de/y", "<p></p>"), (101, None, None), (102, "no address", "<html lang=xx>the of and thing with the of and thing with")],
        "page_id long, url string, html string",
    )
    found = language.identify(language.items_of(docs, pages), *language.fitted(docs)).collect()
    assert len(found) == 42 + 33
    by_page, by_doc = {r.page_id: r for r in found if r.kind == "page"}, {r.doc_id: r for r in found if r.kind == "document"}
    assert all(by_doc[i].language == ("en" if i % 2 else "de") for i in range(40))
    assert by_page[100].language == "de" and by_page[100].text_language is None  # by its host alone
    assert by_page[102].language == "en" and by_page[102].declared == "other"
    assert 0 < by_page[101].probability <= 1
    none = language.identify(language.items_of(docs.limit(0), pages), *language.fitted(docs.limit(0))).collect()
    assert len(none) == 33 and all(r.language is None for r in none)


def test_every_language_is_learned(spark):
    make = random.Random(6)
    names = [f"l{i:02}" for i in range(80)]
    own = {name: ["".join(make.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(12)] for name in names}
    text = lambda name: " ".join(make.choice(own[name]) for _ in range(40))
    rows = [(80 * i + k, text(name), name, None) for i in range(4) for k, name in enumerate(names)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    pages = [(k, None, f"<html lang='l'><p>{text(name)}</p></html>") for k, name in enumerate(names)]
    pages = spark.createDataFrame(pages, "page_id long, url string, html string")
    languages, table_of = language.fitted(docs)
    assert languages == names and table_of.shape == (language.BUCKETS, 80)
    seen = sum(language.trigram_counts(r[1]) for r in rows if r[2] == "l79") + 0.5
    assert np.array_equal(table_of[:, 79], np.log(seen / seen.sum()).astype(np.float32))
    found = language.identify(language.items_of(docs, pages), languages, table_of).collect()
    assert len(found) == 400
    assert all(r.language == names[(r.page_id if r.doc_id is None else r.doc_id) % 80] for r in found)


def test_language_query_knows_the_documents(spark):
    rows = queries.queries()["op2_language_id"](spark, SF_DIR).where("doc_id is not null").collect()
    truth = {r.doc_id: r.lang for r in table(spark, SF_DIR, "documents").collect()}
    assert len(rows) == len(truth)
    assert sum(r.language == truth[r.doc_id] for r in rows) > 0.95 * len(rows)


# --- HTML -----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def all_trees():
    """As the query trains them."""
    return html_main.trained()


@pytest.fixture(scope="module")
def trees():
    return html_main.trained(pages=500)


def test_main_text_of_unseen_pages(trees):
    make, wrong = random.Random(77), 0
    for _ in range(100):
        html = html_main.composed_page(make)
        page = html_main.Page(html)
        wrong += html_main.main_texts([html], trees)[0] != html_main.text_of(page, np.array(page.label) == 1)
    assert wrong <= 10


def test_decoding_keeps_nothing_below_what_it_drops():
    page = html_main.Page("<div><section><p>a</p><p>b</p></section></div>")
    kept = html_main.kept_blocks(page, np.array([0.1, -5.0, 1.0, 2.0, 1.0]))
    assert kept.tolist() == [True, False, False, False, False]
    kept = html_main.kept_blocks(page, np.array([0.1, -3.0, 1.0, 2.0, 1.0]))
    assert kept.tolist() == [True] * 5


def test_html_edges(trees):
    body = "<p>A &amp; B&nbsp;c&lt;d&gt;\n  e<br>f <b>bold</b></p><p>" + "word " * 60 + "<p>" + "more text, here. " * 30 + "&am"
    html = f"<html><head><title>t</title><script>var a='<p>x</p>'</script></head><body><nav><ul><li><a href=/>Home</a></ul></nav><article><h1>Title</h1>{body}"
    text = html_main.main_texts([html], trees)[0]
    assert text.split("\n\n")[:2] == ["Title", "A & B c<d> e f bold"] and text.endswith("here. &am") and "Home" not in text
    assert html_main.main_texts([None, "", "</p></div>", "<script>x"], trees) == [""] * 4
    deep = "<div>" * 3000 + "x"
    assert isinstance(html_main.main_texts([deep], trees)[0], str)
    assert html_main.main_texts([], trees) == []


def test_heads_drawings_and_formulas_without_end_tags(trees):
    prose = "more text, here. " * 30
    article = f"<article><h1>Title</h1><p>{prose}</p></article>"
    plain = html_main.main_texts([f"<html><head><title>t</title></head><body>{article}</body></html>"], trees)
    heads = ["<head><title>t</title><body>", "<head><meta charset=utf-8><title>t</title>", "<head><noscript><link href=x><body>"]
    assert html_main.main_texts([f"<html>{head}{article}" for head in heads], trees) == plain * 3 and plain[0]

    def every(html):
        page = html_main.Page(html)
        return html_main.text_of(page, np.ones(len(page.tags), bool))

    assert every("<head><title>t</title> seen") == "seen"
    assert every('<p>a <svg class="icon"/> b <svg><path d=x/><title>no</title></svg> c <math/> d</p>') == "a\n\nb\n\nc d"
    formula = "<math><semantics><mrow><mi>x</mi><mo>=</mo><mspace/><mn>1</mn></mrow><annotation>no</annotation></semantics></math>"
    assert every(f"<article><p>so {formula} holds</p></article>") == "so x=1 holds"
    assert every("<template><head><p>no</template><p>yes") == "yes"


PROSE = "Long words of a real story go on here, with commas, and then some more of it. Another sentence follows at once."
LAYOUTS = {
    "own header": (
        "<header><h2>Site name</h2></header><nav><a href=/>Home</a> <a href=/b>News</a></nav>"
        "<article><header><h1>Headline of it</h1></header><p>{0}</p><p>{0}</p></article><footer>&copy; Site 2020</footer>",
        ["Headline of it", PROSE, PROSE],
    ),
    "caption": (
        "<nav><a href=/>Home</a> <a href=/b>News</a></nav><article><h1>Headline</h1><p>{0}</p><figure><img src=a.png>"
        "<figcaption>A caption of the picture.</figcaption></figure><p>{0}</p></article><footer>&copy; Site 2020</footer>",
        ["Headline", PROSE, "A caption of the picture.", PROSE],
    ),
    "site header in a wrapper": (
        "<div class=page><header><h1>Site name</h1></header><div id=main><h1>Headline</h1><p>{0}</p><p>{0}</p></div><footer>&copy; Site</footer></div>",
        ["Headline", PROSE, PROSE],
    ),
    "own footer": (
        "<article><h1>Headline</h1><p>{0}</p><p>{0}</p><footer>Filed under: <a href=/>x</a></footer></article>",
        ["Headline", PROSE, PROSE],
    ),
    "menu of words with signs": (
        "<nav><ul><li><a href=/>The</a></li><li><a href=/a>and.</a></li><li><a href=/b>the,</a></li></ul></nav>"
        "<article><h1>Headline</h1><p>{0}</p><p>{0}</p></article>",
        ["Headline", PROSE, PROSE],
    ),
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts_that_the_module_does_not_compose(all_trees, name):
    body, blocks = LAYOUTS[name]
    html = f"<html><head><title>t</title></head><body>{body.format(PROSE)}</body></html>"
    assert html_main.main_texts([html], all_trees)[0].split("\n\n") == blocks


def test_data_main_of_corpus_pages_is_not_read(trees):
    article = "<article><h1>Title</h1><p>" + "more text, here. " * 30 + "</p></article>"
    plain = html_main.main_texts([f"<html><body>{article}</body></html>"], trees)
    for own in ("js/app", "", "0"):
        html = f'<html><head><script data-main="{own}" src="require.js"></script></head><body data-main="{own}">{article}</body></html>'
        assert html_main.main_texts([html], trees) == plain and plain[0].startswith("Title")


def test_html_query(spark):
    rows = queries.queries()["op5_html_extraction"](spark, SF_DIR).collect()
    html = {r.page_id: r.html for r in table(spark, SF_DIR, "pages").collect()}
    assert len(rows) == len(html)
    for row in rows:
        inside = re.search(r"<article>(.*?)(</article>|$)", html[row.page_id], re.S)[1]
        page = html_main.Page(inside)
        assert row.text == html_main.text_of(page, np.ones(len(page.tags), bool))
        assert row.n_chars == len(row.text)


# --- Pipeline -------------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    docs = table(spark, SF_DIR, "documents")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = corpus_pipeline.stored(stage(spark, docs, SF_DIR), "stage")
        assert docs.columns == columns, name
        after = {r.doc_id: r.text for r in docs.collect()}
        assert set(after) <= set(before)
        if name == "n-gram Jaccard join":
            ids = sorted(before)
            classes, _ = brute_classes([before[i] for i in ids])
            assert sorted(after) == sorted({ids[c] for c in classes})
        sizes.append(len(after))
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    texts, library = {r.doc_id: r.text for r in docs.collect()}, Tokenizer.from_file(WORD_BPE)
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for row in out:
        ids = library.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
        assert (row.n_tokens, row.ids_sha256) == (len(ids), digest(" ".join(map(str, ids))))
        assert row.decoded_sha256 == digest(library.decode(ids, skip_special_tokens=False))
    assert len(out) == len(texts) and [name for name, _ in corpus_pipeline.STAGES][0] == "toxicity"


def test_pipeline_drops_lines_on_three_pages_in_a_hundred(spark):
    rows = [(i, "h", ("licence\n" if i < 6 else "few\n" if i < 10 else "") + f"own {i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    kept = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs, SF_DIR).collect()}
    assert kept == {i: f"few\nown {i}" if 6 <= i < 10 else f"own {i}" for i in range(200)}


def test_a_language_of_long_texts_only_is_learned(spark, monkeypatch):
    """Whole texts are counted, whatever their length; so too where host counts are too many to broadcast."""
    german, english = "der die das und nicht ein schnelles wort ", "the and of to in is that word "
    rows = [(i, german * 700, "de") for i in range(20)] + [(100 + i, english * 3, "en") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    languages, table_of = language.fitted(docs)
    items = docs.selectExpr("doc_id", "text", "cast(null as string) declared", "cast(null as string) suffix", "cast(null as string) domain", "'h' || doc_id % 3 host")
    for small in (True, False):
        monkeypatch.setattr(language, "is_small", lambda *_, small=small: small)
        found = {r.doc_id: r.language for r in language.identify(items, languages, table_of).collect()}
        assert found == {i: lang for i, _, lang in rows}


@pytest.mark.parametrize(
    "make",
    [
        lambda n: "<div>" * n + "</section>" * n,
        lambda n: "<div><b>" * n + "</i>" * n + "</b>" * n,
        lambda n: "<i><div>" + "<b>" * n + "</i>" * n,
        lambda n: "<button>" + "<span>" * n + "<p>" * n,
        lambda n: "<svg>" + "<body>" * n,
    ],
)
def test_stray_and_open_tags_cost_in_proportion(make):
    def seconds(n):
        begun = time.monotonic()
        html_main.Page(make(n), labelled=False)
        return time.monotonic() - begun

    assert seconds(100_000) < 10 * max(seconds(25_000), 0.3)


def test_pieces_are_all_rows_in_order():
    texts = ["", None, "ab", "ä", "x" * 9, "", "abc", "d", "e" * 4, None]
    batch = pa.RecordBatch.from_pydict({"n": list(range(len(texts))), "text": pa.array(texts, pa.string())}).slice(1)
    found = [piece.column("text").to_pylist() for piece in pieces(batch, "text", 4)]
    assert found == [[None, "ab", "ä"], ["x" * 9], ["", "abc", "d"], ["e" * 4, None]]
    assert [n for piece in pieces(batch, 1, 4) for n in piece.column(0).to_pylist()] == list(range(1, len(texts)))
    assert list(pieces(batch.slice(0, 0), "text", 4)) == []


#: Prints the MB that the one Python worker keeps after a stage over 200 rows, and then after one over 6,000.
KEPT = """
import re, sys
from pathlib import Path
import pyarrow as pa
import public_tokenizers
from pyspark.sql import SparkSession
from gridwarden.llm import bpe, ngram_join

spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.sql.warehouse.dir", sys.argv[2]).getOrCreate()
spark.sparkContext.setLogLevel("OFF")


def kept(batches):
    for _ in batches:
        pass
    yield pa.RecordBatch.from_pydict({"kb": [int(re.search(r"Pss_Anon:\\s+(\\d+)", Path("/proc/self/smaps_rollup").read_text())[1])]})


for rows in (200, 6000):
    text = {
        "bpe": "concat(repeat('some words, that repeat in each text ', 110), id)",
        "signatures": "concat_ws(' ', transform(sequence(1, 500), x -> hex(hash(id, x))))",
    }[sys.argv[1]]
    docs = spark.range(0, rows, 1, 1).selectExpr("id doc_id", f"{text} text")
    if sys.argv[1] == "bpe":
        stage = bpe.with_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), decoded=True)
    else:
        stage = ngram_join.signatures(docs, 18, 5)
    stage.write.format("noop").mode("overwrite").save()
    print("KEPT", spark.range(0, 1, 1, 1).mapInArrow(kept, "kb long").first().kb // 1024)
"""


@pytest.mark.parametrize("stage", ["bpe", "signatures"])
def test_workers_give_back_what_a_stage_took(stage, tmp_path):
    """Workers go on to the next stage; what they hold counts as an executor's memory there."""
    done = subprocess.run(
        [sys.executable, "-c", KEPT, stage, str(tmp_path)], cwd=Path(__file__).parents[2], capture_output=True, text=True, timeout=300, check=True
    )
    little, much = map(int, re.findall(r"KEPT (\d+)", done.stdout))
    assert much < little + 8, (little, much)
