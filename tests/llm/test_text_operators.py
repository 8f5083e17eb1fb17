import hashlib
import math
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tidegauge.llm import (common, fingerprints, htmltext, licences, neardup, pieces, spandedup,
                           suffixes)
from tidegauge.llm.components import components, thinned


# Fingerprints ---------------------------------------------------------------------------

def shingles(text):
    words = (text or "").encode().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_against_sets(sample):
    rows = {r.doc_id: r for r in fingerprints.pairs_with_next(sample).collect()}
    docs = sorted(sample.collect(), key=lambda r: -r.doc_id)
    assert len(rows) == len(docs)
    prints = defaultdict(set)
    for i, doc in enumerate(docs):
        after, row = docs[(i + 1) % len(docs)], rows[doc.doc_id]
        cut = len(doc.text) // 3
        edited = doc.text[:len(doc.text) - cut] + after.text[:cut]
        assert row.n_chars == len(doc.text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        # Four standard errors of a sketch of 256; exact below that.
        for got, want in ((row.near_edited, jaccard(doc.text, edited)),
                          (row.near_next, jaccard(doc.text, after.text))):
            assert abs(got - want) <= 4 * math.sqrt(want * (1 - want) / 256) + 0.01
        true = len(shingles(doc.text))
        assert abs(row.n_shingles - true) <= (0 if true < 256 else 0.25 * true)
        prints[doc.text].add(row.fingerprint)
    assert all(len(p) == 1 for p in prints.values())


def test_fingerprints_of_tricky_rows(docs, no_docs):
    rows = fingerprints.pairs_with_next(docs).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs.collect())
    assert fingerprints.pairs_with_next(no_docs).count() == 0
    one = docs.filter("doc_id = 7")
    assert fingerprints.pairs_with_next(one).collect()[0].near_next == 1.0


def test_sketches_merge_and_estimate(spark):
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, (1 << 64) - 1, 5000, dtype=np.uint64) for _ in range(3)]
    a = np.concatenate([sets[0], sets[1]])
    b = np.concatenate([sets[1], sets[2]])
    sa, sb = fingerprints.bottom(a), fingerprints.bottom(b)
    assert np.array_equal(fingerprints.merge(sa, sb), fingerprints.bottom(np.concatenate([a, b])))
    assert abs(fingerprints.resemblance(sa, sb) - 1 / 3) < 0.12
    assert abs(fingerprints.containment(sa, sb) - 1 / 2) < 0.15
    assert abs(fingerprints.distinct(sa) / 10000 - 1) < 0.25
    texts = spark.createDataFrame([("a b c d e f g",), ("b c d e f g h i",), ("",), (None,)], "t string")
    prints = texts.select(fingerprints.fingerprint("t").alias("p"))
    whole = prints.select(fingerprints.merged("p").alias("p")).first().p
    assert len(fingerprints.from_text(whole)) == 5


# Main text ------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>Not this</title><style>p{}</style>
<script>var a="<p>not this</p>"</script></head><body><header class="masthead"><a href=/>Site</a></header>
<nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav>
<div class="cookie-notice">We use cookies. Accept them, please, all of them.</div>
<div id=content><h1>A heading &amp; more</h1><p>First   paragraph of the text, long enough,
with a <b>bold</b> word.<p>Second&nbsp;paragraph &lt;of&gt; the text, which is also long enough.
<div class="ad banner">Buy this now. It is cheap. Really. Buy it today, and not tomorrow.</div>
<p>Third.</p><!-- <p>not this</p> --><blockquote>A quotation of some length, with a comma.</blockquote></div>
<aside class=sidebar><p>Related: some other text that is not part of it, at all.</p></aside>
<form><label>Name</label><input><button>Send</button></form>
<section id="comments"><p>Great article, I liked it a lot, thank you for it.</p></section>
<footer><p>Copyright by us. All rights are reserved, of course.</p></footer></body></html>"""


def test_main_text_of_a_page():
    assert htmltext.main_text(PAGE).split("\n") == [
        "A heading & more",
        "First paragraph of the text, long enough, with a bold word.",
        "Second paragraph <of> the text, which is also long enough.", "Third.",
        "A quotation of some length, with a comma."]


ARTICLE = ("<h1>A heading of the page</h1>" + "".join(
    f"<p>Paragraph {k} of the text, which is long enough to be kept. It has stops, and a second sentence.</p>"
    for k in range(6)))
AROUND = ("<nav><a href=a>One</a> <a href=b>Two</a></nav><div class=ad>Buy this now. It is cheap. Really.</div>",
          "<footer><p>Copyright by us. All rights are reserved, of course.</p></footer>")


@pytest.mark.parametrize("before, after", [
    ('<body class="has-sidebar">', "</body>"), ('<body class="no-sidebar comments-open">', "</body>"),
    ('<body class="sidebar">', "</body>"), ('<body><div id="page-search">', "</div></body>"),
    ("<body><form action=x>", "</form></body>"),
    ('<body><form class="form"><div class="no-sidebar"><main class="comments-open"><article>',
     "</article></main></div></form></body>")])
def test_main_text_in_wrappers(before, after):
    """What wraps the whole page decides nothing: the text is that of the page without wrappers."""
    want = htmltext.main_text(f"<body>{AROUND[0]}{ARTICLE}{AROUND[1]}</body>")
    assert want.count("\n") == 6 and "Buy" not in want and "Copyright" not in want
    assert htmltext.main_text(f"<html>{before}{AROUND[0]}{ARTICLE}{AROUND[1]}{after}</html>") == want


COMMENTS = "".join(f"<div class=x><p>Comment {k}: I liked this article a lot, really. It was long, thank you.</p></div>"
                   for k in range(20))


@pytest.mark.parametrize("name", ["comments", "comment-list", "advert", "sidebar", "cookie-consent", "related-posts"])
@pytest.mark.parametrize("page", [
    "{0}{1}", "<div class=content>{0}</div>{1}", "<article>{0}{1}</article>", "<main>{0}{1}</main>",
    "<main><article class=post>{0}</article>{1}</main>", "<div class=content>{0}{1}</div>"])
def test_main_text_without_what_is_longer_than_the_article(page, name):
    other = f'<div class="{name}">{COMMENTS}</div>'
    want = htmltext.main_text(f"<body>{ARTICLE}</body>")
    assert want.count("\n") == 6
    assert htmltext.main_text(f"<body>{page.format(ARTICLE, other)}</body>") == want


def test_main_text_without_nested_comment_articles():
    one = '<li class="comment"><article class="comment-body"><p>{} I liked it a lot, thank you.</p></article></li>'
    page = f"<body><article>{ARTICLE}</article><section id=comments><ol>{''.join(map(one.format, range(30)))}</ol></section>"
    assert htmltext.main_text(page) == htmltext.main_text(ARTICLE)


@pytest.mark.parametrize("attribute", [
    'class="overflow-hidden"', 'class="overflow-x-hidden"', 'aria-hidden="false"', 'data-hidden="false"',
    'class="elementor-widget"', 'class="alert-info"', 'class="social-x"', 'class="x-share"', "title='a > b'"])
def test_main_text_with_names_that_say_nothing(attribute):
    want = htmltext.main_text(f"<body>{ARTICLE}</body>")
    for page in (f"<body {attribute}>{ARTICLE}", f"<body><div {attribute}>{ARTICLE}</div>",
                 "<body><main>" + ARTICLE.replace("<p>", f"<p {attribute}>"),
                 "<body>" + ARTICLE.replace("<p>", f"<div {attribute}>").replace("</p>", "</div>")):
        assert htmltext.main_text(page) == want
    for attribute in ("hidden", "aria-hidden=true", 'style="color: red; display: none"'):
        assert htmltext.main_text(f"<body><div {attribute}><p>Not seen, but long.</p></div>{ARTICLE}") == want


def test_main_text_of_forms_and_scripts_inside_a_block():
    text = "A sentence of the text, which is long enough to be kept, and{} another one, which is as long."
    page = "<article><p>" + text.format("<script>x()</script><button>Send</button><select><option>a</select>")
    assert htmltext.main_text(page) == text.format("")
    assert htmltext.main_text("<p>" + text.format(" &#" + "9" * 5000 + ";")) == text.format(" \ufffd")


@pytest.mark.parametrize("page", [
    "".join(f"<p>Short {'text, with, stops. ' * (i % 7)}{i}.</p>" for i in range(100000)),
    "".join(f"<p>Short text {i}.</p>" for i in range(100000)), "<script " * 125000, "<script \"" * 125001 + ">",
    "<a \"'>" * 200000, '<a b="x>' * 100001, "<div>x" * 100000, "<div>" * 100000 + "x" + "</span>" * 100000,
    "<!" * 500000, "</a " * 300000, "<li><ul>" + "<div>" * 50000 + "<li></li>" * 50000,
    "<button>x" * 100000, "<div " + "a " * 300000 + ">x"], ids=range(13))
def test_time_of_long_and_broken_pages(page):
    start = time.time()
    htmltext.main_text(page)
    assert time.time() - start < 20  # seconds where quadratic work would take hours


def test_main_text_of_tricky_pages(spark):
    rows = [(1, "u", None), (2, "u", ""), (3, "u", "no markup at all, only a sentence of text."),
            (4, "u", "<p>unclosed <b>and long enough to be text, with a stop.<!-- never closed <p>x"),
            (5, "u", "<article>" + "<p>A sentence of the text, again.</p>" * 5000 + "</article>"),
            (6, None, "<script>only()"), (5, "u", "<p>" + "y, " * 100000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn(
        "text", F.lit("clash"))
    out = htmltext.extract(df).collect()
    assert len(out) == len(rows)
    got = {(r.page_id, len(r.text)): r for r in out}
    assert got[1, 0].n_chars == got[2, 0].n_chars == got[6, 0].n_chars == 0
    assert next(r for r in out if r.page_id == 5 and r.text.startswith("A")).text.count("\n") == 4999
    assert next(r for r in out if r.page_id == 4).text == "unclosed and long enough to be text, with a stop."
    assert htmltext.extract(df.limit(0)).count() == 0


def test_minimum_cut_is_minimal():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(1, 9))
        unary = rng.normal(0, 2, n).tolist()
        pairs = [(i, j, float(rng.random() * 2)) for i in range(n) for j in range(i + 1, n)
                 if rng.random() < 0.5]

        def cost(label):
            return (sum(-u if x else 0 for u, x in zip(unary, label, strict=True))
                    + sum(w for i, j, w in pairs if label[i] != label[j]))

        best = min(cost([m >> i & 1 for i in range(n)]) for m in range(1 << n))
        assert abs(cost(htmltext.minimum_cut(unary, pairs)) - best) < 1e-9


# Near-duplicates ------------------------------------------------------------------------

def test_classes_against_all_pairs(sample):
    rows = sample.collect()
    frequent, n = neardup.frequent_shingles(sample)
    values, weights, offset = neardup.weighted([r.text for r in rows], frequent, n)
    sets = [(values[a:b], weights[a:b]) for a, b in zip(offset[:-1], offset[1:], strict=True)]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if rows[i].text == rows[j].text or neardup.similarity(sets[i], sets[j]) >= 0.8:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    want = {}
    for g, r in zip(group, rows, strict=True):
        want.setdefault(g, []).append(r.doc_id)
    want = {x: min(ids) for ids in want.values() for x in ids}
    assert {r.doc_id: r.class_id for r in neardup.classes(sample).collect()} == want


def test_every_text_of_an_id_is_compared(spark):
    rng = np.random.default_rng(11)
    one, other, third = (" ".join(rng.choice([f"w{k}" for k in range(5000)], 300)) for _ in range(3))
    near = {t: t.rsplit(" ", 3)[0] + " x y z" for t in (one, other, third)}
    rows = [(1, one), (1, other), (1, third), (2, near[one]), (3, near[other]), (4, near[third]), (4, third),
            (5, "alone and nothing else at all"), (None, near[third]), (1, one), (6, one)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = Counter((r.doc_id, r.class_id) for r in neardup.classes(df).collect())
    assert found == Counter((i, 5 if i == 5 else 1) for i, _ in rows)
    kept = [sorted(tuple(r) for r in neardup.keep_one(x).collect()) for x in (df, df.orderBy(F.desc("text")))]
    least = min((one, other, third), key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    assert kept == [[(1, least), (5, "alone and nothing else at all")]] * 2


def test_frequent_shingles_are_counted_exactly(sample):
    found, n = neardup.frequent_shingles(sample, rare=20)
    count = Counter()
    for r in sample.collect():
        count.update(set(neardup.shingle_hashes([r.text])[0].tolist()))
    want = {h: c for h, c in count.items() if c >= n / 20}
    assert dict(zip(found[0].tolist(), found[1].tolist(), strict=True)) == want


def test_every_shingle_of_a_text_carries_its_document_frequency(spark, monkeypatch):
    """Over several chunks and ranges, with rare and common shingles, copies, empty and short texts."""
    monkeypatch.setattr(neardup, "CHUNK", 2000)
    rng = np.random.default_rng(21)
    texts = [" ".join(rng.choice(["a", "b", "c"], rng.integers(0, 60))) for _ in range(150)]
    texts += [" ".join(f"u{k}v{i}" for i in range(20)) for k in range(30)] + [texts[3], texts[3], "a", "a b", " "]
    own = [neardup.counted([t])[0].tolist() for t in texts]
    count = Counter(h for hashes in own for h in hashes)
    rows = spark.createDataFrame(list(enumerate(texts)), "_n long, _t string").repartition(3)
    chunks = neardup.dealt(rows, sum(map(len, texts)))
    assert chunks.select("chunk").distinct().count() > 3
    found = {r["_n"]: r for r in neardup.banded(chunks, len(texts), 5).collect()}
    assert sorted(found) == list(range(len(texts)))
    for k, hashes in enumerate(own):
        assert np.frombuffer(found[k]["_d"], np.int64).tolist() == [count[h] for h in hashes]
        assert (found[k]["keys"] is None) == (not hashes)


def test_a_passage_of_a_twentieth_of_all_documents_weighs_less_than_their_own_words(spark):
    passage = [f"p{i}" for i in range(300)]
    texts = [" ".join([*passage, *(f"d{k}w{i}" for i in range(34))]) for k in range(10)]
    texts += [" ".join(f"y{k}z{i}" for i in range(50)) for k in range(190)]
    near = texts[20].replace("y20z49", "other")  # a rare text's copy is still one
    rows = spark.createDataFrame(list(enumerate([*texts, near])), "doc_id long, text string")
    (a, b) = (set(neardup.shingle_hashes([t])[0].tolist()) for t in texts[:2])
    assert len(a & b) / len(a | b) > 0.81  # all weights equal
    found = {r.doc_id: r.class_id for r in neardup.classes(rows).collect()}
    assert found == {i: 20 if i == 200 else i for i in range(201)}


def test_samples_agree_as_often_as_documents_are_similar():
    rng = np.random.default_rng(2)
    ids = np.unique(rng.integers(0, 1 << 63, 900, dtype=np.uint64))
    wa, wb = rng.uniform(0.5, 3, len(ids)), rng.uniform(0.5, 3, len(ids))
    a, b = slice(0, 600), slice(200, 900)
    seeds = neardup.mix(np.arange(1, 1001, dtype=np.uint64))
    drawn = [neardup.samples(ids[s], w[s], np.array([0, len(ids[s])]), seeds)[0]
             for s, w in ((a, wa), (b, wb))]
    true = neardup.similarity((ids[a], wa[a]), (ids[b], wb[b]))
    assert abs((drawn[0] == drawn[1]).mean() - true) < 0.06


def test_classes_of_tricky_rows(docs, no_docs):
    rows = neardup.classes(docs).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs.collect())
    found = defaultdict(set)
    for r in rows:
        found[r.doc_id].add(r.class_id)
    assert found[1] == found[2] == {1} and None in found and found[4] == found[5] == {4} and found[6] == {6}
    assert neardup.classes(no_docs).count() == 0
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({r.class_id for r in rows})
    assert neardup.keep_one(no_docs).count() == 0


def test_a_crowd_of_edited_copies_finds_its_base(spark):
    """Copies link to the base only; each pair of them is below the threshold."""
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(400)]
    texts = []
    for k in range(150):
        words = list(base)
        for at in rng.choice(400, 7, replace=False):
            words[at] = f"x{k}y{at}"
        texts.append(" ".join(words))
    others = [" ".join(f"y{rng.integers(1 << 40)}" for _ in range(50)) for _ in range(600)]
    rows = spark.createDataFrame(list(enumerate([*texts, " ".join(base), *others])),
                                 "doc_id long, text string")
    found = Counter(r.class_id for r in neardup.classes(rows).collect())
    assert found.most_common(2)[0][1] >= 149 and found.most_common(2)[1][1] == 1


def template_pages(n):
    """Pages of one template just below 0.8 of each other, and each page's copy just above."""
    rng = np.random.default_rng(9)
    head = [f"t{i}" for i in range(350)]
    texts = []
    for k in range(n):
        page = head + [f"p{k}w{i}" for i in range(50)]
        texts += [page, page[:370] + [f"c{k}x{i}" for i in range(30)]]
    return [(i, " ".join(texts[i])) for i in rng.permutation(len(texts)).tolist()]


def test_near_copies_in_a_crowd_of_several_classes(spark):
    """Every page links to its copy only; brute force over all pairs of the crowd."""
    n = 40
    pages = template_pages(n)
    others = [(10 ** 6 + k, " ".join(f"y{k}z{i}" for i in range(50))) for k in range(9 * len(pages))]
    rows = spark.createDataFrame(pages + others, "doc_id long, text string")
    frequent, total = neardup.frequent_shingles(rows)
    values, weights, offset = neardup.weighted([t for _, t in pages], frequent, total)
    sets = [(values[a:b], weights[a:b]) for a, b in zip(offset[:-1], offset[1:], strict=True)]
    links = {tuple(sorted((pages[i][0], pages[j][0]))) for i in range(len(pages)) for j in range(i)
             if neardup.similarity(sets[i], sets[j]) >= 0.8}
    assert links == {(2 * k, 2 * k + 1) for k in range(n)}
    found = {r.doc_id: r.class_id for r in neardup.classes(rows).collect()}
    assert found == {i: i - i % 2 if i < 10 ** 6 else i for i, _ in pages + others}


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 101), (205, 200)]
    found = {r.node: r["class"] for r in components(spark.createDataFrame(
        links, "a long, b long")).collect()}
    assert {found[i] for i in range(61)} == {0} and found[101] == 100 and found[205] == 200


def test_a_group_of_many_leaders_has_a_link_for_each_member(spark):
    rng = np.random.default_rng(5)
    crowd = [(leader, node) for node in range(10, 310) for leader in range(4)]
    others = [(1000 + int(a), 1000 + int(b)) for a, b in rng.integers(0, 400, (250, 2)) if a != b]
    links = spark.createDataFrame([*crowd, *others, (3, 1000), (5000, 5001), (5001, 5002)], "a long, b long")
    near = defaultdict(set)
    for a, b in [(r.a, r.b) for r in links.collect()]:
        near[a].add(b)
        near[b].add(a)
    want = {}
    for n in sorted(near):
        todo = [] if n in want else [n]
        while todo:
            x = todo.pop()
            if x not in want:
                want[x] = n
                todo += near[x]
    assert {r.node: r["class"] for r in components(links).collect()} == want
    assert thinned(links).filter("a < 1000 and b < 1000").count() == 300 + 3


def test_rounds_of_components_go_on_with_links_between_classes_only(spark, monkeypatch):
    """A star, a chain in a random order and links between their parts: all tables are a small multiple of the links."""
    rng = np.random.default_rng(11)
    order = [int(x) + 2000 for x in rng.permutation(100)]
    pairs = [(5, i) for i in range(1000, 1300)] + list(zip(order, order[1:])) + [(1299, 3), (9000, order[7])]
    kept = []

    def counted(df, label, narrow=False):
        table = common.keep(df, label, narrow)
        kept.append(table.count())
        return table

    monkeypatch.setattr("tidegauge.llm.components.keep", counted)
    rows = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    found = {r.node: r["class"] for r in rows}
    assert len(rows) == len(found) == 302 + 101
    assert {found[n] for n in (3, 5, *range(1000, 1300))} == {3}
    assert {found[n] for n in (*order, 9000)} == {2000}
    assert sum(kept) <= 8 * len(pairs)


# Repeated spans -------------------------------------------------------------------------


def test_suffixes_that_differ_late_are_ordered_without_a_sort_by_several_keys(monkeypatch):
    rng = np.random.default_rng(4)
    stems = [bytes(rng.integers(97, 100, 60).astype(np.uint8)) for _ in range(3)]
    text = b"".join(stems[rng.integers(0, 3)][:rng.integers(5, 60)] + bytes([rng.integers(97, 100)]) for _ in range(60))
    data = np.frombuffer(text, np.uint8)
    words = suffixes.words_at(data)
    keys = []
    sort = np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda columns, *rest: keys.append(len(columns[0])) or sort(columns, *rest))
    some = rng.permutation(len(data))
    for at in (some, some[:1], some[:0]):
        found = suffixes.lexicographic(words, at.copy())
        assert sorted(found) == sorted(at)
        padded = [(text + bytes(suffixes.DEPTH))[p:p + suffixes.DEPTH] for p in found]
        assert padded == sorted(padded)
    assert sum(keys) == 0
    owner = rng.integers(0, 50, len(data))
    chosen = np.arange(len(data)) < len(data) - suffixes.DEPTH
    for length in (32, 37, 48, 50, 55, 56):
        least = {}
        for p in np.flatnonzero(chosen):
            run = text[p:p + length]
            least[run] = min(least.get(run, 99), owner[p])
        at, got = suffixes.first_owners(data, chosen, lambda p: owner[p], length)
        assert got.tolist() == [least[text[p:p + length]] for p in at]

def cut(rows, length):
    """Removed bytes of (id, text) rows by looking up every window."""
    least = {}
    raw = [(i, (t or "").encode()) for i, t in rows]
    for i, b in raw:
        for k in range(len(b) - length + 1):
            w = b[k:k + length]
            if i is not None and (w not in least or i < least[w]):
                least[w] = i
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            first = least.get(b[k:k + length])
            if first is not None and (i is None or first < i):
                gone[k:k + length] = b"\1" * length
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(b)))
        left = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("sizes", [{}, {"part": 3000, "hot_parts": 2}])
def test_repeated_spans_against_every_window(sample, sizes):
    some = sample.limit(90)
    rows = spandedup.remove_repeats(some, **sizes).collect()
    assert Counter(map(tuple, rows)) == cut([(r.doc_id, r.text) for r in some.collect()], 50)


def test_repeated_spans_of_tricky_rows(docs, no_docs):
    small = docs.filter("doc_id is null or doc_id != 9")
    rows = spandedup.remove_repeats(small, part=2000, hot_parts=2).collect()
    assert Counter(map(tuple, rows)) == cut(
        [(r.doc_id, r.text) for r in small.collect()], 50)
    assert spandedup.remove_repeats(no_docs).count() == 0
    left = spandedup.cut_documents(docs)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} >= {1, 4, 5, 6, 7, 8, 9, 10, 11}
    assert spandedup.cut_documents(no_docs).count() == 0


def test_a_run_at_the_beginning_alone():
    data = np.frombuffer(b"ab" * 2525, np.uint8)
    run, at, least = spandedup.first_of_runs(data, np.array([0]), np.array([9]), np.array([1]), 50)
    assert run.tolist() == [0] * 9 and at.tolist() == list(range(9)) and least.tolist() == [1] * 9


@pytest.mark.parametrize("length", [31, 57])
def test_lengths_that_are_refused(sample, length):
    with pytest.raises(ValueError):
        spandedup.remove_repeats(sample, length=length)


def test_suffixes_are_sorted():
    rng = np.random.default_rng(6)
    for kinds in (2, 3, 256):
        for n in (1, 2, 50, 400):
            data = rng.integers(0, kinds, n).astype(np.uint8)
            chosen = rng.random(n) < 0.7
            order = suffixes.sort_suffixes(data, chosen)
            assert sorted(order.tolist()) == np.flatnonzero(chosen).tolist()
            raw = data.tobytes() + bytes(60)
            keys = [raw[i:i + suffixes.DEPTH] for i in order]
            assert keys == sorted(keys)


# Licences -------------------------------------------------------------------------------

def test_licences_and_inheritance(spark):
    notice = "Licensed under the Apache License, Version 2.0."
    files = [("LICENSE", "Released under the MIT License."), ("a.py", "print(1)"),
             ("lib/b.py", f"# {notice}\nimport os\n"), ("lib/c.py", "text about apache and licenses"),
             ("lib/deep/er/d.py", None), ("vendor/COPYING", notice), ("vendor/x/e.py", ""),
             (None, "no path"), ("a.py", "print(1)"), ("long.txt", "word " * 50000 + "\n" + notice)]
    df = spark.createDataFrame(files, "path string, text string").selectExpr(
        "*", "1 score", "2 dir", "3 licence")
    rows = licences.scan(df)
    got = {(r.path, r.licence, r.origin, r.from_path, r.distance) for r in rows.collect()}
    assert rows.count() == len(files)
    assert got == {
        ("LICENSE", "MIT", "own", "LICENSE", None), ("a.py", "MIT", "inherited", "LICENSE", 0),
        ("lib/b.py", "Apache-2.0", "own", "lib/b.py", None),
        ("lib/c.py", "MIT", "inherited", "LICENSE", 1),
        ("lib/deep/er/d.py", "MIT", "inherited", "LICENSE", 3),
        ("vendor/COPYING", "Apache-2.0", "own", "vendor/COPYING", None),
        ("vendor/x/e.py", "Apache-2.0", "inherited", "vendor/COPYING", 1),
        (None, "MIT", "inherited", "LICENSE", 0),
        ("long.txt", "Apache-2.0", "own", "long.txt", None)}
    first = {r.path: r.licence for r in licences.scan(df, declares="first").collect()}
    assert first["lib/c.py"] == first["lib/deep/er/d.py"] == "Apache-2.0"
    assert licences.scan(df.limit(0)).count() == 0


def test_licence_scores_against_plain_cosine(sample):
    files = sample.selectExpr("cast(doc_id as string) path", "text")
    rows = files.collect()
    vocabulary = set().union(*(licences.terms_of(t) for _, t in licences.TEMPLATES))
    df = Counter(t for r in rows for t in vocabulary & licences.terms_of(r.text).keys())
    assert licences.document_frequencies(files, vocabulary) == (dict(df), len(rows))
    idf, vectors = licences.weights(licences.TEMPLATES, df, len(rows))
    want = {}
    for r in rows:
        for block in [*r.text.split("\n"), r.text]:
            counts = licences.terms_of(block)
            size = math.sqrt(sum((n * idf.get(t, 1.0)) ** 2 for t, n in counts.items()))
            for licence, _, vector in vectors:
                dot = sum(n * idf[t] * vector[t] for t, n in counts.items() if t in vector)
                if size and round(dot / size, 9) >= licences.LEAST:
                    best = (-round(dot / size, 9), licence)
                    want[r.path] = min(want.get(r.path, best), best)
    got = {r.path: (-r.score, r.licence) for r in licences.own_licences(files).collect()}
    assert want and got.keys() == want.keys()
    assert all(abs(got[p][0] - want[p][0]) < 1e-6 and got[p][1] == want[p][1] for p in want)


# Pieces ---------------------------------------------------------------------------------

def test_pieces_equal_the_library(sample):
    machine = pieces.Transducer(open(pieces.MODEL, "rb").read())
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = [r.text for r in sample.limit(60).collect()]
    texts += ["", " ", "  a  b ", "\n\t x", "日本語 \U0001f600", "<s> <0x41>", "a" * 2000, " " * 200,
              "def f(x):\n        return x  # aaaa", "don't.stop,me;now", "ab" * 300]
    for text, ids in zip(texts, machine.encode_all(texts), strict=True):
        assert ids.tolist() == library.encode(text)
        assert machine.decode(ids) == text == library.decode(ids.tolist())


def test_pieces_of_tricky_rows(spark, docs, no_docs):
    rows = pieces.encode_documents(docs).collect()
    assert Counter((r.doc_id, r.ids is None) for r in rows) == Counter(
        (r.doc_id, r.text is None) for r in docs.collect())
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in rows if r.ids is not None)
    assert pieces.encode_documents(no_docs).count() == 0
    texts = spark.createDataFrame([("some text",), (None,), ("",)], "t string")
    back = texts.withColumn("ids", pieces.encoder(spark)("t")).withColumn(
        "again", pieces.decoder(spark)("ids")).collect()
    assert [r.again for r in back] == ["some text", None, ""]


def model_of(entries, kind, prefix=False):
    """A model file of (piece, score, kind of piece)."""
    import struct

    def field(number, wire, body):
        head = bytes([number << 3 | wire])
        return head + (bytes([body]) if wire == 0 else bytes([len(body)]) + body if wire == 2 else body)

    data = b""
    for text, score, piece in entries:
        data += field(1, 2, field(1, 2, text.encode()) + field(2, 5, struct.pack("<f", score))
                      + field(3, 0, piece))
    return data + field(2, 2, field(3, 0, kind)) + field(3, 2, field(3, 0, int(prefix)) + field(4, 0, 0))


def test_unigram_paths_cost_least():
    rng = np.random.default_rng(8)
    entries = [("<unk>", 0.0, pieces.UNKNOWN)] + [
        (t, -float(rng.uniform(1, 9)), pieces.NORMAL)
        for t in ("a", "b", "c", "ab", "bc", "abc", "ca", "aa", "cab")]
    machine = pieces.Transducer(model_of(entries, pieces.UNIGRAM))
    cost = {t: -s for t, s, _ in entries[1:]}

    def least(text):
        best = [0.0] + [math.inf] * len(text)
        for j in range(1, len(text) + 1):
            for i in range(j):
                best[j] = min(best[j], best[i] + cost.get(text[i:j], math.inf))
        return best[-1]

    for _ in range(100):
        text = "".join(rng.choice(list("abc"), int(rng.integers(1, 12))))
        ids = machine.encode(text).tolist()
        assert machine.decode(np.array(ids)) == text
        assert abs(sum(machine.cost[i] for i in ids) - least(text)) < 1e-4
