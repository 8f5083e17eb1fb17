import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tidegauge.llm import packing, queries, runs, whitening

SF_DIR = "/root/testdata/sf0.001"


# Periodic runs --------------------------------------------------------------------------

def all_runs(words, least=12):
    """Runs by trying every period at every place."""
    n, found = len(words), []
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            length = j - i + p
            run = words[i:i + length]
            if length >= max(least, 2 * p) and not any(
                    run[q:] == run[:-q] for q in range(1, p)):
                found.append((i, length, p))
            i = j + 1
    return sorted(found)


def in_words(rows):
    return [tuple(r) for r in rows.tolist()]


@pytest.mark.parametrize("seed", range(4))
def test_runs_against_every_period(seed):
    rng = np.random.default_rng(seed)
    for _ in range(250):
        n, kinds = int(rng.integers(1, 90)), int(rng.integers(1, 5))
        words = rng.integers(0, kinds, n).tolist()
        if rng.random() < 0.5:
            p, a = int(rng.integers(1, 15)), int(rng.integers(0, n))
            words = words[:a] + (words[a:a + p] * n)[:n - a]
        assert in_words(runs.runs_of(words)) == all_runs(words)
        part = runs.runs_of_part([w + 1 for w in words], 2)
        assert in_words(part) == all_runs(words, 2)


def test_extensions_are_common_prefixes():
    rng = np.random.default_rng(2)
    text = rng.integers(1, 4, 60).tolist()
    tree = runs.Extensions(text)
    one, two = (np.array(x) for x in zip(*[(i, j) for i in range(60) for j in range(60) if i != j],
                                         strict=True))
    for i, j, got in zip(one, two, tree.common(one, two), strict=True):
        k = 0
        while max(i, j) + k < 60 and text[i + k] == text[j + k]:
            k += 1
        assert got == k
    assert np.argsort(tree.rank[:-1]).tolist() == sorted(range(60), key=lambda i: text[i:])
    assert np.argsort(tree.falling_rank()[:-1]).tolist() == sorted(
        range(60), key=lambda i: [-x for x in text[i:]])


def test_parts_far_apart_hold_no_run():
    passage = [f"w{i}" for i in range(40)]
    words = passage + [f"x{i}" for i in range(30)] + passage + list("abcdef") * 3 + ["end"]
    assert in_words(runs.runs_of(words)) == [(110, 18, 6)]
    ids = np.unique(words, return_inverse=True)[1].astype(np.uint64)
    assert runs.parts_with_runs(ids) == [(110, 128)]


def test_periodic_query_against_brute_force(spark, tmp_path):
    sample = spark.read.parquet(f"{SF_DIR}/documents.parquet").filter("n_chars < 1500")
    rows = [(r.doc_id, r.text) for r in sample.collect()]
    rows += [(7000 + i, "ab cd ef gh ij kl mn " * (2 + i % 5) + f"tail {i}") for i in range(40)]
    rows += [(8000, None), (8001, ""), (-8002, "x " * 100), (8003, "one word\x1fstill")]
    path = str(tmp_path / "t")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(
        path + "/documents.parquet")
    got = {r.doc_id: r for r in queries.op11_periodic_runs(spark, path).collect()}
    assert len(got) == len(rows)
    planted = 0
    for i, text in rows:
        words = (text or "").encode().split()
        n, h = len(words), zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [words[k if k < a else a + (k - a) % p] for k in range(n)]
            planted += 1
        found = all_runs(words)
        row = got[i]
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        assert row.n_runs == len(found)
        assert (row.start, row.length, row.period, row.exponent_milli) == (
            (*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        assert row.runs_sha256 == hashlib.sha256(
            "".join(f"{s},{k},{q}\n" for s, k, q in found).encode()).hexdigest()
        gone = {w for s, k, q in found for w in range(s + q, s + k)}
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        assert row.collapsed_sha256 == hashlib.sha256(kept).hexdigest()
    assert planted > 5


def test_runs_of_tricky_rows(docs, no_docs):
    rows = runs.find_runs(docs).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs.collect())
    by_id = {r.doc_id: r for r in rows}
    assert [tuple(r) for r in by_id[11].runs] == [(0, 10000, 2)]
    assert by_id[11].collapsed == "x y"
    assert by_id[4].runs == by_id[5].runs == [] and by_id[4].collapsed == ""
    assert runs.digests(runs.find_runs(no_docs)).count() == 0


# Packing --------------------------------------------------------------------------------

def check_packed(rows, texts, size=packing.SIZE):
    library = Tokenizer.from_file(packing.word_tokenizer())
    pieces, places = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    assert Counter(pieces.keys()) == Counter(texts.keys())
    for key, text in texts.items():
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        own = sorted(pieces[key], key=lambda r: r.piece)
        assert len(own) == -(-len(ids) // size)
        for k, r in enumerate(own):
            part = ids[k * size:(k + 1) * size]
            assert (r.piece, r.start, r.length) == (k, k * size, len(part))
            assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= size
    return len(places), sum(r.length for r in rows)


def test_packing_query_against_the_library(spark, sample):
    texts = {r.doc_id: r.text for r in sample.collect()}
    n, total = check_packed(queries.op12_packing(spark, SF_DIR).collect(), texts)
    assert n <= 1.02 * -(-total // packing.SIZE) + 1


def test_packing_in_rounds_and_sequences(spark, sample):
    texts = {r.doc_id: r.text for r in sample.collect()}
    pieces = packing.pieces_of(sample, size=512, with_ids=True)
    packed = packing.pack(pieces, 512, group=40)
    n, total = check_packed(packed.collect(), texts, 512)
    assert n <= 1.1 * total / 512
    made = packing.sequences(packed).collect()
    assert len(made) == n and sum(len(r.ids) for r in made) == total
    library = Tokenizer.from_file(packing.word_tokenizer())
    whole = Counter(i for t in texts.values() for i in library.encode(
        t, add_special_tokens=False).ids)
    whole[0] += len(texts)
    assert Counter(i for r in made for i in r.ids) == whole


def test_pieces_that_fill_nothing_stay(spark):
    pieces = spark.createDataFrame([(i, 1500) for i in range(100)], "i int, length long")
    rows = packing.pack(pieces, 2048, group=10).collect()
    assert sorted(r.i for r in rows) == list(range(100))
    assert len({r.sequence_id for r in rows}) == 100


def test_each_place_keeps_the_squares_smallest():
    rng = np.random.default_rng(4)
    size, lengths = 30, rng.integers(1, 30, 300).tolist()
    into, filled = packing.place(lengths, size)
    own = Counter()
    for n, s in zip(lengths, into.tolist(), strict=True):
        def squares(put, own=own):
            gaps = Counter(size - f for f in {**own, **put}.values() if f < size)
            return sum(c * c for c in gaps.values())
        choices = [squares({b: f + n}) for b, f in own.items() if f + n <= size]
        best = min([*choices, squares({"new": n})])
        assert squares({s: own[s] + n}) == best
        own[s] += n
    assert [own[i] for i in range(len(filled))] == filled.tolist()


def test_words_give_the_ids_of_whole_texts(sample):
    words, whole = (packing.Encoder(packing.word_tokenizer(), a) for a in (False, True))
    rng = np.random.default_rng(5)
    odd = ["a", "́", "'s", "'", "\x1c", "\x85", "　", " ", " ", "\x0b", " ",
           "\n", "\t", "\x0c", "İ", "Σ", "ﬁ", "9", "-", "<|endoftext|>", "<|endoftext",
           "|>", ".,", "b", "'ll",
           "\U0001f600", "ᄀ", "ᅡ", "Å", "t's", "\x00"]
    texts = ["".join(rng.choice(odd, int(rng.integers(0, 30)))) for _ in range(2000)]
    texts += [r.text for r in sample.collect()] + ["x" * 5000 + " y", ""]
    for t in texts:
        assert words.encode(t) == whole.encode(t), repr(t)


def test_packing_of_tricky_rows(spark, docs, no_docs):
    rows = packing.pack_documents(docs).collect()
    firsts = Counter(r.doc_id for r in rows if r.piece == 0)
    assert firsts == Counter(r.doc_id for r in docs.collect())
    assert {r.length for r in rows if r.doc_id in (4, 5)} == {1}
    assert packing.pack_documents(no_docs).count() == 0


# Whitening ------------------------------------------------------------------------------

def expected(vectors, most=32):
    x = np.floor(np.array(vectors, float) * 64).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    y = x - s / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    return n, ((n * x - s) ** 2).sum(axis=1), y, values[::-1][:most], vectors[:, ::-1][:, :most]


def test_whitening_query_against_numpy(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    n, deviation, y, values, vectors = expected([r.embedding for r in table])
    want = y @ vectors / np.sqrt(values)
    got = defaultdict(dict)
    for r in queries.op13_whitening(spark, SF_DIR).collect():
        got[r.vec_id][r.component] = r
    assert len(got) == n and all(sorted(g) == list(range(1, 33)) for g in got.values())
    total = np.trace(y.T @ y / n)
    matrix = np.array([[got[r.vec_id][c].whitened for c in range(1, 33)] for r in table])
    sign = np.sign((matrix * want).sum(axis=0))
    assert np.abs(matrix * sign - want).max() < 1e-8
    for r, d in zip(table, deviation.tolist(), strict=True):
        for c, row in got[r.vec_id].items():
            assert (row.n, row.deviation) == (n, d)
            assert abs(row.explained / (values[c - 1] / total) - 1) < 1e-9
            assert row.identity_error < 1e-9
    assert np.abs(matrix.T @ matrix / n - np.eye(32)).max() < 1e-9


def test_leading_components_of_many_kinds():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 7, 40, 130):
        a = rng.standard_normal((n, 2 * n))
        b = rng.standard_normal((n, max(1, n // 3)))
        close = np.diag(1 + 1e-13 * rng.standard_normal(n))
        for m in (a @ a.T, b @ b.T, np.eye(n), np.ones((n, n)), close, 1e12 * close, 1e-12 * a @ a.T,
                  np.diag(np.arange(n) + 1.0), np.zeros((n, n))):
            values, vectors = whitening.leading_components(m)
            true = np.linalg.eigvalsh(m)[::-1]
            size = max(true[0], 1e-300)
            assert len(values) == min(32, (true > 1e-11 * size).sum()) if m.any() else not len(values)
            assert np.abs(values - true[:len(values)]).max(initial=0) < 1e-12 * size
            assert np.abs(vectors.T @ vectors - np.eye(len(values))).max(initial=0) < 1e-12
            assert np.abs(m @ vectors - vectors * values).max(initial=0) < 1e-11 * size


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()),
                        T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("n", T.StringType()), T.StructField("v", T.StringType())])


def test_whitening_of_tricky_rows(spark):
    rng = np.random.default_rng(9)
    good = [(int(i) + (1 << 60), rng.standard_normal(3).tolist()) for i in range(20)]
    rows = good + good[:5] + [(None, [1.0, 2.0, 3.0]), (1, None), (2, [1.0, None, 2.0]),
                              (3, [float("nan"), 1.0, 1.0]), (4, [float("inf"), 0.0, 0.0]),
                              (5, []), (6, [1.0, 2.0]), (7, [1e30, 0.0, 0.0])]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], VECTORS).repartition(3)
    found = whitening.long_form(df).collect()
    counted = good + good[:5] + [(None, [1.0, 2.0, 3.0])]
    assert Counter(r.vec_id for r in found if r.component == 1) == Counter(i for i, _ in counted)
    n, _, _, values, _ = expected([np.float32(v) for _, v in counted])
    assert {r.n for r in found} == {n} and max(r.component for r in found) == len(values) == 3
    for some in (df.limit(0), df.filter("vec_id = 5"), df.filter("vec_id is null")):
        assert whitening.long_form(some).count() == 0
    flat = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(9)],
                                 "vec_id int, embedding array<double>")
    assert {r.component for r in whitening.long_form(flat).collect()} == {1}


def test_deviations_stay_exact():
    x = np.array([[1 << 40, 5], [-(1 << 40), 6], [7, 8]], np.int64)
    sums = [int(s) for s in x.sum(axis=0)]
    want = [sum((3 * int(a) - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    assert whitening.deviations(x, 3, sums) == [w if w < 1 << 63 else None for w in want]


def test_words_of_letters_are_encoded_without_marks_between_them():
    """Half as many tokens pass the tokenizer; ids are those of each word by itself, letters or not."""
    encoder = packing.Encoder(packing.word_tokenizer())
    plain = packing.Encoder(packing.word_tokenizer())
    passed, whole = [], encoder.whole

    def counted(texts):
        found = whole(texts)
        passed.append(sum(map(len, found)) // 4)
        return found

    encoder.whole = counted
    words = [f"{a}{b}{c}".encode() for a in "b\u00e9st" for b in ("ario", "\u00fcl", "en") for c in ("ung", "at", "\u00df")]
    want = {w: plain.whole([w.decode()])[0] for w in words}
    assert encoder.each(words) == want
    assert sum(passed) == sum(map(len, want.values())) // 4
    # Letters that become two words or a letter and a mark, words of other signs, no word at all.
    odd = ["\u0130x", "\u0958a", "don't", "a0b", "0", "\u00a0", "x", "\u03a3\u03a3", "caf\u00e9", "<|endoftext|>", "ok..."]
    assert encoder.each([w.encode() for w in odd]) == {w.encode(): plain.whole([w])[0] for w in odd}
    text = " ".join([*odd, "ok.", "OK...", *[w.decode() for w in words]])
    assert encoder.encode(text) == plain.whole([text])[0]


def test_words_of_latin_letters_go_straight_to_the_model():
    """Of other steps only marks and words of other signs are in need, and marks once."""
    encoder, plain = (packing.Encoder(packing.word_tokenizer()) for _ in range(2))
    passed, whole = [], encoder.whole
    encoder.whole = lambda texts: passed.extend(texts) or whole(texts)
    letters = [chr(c) for c in [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)] if chr(c).isalpha()]
    texts = [" ".join(f"{a}{b}{c}" for a in letters[k::7] for b in letters[::5] for c in ("", "ung", "É")) for k in range(7)]
    for text in texts:
        assert encoder.encode(text) == plain.whole([text])[0]
    assert passed == []
    for text in ("Hello, été... Çà!", "Later, NOËL... là!", "hello été"):
        assert encoder.encode(text) == plain.whole([text])[0]
    assert len(passed) == 2 and passed[0] == "0" and set(passed[1].split(" 0 ")) == {",", "...", "!"}
    # A sign that joins the letter before it, signs that are no letters, special tokens in both cases.
    for text in ("e\u0301t e\u0301 \u00d7a \u00f7 a\u00f7b \u0130x", "a<|endoftext|> A<|ENDOFTEXT|> b<|endoftext|>c", "É's it'S 'T 0É"):
        assert encoder.encode(text) == plain.whole([text])[0]
