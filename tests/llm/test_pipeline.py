from collections import Counter

import sentencepiece
from test_text_operators import cut

import corpus_pipeline
from tidegauge.llm import mixing, neardup, pieces, quality
from tidegauge.session import scratch_dir


def text_without_repeats(rows, length=50):
    """Texts of (id, text) rows without the bytes that an earlier document has."""
    least = {}
    for i, t in sorted(rows):
        b = t.encode()
        for k in range(len(b) - length + 1):
            least.setdefault(b[k:k + length], i)
    found = {}
    for i, t in rows:
        b = t.encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if least[b[k:k + length]] < i:
                gone[k:k + length] = b"\1" * length
        left = bytes(c for c, g in zip(b, gone, strict=True) if not g).decode("utf-8", "ignore")
        if left or not any(gone):
            found[i] = left
    return found


def smallest_of_each_class(rows):
    table = [r.text for r in rows]
    hashes = [neardup.shingle_hashes([t])[0] for t in table]
    df = Counter(h for own in hashes for h in set(own.tolist()))
    often = sorted(h for h, n in df.items() if n >= len(rows) / neardup.RARE)
    frequent = (neardup.np.array(often, neardup.np.uint64),
                neardup.np.array([df[h] for h in often], float))
    values, weights, offset = neardup.weighted(table, frequent, len(rows))
    sets = [(values[a:b], weights[a:b]) for a, b in zip(offset[:-1], offset[1:], strict=True)]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if table[i] == table[j] or neardup.similarity(sets[i], sets[j]) >= 0.8:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for g, r in zip(group, rows, strict=True):
        least[g] = min(least.get(g, r.doc_id), r.doc_id)
    return set(least.values())


def test_stages_against_brute_force(spark, sample):
    docs, kept = sample, []
    for name, stage in corpus_pipeline.STAGES:
        out = scratch_dir(spark, "stage")
        stage(spark, docs, "/root/testdata/sf0.001").write.parquet(out)
        found = spark.read.parquet(out)
        if name != "encoding":
            assert found.columns == sample.columns
        kept.append((docs, found))
        docs = found
    (before, good), (_, single), (_, short), (_, mix), (_, coded) = kept
    assert {r.doc_id for r in good.collect()} == {
        r.doc_id for r in quality.score(before).filter("kept").collect()}
    assert sorted(r.doc_id for r in single.collect()) == sorted(
        smallest_of_each_class(good.collect()))
    rows = [(r.doc_id, r.text) for r in single.collect()]
    assert {r.doc_id: r.text for r in short.collect()} == text_without_repeats(rows)
    assert all(r.n_chars == len(r.text) for r in short.collect())
    assert cut(rows, 50)  # the query's own brute-force version counts the same spans
    copies = {r.doc_id: r.copies for r in mixing.mix(short).collect() if r.copies}
    assert Counter(r.doc_id for r in mix.collect()) == Counter(copies)
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = {r.doc_id: r.text for r in short.collect()}
    rows = coded.collect()
    assert len(rows) == mix.count()
    assert all(r.ids == library.encode(texts[r.doc_id]) for r in rows)


def test_tricky_and_empty_documents_pass_all_stages(spark, docs, no_docs):
    for rows in (docs.select("doc_id", "text", "lang", "source", "n_chars"), no_docs):
        path = scratch_dir(spark, "tables")
        rows.write.parquet(path + "/documents.parquet")
        found = corpus_pipeline.run(spark, path)
        assert all(r.round_trip for r in found.collect())
