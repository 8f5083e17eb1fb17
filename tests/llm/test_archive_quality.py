import datetime
import hashlib
import uuid
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.llm import quality, warc
from tidegauge.session import scratch_dir

PAGES = "page_id long, url string, html string, payload string, digest string"
LONG = "<p>" + "x" * 200


def read_back(spark, rows):
    folder = scratch_dir(spark, "warc")
    warc.write_archive(spark.createDataFrame(rows, PAGES), folder)
    return folder, warc.parse_header(warc.read_archive(spark, folder)).collect()


def test_archive_of_tricky_pages(spark):
    pages = [(1, "http://a/\r\nb", LONG, "x", "y"), (2, None, LONG, "x", "y"), (3, "u", None, None, None),
             (4, "u", "", "x", "y"), (5, "u", "short", "x", "y"), (6, "u", "short", "x", "y"),
             (7, "u", "é" * 60, "x", "y"), (8, "u", "é" * 60, "x", "y"),
             (9, "u", "z" * 300000, "x", "y"), (None, "u", LONG, "x", "y"), (1, "v", LONG, "x", "y"),
             (9, "u", "z" * 300000, "x", "y")]
    folder, rows = read_back(spark, pages)
    assert len(rows) == len(pages)
    assert Counter((r.id, bytes(r.payload).decode()) for r in rows) == Counter(
        (p[0], p[2] or "") for p in pages)
    for r in rows:
        assert hashlib.sha256(r.payload).hexdigest() == r.digest and r.length == len(r.payload)
    kinds = {(r.id, r.type, r.refers_to) for r in rows}
    assert {(1, "response", None), (2, "revisit", 1), (5, "response", None), (6, "response", None),
            (7, "response", None), (8, "revisit", 7), (None, "revisit", 1)} <= kinds
    assert {r.url for r in rows if r.id == 2} == {None}
    assert spark.read.parquet(folder + "/payloads").count() == len({p[2] or "" for p in pages})
    first = next(r for r in rows if r.id == 1 and "a" in r.url)
    assert first.url == "http://a/  b"


def records_of_file(data):
    """(fields, block) of the records of an uncompressed WARC file, read by the standard's grammar."""
    found, at = [], 0
    while at < len(data):
        head = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:head].decode().split("\r\n")
        assert version == "WARC/1.1"
        fields = dict(line.split(": ", 1) for line in lines)
        end = head + 4 + int(fields["Content-Length"])
        assert data[end:end + 4] == b"\r\n\r\n"
        found.append((fields, data[head + 4:end]))
        at = end + 4
    return found


def test_records_of_an_archive_are_those_of_a_file(spark):
    folder, _ = read_back(spark, [(1, "http://a/é", LONG + "é", "", ""), (2, None, LONG + "é", "", ""),
                                  (None, "http://b/", LONG + "é", "", ""), (4, "http://c/", None, "", "")])
    rows = warc.record_bytes(warc.read_archive(spark, folder)).collect()
    found = records_of_file(b"".join(bytes(r.record) for r in rows))
    assert len(found) == len({f["WARC-Record-ID"] for f, _ in found}) == 4
    first = next(f for f, _ in found if f["WARC-Target-URI"] == "http://a/é")
    for fields, block in found:
        uuid.UUID(fields["WARC-Record-ID"].strip("<>"))
        datetime.datetime.strptime(fields["WARC-Date"], "%Y-%m-%dT%H:%M:%SZ")
        assert fields["Content-Type"] == "application/http; msgtype=response"
        head, body = block.split(b"\r\n\r\n", 1)
        length = int(head.split(b"Content-Length: ")[1])
        if fields["WARC-Type"] == "response":
            assert len(body) == length
            assert fields["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(body).hexdigest()
        else:
            assert not body and length == len(LONG) + 2
            assert fields["WARC-Refers-To"] == first["WARC-Record-ID"]
            assert fields["WARC-Refers-To-Target-URI"] == "http://a/é"
            assert fields["WARC-Refers-To-Date"] == first["WARC-Date"]
    assert sorted(f["WARC-Type"] for f, _ in found) == ["response", "response", "revisit", "revisit"]


def test_dates_of_an_archive(spark):
    pages = spark.sql("""select 1 page_id, 'u' url, 'x' html, timestamp_seconds(1000000000) seen
                         union all select 2, 'u', 'x', null""")
    folder = scratch_dir(spark, "warc")
    warc.write_archive(pages, folder, date="seen")
    dates = {r.id: r.date for r in warc.parse_header(warc.read_archive(spark, folder)).collect()}
    assert dates[1] == "2001-09-09T01:46:40Z" and dates[2] > "2020"


def test_rows_without_ids_are_responses_if_all_are(spark):
    _, rows = read_back(spark, [(None, "u", LONG, "", ""), (None, "v", LONG, "", "")])
    assert [(r.type, r.refers_to) for r in rows] == [("response", None)] * 2


def test_empty_archive(spark):
    assert read_back(spark, [])[1] == []


def test_a_changed_payload_stops_the_read(spark):
    folder, _ = read_back(spark, [(1, "u", LONG, "", "")])
    bad = spark.read.parquet(folder + "/payloads").withColumn("payload", F.lit(b"other"))
    bad.write.parquet(folder + "/changed")
    spark.read.parquet(folder + "/changed").write.mode("overwrite").parquet(folder + "/payloads")
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read_archive(spark, folder).collect()


def plain_counts(text):
    """The base counts by their definition, character by character."""
    blank = set(" \t\n\x0b\x0c\r")
    words, word = [], ""
    for c in text + " ":
        if c in blank:
            words += [word] * bool(word)
            word = ""
        else:
            word += c
    lines = [x for x in text.split("\n") if any(c not in blank for c in x)]
    grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    inside = {i + k for i in range(len(words) - 4) if grams[tuple(words[i:i + 5])] > 1
              for k in range(5)}
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(inside),
            len(words) < 10 or 100 * len(inside) > 20 * len(words))


def test_base_counts(spark, docs, sample):
    for rows in (docs, sample.limit(60)):
        found = quality.score(rows)
        got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                       r.n_repeat_words, r.base_failed) for r in found.collect())
        want = Counter((r.doc_id, *plain_counts(r.text or "")) for r in rows.collect())
        assert got == want
        assert found.filter("base_failed and kept").count() == 0


def test_fit_finds_the_rules_accuracies():
    rng = np.random.default_rng(5)
    good = rng.random(20000) < 0.8
    right = (0.95, 0.9, 0.8, 0.7)
    patterns = Counter()
    for g in good:
        patterns["".join("-" if rng.random() < 0.2 else "gb"[int((rng.random() < p) != g)]
                         for p in right)] += 1
    prior, rates, posterior = quality.fit(patterns)
    assert abs(prior - 0.8) < 0.03
    for r, p in enumerate(right):
        assert abs(rates[1, r, 0] / (rates[1, r, 0] + rates[1, r, 1]) - p) < 0.04
    assert posterior["gggg"] > 0.99 > 0.5 > posterior["bbbb"]


def test_verdicts_follow_the_labels(spark):
    """Held-out labels: the rules never see them."""
    folder = "/root/testdata/sf0.01"
    found = quality.score(spark.read.parquet(folder + "/documents.parquet"))
    labels = spark.read.parquet(folder + "/labels.parquet")
    rows = found.join(labels, "doc_id").filter("not base_failed").collect()
    clean = [r.kept for r in rows if r.quality == 1]
    junk = [r.kept for r in rows if r.quality == 0]
    assert np.mean(clean) > 0.99 and np.mean(junk) < 0.1


def test_kept_documents_keep_their_columns(docs, no_docs):
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in quality.score(docs).filter("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == ids
    assert quality.keep_good(no_docs).count() == quality.score(no_docs).count() == 0
