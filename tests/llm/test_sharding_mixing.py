import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tidegauge.llm import mixing, sharding
from tidegauge.session import scratch_dir


def test_shards_of_tricky_rows(spark, docs):
    rows = sharding.shard_documents(docs, 4, scratch_dir(spark, "maps")).collect()
    assert len(rows) == docs.count()
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(
            range(sum(r.shard == shard for r in rows)))
    want = Counter((t.doc_id, len((t.text or "").encode()) + 1, zlib.crc32((t.text or "").encode()))
                   for t in docs.select("doc_id", "text").collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want


def test_shards_are_near_equal_in_bytes(spark, sample):
    rows = sharding.shard_documents(sample, 8, scratch_dir(spark, "maps"))
    sums = [r["sum(size)"] for r in rows.groupBy("shard").sum("size").collect()]
    largest = rows.agg(F.max("size")).first()[0]
    assert len(sums) == 8 and max(sums) - min(sums) <= largest


def test_no_rows_to_shard(spark, no_docs):
    assert sharding.shard_documents(no_docs, 4, scratch_dir(spark, "maps")).count() == 0


def test_rebalancing_moves_slots_only_where_needed(spark):
    loads = {s: (100 + s % 7, 1) for s in range(512)}
    first = sharding.new_map(loads, 4, 512)
    more = sharding.rebalanced(first, loads, 5)
    assert {more[s] for s in more if more[s] != first[s]} == {4}
    sums = defaultdict(int)
    for s, shard in more.items():
        sums[shard] += loads[s][0]
    assert max(sums.values()) - min(sums.values()) <= 110
    fewer = sharding.rebalanced(first, loads, 3)
    assert set(fewer.values()) == {0, 1, 2}
    assert sharding.rebalanced(more, loads, 5) == more
    folder = scratch_dir(spark, "maps")
    for version, found in ((1, first), (2, more)):
        sharding.save_map(sharding.map_table(spark, found, loads, version), folder)
    loaded = {r.vslot: r.shard for r in sharding.load_map(spark, folder).collect()}
    assert loaded == more
    assert {r.vslot: r.shard for r in sharding.load_map(spark, folder, 1).collect()} == first


def test_written_shards_hold_each_record_once(spark, sample):
    assigned = sharding.shard_documents(sample, 3, scratch_dir(spark, "maps"))
    path = scratch_dir(spark, "shards")
    sharding.write_shards(sample, assigned, path)
    back = spark.read.parquet(path)
    assert back.count() == sample.count() == back.select("doc_id").distinct().count()
    assert back.select("doc_id", "shard").exceptAll(assigned.select("doc_id", "shard")).count() == 0


def targets_by_rounds(sizes, weights=(5, 2, 1)):
    """The targets as their definition goes: share, stop, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, stopped = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in stopped]
        whole = sum(weight[s] for s in free)
        got = {s: left * weight[s] / whole for s in free}
        over = [s for s in free if got[s] > 2 * sizes[s]]
        if not over:
            return {**stopped, **got}
        for s in over:
            stopped[s] = 2.0 * sizes[s]
            left -= 2 * sizes[s]


def test_targets_equal_rounds_of_sharing(spark):
    for sizes in ({"a": 100, "b": 1, "c": 50, None: 7}, {"a": 10}, {"a": 5, "b": 0, "c": 100},
                  {f"s{i:02}": (i * 37) % 91 for i in range(30)}):
        table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        found = {r.source: r.target for r in mixing.targets(table).collect()}
        want = targets_by_rounds(sizes)
        assert found.keys() == want.keys()
        assert all(abs(found[s] - want[s]) < 1e-6 for s in want)


def test_mix_of_tricky_rows(docs):
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    size = Counter()
    for r in rows:
        size[r.source] += r["size"]
        assert 0 <= r.taken <= 2 * r["size"] and r.taken == r.copies * r["size"]
    want = targets_by_rounds(size)
    for r in rows:
        assert r.source_size == size[r.source] and abs(r.target - want[r.source]) < 1e-6
    again = mixing.mix(docs).collect()
    key = lambda r: (str(r.doc_id), str(r.source), r["size"], r.taken)
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_taken_words_come_within_a_document_of_the_target(sample):
    rows = mixing.mix(sample).collect()
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r["size"] for r in own)


def test_mixed_documents_come_as_often_as_taken(docs, no_docs):
    whole = mixing.mixed(docs)
    assert whole.columns == docs.columns
    taken = sum(r.copies for r in mixing.mix(docs).collect())
    assert whole.count() == taken
    assert mixing.mixed(no_docs).count() == mixing.mix(no_docs).count() == 0
