"""Keyed tables on Parquet: the last row written for a key wins.

Where a table format or a store with a MERGE of its own is installed, use that (``sinks.write_store``).
Parquet has none, so a write unites the stored rows of its buckets with its own, takes the newest of
each key and overwrites those buckets, as folders ``data/bucket=<hash of the key>``. A write costs as
much as the buckets of its keys: choose ``buckets`` so that one holds some gigabytes, and batches
that touch few.

Small files beside the data tell what is there: ``_table.json`` the columns and keys, ``_done/<n>.json``
the last batch of each stream after write n. The new buckets are written aside first; while they are
put in place, ``_writing.json`` names them. A job that died there is finished by the next one's
``ensure_table``. One writer at a time: another one's write in between is an error (``TableChanged``).
"""

import functools
import json
import operator
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge import schemas
from tidegauge.session import scratch_dir
from tidegauge.sources import files


class TableChanged(RuntimeError):
    """Another writer is at work or was first; read again and retry."""


def ensure_table(spark, path, schema, keys, buckets, bucket_by=None):
    """Create an empty table unless there is one; returns whether it was created.

    A table of other columns or keys at that place is an error. ``bucket_by``, by default the keys,
    must be among the keys. A write that was broken off is finished.
    """
    bucket_by = list(bucket_by or keys)
    if not keys or not set(keys) <= set(schema.fieldNames()) or not set(bucket_by) <= set(keys):
        raise ValueError(f"bad keys {keys} or bucket_by {bucket_by}")
    table = {"schema": schema.jsonValue(), "keys": list(keys), "buckets": buckets,
             "bucket_by": bucket_by}
    files.make_dir(spark, f"{path}/_done")
    files.make_dir(spark, f"{path}/data")
    try:
        files.create_text(spark, f"{path}/_table.json", json.dumps(table))
        return True
    except files.FileTaken:
        there = _table(spark, path)
    columns = [(f.name, f.dataType) for f in _schema(there)]
    if columns != [(f.name, f.dataType) for f in schema] or there["keys"] != list(keys):
        raise ValueError(f"the table at {path} has other columns or keys")
    if files.exists(spark, f"{path}/_writing.json"):
        _put_in_place(spark, path, there)
    return False


def _table(spark, path):
    if not files.exists(spark, f"{path}/_table.json"):
        raise FileNotFoundError(f"no table at {path}")
    return json.loads(files.read_text(spark, f"{path}/_table.json"))


def _done(spark, path):
    """(number of writes, last batch of each stream)."""
    marks = files.names(spark, f"{path}/_done")
    marks = [m for m in marks if m.endswith(".json") and not m.startswith(".")]
    if not marks:
        return 0, {}
    return int(marks[-1][:-5]), json.loads(files.read_text(spark, f"{path}/_done/{marks[-1]}"))


def _schema(table):
    return T.StructType.fromJson(table["schema"])


def _stored_schema(table):
    return T.StructType([*_schema(table), T.StructField("bucket", T.IntegerType())])


def _bucket(table):
    return F.pmod(F.xxhash64(*table["bucket_by"]), F.lit(table["buckets"])).cast("int")


def read_table(spark, path, columns=None):
    """The table as of now. Name the ``columns`` you need: others are then not read."""
    table = _table(spark, path)
    rows = spark.read.schema(_stored_schema(table)).parquet(f"{path}/data")
    return rows.select(*(columns or _schema(table).fieldNames()))


def table_head(spark, path, n=5, ordered=True):
    """``n`` rows of the table, by default the first by key."""
    rows = read_table(spark, path)
    return (rows.orderBy(*_table(spark, path)["keys"]) if ordered else rows).limit(n)


def _newest_rows(df, keys, order):
    """The row with the greatest ``order`` for each key, partly reduced before the shuffle.

    All columns follow in the comparison, so equal orders are decided the same way always.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not rest:
        return df.select(*keys).distinct()
    picked = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_r"))
    return picked.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def limit_text(df, max_len, on_long="fail"):
    """Enforce the longest text of columns, ``{column: characters}``.

    ``fail`` fails the query on a longer text, ``truncate`` cuts it, ``reject`` leaves the
    row out; ``too_long`` gives the rows left out.
    """
    for name, n in max_len.items():
        long = F.char_length(name) > n
        if on_long == "fail":
            wrong = F.raise_error(F.lit(f"text of {name} longer than {n}"))
            df = df.withColumn(name, F.when(long, wrong).otherwise(F.col(name)))
        elif on_long == "truncate":
            df = df.withColumn(name, F.substring(name, 1, n))
        elif on_long == "reject":
            df = df.filter(~F.coalesce(long, F.lit(False)))
        else:
            raise ValueError(f"unknown on_long {on_long!r}")
    return df


def too_long(df, max_len):
    cond = F.lit(False)
    for name, n in max_len.items():
        cond = cond | F.coalesce(F.char_length(name) > n, F.lit(False))
    return df.filter(cond)


def _one_per_key(df, keys, seq, columns):
    key_ok = functools.reduce(operator.and_, [F.col(k).isNotNull() for k in keys])
    wrong = F.raise_error(F.lit(f"null in key {keys}"))
    rest = [c for c in columns if c not in keys]
    checked = rest[0] if rest else keys[0]  # a key as it came keeps rows where they were dealt by it
    df = df.withColumn(checked, F.when(key_ok, F.col(checked)).otherwise(wrong))
    if seq is not None:
        ordered = df.select(*columns, F.col(seq).alias("_seq"))
        return _newest_rows(ordered, keys, ["_seq"])
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"),
                                    F.max(F.struct(F.lit(0), *rest)).alias("_r"))
    twice = F.raise_error(F.concat(F.lit("key written twice in one batch without seq: "),
                                   F.to_json(F.struct(*keys))))
    first = F.when(F.col("_n") == 1, F.col(keys[0])).otherwise(twice).alias(keys[0])
    return grouped.select(first, *keys[1:], *[F.col(f"_r.{c}").alias(c) for c in rest])


def upsert(spark, path, df, seq=None, columns=None, batch_id=None, stream="default",
           max_len=None, on_long="fail"):
    """Insert or replace rows by key; returns whether anything was applied.

    ``seq`` names the column that orders rows of equal key within ``df``; without it a key
    that comes twice fails the query. ``columns`` limits what is written: other columns keep
    their stored value, or are null for a new key. With ``batch_id``, a batch of ``stream``
    that was applied before is skipped.
    """
    table, (number, applied) = _table(spark, path), _done(spark, path)
    if batch_id is not None and batch_id <= applied.get(stream, -1):
        return False
    schema, keys = _schema(table), table["keys"]
    columns = columns or schema.fieldNames()
    missing = [c for c in keys if c not in columns]
    if missing:
        raise ValueError(f"columns lack the keys {missing}")
    if max_len:
        df = limit_text(df, max_len, on_long)
    typed = [F.col(c).cast(schema[c].dataType).alias(c) for c in columns]
    carried = [seq] if seq is not None and seq not in columns else []
    rows = _one_per_key(df.select(*typed, *carried), keys, seq, columns)
    rows = rows.withColumn("bucket", _bucket(table))
    aside = scratch_dir(spark, "table-batch")
    rows.write.parquet(aside)  # once, to know which buckets it has
    rows = spark.read.schema(rows.schema).parquet(aside)
    found = [r[0] for r in rows.select("bucket").distinct().collect()]
    if found:
        ready = f"{path}/_next-{uuid.uuid4().hex}"
        merged = _united(_stored(spark, path, table, found), rows, table, columns)
        merged.write.partitionBy("bucket").parquet(ready)
    files.remove_tree(spark, aside)
    applied = applied if batch_id is None else {**applied, stream: batch_id}
    try:
        _commit(spark, path, table, number, found and ready, applied)
    except TableChanged:
        if found:
            files.remove_tree(spark, ready)
        raise
    return True


def _stored(spark, path, table, buckets):
    rows = spark.read.schema(_stored_schema(table)).parquet(f"{path}/data")
    return rows.filter(F.col("bucket").isin(buckets))


def _united(stored, rows, table, columns):
    """One row for each key of both: the written columns of ``rows``, if there, the rest as stored.

    The one shuffle is by bucket and part of a bucket, for the write that follows. It comes before any
    grouping: rows of a table are packed so tightly that a split's would not fit a task when sorted.
    """
    schema, keys = _schema(table), table["keys"]
    new = [c for c in columns if c not in keys]
    kept = [c for c in schema.fieldNames() if c not in columns]
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64(F.lit("part"), *keys), F.lit(max(1, tasks // table["buckets"])))
    both = stored.withColumn("_turn", F.lit(0)).unionByName(
        rows.withColumn("_turn", F.lit(1)), allowMissingColumns=True)
    dealt = both.withColumn("_part", part).repartition("bucket", "_part")
    grouped = dealt.groupBy("bucket", "_part", *keys).agg(
        F.max_by(F.struct(F.lit(0), *new), "_turn").alias("_new"),
        F.max_by(F.struct(F.lit(0), *kept), F.when(F.col("_turn") == 0, 0)).alias("_kept"))
    values = {**{c: F.col(f"_new.{c}") for c in new}, **{c: F.col(f"_kept.{c}") for c in kept}}
    return grouped.select(*[values.get(c, F.col(c)).alias(c) for c in schema.fieldNames()], "bucket")


def _commit(spark, path, table, number, ready, applied):
    """Put the buckets written to ``ready`` in place, unless another write was first."""
    note = json.dumps({"number": number, "ready": ready or None, "applied": applied})
    try:
        files.create_text(spark, f"{path}/_writing.json", note)
    except files.FileTaken as e:
        raise TableChanged(path) from e
    if _done(spark, path)[0] != number:
        files.remove(spark, f"{path}/_writing.json")
        raise TableChanged(path)
    _put_in_place(spark, path, table)


def _put_in_place(spark, path, table):
    """Overwrites the buckets that ``_writing.json`` names; a second time changes nothing."""
    note = json.loads(files.read_text(spark, f"{path}/_writing.json"))
    number = note["number"]
    if _done(spark, path)[0] == number:
        for bucket in files.names(spark, note["ready"]) if note["ready"] else []:
            if bucket.startswith("bucket="):  # those not moved yet
                files.move_tree(spark, f"{note['ready']}/{bucket}", f"{path}/data/{bucket}")
        files.create_text(spark, f"{path}/_done/{number + 1:010d}.json", json.dumps(note["applied"]))
        files.remove(spark, f"{path}/_done/{number:010d}.json")
    files.remove(spark, f"{path}/_writing.json")
    if note["ready"]:
        files.remove_tree(spark, note["ready"])


def ensure_cells(spark, path, buckets, binary=False):
    """A cell table. All cells of a row are in one bucket."""
    schema = schemas.BINARY_CELL if binary else schemas.CELL
    return ensure_table(spark, path, schema, schemas.CELL_KEYS, buckets, ["row_key"])


def write_cells(spark, path, cells, batch_id=None, stream="default"):
    """Put cells: for each (row_key, family, qualifier) the last write wins."""
    seq = "seq" if "seq" in cells.columns else None
    return upsert(spark, path, cells, seq, batch_id=batch_id, stream=stream)
