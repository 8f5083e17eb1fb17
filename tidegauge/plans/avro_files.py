"""Writes test inputs as Avro files where the Avro data source is not installed.

Each task encodes its partition as one object container file. Spark's text writer puts the bytes into files, on any
file system that Spark reaches: the sync marker, which ends the header and each block, is the line separator.
"""

import json
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.sources import files
from tidegauge.sources.employees import has_avro

# Avro type names.
_TYPES = {T.IntegerType(): "int", T.LongType(): "long", T.StringType(): "string"}


def write_avro(df, path):
    """Write ``df`` (int, long and string columns, null or not) as files ``*.avro`` in the new folder ``path``."""
    spark = df.sparkSession
    if has_avro(spark):
        df.write.format("avro").save(path)
        return
    schema = json.dumps({
        "type": "record", "name": "row",
        "fields": [{"name": f.name, "type": ["null", _TYPES[f.dataType]]} for f in df.schema]})
    kinds = [_TYPES[f.dataType] for f in df.schema]

    # Defined here so that it travels to the workers by value, without the package.
    def encode(batches):
        import pyarrow as pa

        def number(n):
            n = (n << 1) ^ (n >> 63)
            out = bytearray()
            while n & ~0x7F:
                out.append(n & 0x7F | 0x80)
                n >>= 7
            out.append(n)
            return bytes(out)

        def text(s):
            raw = s.encode("utf-8") if isinstance(s, str) else s
            return number(len(raw)) + raw

        def field(v, kind):
            if v is None:
                return number(0)
            return number(1) + (text(v) if kind == "string" else number(v))

        def line(raw):
            return pa.RecordBatch.from_pydict({"value": pa.array([raw], pa.binary())})

        meta = {"avro.schema": schema, "avro.codec": "null"}
        yield line(b"Obj\x01" + number(len(meta))
                   + b"".join(text(k) + text(v) for k, v in meta.items()) + number(0))
        for batch in batches:
            if not batch.num_rows:
                continue
            # Strings as bytes: not all that Spark holds can be decoded.
            columns = [(c.cast(pa.binary()) if kind == "string" else c).to_pylist()
                       for kind, c in zip(kinds, batch.columns)]
            body = b"".join(
                field(v, kind) for row in zip(*columns) for kind, v in zip(kinds, row))
            yield line(number(batch.num_rows) + number(len(body)) + body)

    lines = df.mapInArrow(encode, "value binary").select(F.col("value").cast("string"))
    sync = uuid.uuid4().hex[:16]
    lines.write.options(lineSep=sync, compression="none", maxRecordsPerFile=0).text(path)
    for name, size in files.sizes(spark, path).items():
        if size and name.startswith("part-"):  # without a partition there is one file of no bytes
            files.rename(spark, f"{path}/{name}", f"{path}/{name.removesuffix('.txt')}.avro")
