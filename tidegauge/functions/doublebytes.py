"""Doubles as eight big-endian bytes and back.

Spark has no such cast. Both directions are one Arrow batch call on whole columns: on four
million sensor rows that took half the time of the JVM route (``reflect`` and hex text).
"""

from pyspark.sql import functions as F


def _arrow(function, returns):
    import pyarrow as pa

    function.__annotations__ = {"values": pa.Array, "return": pa.Array}
    return F.arrow_udf(function, returns)


# The functions are defined inside so that they travel to the workers by value, without
# the package.

def double_to_bytes(column):
    def encode(values):
        import pyarrow as pa
        import pyarrow.compute as pc

        gone = values.is_null()
        raw = values.fill_null(0.0).to_numpy().astype(">f8").tobytes()
        coded = pa.FixedSizeBinaryArray.from_buffers(
            pa.binary(8), len(values), [None, pa.py_buffer(raw)]).cast(pa.binary())
        return pc.if_else(gone, pa.scalar(None, pa.binary()), coded)

    return _arrow(encode, "binary")(column)


def double_from_bytes(column):
    def decode(values):
        import numpy as np
        import pyarrow as pa

        gone = values.is_null().to_numpy(zero_copy_only=False)
        # Fails on a stored value of any other length.
        fixed = values.fill_null(bytes(8)).cast(pa.binary(8))
        raw = np.frombuffer(fixed.buffers()[1], dtype=">f8", count=len(fixed),
                            offset=8 * fixed.offset)
        return pa.array(raw.astype("f8"), mask=gone)

    return _arrow(decode, "double")(column)
