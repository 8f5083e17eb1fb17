"""Wide rows to cells of a wide-column table and back.

A cell is (row_key, family, qualifier, value). Each encoder emits all cells of a row from
one ``inline`` over the row, so the input is read and parsed once however many families it
feeds. Null fields have no cell. A ``seq`` column of the input goes along with each cell;
it orders writes to the same cell.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge import schemas
from tidegauge.functions.doublebytes import double_from_bytes, double_to_bytes
from tidegauge.operators.filters import LOW_PRESSURE, is_alert

# The qualifiers stored for each kind of row.
SENSOR_TEXT = ["resid", "date"] + schemas.METRICS
SENSOR_BINARY = list(schemas.METRICS)
# Both spellings are found in stored tables.
RESID_QUALIFIERS = ["resid", "resID"]
# Fixed value: the order in which families of a row are read; the last one wins.
FAMILIES = ["alert", "data"]


def sensor_key():
    return F.concat("resid", F.lit("_"), "date", F.lit(" "), "time")


def vmstat_key():
    return F.concat("DATE", F.lit(" "), "TIME")


def employee_key():
    """The employee's number, so that no two employees share a row."""
    return F.col("emp_no").cast("string")


def by_row(df, key):
    """``df`` with the rows of a key in one task, for cells that are then grouped by their keys.

    Cells are many times the rows that they are made from, so the rows are shuffled, and grouping the
    cells needs no shuffle of its own.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def _coded(df, columns, encoding):
    """``df`` with the stored form of each column beside it, made once for all its cells."""

    def stored(c):
        if encoding == "text":
            return F.col(c).cast("string")
        if isinstance(df.schema[c].dataType, T.DoubleType):
            return double_to_bytes(F.col(c))
        return F.encode(F.col(c).cast("string"), "UTF-8")

    if encoding not in ("text", "binary"):
        raise ValueError(f"unknown encoding {encoding!r}")
    return df.withColumns({f"_stored_{c}": stored(c) for c in columns})


def _family(columns, family, names=None, only=None):
    """A row's cells in one family; null, and so not emitted, where not ``only``."""
    names = names or {}

    def value(c):
        stored = F.col(f"_stored_{c}")
        return stored if only is None else F.when(only, stored)

    return [F.struct(F.lit(family).alias("family"), F.lit(names.get(c, c)).alias("qualifier"),
                     value(c).alias("value"))
            for c in columns]


def _emit(df, key, cells):
    seq = ["seq"] if "seq" in df.columns else []
    out = df.select(key.alias("row_key"), F.inline(cells), *seq)
    return out.filter(F.col("value").isNotNull())


def encode_cells(df, key, columns=None, family="data", encoding="text", names=None):
    """One cell for each column; ``names`` renames columns to other qualifiers.

    ``text`` stores every value as text. ``binary`` stores doubles as eight big-endian
    bytes and text as UTF-8.
    """
    columns = columns or [c for c in df.columns if c != "seq"]
    return _emit(_coded(df, columns, encoding), key, F.array(*_family(columns, family, names)))


def encode_alert_cells(df, encoding="text"):
    """The psi cell of the ``alert`` family."""
    return _emit(_coded(df, ["psi"], encoding), sensor_key(),
                 F.array(*_family(["psi"], "alert")))


def route(df, mode="both", encoding="text", threshold=LOW_PRESSURE, columns=None, names=None):
    """Sensor rows to the ``data`` and ``alert`` families.

    ``both``: every row to ``data`` and low pressure to ``alert`` as well. ``exclusive``:
    low pressure to ``alert`` only, all other rows to ``data``.
    """
    low = is_alert("psi", threshold)
    if mode == "both":
        columns = columns or (SENSOR_TEXT if encoding == "text" else SENSOR_BINARY)
        cells = F.array(*_family(columns, "data", names), *_family(["psi"], "alert", only=low))
    elif mode == "exclusive":
        columns = columns or SENSOR_BINARY
        data = F.array(*_family(columns, "data", names))
        cells = F.when(low, F.array(*_family(["psi"], "alert"))).otherwise(data)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    coded = _coded(df, dict.fromkeys([*columns, "psi"]), encoding)
    return _emit(coded, sensor_key(), cells)


def vmstat_cells(df):
    """The 16 counters of time-stamped vmstat rows; date and time are the key only."""
    return encode_cells(df, vmstat_key(), schemas.VMSTAT_COUNTERS)


def employee_cells(df):
    return encode_cells(df, employee_key(), schemas.EMPLOYEE.fieldNames())


def _placed(cells, families):
    """Cells with ``_place``, which orders the writes that could fill the same column."""
    place = F.lit(0)
    for i, family in enumerate(families, 1):
        place = F.when(F.col("family") == family, F.lit(i)).otherwise(place)
    if "seq" in cells.columns:
        place = F.struct(place, "seq")
    return cells.withColumn("_place", place)


def _last(value, qualifiers):
    return F.max_by(value, F.when(F.col("qualifier").isin(*qualifiers), F.col("_place")))


def decode_cells(cells, encoding="text", families=FAMILIES):
    """Cells back to sensor rows, one for each row key.

    A missing cell reads as 0.0 or an empty string, an unknown qualifier is left out, a
    value that is no number fails the query. When both families hold psi, ``data`` wins.

    One aggregation with one shuffle; the cells of a row meet partly before it. Families
    are ranked and numbers in text read ahead of it, so that it carries mostly numbers; the
    bytes of a number are decoded after it, when there is one for each row and metric.
    """
    known = cells.filter(F.col("qualifier").isin(*RESID_QUALIFIERS, "date", *schemas.METRICS))
    placed = _placed(known, families)
    if encoding == "text":
        wrong = F.raise_error(F.concat(F.lit("bad cell: "), "qualifier", F.lit(" "), "value"))
        number = F.when(F.col("qualifier").isin(*schemas.METRICS),
                        F.coalesce(F.col("value").try_cast("double"), wrong))
        placed, stored = placed.withColumn("_number", number), "_number"
    elif encoding == "binary":
        stored = "value"
    else:
        raise ValueError(f"unknown encoding {encoding!r}")
    rows = placed.groupBy("row_key").agg(
        _last("value", RESID_QUALIFIERS).alias("resID"), _last("value", ["date"]).alias("date"),
        *[_last(stored, [m]).alias(m) for m in schemas.METRICS])

    def text(name):
        return F.decode(name, "UTF-8") if encoding == "binary" else F.col(name)

    def number(name):
        return double_from_bytes(F.col(name)) if encoding == "binary" else F.col(name)

    return rows.select(
        F.col("row_key").alias("key"),
        *[F.coalesce(text(c), F.lit("")).alias(c) for c in ("resID", "date")],
        *[F.coalesce(number(m), F.lit(0.0)).alias(m) for m in schemas.METRICS])


def project_family(cells, family, qualifiers):
    """Named columns of one family as text, one row for each key, the key left out."""
    found = cells.filter((F.col("family") == family) & F.col("qualifier").isin(*qualifiers))
    rows = _placed(found, [family]).groupBy("row_key").agg(
        *[_last("value", [q]).alias(q) for q in qualifiers])
    return rows.select(*qualifiers)
