"""Lines to typed rows.

``strict`` fails the query on the first bad line, whichever columns the query goes on to
read. ``permissive`` keeps every line: a good one has null in ``_bad``, a bad one holds the
line there and null elsewhere; ``good_rows`` and ``bad_rows`` split the two.

Each parser emits its row through ``inline``. That is a barrier on purpose: a filter
written after it runs on the parsed values, so every line is split and parsed once and
none escapes its check. Pushed below, the same filter would repeat the split for each
column it mentions, which measured four times slower.

Columns beside ``value`` (a sequence number, say) pass through.
"""

from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge import schemas
from tidegauge.functions.numbers import read_number, valid_number
from tidegauge.functions.text import blank_fields, comma_fields
from tidegauge.operators.filters import drop_lines_containing

BAD = "_bad"


def good_rows(df):
    return df.filter(F.col(BAD).isNull()).drop(BAD)


def bad_rows(df):
    others = [c for c in df.columns if c == BAD or c == "seq"]
    return df.filter(F.col(BAD).isNotNull()).select(*others)


def _rows(lines, parts, schema, positions, mode, what):
    """One typed row for each line whose fields at ``positions`` fit ``schema``."""
    split = lines.withColumn("_parts", parts)
    # Each number is read once, here; the check and the row below use the result.
    texts = {p: F.get("_parts", F.lit(p)) for p in positions}
    numbers = {p: read_number(texts[p], f.dataType).alias(f"_{p}")
               for f, p in zip(schema, positions) if not isinstance(f.dataType, T.StringType)}
    typed = split.select("*", *numbers.values())
    ok = F.size("_parts") > max(positions)
    for f, p in zip(schema, positions):
        if p in numbers:
            ok = ok & valid_number(texts[p], F.col(f"_{p}"), f.dataType)
    values = [(F.col(f"_{p}") if p in numbers else texts[p]).alias(f.name)
              for f, p in zip(schema, positions)]
    if mode == "strict":
        wrong = F.raise_error(F.concat(F.lit(f"bad {what} line: "),
                                       F.coalesce("value", F.lit("null"))))
        row = F.array(F.when(ok, F.struct(*values)).otherwise(wrong))
    elif mode == "permissive":
        good = F.struct(*values, F.lit(None).cast("string").alias(BAD))
        bad = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema],
                       F.coalesce("value", F.lit("")).alias(BAD))
        row = F.array(F.when(ok, good).otherwise(bad))
    elif mode == "drop":
        row = F.when(ok, F.array(F.struct(*values)))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    passed = [c for c in lines.columns if c != "value"]
    return typed.select(F.inline(row), *passed)


def _comma_rows(lines, schema, mode, what, line=None):
    parts = comma_fields(F.col("value") if line is None else line)
    return _rows(lines, parts, schema, range(len(schema)), mode, what)


def parse_sensor(lines, mode="strict"):
    return _comma_rows(lines, schemas.SENSOR, mode, "sensor")


def parse_pump(lines, mode="strict"):
    return _comma_rows(lines, schemas.PUMP, mode, "pump")


def parse_maint(lines, mode="strict"):
    return _comma_rows(lines, schemas.MAINT, mode, "maintenance")


def parse_employee(lines, quotes="strip", mode="strict"):
    """``strip`` deletes every double quote before the split, ``keep`` leaves them."""
    if quotes not in ("strip", "keep"):
        raise ValueError(f"unknown quotes {quotes!r}")
    line = F.col("value")
    if quotes == "strip":
        line = F.replace(line, F.lit('"'), F.lit(""))
    return _comma_rows(lines, schemas.EMPLOYEE, mode, "employee", line)


def parse_vmstat(lines, mode="strict"):
    """vmstat output. Field 0 is what stands before the line's leading blank.

    ``strict`` and ``permissive`` leave out header lines and want fields 1 to 17;
    ``lenient`` wants date and time in fields 18 and 19 and drops every shorter line.
    """
    parts = blank_fields(F.col("value"))
    if mode == "lenient":
        positions = [*range(1, 17), 18, 19]
        return _rows(lines, parts, schemas.VMSTAT_STAMPED, positions, "drop", "vmstat")
    body = drop_lines_containing(lines, ["memory", "buff"])
    return _rows(body, parts, schemas.VMSTAT, range(1, 18), mode, "vmstat")


def conform(df, schema, key=None, null_key="reject"):
    """Select the schema's fields by name and type.

    A null ``key`` is kept aside in ``_bad`` as JSON (``reject``), becomes 0 (``zero``) or
    fails the query (``fail``).
    """
    fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
    if key is None:
        return df.select(*fields)
    record = F.to_json(F.struct(*[f.name for f in schema]))
    if null_key == "reject":
        return df.select(*fields, F.when(F.col(key).isNull(), record).alias(BAD))
    if null_key == "zero":
        whole = F.coalesce(F.col(key), F.lit(0)).cast(schema[key].dataType).alias(key)
    elif null_key == "fail":
        wrong = F.raise_error(F.concat(F.lit(f"record without {key}: "), record))
        whole = F.when(F.col(key).isNotNull(), F.col(key).cast(schema[key].dataType)) \
            .otherwise(wrong).alias(key)
    else:
        raise ValueError(f"unknown null_key {null_key!r}")
    return df.select(*[whole if f.name == key else c for f, c in zip(schema, fields)])


def project_posts(df, id="id", text="text", created_at="created_at"):
    """Posts as (id, text, created_at), the time as text, and their ``seq`` if they have one."""
    seq = ["seq"] if "seq" in df.columns else []
    return df.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text"),
                     F.col(created_at).cast("string").alias("created_at"), *seq)


# Objects whose fields drift --------------------------------------------------------------

REST = "_rest"


def parse_objects(lines, schema, key=None):
    """JSON lines bound to the schema by name, whatever else the objects hold.

    Each line is read once, into a variant. Fields that the schema does not name are kept in
    ``_rest``, a map of their values as JSON text. A line that is no object, or has a field that does
    not fit its type, or no ``key``, is a bad row: it is in ``_bad`` and null elsewhere (see
    ``good_rows``). A missing or null field is null.
    """
    read = lines.withColumn("_v", F.try_parse_json("value"))
    json = F.to_json("_v")
    read = read.withColumn("_fields", F.when(
        F.startswith(json, F.lit("{")), F.from_json(json, "map<string,string>")))
    names = schema.fieldNames()
    found = {f.name: F.try_variant_get("_v", f"$['{f.name}']", f.dataType.simpleString())
             for f in schema}
    typed = read.select("*", *[found[n].alias(f"_{i}") for i, n in enumerate(names)])
    ok = F.col("_fields").isNotNull()
    for i, f in enumerate(schema):
        text = F.try_element_at("_fields", F.lit(f.name))
        fits = F.col(f"_{i}").isNotNull()
        if isinstance(f.dataType, T.IntegralType):  # a variant's fraction would be cut off
            fits = fits & text.rlike(r"^[+-]?\d+$")
        ok = ok & (fits | text.isNull())
    if key is not None:
        ok = ok & F.col(f"_{names.index(key)}").isNotNull()
    rest = F.map_filter("_fields", lambda k, v: ~k.isin(names))
    good = F.struct(*[F.col(f"_{i}").alias(n) for i, n in enumerate(names)], rest.alias(REST),
                    F.lit(None).cast("string").alias(BAD))
    bad = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema],
                   F.lit(None).cast("map<string,string>").alias(REST),
                   F.coalesce("value", F.lit("")).alias(BAD))
    passed = [c for c in lines.columns if c != "value"]
    return typed.select(F.inline(F.array(F.when(F.coalesce(ok, F.lit(False)), good).otherwise(bad))),
                        *passed)


# Counts of what a parser leaves out ------------------------------------------------------

class Counts:
    """Lines read, rows kept and rows marked bad, counted in the pass that reads them."""

    def __init__(self):
        self.lines, self.rows = Observation(), Observation()

    def get(self):
        """The counts as a dict; waits for the first action on the rows to end."""
        read, made = self.lines.get, self.rows.get
        return {"read": read["n"], "kept": made["n"] - made["bad"], "bad": made["bad"],
                "dropped": read["n"] - made["n"]}


def counted(lines, parse, *args, **options):
    """(rows of ``parse(lines)``, their ``Counts``); nothing is read twice for them.

    For a stream the counts are in its progress, by the names ``lines`` and ``rows``, and the second
    result is None.
    """
    def made_of(df):
        bad = F.count(BAD) if BAD in df.columns else F.count(F.lit(None))
        return F.count(F.lit(1)).alias("n"), bad.alias("bad")

    if lines.isStreaming:
        rows = parse(lines.observe("lines", F.count(F.lit(1)).alias("n")), *args, **options)
        return rows.observe("rows", *made_of(rows)), None
    counts = Counts()
    rows = parse(lines.observe(counts.lines, F.count(F.lit(1)).alias("n")), *args, **options)
    return rows.observe(counts.rows, *made_of(rows)), counts
