"""The jobs' inputs, derived by Spark from the given tables.

``seq`` is the order of the rows, for writes to the same key.
"""

from pyspark.sql import functions as F

from tidegauge import schemas
from tidegauge.sources import files, widen


def table(spark, sf_dir, name):
    return widen(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def stream_table(spark, sf_dir, name):
    """The table's files as a stream; the table is one file or a folder of files."""
    path = f"{sf_dir}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files.is_dir(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def _date(ts):
    """The date of a timestamp without zone, whatever the session's zone."""
    return F.substring(F.col(ts).cast("string"), 1, 10)


def _time(ts):
    return F.substring(F.col(ts).cast("string"), 12, 8)


def _device(column):
    return F.concat(F.lit("R"), F.col(column).cast("string"))


def sensor_lines(events):
    """``resid,date,time,hz,disp,flo,sedPPM,psi,chlPPM`` for each event."""
    fields = [
        _device("user_id"),
        _date("ts"),
        _time("ts"),
        F.col("value"),
        F.get_json_object("props", "$.k").cast("double"),
        (F.col("event_id") % 100).cast("double"),
        F.col("user_id").cast("double"),
        F.col("value"),
        F.hour("ts").cast("double"),
    ]
    line = F.concat_ws(",", *[f.cast("string") for f in fields])
    return events.select(line.alias("value"), F.col("event_id").alias("seq"))


def pump_lines(customer, nation):
    fields = [_device("c_custkey"), F.col("c_mktsegment"), F.lit("2015-03-01"),
              F.lit("2016-04-02"), F.col("n_name"), F.col("c_custkey") % 180,
              F.col("c_custkey") % 90]
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(F.concat_ws(",", *[f.cast("string") for f in fields]).alias("value"))


def maint_lines(orders):
    fields = [_device("o_custkey"), F.col("o_orderdate").cast("date"),
              F.col("o_orderpriority"), F.col("o_orderstatus")]
    return orders.select(F.concat_ws(",", *[f.cast("string") for f in fields]).alias("value"))


def employees(customer):
    return customer.select(
        F.col("c_custkey").cast("bigint").alias("emp_no"),
        F.lit("1960-01-01").alias("birth_date"),
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.when(F.col("c_custkey") % 2 == 0, "M").otherwise("F").alias("gender"),
        F.lit("1990-01-01").alias("hire_date"))


def employee_lines(rows, quoted):
    """Employee CSV; ``quoted`` puts every field in double quotes."""
    mark = '"' if quoted else ""
    fields = [F.concat(F.lit(mark), F.col(f.name).cast("string"), F.lit(mark))
              for f in schemas.EMPLOYEE]
    return rows.select(F.concat_ws(",", *fields).alias("value"))


# The two header lines vmstat repeats.
VMSTAT_HEADER = [
    "procs -----------memory---------- ---swap-- -----io---- -system-- ------cpu-----",
    " r  b   swpd   free   buff  cache   si   so    bi    bo   in   cs us sy id wa st",
]


def vmstat_lines(events, stamped=False):
    """One vmstat line for each event and a header at every hundredth; ``stamped`` lines
    end in date and time, and each header is then followed by a line cut short."""
    tokens = [(F.col("event_id") * i % 1000).cast("string") for i in range(1, 18)]
    if stamped:
        tokens += [_date("ts"), _time("ts")]
    line = F.concat(F.lit(" "), F.concat_ws("  ", *tokens))
    extra = [F.lit(h) for h in VMSTAT_HEADER]
    if stamped:
        extra.append(F.concat(F.lit(" "), F.concat_ws("  ", *tokens[:12])))
    shown = F.when(F.col("event_id") % 100 == 0, F.array(*extra, line)).otherwise(F.array(line))
    return events.select(F.explode(shown).alias("value"), F.col("event_id").alias("seq"))


def posts(documents):
    return documents.select(F.col("doc_id").alias("id"), "text",
                            F.col("source").alias("created_at"))
