"""Employee records from JSON lines, XML, Avro and comma-separated text."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidegauge import schemas
from tidegauge.operators.parse import conform, parse_employee
from tidegauge.sources.lines import read_lines

# The element names of the XML input.
XML_TAGS = {"rootTag": "employees", "rowTag": "employee"}


def read_employees(spark, path, fmt, null_key="reject", quotes="strip", mode="strict"):
    """Employees bound by name to the declared schema.

    A record the format's reader cannot bind fails the query. ``null_key`` says what
    happens to a record without its number, see ``conform``; for ``csv``, ``quotes`` and
    ``mode`` are those of ``parse_employee``.
    """
    if fmt == "csv":
        return parse_employee(read_lines(spark, path), quotes=quotes, mode=mode)
    if fmt == "json":
        raw = spark.read.schema(schemas.EMPLOYEE).option("mode", "FAILFAST").json(path)
    elif fmt == "xml":
        raw = read_xml(spark, path, schemas.EMPLOYEE, XML_TAGS["rowTag"])
    elif fmt == "avro":
        raw = read_avro(spark, path, schemas.EMPLOYEE_AVRO)
    else:
        raise ValueError(f"unknown employee format {fmt!r}")
    return conform(raw, schemas.EMPLOYEE, key="emp_no", null_key=null_key)


def read_xml(spark, path, schema, tag):
    """The elements ``tag`` of XML files in UTF-8, bound by name; one that cannot be bound fails the query.

    Spark's XML reader gives each file to one task. Here files are cut before each ``<tag`` by the
    reader of text, which splits them, and each element is bound by itself. So elements do not nest, and
    no other element's name begins with ``tag`` but one around the rows; a comment or CDATA section that holds
    ``<tag`` fails the query.
    """
    attributes = r"""(?:\s(?:[^<>"']|"[^"]*"|'[^']*')*)?"""
    whole = r"<!\[CDATA\[.*?\]\]>|<!--.*?-->"
    parts = spark.read.option("lineSep", f"<{tag}").text(path)
    broken = F.regexp_replace("value", f"(?s){whole}", "").rlike(r"<!--|<!\[CDATA\[")
    wrong = F.raise_error(F.lit(f"<{tag} in a comment or CDATA section"))
    plain = F.when(broken, wrong).otherwise(
        F.regexp_replace("value", r"(?s)(<!\[CDATA\[.*?\]\]>)|<!--.*?-->", "$1"))
    found = parts.select(plain.alias("part")).filter(F.col("part").rlike(r"^(?:[/>]|\s+[^\s<])"))
    # What follows the end belongs to no element. Without an end the part is no XML, and that fails.
    element = F.regexp_extract("part", rf"(?s)^(?:{attributes}/>|.*?</{tag}\s*>)", 0)
    text = F.concat(F.lit(f"<{tag}"), F.when(element != "", element).otherwise(F.col("part")))
    return found.select(F.from_xml(text, schema, {"mode": "FAILFAST", "rowTag": tag}).alias("row")).select(
        "row.*")


def has_avro(spark):
    try:
        spark.read.format("avro").schema("a int").load([])
        return True
    except AnalysisException:
        return False


def read_avro(spark, path, schema):
    """Avro files by the Avro data source, or without its package ``spark-avro`` by the bundled input format.

    The input format splits files and renders each record as JSON; only files named
    ``*.avro`` are read by either.
    """
    if has_avro(spark):
        return spark.read.format("avro").load(path).select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    records = spark.sparkContext.hadoopFile(
        path,
        "org.apache.avro.mapred.AvroAsTextInputFormat",
        "org.apache.hadoop.io.Text",
        "org.apache.hadoop.io.Text",
    ).keys()
    return spark.read.schema(schema).option("mode", "FAILFAST").json(records)
