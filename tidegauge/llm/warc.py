"""Content-addressed archive of web records.

Two tables: ``payloads`` holds the bytes of every distinct payload once, by its SHA-256;
``records`` holds the exact header blocks of every record, that of the archive and that of the HTTP
message, and the digest of what it carries. Reading joins the two, checks each payload against its
digest and length, and gives back the original records, revisits with the bytes that they refer to.
``record_bytes`` makes the records of a WARC 1.1 file of them, which any reader of such files takes.

Of equal payloads of at least ``least`` bytes the row of the smallest id is a response and rows of
other ids, null included, revisit it; among rows of that id none revisits another. If all ids are null, all are
responses. Smaller payloads are kept once like all, but no record revisits them. A null payload is empty. A null
or empty url is written as the record's own id and read back as null; line ends in a url become spaces. Record ids
come from id, url, date and digest, so rows equal in all of them have one. Where there is no date, it is
that of the writing. An empty table gives an empty archive. Columns other than those named are ignored.
"""

from pyspark.sql import functions as F

from tidegauge.llm.common import keep

LEAST = 100
END = "\r\n"


def records_of(pages, key="page_id", url="url", payload="html", date=None):
    """(id, url, stamp, payload, digest, length) of each row."""
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    clean = F.regexp_replace(F.col(url), r"[\r\n]", " ")
    when = F.coalesce(F.col(date), F.current_timestamp()) if date else F.current_timestamp()
    whole = pages.select(
        F.col(key).alias("id"), F.when(F.trim(clean) != "", clean).alias("url"), F.date_format(
            F.to_utc_timestamp(when, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("stamp"),
        body.alias("payload"))
    return whole.select("*", F.sha2("payload", 256).alias("digest"),
                        F.octet_length("payload").cast("long").alias("length"))


def record_id(row_id, url, stamp, digest):
    """A URI from what makes a record: a UUID of version 8, its digits from a SHA-256."""
    made = F.sha2(F.concat_ws(" ", F.coalesce(row_id.cast("string"), F.lit("null")), stamp, digest, url), 256)
    return F.concat(F.lit("urn:uuid:"), F.substring(made, 1, 8), F.lit("-"), F.substring(made, 9, 4), F.lit("-8"),
                    F.substring(made, 13, 3), F.lit("-a"), F.substring(made, 16, 3), F.lit("-"),
                    F.substring(made, 19, 12))


def roles(narrow, least=LEAST):
    """The rows with ``first``, the row (id, url, stamp) that they revisit, null for responses."""
    named = narrow.filter((F.col("length") >= least) & F.col("id").isNotNull())
    first = named.groupBy("digest").agg(F.min(F.struct("id", "url", "stamp")).alias("first"))
    return narrow.join(first, "digest", "left").withColumn(
        "first", F.when(~F.col("id").eqNullSafe(F.col("first.id")), F.col("first")))


def http_header(length):
    """Header of the HTTP message whose body is the payload."""
    return F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
                    length.cast("string"), F.lit(END + END))


def header(http):
    """Header block of a WARC 1.1 record of a row of ``roles``, lines ended by CR LF, as a column."""
    revisit = F.col("first").isNotNull()
    own = record_id(F.col("id"), F.col("url"), F.col("stamp"), F.col("digest"))
    other = record_id(F.col("first.id"), F.col("first.url"), F.col("first.stamp"), F.col("digest"))
    message = F.octet_length(http).cast("long")

    def line(name, value):
        return F.concat(F.lit(f"{name}: "), value.cast("string"))

    lines = [
        F.lit("WARC/1.1"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <"), own, F.lit(">")),
        line("WARC-Date", F.col("stamp")),
        line("WARC-Target-URI", F.coalesce("url", own)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <"), other, F.lit(">"))),
        F.when(revisit, line("WARC-Refers-To-Target-URI", F.coalesce("first.url", other))),
        F.when(revisit, line("WARC-Refers-To-Date", F.col("first.stamp"))),
        F.when(revisit, F.lit(
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: application/http; msgtype=response"),
        line("Content-Length", F.when(revisit, message).otherwise(message + F.col("length"))),
        line("X-Payload-Length", F.col("length")),
        line("X-Row-ID", F.col("id")),
        line("X-Refers-To-Row-ID", F.col("first.id")),
    ]
    # concat of a null is null and concat_ws leaves nulls out: absent fields write no line.
    return F.concat(F.concat_ws(END, *lines), F.lit(END + END))


def write_archive(pages, folder, key="page_id", url="url", payload="html", least=LEAST, date=None):
    """Writes the archive of ``pages`` below ``folder``: tables ``records`` and ``payloads``.

    The roles are found on ids, urls and digests alone; payload bytes are shuffled once. ``date`` names a
    column of timestamps.
    """
    whole = records_of(pages, key, url, payload, date)
    # Written first, so that all that follows has the same time of writing.
    narrow = keep(whole.drop("payload"), "warc-narrow")
    http = http_header(F.col("length"))
    roles(narrow, least).select(
        "id", "digest", "length", header(http).cast("binary").alias("header"),
        http.cast("binary").alias("http")).write.parquet(f"{folder}/records")
    # Payload bytes of equal digest are equal, so any one of them will do; each task drops
    # its own repeats before the shuffle.
    whole.select("digest", "payload").dropDuplicates(["digest"]).write.option(
        "compression", "zstd").parquet(f"{folder}/payloads")


def read_archive(spark, folder):
    """Original records: (header, http, payload, digest, length), payloads verified.

    A payload whose bytes do not have their digest stops the read.
    """
    records = spark.read.parquet(f"{folder}/records")
    payloads = spark.read.parquet(f"{folder}/payloads")
    sound = F.sha2("payload", 256) == F.col("digest")
    checked = payloads.select("digest", F.when(sound, F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload does not match its digest "), F.col("digest")))
    ).alias("payload"))
    return records.join(checked, "digest").select("header", "http", "payload", "digest", "length")


def parse_header(records):
    """Fields of the header block of each record."""
    text = F.decode("header", "UTF-8")

    def field(name, pattern=r"([^\r\n]*)"):
        return F.regexp_extract(text, rf"(?m)^{name}: {pattern}\r\n", 1)

    def number(name, pattern):
        return F.when(field(name, pattern) != "", field(name, pattern).cast("long"))

    target, own = field("WARC-Target-URI"), field("WARC-Record-ID", "<([^>]*)>")
    return records.select(
        number("X-Row-ID", r"(-?\d+)").alias("id"), own.alias("record_id"),
        field("WARC-Type").alias("type"), F.when(target != own, target).alias("url"),
        field("WARC-Date").alias("date"),
        field("WARC-Payload-Digest", "sha256:([0-9a-f]{64})").alias("digest"),
        number("X-Refers-To-Row-ID", r"(-?\d+)").alias("refers_to"),
        number("X-Payload-Length", r"(\d+)").alias("length"), "payload")


def record_bytes(records):
    """The bytes of each record as a WARC file has them; a revisit has the head of its message only."""
    kind = F.decode("header", "UTF-8").contains("WARC-Type: revisit\r\n")
    return records.select(F.concat(
        "header", "http", F.when(kind, F.lit(b"")).otherwise(F.col("payload")),
        F.lit(b"\r\n\r\n")).alias("record"))
