"""What the operators of this package share."""

import contextlib
import gc
import os
import pathlib
import re

from pyspark.sql import functions as F

from tidegauge.session import scratch_dir

# Fixed value: a word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20
_BYTES = re.compile(r"(-?\d+)\s*([kmgtp]?)b?")


def keep(df, label, narrow=False):
    """``df`` written to the shared folder and read back: cuts lineage, survives executors.

    A ``narrow`` table, of ids and numbers of what has texts elsewhere, is written by an
    eighth of the shuffle's tasks, whose number suits texts.
    """
    path = scratch_dir(df.sparkSession, label)
    if narrow:
        df = df.coalesce(-(-tasks(df.sparkSession) // 8))
    df.write.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept.scratch_path = path
    return kept


def discard(kept):
    """Removes a table of ``keep``; nothing may still be to be computed from it."""
    path = kept.sparkSession._jvm.org.apache.hadoop.fs.Path(kept.scratch_path)
    conf = kept.sparkSession._jsparkSession.sessionState().newHadoopConf()
    path.getFileSystem(conf).delete(path, True)


def release(spark):
    """Lets Spark drop the shuffle files of steps that are done.

    It does so when the driver's garbage is collected, which in a quiet driver comes late: the
    files of all steps would lie on the executors' disks at once.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ready(spark):
    """Prepares a session for Python in its tasks.

    Workers on this machine import the package from where the driver has it; on a cluster install
    it on the workers or pass it with ``--py-files``. Workers get batches of some megabytes at a
    time, now and when a lazy result is computed: with long texts the usual batch of thousands of
    rows is most of a worker's memory. A smaller setting of the session's own is left as it is.
    """
    number, unit = _BYTES.fullmatch(spark.conf.get(BATCH).lower()).groups()
    now = int(number) << 10 * (" kmgtp".index(unit) if unit else 0)
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(BATCH, f"{BATCH_BYTES}b")
    root = str(pathlib.Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


@contextlib.contextmanager
def smaller_batches(spark, size):
    """Workers get batches of so many bytes at most for what is computed inside the block."""
    ready(spark)
    before = spark.conf.get(BATCH)
    number, unit = _BYTES.fullmatch(before.lower()).groups()
    if int(number) << 10 * (" kmgtp".index(unit) if unit else 0) > size:
        spark.conf.set(BATCH, f"{size}b")
    try:
        yield
    finally:
        spark.conf.set(BATCH, before)


def tasks(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text):
    """Words of the text; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def utf8_bytes(text):
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
