"""Session settings and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession

# What the jobs are tuned for. Nothing here is needed for right results: strictness is
# written into the plans and does not lean on ANSI mode, windows do not lean on the zone.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Recording the Python line of every column call doubled the time of making some plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app="tidegauge", **conf):
    """A session with the recommended settings; the master comes from spark-submit."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark, label):
    """A fresh folder for tables that cut lineage, below the cluster's shared folder.

    The shared folder is ``spark.checkpoint.dir``. Only a local session without that
    setting gets a folder of this machine; on a cluster its absence is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tidegauge-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
