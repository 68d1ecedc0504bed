"""Session construction and lineage cutting.

Cluster runs get their settings from the cluster; the defaults here only fill what
is unset.  ``materialize`` writes a reliable checkpoint into the shared folder the
cluster names in ``spark.checkpoint.dir`` so a lost executor never forces a replay
of the whole lineage.
"""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  AQE re-plans joins from runtime sizes (a checked
# broadcast), coalesces small shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of lineage cuts are removed once their DataFrame is unreachable
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(app: str = "formsieve", master: str | None = None,
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    active = SparkSession.getActiveSession()
    SparkContext._ensure_initialized()
    launched = SparkConf()  # what spark-submit / spark-defaults already set
    for k, v in DEFAULT_CONF.items():
        # defaults only: a setting the cluster (or a running session) made is kept
        if launched.contains(k) or (active is not None and active.conf.get(k, None) is not None):
            continue
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder.  Read from the session; only a local-mode session
    (tests) without one gets a scratch folder - a cluster must name a shared folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: lineage cuts need a shared folder "
                               "that every executor and the driver can read")
        conf_dir = tempfile.mkdtemp(prefix="formsieve-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (never a local one): the result survives executor loss
    and later stages read it instead of recomputing the lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
