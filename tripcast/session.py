"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every query relies on.  Calendar functions in this package are
# written to be independent of the session zone; UTC is pinned anyway so that
# anything the user adds (``date_format`` on timestamps, ``hour``) behaves the
# same on every cluster.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No broadcast from size *estimates*: a fact table whose pruned estimate
    # looks small would be shipped to every executor.  Broadcasts are placed
    # explicitly after a row-count check (operators.broadcast), and AQE may
    # still turn a sort-merge join into a local hash join once the measured
    # shuffle partitions are small.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "tripcast",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Return (or create) a session with the package defaults applied.

    On a cluster call without ``master`` so the launcher's settings win; in
    tests pass ``local[N]``.  ``shuffle_partitions`` should be sized so that a
    shuffle partition holds ~128-256 MB at the target scale; AQE coalesces
    small ones at run time.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on an existing session
                pass
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure reliable checkpoints have a shared folder and return it.

    The cluster names the folder in ``spark.checkpoint.dir``; it is used as
    is.  Only when nothing is configured and the master is local (tests,
    laptops) a fresh temporary folder is created.  On a cluster without the
    setting this raises, because a machine-local folder would not survive
    the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared "
                "folder (HDFS/S3/ABFS) before running iterative operators")
        configured = tempfile.mkdtemp(prefix="tripcast-ckpt-")
    elif not sc.master.startswith("local") and str(configured).startswith("/"):
        # A plain path means the default file system, which may be machine-local.
        default = sc._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
        if default.startswith("file:"):
            raise RuntimeError(f"spark.checkpoint.dir {configured} names no file system; "
                               "give it with one (hdfs://, s3a://, or file:// for a shared mount)")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
