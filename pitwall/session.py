"""SparkSession construction and the few knobs the engine reads from it."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Engine-level settings read from the session conf (all optional).
HOT_KEY_ROWS = "spark.pitwall.series.hotKeyRows"      # group size above which series ops split a key
CHUNK_ROWS = "spark.pitwall.series.chunkRows"          # rows per chunk when a key is split
BROADCAST_ROWS = "spark.pitwall.broadcast.maxRows"     # row bound for explicit broadcasts
RANGE_ROWS = "spark.pitwall.series.rangeRows"          # rows per range partition of a split key
SCOPE = "spark.pitwall.scope"                          # keys: literal session keys | runtime: a join that prunes at run time
ORDINAL = "spark.pitwall.series.ordinal"               # split-key ordinal route: auto | time | range

DEFAULTS = {
    HOT_KEY_ROWS: 4_000_000,
    CHUNK_ROWS: 1_000_000,
    BROADCAST_ROWS: 2_000_000,
    RANGE_ROWS: 4_000_000,
}


# Settings every plan relies on; applied to a session the engine did not build (e.g. a caller's).
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def apply_engine_conf(spark: SparkSession) -> SparkSession:
    for k, v in ENGINE_CONF.items():
        spark.conf.set(k, v)
    return spark


def conf_int(spark: SparkSession, key: str) -> int:
    return int(spark.conf.get(key, str(DEFAULTS[key])))


def session(app: str = "pitwall", master: str | None = None, shuffle_partitions: int | None = None,
            conf: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the settings every plan assumes.

    * UTC session time zone: epoch seconds and day boundaries are zone-free.
    * ANSI mode on (the 4.x default): bad casts fail loudly instead of nulling.
    * AQE on, with partition coalescing and skew-join splitting, so shuffle
      sizing adapts at run time and a hot join key is split across tasks.
    * No broadcast from plan-time size *estimates* (they ignore explodes and
      filters): a side is broadcast only by an explicit hint placed behind a
      counted row bound, or by AQE after the side's stage has run and its
      real size is known (``adaptive.autoBroadcastJoinThreshold``).
    * No web UI.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        **ENGINE_CONF,
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory.

    On a cluster the operator names a shared folder in ``spark.checkpoint.dir``;
    it is used as is. Only a local session without one gets a scratch folder
    (tests and single-machine runs).
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="pitwall-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()
