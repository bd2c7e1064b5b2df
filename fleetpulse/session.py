"""Session construction and shared scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on.  AQE re-plans joins and coalesces
# shuffle partitions at run time; skew-join splitting guards the left joins
# against a hot vehicle or route key.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Sizing for a large cluster (inputs of ~100 TB, ~1000 executors), chosen
# with ``build_session(profile="cluster")``:
# * batch shuffles start at 16384 partitions and AQE coalesces them to
#   ~256 MB each, so no reducer sorts or aggregates more than it can hold;
#   a skewed join partition is split by the skew-join rule above;
# * scans cut files into 256 MB splits;
# * streams do not use AQE: their state is split into
#   ``spark.sql.shuffle.partitions`` parts, fixed in the checkpoint at the
#   first start, so that number stays moderate;
# * state of stateful streaming operators, where a job adds some (silver keeps
#   its ledger in files), lives in RocksDB, off the executor heap, with
#   changelog checkpoints so each batch uploads only its changes.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16384",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "512",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

PROFILES = {"local": {}, "cluster": CLUSTER_CONF}


def build_session(master: str | None = None, app: str = "fleetpulse",
                  conf: dict[str, str] | None = None,
                  profile: str = "local") -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    ``master`` is only set when given: on a cluster the launcher decides.
    ``profile`` adds a sizing profile (``"cluster"``: ``CLUSTER_CONF``);
    ``conf`` overrides both.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **PROFILES[profile], **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared scratch space for this application.

    Uses the cluster's checkpoint directory (``spark.checkpoint.dir`` or one
    already set on the context).  Only when none is configured - local runs
    and tests - a private directory is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if sc.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="fleetpulse-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused location under the shared scratch root."""
    root = shared_dir(spark).rstrip("/")
    return f"{root}/fleetpulse/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str | None:
    """Return the local filesystem path behind ``path`` or None if remote."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
        return path
    if "://" in path:
        return None
    return path if os.path.isabs(path) else None
