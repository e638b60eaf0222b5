"""Session settings for running the reporting plans on a cluster or locally."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings every plan in this package assumes or profits from.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits a hot join key's shuffle partition, so lookups on a key that holds
    # a large share of the fact do not end up in one task.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Also when the split costs the next step an extra shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Checkpoint files go away with the frames that wrote them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(app: str = "quartermill", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or fetch) a session with :data:`DEFAULTS`; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def run_folder(spark: SparkSession) -> str:
    """A new folder for the files of one run, below the folder the cluster shares.

    That is ``spark.checkpoint.dir``, or the checkpoint folder of the session; a local
    session without either gets a folder of its own, a cluster without is an error.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if shared is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="quartermill-")
    return f"{shared.rstrip('/')}/run-{uuid.uuid4().hex}"
