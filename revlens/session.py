"""Session helpers.

The library never creates a module-level session.  ``get_session`` is for
scripts and tests; on a cluster the caller's session is used as-is and only
settings that are *unset* get a default.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that make results reproducible across engines (UTC wall clock) and
# keep plans adaptive.  Applied only where the session does not set them.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(master: str | None = None, app: str = "revlens", conf: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session; a private folder is
    only created when it is unset and the master is local (tests).
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="revlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared checkpoint folder.

    Streaming checkpoints, sink tables and lineage cuts go here so that a lost
    executor (or driver restart) finds them on shared storage.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "revlens", *parts, uuid.uuid4().hex])


def local_path(p: str) -> str:
    """Strip a ``file:`` scheme for Python-side checks in tests."""
    return p[5:] if p.startswith("file:") else p


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
