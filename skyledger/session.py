"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
STATE_CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
# AQE may turn a sort-merge join into a hash join where every partition of one side is this small.
HASH_JOIN_LIMIT = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
HASH_JOIN_SIZE = "64MB"

_LOCAL_ROOTS: dict[str, str] = {}


def build_session(app: str = "skyledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with this library's defaults; keyword ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(HASH_JOIN_LIMIT, HASH_JOIN_SIZE)
        .config(STATE_STORE, ROCKSDB)
        .config(STATE_CHANGELOG, "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Only a local session may go without it; a cluster must name one, because a machine's
    own temporary folder is lost with that machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    # ``local-cluster`` has executors of its own.
    if not (spark.sparkContext.master + "[").startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="skyledger-")
    return _LOCAL_ROOTS[app]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path for this application under the shared folder (not created yet)."""
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/skyledger/{app}/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of whichever file system the path names, if it is there."""
    target, files = _file_system(spark, path)
    files.delete(target, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none if there is no such folder."""
    target, files = _file_system(spark, path)
    return [f.getPath().getName() for f in files.listStatus(target)] if files.exists(target) else []


def drop_scratch(spark: SparkSession) -> None:
    """Remove what this application wrote under the shared folder; call it when all is read."""
    delete(spark, f"{shared_root(spark)}/skyledger/{spark.sparkContext.applicationId}")
