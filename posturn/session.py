"""SparkSession helpers.

The library never creates a session on its own inside a transformation; these
helpers are for entry points, tests and the benchmark.  On a cluster the
session comes from the launcher and only the settings that are still unset are
filled in.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings every result depends on (timestamps are instants in UTC).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # A JSON object with a repeated key keeps its last value, like Python's
    # json.loads (typed from_json already does; VARIANT parsing needs this).
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Sensible defaults; a cluster launcher may already have set them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Each micro-batch uploads only the state changes, not a full snapshot.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


_LOCAL_ROOT: tuple[str, str] | None = None
_SHIPPED: set[str] = set()


def build_session(master: str | None = None, app_name: str = "posturn",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or attach to) a session with the library's required settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **REQUIRED_CONF}.items():
        builder = builder.config(key, value)
    if master and master.startswith("local"):
        # Local mode: the driver JVM is the only executor.
        builder = builder.config("spark.driver.memory", os.environ.get("POSTURN_DRIVER_MEMORY", "8g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the required runtime settings to an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


def stateful(spark: SparkSession) -> SparkSession:
    """The session with the state store that ``transformWithState`` needs; set before the query starts."""
    for key in ("spark.sql.streaming.stateStore.providerClass",
                "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"):
        spark.conf.set(key, DEFAULT_CONF[key])
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make ``posturn`` importable in the Python workers, once per application.

    Pandas UDFs (``mapInPandas``, ``applyInPandasWithState``) pickle functions
    by module reference, so the executors need the package.  When it was not
    already shipped with ``--py-files`` (i.e. it is imported from a source
    tree), it is zipped into a driver-side staging file and added with
    ``addPyFile``; Spark serves it to every executor, including ones started
    later, so no executor reads the driver's disk.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(pkg_dir):
        staging = tempfile.mkdtemp(prefix="posturn-pyfiles-")
        archive = os.path.join(staging, "posturn.zip")
        base = os.path.dirname(pkg_dir)
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as zf:
            for folder, _dirs, files in os.walk(pkg_dir):
                for name in files:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        zf.write(full, os.path.relpath(full, base))
        sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and lineage-cutting tables.

    Read from ``spark.checkpoint.dir``, which a cluster points at shared
    storage.  Only when it is unset in local mode (tests) is a private scratch
    folder created once per application and registered with the context, so
    ``DataFrame.checkpoint`` and streaming checkpoints land in the same place.
    On a cluster an unset folder is an error: a driver-local folder is not
    visible to the executors.
    """
    global _LOCAL_ROOT
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    if not root:
        if _LOCAL_ROOT is None or _LOCAL_ROOT[0] != sc.applicationId:
            _LOCAL_ROOT = (sc.applicationId, tempfile.mkdtemp(prefix="posturn-ckpt-"))
        root = _LOCAL_ROOT[1]
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A sub-path of the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), *parts)
