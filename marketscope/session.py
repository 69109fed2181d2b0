"""Session defaults and the shared scratch folder.

Intermediate tables are written under the folder the cluster names in
``spark.checkpoint.dir`` (shared storage on a real cluster). A private folder
is only created when the setting is absent, which happens in local tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings every plan in this package assumes. AQE re-plans joins from
# measured stage sizes (broadcast only when the materialised side is small),
# coalesces small partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "marketscope",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``marketscope`` importable in the Python workers (once per application).

    The few Python tasks (registry-format export, the zip data source) are
    pickled by reference to this package; executors get it as a zip through
    ``addPyFile``, from the shared folder.
    """
    import io
    import zipfile

    import marketscope
    from marketscope.sources import files

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(marketscope.__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", compression=zipfile.ZIP_DEFLATED) as z:
        for root, _, names in os.walk(pkg):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    target = shared_dir(spark, "pyfiles") + "/marketscope.zip"
    with files.open_output(target) as out:
        out.write(buf.getvalue())
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    A private folder is created only when the setting is absent and Spark
    runs in local mode (tests); on a cluster a machine-local folder would be
    invisible to the executors, so the setting is required there.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="marketscope-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one written table."""
    root = checkpoint_root(spark)
    path = f"{root.rstrip('/')}/marketscope/{name}-{uuid.uuid4().hex[:12]}"
    if "://" not in path or path.startswith("file:"):
        os.makedirs(local_path(path), exist_ok=True)
    return path


def local_path(path: str) -> str:
    """'file:/x', 'file:///x' -> '/x'; other strings unchanged."""
    if path.startswith("file://"):
        return path[len("file://"):]
    return path.removeprefix("file:")
