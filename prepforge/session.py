"""Session helpers: the conf every job here assumes, and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Conf the library relies on. ANSI stays on (every division goes through
# try_divide), timestamps are read as UTC, AQE re-plans joins and coalesces
# shuffle partitions at run time, and skewed join partitions are split.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "prepforge", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; a cluster passes its own conf."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("PREPFORGE_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``prepforge`` importable in executor Python workers (pandas UDFs,
    ``applyInPandas``, ``mapInPandas``): zip the package once per application
    and hand it to ``SparkContext.addPyFile``, as ``--py-files`` would."""
    import zipfile

    import prepforge
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    if "prepforge" in (sc.getConf().get("spark.submit.pyFiles", "") or ""):
        _SHIPPED.add(sc.applicationId)  # already shipped with --py-files
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(prepforge.__file__)))
    zpath = os.path.join(tempfile.mkdtemp(prefix="prepforge-pkg-"), "prepforge.zip")
    with zipfile.ZipFile(zpath, "w") as z:
        for dirpath, _, files in os.walk(os.path.join(root, "prepforge")):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Prepare the session for the library and return the shared checkpoint
    folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names a shared file system and is used as is.
    Only when it is unset (local tests) a fresh scratch folder is made.  The
    package is shipped to the executors' Python workers once per application.
    """
    ship_package(spark)
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="prepforge-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d
