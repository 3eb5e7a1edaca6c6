"""Session construction and lineage cutting.

Cluster jobs get their SparkSession from the launcher; ``get_spark`` only builds a
local one for tests and benchmarks. ``checkpoint_dir`` honours the cluster's
``spark.checkpoint.dir`` and only invents a scratch folder for local masters.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(cpus: int | str | None = None, app: str = "colloquy", shuffle_partitions: int = 8) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS") or "*"
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("COLLOQUY_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a scratch one only on local masters."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the context and its checkpoint dir
        sc = None
    configured = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
    if configured:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    if sc is None or not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="colloquy-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the shared checkpoint folder and read back.

    Unlike a checkpoint it is columnar: readers fetch the columns they use and skip row
    groups by their filters. Tables stay until that folder's retention removes them.
    """
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/stored/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a Hadoop glob (file listing only, no data read); empty when none."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(p)
    return [] if found is None else [str(s.getPath().toString()) for s in found]


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``colloquy`` importable in every Python worker (UDFs, mapInPandas, state fns).

    Zips the installed package once per process and registers it with ``addPyFile``,
    which distributes it to all executors. Idempotent per Spark application.
    """
    import hashlib
    import zipfile

    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # Spark Connect: no SparkContext on the client
        sc, app = None, f"connect-{id(spark)}"
    if app in _SHIPPED:
        return
    import colloquy

    root = os.path.dirname(os.path.abspath(colloquy.__file__))
    files = sorted(
        os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".py")
    )
    digest = hashlib.sha1()
    for f in files:
        with open(f, "rb") as fh:
            digest.update(f.encode() + fh.read())
    path = os.path.join(tempfile.gettempdir(), f"colloquy-{digest.hexdigest()[:12]}.zip")
    if not os.path.exists(path):
        tmp = path + f".{os.getpid()}.part"
        with zipfile.ZipFile(tmp, "w", zipfile.ZIP_DEFLATED) as z:
            for f in files:
                z.write(f, os.path.join("colloquy", os.path.relpath(f, root)))
        os.replace(tmp, path)
    if sc is not None:
        sc.addPyFile(path)
    else:
        spark.addArtifacts(path, pyfile=True)
    _SHIPPED.add(app)
