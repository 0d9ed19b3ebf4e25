"""Session construction and lineage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "trustframe", driver_memory: str = "16g") -> SparkSession:
    """Session with the settings every operator assumes: UTC clock, AQE on,
    Arrow on, UI off. On a cluster pass ``master=None`` and let spark-submit
    decide memory and cores; ``shuffle_partitions`` should be sized to the
    data there. In local mode all tasks share the driver heap, so it is sized
    here (effective only when this call starts the JVM)."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
        if master.startswith("local") and driver_memory:
            b = b.config("spark.driver.memory", driver_memory)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def importable_in_tasks(spark: SparkSession) -> None:
    """Python workers import this package from where the driver does, unless it is installed there (or shipped with
    ``--py-files``). Call it before building an operator that runs the package's own Python in tasks."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the job (a shared file system path).
    Only a local-mode session without the setting (tests, bench) gets a
    private scratch folder."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get(_CKPT_KEY, None) \
        or sc.getConf().get(_CKPT_KEY, None)
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; set it to a shared folder")
    d = tempfile.mkdtemp(prefix="trustframe-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame, large: bool = True) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and continue from it;
    both forms survive the loss of executors (unlike a local checkpoint).
    ``large=True``: a Parquet table (columnar write/read, cheapest for big
    intermediate tables). ``large=False``: a reliable RDD checkpoint, which has
    less fixed cost for small, size-checked helper tables."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    if not large:
        return df.checkpoint(eager=True)
    path = f"{base.rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
