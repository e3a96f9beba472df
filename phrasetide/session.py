"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "phrasetide", master: str | None = None,
                  **conf: object) -> SparkSession:
    """A session with UTC times and adaptive execution; ``conf`` overrides."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings: dict[str, object] = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.shuffle.io.maxRetries": "20",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone; hours, cursors and display times are all UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local session that names none (tests) gets a temporary folder; on a
    cluster the setting is required, since a machine-local folder would lose
    data with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    made = tempfile.mkdtemp(prefix="phrasetide-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def new_work_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/phrasetide/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``, in any store that Spark reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of all files under ``paths``."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = [spark._jvm.org.apache.hadoop.fs.Path(path) for path in paths]
    return sum(at.getFileSystem(conf).getContentSummary(at).getLength() for at in found)
