"""Session defaults for local runs; a cluster's own settings always win."""

from __future__ import annotations

import hashlib
import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "corpusloom", cores: str = "*", **extra: str) -> SparkSession:
    """A local session with the settings the queries assume (UTC, AQE, Arrow)."""
    conf = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.driver.host": "127.0.0.1",
    } | extra
    spark = SparkSession.builder.master(f"local[{cores}]").appName(app).config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """A folder that driver and executors share: the session's checkpoint folder, set here only where unset."""
    if at := spark.conf.get("spark.checkpoint.dir", None):
        return at.rstrip("/")
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        local = sc.master == "local" or sc.master.startswith("local[")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="corpusloom-") if local else spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints")
    return sc.getCheckpointDir().rstrip("/")


def stored(df: DataFrame, what: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` written as Parquet under a new name in the shared folder, and read back.

    With ``by`` there is a folder for each of its values, so that a read of one value opens no other's files.
    """
    path = f"{shared_dir(df.sparkSession)}/{what}-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application, so that executors need no copy of it.

    It goes through the shared folder, whatever file system that is on.
    """
    sc = spark.sparkContext
    if getattr(sc, "_corpusloom_shipped", False):
        return
    root, data = Path(__file__).parent, io.BytesIO()
    if not root.is_dir():  # imported from an archive, which the application has sent itself
        return
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(root.rglob("*.py")):
            z.writestr(zipfile.ZipInfo(str(path.relative_to(root.parent))), path.read_bytes())
    at = f"{shared_dir(spark)}/corpusloom-{hashlib.sha256(data.getvalue()).hexdigest()[:12]}.zip"
    path = sc._jvm.org.apache.hadoop.fs.Path(at)
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
    out.write(data.getvalue())
    out.close()
    sc.addPyFile(at)
    sc._corpusloom_shipped = True
