"""Session helpers shared by every operator."""

from __future__ import annotations

import atexit
import gc
import io
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once a session, so that they need no copy of their own."""
    sc = spark.sparkContext
    if getattr(sc, "_sheafline", False):
        return
    root, packed = Path(__file__).resolve().parent, io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    # The driver serves the file to the executors itself; its place matters to the driver alone.
    at = Path(tempfile.mkdtemp(prefix="sheafline-")) / "sheafline.zip"
    at.write_bytes(packed.getvalue())
    sc.addPyFile(str(at))
    sc._sheafline = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a reliable checkpoint.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. A local session without one gets a temporary
    folder, removed when the process ends; on a cluster a missing folder is an error, as executors would not share it.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir")
        if named is None and not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
        if named is None:
            named = tempfile.mkdtemp(prefix="sheafline-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        sc.setCheckpointDir(named)
    return df.checkpoint()


def freed(spark: SparkSession) -> None:
    """Have the files of shuffles that nothing refers to any longer deleted now; else they stay until the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
