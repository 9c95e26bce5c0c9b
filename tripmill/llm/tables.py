"""Tables, shared storage and code of the executors."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

#: Compressed bytes of a staged table that one group of it holds.
GROUP_BYTES = 32 << 20
PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def groups_of(staged_table: DataFrame, group_bytes: int = GROUP_BYTES) -> int:
    """Number of groups to deal a staged table into: as many as shuffle partitions, or more if it is so large
    that they would hold more than ``group_bytes`` each. By the size of its files, which Spark knows."""
    size = int(str(staged_table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    partitions = int(staged_table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, partitions, -(-size // group_bytes))


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package, once per application.

    Spark serves the archive from its folder of files on the driver, so the executors need neither an
    installed copy nor a path that they share with the driver.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w") as archive:
        for source in sorted(PACKAGE.rglob("*.py")):
            archive.write(source, source.relative_to(PACKAGE.parent))
    path = Path(SparkFiles.getRootDirectory()) / "code" / f"{PACKAGE.name}.zip"
    path.parent.mkdir(exist_ok=True)
    path.write_bytes(content.getvalue())
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(application)
