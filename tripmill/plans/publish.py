"""Reports that can be read while they are being replaced.

A report is written to a folder of its own under ``<output>/versions``; when all its sections are there, one
row naming it is appended to ``<output>/manifest``, as a single file that appears at once or not at all.
Readers take the latest version the manifest names. Whatever fails before that row leaves the previous
report as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.plans.writing import write_report

MANIFEST = "sequence bigint, version string, format string, sections array<string>, published_at timestamp"


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def manifest(spark: SparkSession, output: str) -> DataFrame:
    """The versions published so far, one row each; none if there are no reports yet."""
    path = f"{output}/manifest"
    if not _exists(spark, path):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(path)


def current(spark: SparkSession, output: str):
    """The manifest row of the report that readers get, or None."""
    return manifest(spark, output).orderBy(F.desc("sequence"), F.desc("version")).first()


def version_folder(output: str, version: str) -> str:
    return f"{output}/versions/{version}"


def publish_report(
    sections: Mapping[str, DataFrame], output: str, fmt: str = "parquet", partition_by: str | None = None
) -> str:
    """Write all sections, then publish them together; returns the folder of this version.

    Where two runs publish at once, both versions are whole and the later row counts; rows of one sequence
    number are ordered by version name.
    """
    if not sections:
        raise ValueError("a report has at least one section")
    spark = next(iter(sections.values())).sparkSession
    version = uuid.uuid4().hex
    folder = write_report(sections, version_folder(output, version), fmt, partition_by=partition_by)
    before = current(spark, output)
    row = [((before.sequence if before else 0) + 1, version, fmt, sorted(sections))]
    named = spark.createDataFrame(row, MANIFEST.rsplit(", ", 1)[0]).withColumn("published_at", F.current_timestamp())
    named.coalesce(1).write.mode("append").parquet(f"{output}/manifest")
    return folder


def read_section(spark: SparkSession, output: str, section: str, schema=None) -> DataFrame:
    """A section of the published report. Formats without types need the section's schema."""
    row = current(spark, output)
    if row is None:
        raise FileNotFoundError(f"no report has been published in {output}")
    if section not in row.sections:
        raise KeyError(f"the report has no section {section}")
    reader = spark.read.format(row.format)
    reader = reader if schema is None else reader.schema(schema)
    return reader.load(f"{version_folder(output, row.version)}/{section}")


def prune_reports(spark: SparkSession, output: str, keep: int = 2) -> list[str]:
    """Remove all published versions but the last ``keep``, and return their names.

    Keep at least one more than readers may be behind. Versions that were never published stay, as a run
    may be writing them.
    """
    if keep < 1:
        raise ValueError("the report that readers get is kept")
    rows = manifest(spark, output).orderBy(F.desc("sequence"), F.desc("version")).select("version").collect()
    removed = []
    for row in rows[keep:]:
        path = spark._jvm.org.apache.hadoop.fs.Path(version_folder(output, row.version))
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True):
            removed.append(row.version)
    return removed
