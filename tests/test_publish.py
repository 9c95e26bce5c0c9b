"""Reports that are replaced as a whole."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tripmill.plans import report
from tripmill.plans.publish import current, manifest, prune_reports, publish_report, read_section

NAMES = [f"part{i}" for i in range(10)]


def sections(spark, value, failing=None):
    """Ten sections of one row that holds ``value``; ``failing`` raises while it is written."""
    made = {n: spark.range(1).select(F.lit(value).alias("v")) for n in NAMES}
    if failing:
        made[failing] = spark.range(1).select(F.raise_error(F.lit("no disk")).cast("string").alias("v"))
    return made


def read_all(spark, output):
    return {read_section(spark, output, n).first().v for n in NAMES}


def test_readers_get_the_latest_whole_report(spark, tmp_path):
    output = str(tmp_path / "report")
    assert current(spark, output) is None
    with pytest.raises(FileNotFoundError):
        read_section(spark, output, "part0")
    for value in ("august", "september"):
        publish_report(sections(spark, value), output)
        assert read_all(spark, output) == {value}
    assert [r.sequence for r in manifest(spark, output).orderBy("sequence").collect()] == [1, 2]
    with pytest.raises(KeyError):
        read_section(spark, output, "unknown")
    with pytest.raises(ValueError):
        publish_report({}, output)


@pytest.mark.parametrize("failing", NAMES[::3] + ["part5"])
def test_a_failure_leaves_the_old_report(spark, tmp_path, failing):
    output = str(tmp_path / "report")
    publish_report(sections(spark, "august"), output)
    with pytest.raises(Exception, match="no disk"):
        publish_report(sections(spark, "september", failing), output)
    assert read_all(spark, output) == {"august"}
    publish_report(sections(spark, "october"), output)
    assert read_all(spark, output) == {"october"}


def test_a_reader_is_not_disturbed(spark, tmp_path):
    output = str(tmp_path / "report")
    publish_report(sections(spark, "august"), output)
    begun = read_section(spark, output, "part3")
    publish_report(sections(spark, "september"), output)
    assert begun.first().v == "august"


def test_old_versions_are_pruned(spark, tmp_path):
    output = str(tmp_path / "report")
    for value in ("july", "august", "september"):
        publish_report(sections(spark, value), output)
    (tmp_path / "report" / "versions" / "unpublished").mkdir()
    assert len(prune_reports(spark, output, keep=2)) == 1
    assert read_all(spark, output) == {"september"}
    left = {p.name for p in Path(output, "versions").iterdir() if not p.name.startswith(".")}
    assert len(left) == 3 and "unpublished" in left
    assert prune_reports(spark, output, keep=2) == []
    with pytest.raises(ValueError):
        prune_reports(spark, output, keep=0)


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_other_formats(spark, tmp_path, fmt):
    output = str(tmp_path / "report")
    publish_report(sections(spark, "august"), output, fmt)
    assert read_section(spark, output, "part1", "v string").first().v == "august"


def test_headings_name_columns_of_the_tables(spark):
    import fixtures as fx

    found = report.headings(spark).collect()
    trips = fx.spoiled_trips(spark)
    for section in ("daily_table", "vehicle_table", "driver_table"):
        shown = [r.column for r in found if r.section == section]
        assert getattr(report, section)(trips).columns[: len(shown)] == shown
    assert [r.heading for r in found if r.column is None] == ["Geral", "Produção diária", "Caminhões", "Motoristas"]
