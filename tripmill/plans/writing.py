"""Writing the sections of a report."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

DEFAULT_OUTPUT = "producaoPrimaria"
#: Sections written at the same time. They are small jobs, most of whose time is not spent in tasks.
WRITERS = 4


def write_report(
    sections: Mapping[str, DataFrame],
    output: str = DEFAULT_OUTPUT,
    fmt: str = "parquet",
    writers: int = WRITERS,
    partition_by: str | None = None,
) -> str:
    """Write every section to its own folder under ``output`` and return that path.

    Sections with the column ``partition_by`` get a folder per value of it. If a section fails, those already begun are still written, and the first failure is raised.
    """

    def write(name: str) -> None:
        writer = sections[name].write.mode("overwrite").format(fmt)
        if partition_by in sections[name].columns:
            writer = writer.partitionBy(partition_by)
        writer.save(f"{output}/{name}")

    session = next((section.sparkSession for section in sections.values()), None)
    with ThreadPoolExecutor(max_workers=max(1, writers)) as pool:
        begun = [pool.submit(inheritable_thread_target(session)(write), name) for name in sections]
    for one in begun:
        one.result()
    return output
