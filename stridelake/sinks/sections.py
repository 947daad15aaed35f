"""Report sections and sorted outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame

# The default format would cut instants to milliseconds.
TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def write_section(df: DataFrame, path: str, order_by: list[str] | None = None) -> None:
    """Write one report section as JSON lines.

    With ``order_by`` the rows are range-partitioned: each part file is sorted and the files
    follow one another in order, so no single task has to hold the whole section.
    """
    if order_by:
        df = df.orderBy(*order_by)
    df.write.mode("overwrite").option("timestampFormat", TIMESTAMP).json(path)


def write_bundle(sections: dict[str, DataFrame], path: str) -> None:
    """Write all sections of a report below ``path``, one folder each."""
    for name, df in sections.items():
        write_section(df, f"{path}/{name}")
