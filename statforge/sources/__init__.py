"""Sources: text scans (S1-S6, S10, S11) and parameter files."""

from statforge.sources.params import (
    centroids_frame,
    centroids_to_list,
    moments_to_lists,
    read_centroids,
    read_moments,
    read_variables,
)
from statforge.sources.position import numbered_lines, numbered_rows
from statforge.sources.text import (
    cut_fields,
    fixed_width,
    lines_from_columns,
    parse_delimited,
    read_lines,
    redelimit,
)


def read_table(spark, sf_dir: str, name: str, position: bool = False):
    """One parquet test table (``{sf_dir}/{name}.parquet``); its splits follow
    ``spark.sql.files.maxPartitionBytes`` and ``spark.sql.files.minPartitionNum``.
    ``position`` adds the rows' ``file`` and ``line_no``."""
    table = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return numbered_rows(table) if position else table


__all__ = [
    "centroids_frame",
    "centroids_to_list",
    "cut_fields",
    "fixed_width",
    "lines_from_columns",
    "moments_to_lists",
    "numbered_lines",
    "numbered_rows",
    "parse_delimited",
    "read_centroids",
    "read_lines",
    "read_moments",
    "read_table",
    "read_variables",
    "redelimit",
]
