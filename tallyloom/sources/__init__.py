"""Typed readers and overwriting writers."""

from tallyloom.sources.readers import (
    LAYOUTS,
    Checked,
    read_centers,
    read_checked,
    read_key_values,
    read_lines,
    read_match_profiles,
    read_named_lines,
    read_nations,
    read_pairs,
    read_parts,
    read_play_log,
    read_points,
    read_suppliers,
    read_table,
    read_team_profiles,
    spread,
)
from tallyloom.sources.writers import (
    centers_frame,
    replace_output,
    write_centers,
    write_csv,
    write_key_values,
    write_line_parts,
    write_lines,
    write_parquet,
)

__all__ = [
    "LAYOUTS",
    "Checked",
    "centers_frame",
    "read_centers",
    "read_checked",
    "read_key_values",
    "read_lines",
    "read_match_profiles",
    "read_named_lines",
    "read_nations",
    "read_pairs",
    "read_parts",
    "read_play_log",
    "read_points",
    "read_suppliers",
    "read_table",
    "read_team_profiles",
    "replace_output",
    "spread",
    "write_centers",
    "write_csv",
    "write_key_values",
    "write_line_parts",
    "write_lines",
    "write_parquet",
]
