"""Column-level building blocks: date parts, zone-free epoch values, gaps and
ratios.  Every function returns a built-in Spark ``Column`` (whole-stage
codegen, no Python at run time)."""

from clickweave.functions.dates import (
    date_part_columns,
    epoch_micros,
    epoch_seconds,
    micros_to_seconds,
)
from clickweave.functions.gaps import ratio, second_difference, step_gap, total_gap

__all__ = [
    "date_part_columns",
    "epoch_micros",
    "epoch_seconds",
    "micros_to_seconds",
    "ratio",
    "second_difference",
    "step_gap",
    "total_gap",
]
