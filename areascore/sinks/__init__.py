"""Writers."""

from areascore.sinks.writers import (
    count_rows,
    write_csv,
    write_dataset,
    write_single_file,
    write_with_counts,
)

__all__ = ["count_rows", "write_csv", "write_dataset", "write_single_file", "write_with_counts"]
