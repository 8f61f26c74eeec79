"""Sources and sinks: declared schemas, CSV scans, prediction and importance
writers."""

from clickweave.sources.files import (
    IMPORTANCE,
    IMPRESSIONS,
    ITEMS,
    PREDICTIONS,
    TEST_IMPRESSIONS,
    VIEW_LOG,
    Scan,
    read_csv,
    scan_csv,
    write_csv,
    write_importance,
    write_predictions,
)

__all__ = ["IMPORTANCE", "IMPRESSIONS", "ITEMS", "PREDICTIONS", "TEST_IMPRESSIONS", "VIEW_LOG", "Scan", "read_csv", "scan_csv",
           "write_csv", "write_importance", "write_predictions"]
