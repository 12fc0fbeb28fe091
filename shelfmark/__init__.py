"""Library circulation, course-reserve and inventory reports on Spark."""

from shelfmark.plans import REPORTS, run_report
from shelfmark.sources import Tables, store_lower_ids

__all__ = ["REPORTS", "Tables", "run_report", "store_lower_ids"]
