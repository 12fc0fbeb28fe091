from shelfmark.plans.catalog import REPORTS, Parameter, ReportSpec, run_report
from shelfmark.plans.circulation import (
    circ_stats_course_reserves, circulation_history, internal_use_by_item, internal_use_count,
    zero_use_items,
)
from shelfmark.plans.derived import instance_ext, item_circulation_notes, item_ext
from shelfmark.plans.inventory import class_list, collection_inventory, note_type_items
from shelfmark.plans.reserves import (
    reserves_listings_only, reserves_permanent, reserves_quarter, reserves_quarter_course,
)

__all__ = [
    "REPORTS", "Parameter", "ReportSpec", "circ_stats_course_reserves", "circulation_history",
    "class_list", "collection_inventory", "instance_ext", "internal_use_by_item",
    "internal_use_count", "item_circulation_notes", "item_ext", "note_type_items",
    "reserves_listings_only", "reserves_permanent", "reserves_quarter",
    "reserves_quarter_course", "run_report", "zero_use_items",
]
