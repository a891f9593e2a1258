from tallywright.operators.hierarchy import entity_hierarchy
from tallywright.operators.joins import left_join_coalesced, preserve_rows
from tallywright.operators.numbering import batch_numbers, first_in_group, number_rows, occurrence_count, running_totals
from tallywright.operators.rangesums import range_sums
from tallywright.operators.reshape import column_widths, labelled_sums, pivot_sums, unpivot_present

__all__ = [
    "batch_numbers",
    "column_widths",
    "entity_hierarchy",
    "first_in_group",
    "labelled_sums",
    "left_join_coalesced",
    "number_rows",
    "occurrence_count",
    "pivot_sums",
    "preserve_rows",
    "range_sums",
    "running_totals",
    "unpivot_present",
]
