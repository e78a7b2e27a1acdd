from rosterflow.functions.compare import any_differs, differs
from rosterflow.functions.mapping import compose_maps, first_match, map_values
from rosterflow.functions.talent import PERFORMANCE_LABELS, POTENTIAL_LABELS, seven_box
from rosterflow.functions.text import (
    blank_to_null,
    cast_key,
    date_text,
    end_date_or_sentinel,
    filled,
    load_stamp,
    null_text,
    parse_amount,
    parse_date,
    scale_hundredths,
    sentinel_to_null,
    sheet_team,
    split_name,
)

__all__ = [
    "PERFORMANCE_LABELS",
    "POTENTIAL_LABELS",
    "any_differs",
    "blank_to_null",
    "cast_key",
    "compose_maps",
    "date_text",
    "differs",
    "end_date_or_sentinel",
    "filled",
    "first_match",
    "load_stamp",
    "map_values",
    "null_text",
    "parse_amount",
    "parse_date",
    "scale_hundredths",
    "sentinel_to_null",
    "seven_box",
    "sheet_team",
    "split_name",
]
