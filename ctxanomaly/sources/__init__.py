"""Sources and sinks."""

from ctxanomaly.sources.fixtures import raw_events, raw_lineitem, raw_prices, table
from ctxanomaly.sources.records import coerce_datetime, merge_parts, profile, read_records, read_results, read_stage
from ctxanomaly.sources.sinks import write_report, write_stage

__all__ = [
    "coerce_datetime",
    "merge_parts",
    "profile",
    "raw_events",
    "raw_lineitem",
    "raw_prices",
    "read_records",
    "read_results",
    "read_stage",
    "table",
    "write_report",
    "write_stage",
]
