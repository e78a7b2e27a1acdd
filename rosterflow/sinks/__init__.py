from rosterflow.sinks.files import export_csv, route_by_team, stage_export
from rosterflow.sinks.tables import append_to, publish_snapshot, write_replace, write_truncate_append

__all__ = [
    "append_to",
    "export_csv",
    "publish_snapshot",
    "route_by_team",
    "stage_export",
    "write_replace",
    "write_truncate_append",
]
