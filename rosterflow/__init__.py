"""rosterflow: people-data reconciliation on PySpark.

Every function takes DataFrames and returns DataFrames, lazily, on built-in
Spark expressions.  See README.md for a tour.
"""

from rosterflow.model import DIVISIONS, ROSTER_COLUMNS, Division, UpdateGroup
from rosterflow.session import build_session, materialize, recommended_conf, shared_dir

__all__ = [
    "DIVISIONS",
    "ROSTER_COLUMNS",
    "Division",
    "UpdateGroup",
    "build_session",
    "materialize",
    "recommended_conf",
    "shared_dir",
]
