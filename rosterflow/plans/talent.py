"""The talent table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rosterflow.operators.matrix import with_labels, with_seven_box


def talent_matrix_table(scores: DataFrame) -> DataFrame:
    """Scores as labels, with their box.  ``talent_matrix`` gives the counts."""
    return with_labels(with_seven_box(scores))
