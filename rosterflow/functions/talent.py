"""Talent classification."""

from __future__ import annotations

from pyspark.sql import Column

from rosterflow.functions.mapping import first_match

# Performance, potential, box.
SEVEN_BOXES = [
    (3, 3, "rock_star"),
    (3, 2, "singer_star"),
    (3, 1, "vocal_coach"),
    (2, 3, "future_rock_star"),
    (2, 2, "choir_singer"),
    (2, 1, "solist_solid"),
    (1, 1, "out_of_tune"),
]
PERFORMANCE_LABELS = {3: "High Performance", 2: "Achieve Performance", 1: "Low Performance"}
POTENTIAL_LABELS = {3: "High Potential", 2: "Potential", 1: "At Potential"}


def seven_box(performance: Column, potential: Column) -> Column:
    """Name of the talent box; pairs without a box give null."""
    return first_match([performance, potential], SEVEN_BOXES)
