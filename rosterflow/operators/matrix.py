"""The talent matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterflow.functions.mapping import map_values
from rosterflow.functions.talent import PERFORMANCE_LABELS, POTENTIAL_LABELS, seven_box


def with_seven_box(df: DataFrame, performance: str = "performance", potential: str = "potential") -> DataFrame:
    """Add ``seven_box``; pairs without a box get null."""
    return df.withColumn("seven_box", seven_box(F.col(performance), F.col(potential)))


def with_labels(df: DataFrame, performance: str = "performance", potential: str = "potential") -> DataFrame:
    """Scores as labels; a score without a label becomes null."""
    return df.withColumns(
        {
            performance: map_values(F.col(performance), PERFORMANCE_LABELS),
            potential: map_values(F.col(potential), POTENTIAL_LABELS),
        }
    )


def talent_matrix(df: DataFrame, performance: str = "performance", potential: str = "potential") -> DataFrame:
    """Head count and share per box.  The share's window spans the boxes, seven at most."""
    boxed = with_seven_box(df, performance, potential).filter(F.col("seven_box").isNotNull())
    counts = boxed.groupBy(performance, potential, "seven_box").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.withColumn("share", F.col("n").cast("double") / total)


def talent_grid(df: DataFrame, performance: str = "performance", potential: str = "potential") -> DataFrame:
    """The matrix as a grid: one row per performance, one count per potential."""
    counted = df.groupBy(performance).pivot(potential, [1, 2, 3]).agg(F.count(F.lit(1)))
    return counted.select(
        performance, *[F.coalesce(F.col(str(p)), F.lit(0)).alias(f"potential_{p}") for p in (1, 2, 3)]
    )
