"""Sheet grids: ``(sheet STRING, row_ord BIGINT, cells ARRAY<STRING>)``, row 0 the header."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.text import sheet_team
from rosterflow.model import ROSTER_LABELS, SHEET_WIDTHS
from rosterflow.operators.frames import rename_columns

TEAM_SHEET_PREFIX = "chapter_lead_"  # fixed value: how team sheets are named


def header_names(cells: Sequence[str | None], duplicates: str = "suffix") -> list[str]:
    """Usable column names: blanks become ``column_<i>``, repeats get ``_2``, ``_3``, ..."""
    names: list[str] = []
    taken: set[str] = set()
    for i, cell in enumerate(cells, start=1):
        base = (cell or "").strip() or f"column_{i}"
        name, n = base, 1
        while name.lower() in taken:
            if duplicates == "fail":
                raise ValueError(f"header name {base!r} is used more than once")
            n += 1
            name = f"{base}_{n}"
        taken.add(name.lower())
        names.append(name)
    return names


def promote_header(
    grid: DataFrame,
    max_cols: int | None = None,
    row_col: str | None = "sheet_row",
    duplicates: str = "suffix",
    sheet: str | None = None,
) -> DataFrame:
    """One sheet as a table: row 0 names the columns, the rest is data.

    Keeps the first ``max_cols`` columns.  Without ``max_cols``, a filled cell beyond the
    header fails the job.  Cells missing from a short row are blank.  ``sheet`` picks one of
    several sheets; a grid with more than one header row is refused.  ``row_col`` is the
    1-based row in the sheet, so data starts at 2.  Only the header comes to the driver.
    """
    if sheet is not None:
        grid = grid.filter(F.col("sheet") == sheet)
    headers = grid.filter(F.col("row_ord") == 0).select("cells").take(2)
    if not headers:
        raise ValueError("the grid has no header row (row_ord = 0)")
    if len(headers) > 1:
        raise ValueError("the grid has more than one header row; name the sheet to read")
    names = header_names(list(headers[0]["cells"])[:max_cols], duplicates)
    cells = [F.coalesce(F.get("cells", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)]
    if max_cols is None and cells:
        surplus = F.exists(
            F.slice("cells", F.lit(len(names) + 1), F.greatest(F.size("cells") - len(names), F.lit(0))),
            lambda c: F.trim(c) != "",
        )
        text = F.concat(F.lit("a cell beyond the header in row "), F.col("row_ord").cast("string"))
        first = F.coalesce(F.get("cells", F.lit(0)), F.lit(""))
        cells[0] = F.when(surplus, F.raise_error(text).cast("string")).otherwise(first).alias(names[0])
    if row_col:
        cells.append((F.col("row_ord") + 1).alias(row_col))
    return grid.filter(F.col("row_ord") > 0).select(*cells)


def roster_from_grid(grid: DataFrame, max_cols: int | None = None, row_col: str = "sheet_row") -> DataFrame:
    """A roster sheet as a table with the snake_case names of ``ROSTER_LABELS``.

    Labels the roster does not know keep their own name.
    """
    return rename_columns(promote_header(grid, max_cols, row_col), ROSTER_LABELS)


def load_sheet(grid: DataFrame, name: str, sheet: str | None = None) -> DataFrame:
    """The master sheet, or a division's, at its declared width (``SHEET_WIDTHS``), ready for ``sinks``.

    A division's rows carry ``sheet_row``, the master's ``row_ord``, their place among the data
    rows from 0.  Columns beyond the width are left out, whatever they hold.
    """
    if name not in SHEET_WIDTHS:
        raise ValueError(f"no width is declared for {name!r}; known are {sorted(SHEET_WIDTHS)}")
    rows = rename_columns(promote_header(grid, SHEET_WIDTHS[name], "sheet_row", sheet=sheet), ROSTER_LABELS)
    if name != "master":
        return rows
    return rows.withColumn("sheet_row", F.col("sheet_row") - 2).withColumnRenamed("sheet_row", "row_ord")


def union_team_sheets(
    grids: DataFrame,
    teams: DataFrame,
    columns: Sequence[str],
    prefix: str = TEAM_SHEET_PREFIX,
) -> DataFrame:
    """The sheets of known teams, stacked: ``team_name``, ``sheet_row`` and ``columns``.

    Each sheet is read by its own header, which is removed.  A column that a sheet
    lacks is null there; a cell missing from a short row is blank.  A sheet of a known team
    without a header, or with two headers of one wanted name, fails the job.  The data
    rows see one join, to a table with one row per sheet, whose hot sheets adaptive
    execution splits.
    """
    known = teams.select(F.col(teams.columns[0]).alias("team_name")).distinct()
    header = F.transform("cells", lambda c: F.trim(c))
    positions = [
        F.nullif(F.array_position(header, F.lit(c)), F.lit(0)).cast("int").alias(f"__at_{i}")
        for i, c in enumerate(columns)
    ]
    twice = lambda c: F.size(F.filter(header, lambda h: h == F.lit(c))) > 1
    repeated = reduce(lambda a, b: a | b, map(twice, columns), F.lit(False))
    headers = grids.filter(F.col("row_ord") == 0).select("sheet", repeated.alias("__repeated"), *positions)
    sheets = (
        grids.filter(F.col("sheet").startswith(prefix)).select("sheet").distinct()
        .withColumn("team_name", sheet_team(F.col("sheet"), prefix)).join(known, "team_name", "left_semi")
        .join(headers, "sheet", "left")
    )
    fault = F.when(F.col("__repeated").isNull(), F.lit("no header in ")).when(F.col("__repeated"), F.lit("a header name is used twice in "))
    checked = F.when(fault.isNotNull(), F.raise_error(F.concat(fault, F.col("sheet"))).cast("string")).otherwise(F.col("team_name"))
    joined = grids.filter((F.col("row_ord") > 0) & F.col("sheet").startswith(prefix)).join(sheets, "sheet")
    values = [
        F.when(
            F.col(f"__at_{i}").isNotNull(),
            F.coalesce(F.get("cells", F.col(f"__at_{i}") - 1), F.lit("")),
        ).alias(c)
        for i, c in enumerate(columns)
    ]
    return joined.select(checked.alias("team_name"), (F.col("row_ord") + 1).alias("sheet_row"), *values)
