"""Cell patches: from flagged rows to cells, and from cells to a new sheet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.model import UpdateGroup
from rosterflow.operators.joins import anti_join


def _explode_cells(df: DataFrame, cells: list[tuple[Column, Column]], keep: Sequence[str]) -> DataFrame:
    """One row per wanted cell; ``cells`` holds (wanted, struct) pairs."""
    any_wanted = cells[0][0]
    for wanted, _ in cells[1:]:
        any_wanted = any_wanted | wanted
    items = F.array(*[F.struct(wanted.alias("wanted"), cell.alias("cell")) for wanted, cell in cells])
    return (
        df.filter(any_wanted)
        .select(*keep, F.explode(items).alias("item"))
        .filter("item.wanted")
        .select(*keep, "item.cell.*")
    )


def build_patches(
    plan: DataFrame, groups: Sequence[UpdateGroup], row: str = "sheet_row", ranges: bool = False
) -> DataFrame:
    """One row per cell to write: ``(sheet_row, field, value, group)``.

    A group contributes every field it writes, by name.  With ``ranges`` the frame
    also has the address of the group's range and of the cell, where the group
    declares its column letters.
    """
    cells = []
    for group in groups:
        for name in group.fields:
            parts = [
                F.lit(name).alias("field"),
                F.col(name).cast("string").alias("value"),
                F.lit(group.name).alias("group"),
            ]
            if ranges:
                letter = group.cells.get(name)
                whole = F.concat(F.lit(group.first_col), F.col(row), F.lit(":"), F.lit(group.last_col), F.col(row))
                parts += [whole.alias("range"), F.concat(F.lit(letter), F.col(row)).alias("cell")]
            cells.append((F.col(group.name) == 1, F.struct(*parts)))
    return _explode_cells(plan, cells, [row])


def build_field_patches(
    diff: DataFrame,
    values: Mapping[str, str],
    cells: Mapping[str, str] | None = None,
    flag_prefix: str = "differences_",
    row: str = "sheet_row",
) -> DataFrame:
    """One row per differing field: ``(sheet_row, field, value, group)``, each field its own group.

    ``values`` maps a field to the column that holds its new text; ``cells`` its
    column letter, which adds the cell address.
    """
    wanted = []
    for name, source in values.items():
        parts = [
            F.lit(name).alias("field"),
            F.col(source).cast("string").alias("value"),
            F.lit(name).alias("group"),
        ]
        if cells is not None:
            parts.append(F.concat(F.lit(cells.get(name)), F.col(row)).alias("cell"))
        wanted.append((F.col(flag_prefix + name), F.struct(*parts)))
    return _explode_cells(diff, wanted, [row])


def apply_patches(
    sheet: DataFrame,
    patches: DataFrame,
    fields: Sequence[str],
    row: str = "sheet_row",
    duplicates: str = "fail",
    order: str | None = None,
    unknown: str = "fail",
) -> DataFrame:
    """The sheet after its patches.  A patch may set null, so presence is kept apart.

    Two patches for one cell raise at run time with ``duplicates='fail'``; with
    ``'last'`` the one with the highest ``order`` wins, null being the lowest and the larger
    value winning a tie.  A patch for a row that the sheet lacks, or a field that isn't among
    ``fields``, raises at run time too; with ``unknown='skip'`` it is left out, and
    :func:`rejected_patches` lists it.  The patches are folded to one row per sheet row by
    an aggregation that combines before the shuffle.
    """
    if duplicates not in ("fail", "last"):
        raise ValueError(f"duplicates must be 'fail' or 'last', not {duplicates!r}")
    if unknown not in ("fail", "skip"):
        raise ValueError(f"unknown must be 'fail' or 'skip', not {unknown!r}")
    if duplicates == "last" and order is None:
        raise ValueError("duplicates='last' needs an order column")
    known_field = F.coalesce(F.col("field").isin(list(fields)), F.lit(False))
    folded = [F.count_if(~known_field).alias("__other")]
    for name in fields:
        hit = F.col("field") == name
        folded.append(F.count_if(hit).alias(f"__n_{name}"))
        boxed = F.when(hit, F.struct("value"))
        newest = F.max_by(boxed, F.when(hit, F.struct(order, "value"))) if duplicates == "last" else F.max(boxed)
        folded.append(newest.alias(f"__v_{name}"))
    wide = patches.groupBy(F.col(row).alias("__row")).agg(*folded)
    # with 'fail', rows that only the patches have must come through to raise
    joined = sheet.withColumn("__here", F.lit(True)).join(
        wide, sheet[row] == wide["__row"], "full_outer" if unknown == "fail" else "left"
    )
    kind = sheet.schema[row].dataType
    where = F.coalesce(F.col("__row").cast("string"), F.lit("null"))
    checked = F.when(F.col("__here").isNull(), F.raise_error(F.concat(F.lit("a patch for a row that isn't there: "), where)).cast(kind))
    checked = checked.when(F.col("__other") > 0, F.raise_error(F.concat(F.lit("a patch for an unknown field in row "), where)).cast(kind))

    patched = {row: checked.otherwise(F.col(row))} if unknown == "fail" else {}
    for name in fields:
        count, value = F.col(f"__n_{name}"), F.col(f"__v_{name}")["value"]
        new = value.cast(sheet.schema[name].dataType)
        result = F.when(count > 0, new).otherwise(F.col(name))
        if duplicates == "fail":
            text = F.concat(F.lit(f"more than one patch for {name} in row "), F.col(row).cast("string"))
            result = F.when(count > 1, F.raise_error(text).cast(sheet.schema[name].dataType)).otherwise(result)
        patched[name] = result
    return joined.select(*[patched[c].alias(c) if c in patched else F.col(c) for c in sheet.columns])


def rejected_patches(sheet: DataFrame, patches: DataFrame, fields: Sequence[str], row: str = "sheet_row") -> DataFrame:
    """The patches for rows that the sheet lacks or fields that aren't among ``fields``."""
    known = F.coalesce(F.col("field").isin(list(fields)), F.lit(False))
    return patches.filter(~known).unionByName(anti_join(patches.filter(known), sheet, [row]))
