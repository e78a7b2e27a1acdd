"""Numbering rows without an un-partitioned window or a hot group.

The operators here split a long run of rows into blocks of the ordering column.
That column is a BIGINT ordinal, unique among the rows to number, so a block holds
at most ``block_rows`` rows whatever the data looks like.  Rows are numbered inside
their block, and the rows of the earlier blocks are added from a small table of block
counts.  A row without an ordinal comes first, in a block of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterflow.functions.text import filled
from rosterflow.session import materialize

BLOCK_ROWS = 250_000
HOT_ROWS = 1_000_000

_BLOCK, _BEFORE, _HOT, _ROWS = "__block", "__before", "__hot", "__rows"
_KEY, _ORDER, _SIDE = "__key", "__order", "__side"
_NO_ORDER = -(2**63)


def _block_of(order: str, block_rows: int):
    """Blocks follow the order; rows without one are the first block, as nulls sort first."""
    return F.coalesce(F.expr(f"`{order}` div {int(block_rows)}"), F.lit(_NO_ORDER))


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]):
    """Equality of the named columns, null being equal to null; the right ones are prefixed."""
    return reduce(lambda a, b: a & b, (left[n].eqNullSafe(right[f"__r_{n}"]) for n in names))


def _prefixed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({n: f"__r_{n}" for n in names})


def _rows_before(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Running total of ``_ROWS`` over the earlier blocks; one row per block in and out."""
    window = Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(_ROWS).over(window), F.lit(0)).cast("bigint")
    return counts.select(*keys, _BLOCK, before.alias(_BEFORE))


def dense_ordinal(
    df: DataFrame, order: str, out: str = "row_ord", start: int = 0, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Number all rows ``start, start + 1, ...`` along ``order`` (a unique BIGINT), those without one first.

    The rows are read twice, for the counts and for themselves, so ``order`` must
    not change between readings; put an expensive frame through
    ``rosterflow.materialize`` first.  One shuffle of the rows, by block.  The window that spans the whole table runs
    over block counts only: one row per ``block_rows`` ordinals.
    """
    blocked = df.withColumn(_BLOCK, _block_of(order, block_rows))
    counts = blocked.groupBy(_BLOCK).agg(F.count(F.lit(1)).alias(_ROWS))
    local = F.row_number().over(Window.partitionBy(_BLOCK).orderBy(order))
    return (
        blocked.withColumn(out, local.cast("bigint"))
        .join(_rows_before(counts, []), _BLOCK)
        .withColumn(out, F.col(out) + F.col(_BEFORE) + F.lit(start - 1))
        .select(*df.columns, out)
    )


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, side: str | None = None) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows, on one ``side`` at least; None when there are none.

    One aggregation over the key columns alone, which combines on the map side, so
    a hot key costs no more than another.  The keys are written to the shared folder
    and stay a frame: their number is that of the rows over ``hot_rows`` at most.
    """
    sides = [] if side is None else [side]
    counts = df.groupBy(*keys, *sides).agg(F.count(F.lit(1)).alias(_ROWS)).filter(F.col(_ROWS) > hot_rows).select(*keys)
    found = materialize(counts.distinct() if sides else counts, "hot_keys")
    return None if found.isEmpty() else found


def _number_spread(
    df: DataFrame, hot: DataFrame, keys: Sequence[str], order: str, out: str, block_rows: int
) -> DataFrame:
    """Numbering with the rows of ``hot`` keys spread over blocks; a null in a key is a value like others.

    The table of block counts holds hot keys only.
    """
    known = _prefixed(hot, keys).withColumn(_HOT, F.lit(True))
    marked = df.join(known, _same(df, known, keys), "left").select(*df.columns, _HOT)
    blocked = marked.withColumn(
        _BLOCK, F.when(F.col(_HOT), _block_of(order, block_rows)).otherwise(F.lit(0))
    )
    counts = blocked.filter(_HOT).groupBy(*keys, _BLOCK).agg(F.count(F.lit(1)).alias(_ROWS))
    local = F.row_number().over(Window.partitionBy(*keys, _BLOCK).orderBy(order))
    numbered = blocked.withColumn(out, local.cast("bigint"))
    before = _prefixed(_rows_before(counts, keys), [*keys, _BLOCK])
    return (
        numbered.join(before, _same(numbered, before, [*keys, _BLOCK]), "left")
        .withColumn(out, F.col(out) + F.coalesce(F.col(_BEFORE), F.lit(0)))
        .select(*df.columns, out)
    )


def occurrence_number(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str,
    out: str = "n",
    hot_rows: int | None = HOT_ROWS,
    block_rows: int = BLOCK_ROWS,
    null_keys: str = "number",
    hot: DataFrame | None = None,
) -> DataFrame:
    """``row_number()`` per key along ``order`` (a unique BIGINT), safe for hot keys.

    Rows of an ordinary key share one window partition.  Keys with more than
    ``hot_rows`` rows are found by a small job first, and their rows are spread
    over blocks; ``hot_rows=None`` skips that job where keys are known to be even,
    and ``hot`` gives the keys where they are known.  The result is the same either way.
    ``null_keys='drop'`` removes rows with a null key, which can pair with nothing;
    ``'number'`` numbers them as a group of their own.  Rows without an order come first.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if null_keys not in ("number", "drop"):
        raise ValueError(f"null_keys must be 'number' or 'drop', not {null_keys!r}")
    if null_keys == "drop":
        df = df.filter(~reduce(lambda a, b: a | b, (F.col(key).isNull() for key in keys)))
    if hot is None and hot_rows is not None:
        hot = hot_keys(df, keys, hot_rows)
    if hot is None:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(order)).cast("bigint"))
    return _number_spread(df, hot, keys, order, out, block_rows)


def _pair_by_union(
    master: DataFrame, sheet: DataFrame, key: str, order: str, sheet_key: str, sheet_order: str, out: str
) -> DataFrame:
    """Pairing without a join: both sides in one shuffle by key, and two windows on it.

    The first window numbers the rows of a key on each side.  In the second, a
    master row and the sheet row with its key and number stand next to each other.
    """
    left = master.select("*", F.col(key).alias(_KEY), F.col(order).alias(_ORDER), F.lit(0).alias(_SIDE))
    right = sheet.select("*", F.col(sheet_key).alias(_KEY), F.col(sheet_order).alias(_ORDER), F.lit(1).alias(_SIDE))
    both = left.unionByName(right, allowMissingColumns=True).repartition(_KEY)
    place = F.row_number().over(Window.partitionBy(_KEY, _SIDE).orderBy(_ORDER))
    pair = Window.partitionBy(_KEY, out).orderBy(_SIDE)
    partner = {c: F.lead(c).over(pair) for c in sheet.columns}
    partner[f"{out}_sheet"] = F.lead(out).over(pair)
    return (
        both.withColumn(out, place.cast("bigint"))
        .withColumns(partner)
        .filter(F.col(_SIDE) == 0)
        .select(*master.columns, out, *partner)
    )


def nth_occurrence_join(
    master: DataFrame,
    sheet: DataFrame,
    key: str,
    order: str,
    sheet_key: str | None = None,
    sheet_order: str = "sheet_row",
    out: str = "n",
    hot_rows: int | None = HOT_ROWS,
    block_rows: int = BLOCK_ROWS,
    null_keys: str = "number",
) -> DataFrame:
    """Left join that pairs the n-th master row of a key with its n-th sheet row.

    Sheet columns come out as ``<name>_sheet``, the sheet's order column under its
    own name; ``<out>_sheet`` is null where a master row has no partner.  Blank and
    null sheet keys can pair with nothing and are left out; null master keys stay,
    without a partner, unless ``null_keys='drop'``.

    Where no key is hot, each side is shuffled once, by key.  Where one is, its rows
    are numbered in blocks, and the sides are joined on (key, n), which spreads it.
    Hot keys are searched once, in one aggregation over the keys of both sides;
    ``hot_rows=None`` skips that where keys are known to be even.  Columns of the
    result that would share a name are refused.
    """
    sheet_key = sheet_key or key
    named = sheet.filter(filled(F.col(sheet_key)))
    named = named.select(
        *[F.col(f"`{c}`").alias(c if c == sheet_order else f"{c}_sheet") for c in named.columns]
    )
    sheet_key = f"{sheet_key}_sheet"
    taken = {c.lower() for c in (*master.columns, out)}
    clashes = [c for c in (*named.columns, f"{out}_sheet") if c.lower() in taken]
    if clashes or out.lower() in {c.lower() for c in master.columns}:
        raise ValueError(f"columns of both sides would share a name, rename them first: {clashes or [out]}")
    if null_keys == "drop":
        master = master.filter(F.col(key).isNotNull())
    hot = None
    if hot_rows is not None:
        sides = master.select(F.col(key).alias(_KEY), F.lit(0).alias(_SIDE)).unionByName(
            named.select(F.col(sheet_key).alias(_KEY), F.lit(1).alias(_SIDE))
        )
        hot = hot_keys(sides, [_KEY], hot_rows, _SIDE)
    if hot is None:
        return _pair_by_union(master, named, key, order, sheet_key, sheet_order, out)
    left = occurrence_number(master, key, order, out, None, block_rows, null_keys, hot.withColumnRenamed(_KEY, key))
    right = occurrence_number(
        named, sheet_key, sheet_order, f"{out}_sheet", None, block_rows, "drop", hot.withColumnRenamed(_KEY, sheet_key)
    )
    on = (left[key] == right[sheet_key]) & (left[out] == right[f"{out}_sheet"])
    return left.repartition(key, out).join(right.repartition(sheet_key, f"{out}_sheet"), on, "left")


def append_rows(
    sheet: DataFrame,
    new_rows: DataFrame,
    order: str,
    sheet_row: str = "sheet_row",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``new_rows`` numbered along ``order`` after the last row of ``sheet``.

    An empty sheet has its header in row 1, so the first new row is row 2.
    """
    last = sheet.agg(F.coalesce(F.max(sheet_row), F.lit(1)).cast("bigint")).scalar()
    rest = new_rows.drop(sheet_row)
    return dense_ordinal(rest, order, sheet_row, 1, block_rows).withColumn(
        sheet_row, F.col(sheet_row) + last
    )
