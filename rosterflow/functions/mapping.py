"""Value maps and first-match rules."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Literal maps and rules are part of the plan, so they must stay small; a larger
# one belongs in a table and is joined with rosterflow.operators.joins.lookup_join.
MAX_LITERAL_ENTRIES = 200


def map_values(col: Column, mapping: Mapping, unmapped: str = "null") -> Column:
    """Replace values by a literal map.

    ``unmapped='null'`` turns other values into null; ``unmapped='keep'`` leaves
    them as they are, as text.
    """
    if unmapped not in ("null", "keep"):
        raise ValueError(f"unmapped must be 'null' or 'keep', not {unmapped!r}")
    if len(mapping) > MAX_LITERAL_ENTRIES:
        raise ValueError(f"{len(mapping)} entries are too many for a literal map; join a frame of them (operators.joins.lookup_join)")
    mapped = first_match([col], mapping.items())
    return F.coalesce(mapped, col.cast("string")) if unmapped == "keep" else mapped


def compose_maps(*maps: Mapping) -> dict:
    """One map with the effect of several applied in turn, unmapped values kept."""
    merged: dict = {}
    for key in dict.fromkeys(key for mapping in maps for key in mapping):
        value = key
        for mapping in maps:
            value = mapping.get(value, value)
        merged[key] = value
    return merged


def first_match(columns: Sequence[Column], rules: Iterable[Sequence]) -> Column:
    """Value of the first rule whose leading entries equal ``columns``, else null."""
    result = None
    for *keys, value in rules:
        if len(keys) != len(columns):
            raise ValueError(f"a rule needs {len(columns)} keys and a value, got {(*keys, value)!r}")
        test = columns[0] == F.lit(keys[0])
        for column, key in zip(columns[1:], keys[1:]):
            test = test & (column == F.lit(key))
        result = F.when(test, value) if result is None else result.when(test, value)
    return F.lit(None).cast("string") if result is None else result


def shadowed_rules(rules: Iterable[Sequence]) -> list[tuple]:
    """Rules that can never be reached because an earlier one has the same keys."""
    seen: set[tuple] = set()
    hidden = []
    for rule in rules:
        keys = tuple(rule[:-1])
        if keys in seen:
            hidden.append(tuple(rule))
        seen.add(keys)
    return hidden
