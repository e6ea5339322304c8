"""JSON objects with keys that are not known beforehand, as map<string, variant>.

A map must not hold a key twice, so a key is taken out before it is put in. The common case, in which there is nothing
to take out, copies the map once and runs no per-entry function.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def without(target: Column, *keys: str) -> Column:
    return F.map_filter(target, lambda k, _: ~k.isin(*keys))


def overlay(base: Column, top: Column) -> Column:
    """Both maps' entries; where both have a key, `top` wins even if its value is a JSON null."""
    rest = F.map_filter(base, lambda k, _: ~F.map_contains_key(top, k))
    shared = F.arrays_overlap(F.map_keys(base), F.map_keys(top))
    return F.when(shared, F.map_concat(rest, top)).otherwise(F.map_concat(base, top))


def put(target: Column, key: str, value: Column) -> Column:
    """The map with one key set."""
    entry = F.create_map(F.lit(key), value.cast("variant"))
    replaced = F.map_concat(without(target, key), entry)
    return F.when(F.map_contains_key(target, key), replaced).otherwise(F.map_concat(target, entry))


def rename_key(target: Column, old: str, new: str) -> Column:
    """Move `old` to `new`, replacing what `new` held; unchanged when `old` is absent."""
    moved = F.map_concat(without(target, old, new), F.create_map(F.lit(new), F.element_at(target, old)))
    return F.when(F.map_contains_key(target, old), moved).otherwise(target)


def put_nulls(target: Column, *keys: str) -> Column:
    """The map with a JSON null for each of the keys that it lacks."""
    null = F.parse_json(F.lit("null"))
    entries = F.create_map(*[part for key in keys for part in (F.lit(key), null)])
    return F.map_concat(target, F.map_filter(entries, lambda k, _: ~F.map_contains_key(target, k)))


def number(target: Column, key: str) -> Column:
    """The value as a double; null when absent or not a number."""
    return F.try_variant_get(F.try_element_at(target, F.lit(key)), "$", "double")


def text(target: Column, key: str) -> Column:
    """The value as text; null when absent."""
    return F.try_variant_get(F.try_element_at(target, F.lit(key)), "$", "string")
