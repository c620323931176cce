"""Label maps. A map cannot be a join key, so each one has a canonical text key that converts both ways."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAP_TYPE = "map<string,string>"


def key_of(labels: Column) -> Column:
    """Canonical JSON text of a label map, entries in key order."""
    return F.to_json(F.map_from_entries(F.sort_array(F.map_entries(labels))))


def from_key(key: Column) -> Column:
    return F.from_json(key, MAP_TYPE)


def empty() -> Column:
    return F.expr("map_from_entries(cast(array() as array<struct<key:string,value:string>>))")


def get(labels: Column, key: str) -> Column:
    """Label value; a missing label reads as the empty text."""
    return F.coalesce(F.try_element_at(labels, F.lit(key)), F.lit(""))


def pick(labels: Column, keys) -> Column:
    """Map of just these keys, missing ones as empty text."""
    keys = list(keys)
    if not keys:
        return empty()
    return F.create_map(*[x for k in keys for x in (F.lit(k), get(labels, k))])


def without(labels: Column, keys) -> Column:
    keys = list(keys)
    return F.map_filter(labels, lambda k, _: ~k.isin(keys)) if keys else labels


def put(labels: Column, key: str, value: Column) -> Column:
    """Set one label. The old entry is taken out only where there is one."""
    entry = F.create_map(F.lit(key), value)
    return (F.when(F.map_contains_key(labels, key), F.map_concat(without(labels, [key]), entry))
            .otherwise(F.map_concat(labels, entry)))


def encode(labels: Column) -> Column:
    """``{k=v,k2=v2}`` text form, entries in key order."""
    entries = F.sort_array(F.map_entries(labels))
    body = F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return F.concat(F.lit("{"), body, F.lit("}"))


def decode(text: Column) -> Column:
    """Inverse of :func:`encode`; text without braces becomes the value of the label ``_``."""
    inner = F.substring(text, F.lit(2), F.length(text) - 2)
    return (F.when(~(text.startswith("{") & text.endswith("}")), F.create_map(F.lit("_"), text))
            .when(inner == "", empty())
            .otherwise(F.str_to_map(inner, F.lit(","), F.lit("="))))


def relabel(labels: Column, key: str, values, new_key: str, new_values) -> Column:
    """Rename a label and map its values pairwise; rows whose value is not listed keep the old label."""
    if len(values) != len(new_values):
        raise ValueError("relabel needs as many new values as old ones")
    swap = F.create_map(*[F.lit(x) for pair in zip(values, new_values) for x in pair])
    hit = get(labels, key)
    return F.when(hit.isin(list(values)), put(without(labels, [key]), new_key, F.try_element_at(swap, hit))).otherwise(labels)


# ---- label-to-long tables ----

def table_encode(table: Column) -> Column:
    """``k,v|k2,v2`` text of a label-to-long map, in key order."""
    entries = F.sort_array(F.map_entries(table))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit(","), e["value"].cast("string"))), "|")


def table_decode(text: Column) -> Column:
    pairs = F.split(text, r"\|")
    entry = lambda p: F.struct(F.regexp_extract(p, r"^(.*),[^,]*$", 1).alias("key"),
                               F.regexp_extract(p, r",([^,]*)$", 1).cast("bigint").alias("value"))
    return F.map_from_entries(F.transform(F.filter(pairs, lambda p: p != ""), entry))


def table_merge(a: Column, b: Column, how: str = "sum") -> Column:
    combine = {
        "sum": lambda x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)),
        "max": lambda x, y: F.greatest(x, y),
        "min": lambda x, y: F.least(x, y),
    }[how]
    return F.map_zip_with(a, b, lambda _, x, y: combine(x, y))
