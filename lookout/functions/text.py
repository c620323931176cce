"""Names, statements, message templates, JSON tags."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default maximum name lengths.
SERVICE_MAX, INSTANCE_MAX, ENDPOINT_MAX, STATEMENT_MAX = 70, 70, 150, 2000


def cut(c: Column, limit: int) -> Column:
    return F.substring(c, 1, limit)


def service_name(c: Column, limit: int = SERVICE_MAX) -> Column:
    return cut(c, limit)


def instance_name(c: Column, limit: int = INSTANCE_MAX) -> Column:
    return cut(c, limit)


def endpoint_name(c: Column, limit: int = ENDPOINT_MAX) -> Column:
    return cut(c, limit)


def group_of(name: Column) -> Column:
    """Text before ``::``, empty when there is none."""
    return F.when(F.instr(name, "::") > 1, F.substring_index(name, "::", 1)).otherwise(F.lit(""))


def short_name(name: Column) -> Column:
    at = F.instr(name, "::")
    return F.when(at > 1, F.substring(name, at + 2, F.length(name))).otherwise(name)


def template(text: str, **values: Column) -> Column:
    """Fill ``{id}`` and ``{name}`` placeholders of a message template."""
    out = F.lit(text)
    for key, value in values.items():
        out = F.replace(out, F.lit("{" + key + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def json_props_merge(old: Column, new: Column) -> Column:
    """Merge two property objects held as JSON text; the newer value of a key wins."""
    a, b = (F.coalesce(F.from_json(x, "map<string,string>"), F.from_json(F.lit("{}"), "map<string,string>"))
            for x in (old, new))
    merged = F.map_zip_with(a, b, lambda _, x, y: F.coalesce(y, x))
    return F.to_json(F.map_from_entries(F.sort_array(F.map_entries(merged))))


def logic_endpoint(tag: Column, is_local: Column, op_name: Column, span_latency: Column, is_error: Column) -> Column:
    """Logic-endpoint tag JSON to struct(name, latency, status); null when the tag names no endpoint."""
    j = F.from_json(tag, "`logic-span` boolean, name string, latency int, status boolean")
    local = is_local & F.coalesce(j["logic-span"], F.lit(False))
    explicit = j["name"].isNotNull() & j["latency"].isNotNull() & j["status"].isNotNull()
    return (F.when(local, F.struct(op_name.alias("name"), span_latency.cast("int").alias("latency"), (~is_error).alias("status")))
            .when(explicit, F.struct(j["name"].alias("name"), j["latency"].alias("latency"), j["status"].alias("status"))))


def searchable_tags(tags: Column, keys, max_length: int = 256) -> Column:
    """Allowed tags as distinct ``key=value`` texts no longer than the limit. ``tags`` is array of struct(key, value)."""
    kept = F.filter(tags, lambda t: t["key"].isin(list(keys)) & t["value"].isNotNull())
    pairs = F.transform(kept, lambda t: F.concat(t["key"], F.lit("="), t["value"]))
    return F.array_distinct(F.filter(pairs, lambda p: F.length(p) <= max_length))


def json_fields(body: Column, kinds: Mapping[str, str]) -> Column:
    """Struct of the named fields of a JSON object, cast to their kinds; null where absent, of another kind or no JSON."""
    field = lambda name: F.get_json_object(body, f"$['{name}']")
    return F.struct(*[field(n).try_cast(k).alias(n) for n, k in kinds.items()])


def json_object(**fields: Column) -> Column:
    """JSON text of the fields that are not null, in this order, as event parameters and properties are kept."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


def uri_path(url: Column) -> Column:
    """Path of a URL without scheme, host, query and fragment."""
    return F.regexp_extract(url, r"^(?:[a-z]+://[^/?#]*)?(/[^?#]*)", 1)


def whole(pattern: str) -> str:
    """A regular expression that matches entire texts only, also not up to a last line feed."""
    return rf"\A(?:{pattern})\z"
