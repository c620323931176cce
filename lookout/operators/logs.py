"""Log analysis and search.

A log row is (service, instance, endpoint, layer, ts in ms, trace_id, segment_id, span_id, body, body_type, tags map).
Parsing adds ``parsed`` (map) and ``aborted``; sinks read ``keep``.
"""

from __future__ import annotations

import json
import re
from typing import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import ids
from ..functions import labels as L
from ..functions.timebucket import bucket_of_millis
from .topk import first_per_group

METADATA = ("service", "instance", "endpoint", "layer", "timestamp")


def prepare(df: DataFrame) -> DataFrame:
    return df.withColumn("parsed", L.empty()).withColumn("aborted", F.lit(False)).withColumn("keep", F.lit(True))


def parse_regexp(df: DataFrame, pattern: str, abort_on_failure: bool = True) -> DataFrame:
    """Named groups of the first match anywhere in the body become fields."""
    names = re.findall(r"\(\?<([A-Za-z][A-Za-z0-9]*)>", pattern)
    # position of each named group among all capturing groups
    opened = [m.group(0) for m in re.finditer(r"\\.|\((?!\?)|\(\?<[A-Za-z]", pattern) if not m.group(0).startswith("\\")]
    index = [i + 1 for i, g in enumerate(opened) if g.startswith("(?<")]
    body = F.coalesce("body", F.lit(""))
    hit = body.rlike(pattern)
    entries = [x for n, i in zip(names, index) for x in (F.lit(n), F.regexp_extract(body, pattern, i))]
    fields = F.create_map(*entries) if entries else L.empty()
    return _parsed(df, F.when(hit, fields), abort_on_failure, metadata=False)


def _parsed(df: DataFrame, fields: Column, abort_on_failure: bool, metadata: bool = True) -> DataFrame:
    """``fields`` is null where parsing failed. Metadata fills absent keys; a failure keeps only the metadata."""
    if metadata:
        source = {"timestamp": F.col("ts").cast("string")}
        pairs = [x for k in METADATA if (k in df.columns or k in source) for x in (F.lit(k), source.get(k, F.col(k) if k in df.columns else None))]
        base = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())
        merged = F.map_zip_with(base, F.coalesce(fields, L.empty()), lambda _, meta, own: F.coalesce(own, meta))
    else:
        merged = F.coalesce(fields, L.empty())
    failed = fields.isNull() if abort_on_failure else F.lit(False)
    return (df.withColumn("_failed", failed).withColumn("parsed", F.when(F.col("aborted"), F.col("parsed")).otherwise(merged))
            .withColumn("aborted", F.col("aborted") | F.col("_failed")).drop("_failed"))


def parse_json(df: DataFrame, abort_on_failure: bool = True) -> DataFrame:
    """Top-level fields of a JSON object body; nested values stay JSON text for :func:`path`."""
    body = F.trim(F.coalesce("body", F.lit("")))
    fields = F.when(body.startswith("{"), F.from_json(body, L.MAP_TYPE))
    return _parsed(df, fields, abort_on_failure)


def _yaml_scalar(text: str):
    text = text.strip()
    if len(text) > 1 and text[0] == text[-1] and text[0] in "\"'":
        return text[1:-1]
    return re.sub(r"(^|\s)#.*$", "", text).strip()


_YAML_KEY = re.compile(r"^((?:\"[^\"]*\"|'[^']*'|[^:#\s][^:]*?))\s*:(?=\s|$)(.*)$")
_YAML_BLOCK = re.compile(r"^([|>])([1-9]?)([+-]?)([1-9]?)\s*(?:#.*)?$")
_YAML_TOKEN = re.compile(r"\s*(?:(\"[^\"]*\"|'[^']*')|([\[\]{},])|(:)(?=[\s,\]}]|$)|((?:[^\s\[\]{},:\"']|:(?![\s,\]}]|$))(?:[^\[\]{},:]|:(?![\s,\]}]|$))*))")


class _Yaml:
    """Reads a map in block style. Entries are (indent, text, line): blank lines and comments are no entries, but the
    body of a block scalar is taken from the lines themselves."""

    def __init__(self, body: str):
        self.raw = body.split("\n")
        self.lines = [(len(x) - len(x.lstrip(" ")), x.strip(), i) for i, x in enumerate(self.raw) if x.strip() and not x.lstrip().startswith("#") and x.strip() not in ("---", "...")]

    def after(self, at: int, line: int) -> int:
        """The first entry from ``at`` on that stands on ``line`` or below."""
        while at < len(self.lines) and self.lines[at][2] < line:
            at += 1
        return at

    def block_scalar(self, header: re.Match, indent: int, line: int) -> tuple[str, int]:
        """The text of a literal (``|``) or folded (``>``) scalar below ``line``, and the line after it."""
        end, found = line + 1, []
        while end < len(self.raw) and (not self.raw[end].strip() or len(self.raw[end]) - len(self.raw[end].lstrip(" ")) > indent):
            found.append(self.raw[end])
            end += 1
        given = header[2] or header[4]
        depth = indent + int(given) if given else min((len(x) - len(x.lstrip(" ")) for x in found if x.strip()), default=0)
        found = [x[depth:] if x.strip() else "" for x in found]
        kept = len(found)
        while kept and not found[kept - 1]:
            kept -= 1
        if header[1] == "|":
            text = "\n".join(found[:kept])
        else:
            text, blank = "", 0
            for i, x in enumerate(found[:kept]):
                if not x:
                    blank += 1
                    continue
                deep = x.startswith(" ") or (i > 0 and found[i - 1 - blank].startswith(" ") if i - 1 - blank >= 0 else False)
                text += ("\n" * (blank + deep) if blank or deep else " ") + x if text else "\n" * blank + x
                blank = 0
        if header[3] == "-":
            return text, end
        return text + "\n" * (1 + len(found) - kept if header[3] == "+" else bool(kept)), end

    def flow(self, text: str, line: int, indent: int):
        """A list or map in brackets, over deeper lines where it does not end on its own; None if it never does."""
        while True:
            value, rest = _yaml_flow(text)
            if rest is not None or line + 1 >= len(self.raw):
                break
            line += 1
            if self.raw[line].strip() and len(self.raw[line]) - len(self.raw[line].lstrip(" ")) <= indent and self.raw[line].strip()[0] not in "]}":
                return None, line
            text += " " + re.sub(r"(^|\s)#.*$", "", self.raw[line])
        return (value if rest is not None and not _yaml_scalar(rest) else None), line + 1

    def value(self, text: str, at: int, indent: int):
        """The value that ``text``, the rest of entry ``at - 1``, starts, and the entry after it."""
        line = self.lines[at - 1][2]
        header = _YAML_BLOCK.match(text)
        if header:
            found, line = self.block_scalar(header, indent, line)
            return found, self.after(at, line)
        if text[:1] in ("[", "{"):
            found, line = self.flow(text, line, indent)
            if found is not None:
                return found, self.after(at, line)
        return _yaml_scalar(text), at

    def block(self, at: int, indent: int):
        """The map or list that starts at entry ``at``, and the entry after it."""
        lines, item_of = self.lines, lambda x: x == "-" or x.startswith("- ")
        if item_of(lines[at][1]):
            items = []
            while at < len(lines) and lines[at][0] == indent and item_of(lines[at][1]):
                rest = lines[at][1][1:].lstrip()
                inner = indent + len(lines[at][1]) - len(rest)
                if rest and (_YAML_KEY.match(rest) and rest[0] not in "[{" or rest.startswith("- ")):
                    lines[at] = (inner, rest, lines[at][2])
                    item, at = self.block(at, inner)
                elif rest:
                    item, at = self.value(rest, at + 1, indent)
                elif at + 1 < len(lines) and lines[at + 1][0] > indent:
                    item, at = self.block(at + 1, lines[at + 1][0])
                else:
                    item, at = "", at + 1
                items.append(item)
            return items, at
        fields = {}
        while at < len(lines) and lines[at][0] == indent:
            found = _YAML_KEY.match(lines[at][1])
            if not found:
                break
            key, rest = _yaml_scalar(found[1]), found[2].strip()
            at += 1
            deeper = at < len(lines) and (lines[at][0] > indent or (lines[at][0] == indent and lines[at][1].startswith("- ")))
            if (not rest or rest.startswith("#")) and deeper:
                fields[key], at = self.block(at, lines[at][0])
            else:
                fields[key], at = self.value(rest, at, indent)
                while at < len(lines) and lines[at][0] > indent:  # below a scalar nothing can nest
                    at += 1
        return fields, at


def _yaml_flow(text: str):
    """The list or map that ``text`` begins with and the text after it, which is None while brackets are open."""
    stack: list = []
    at, key = 0, None
    while True:
        token = _YAML_TOKEN.match(text, at)
        if not token:
            return None, None
        at = token.end()
        quoted, sign, colon, plain = token.groups()
        if sign in ("[", "{"):
            stack.append([sign, [] if sign == "[" else {}, None])
            continue
        if not stack:
            return None, None
        top = stack[-1]
        if colon:
            top[2], key = key, None
            continue
        if sign is None:
            value = quoted[1:-1] if quoted is not None else plain.strip()
        elif sign == ",":
            _yaml_put(top, key)
            key = None
            continue
        else:
            _yaml_put(top, key)
            key = None
            stack.pop()
            if not stack:
                return top[1], text[at:]
            value = top[1]
            top = stack[-1]
        key = value


def _yaml_put(top: list, value) -> None:
    """End an entry of an open list or map; a key without a value has the empty text."""
    if isinstance(top[1], list):
        if top[2] is not None:
            top[1].append({str(top[2]): "" if value is None else value})
        elif value is not None:
            top[1].append(value)
    elif top[2] is not None:
        top[1][str(top[2])] = "" if value is None else value
    elif value is not None:
        top[1][str(value)] = ""
    top[2] = None


def yaml_fields(body: str | None) -> dict[str, str] | None:
    """Top-level fields of a YAML map in block style; maps and lists below them, also in brackets, as JSON text. Scalars
    stay text, block scalars with their lines or folded, a repeated key keeps its last value, and lines that are no
    entries of a map end it. None where there is no map."""
    reader = _Yaml(body or "")
    if not reader.lines or not _YAML_KEY.match(reader.lines[0][1]):
        return None
    fields, _ = reader.block(0, reader.lines[0][0])
    return {k: v if isinstance(v, str) else json.dumps(v) for k, v in fields.items()}


@F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
def _nested_yaml(bodies: pd.Series) -> pd.Series:
    return bodies.map(yaml_fields)


def parse_yaml(df: DataFrame, abort_on_failure: bool = True) -> DataFrame:
    """``key: value`` bodies. Maps and lists below a key become JSON text, for :func:`path`, as with JSON bodies.

    Flat bodies are read by column functions; only bodies with an indented line, a list, brackets or a block scalar go
    to Python.
    """
    text = F.coalesce("body", F.lit(""))
    nested = (text.rlike(r"(?m)^(?:[ ]+|-[ \n]|-$)") | text.rlike(r"(?m)^[^\s#-][^:]*:\s+[\[{|>]")) & text.rlike(r"(?m)^[^\s#-][^:]*:")
    lines = F.filter(F.split(text, "\n"), lambda l: l.rlike(r"^[^\s#][^:]*:"))
    entry = lambda l: F.struct(F.trim(F.regexp_extract(l, r"^([^:]*):", 1)).alias("key"),
                               F.regexp_replace(F.trim(F.regexp_extract(l, r"^[^:]*:(.*)$", 1)), r"""^(["'])(.*)\1$""", "$2").alias("value"))
    entries = F.transform(lines, entry)
    # a repeated key keeps its last value
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    last = F.transform(keys, lambda k: F.struct(k.alias("key"), F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"].alias("value")))
    flat = F.when(F.size(lines) > 0, F.map_from_entries(last))
    deep = df.withColumn("_deep", _nested_yaml(F.when(nested, F.col("body"))))
    return _parsed(deep, F.when(nested, F.col("_deep")).otherwise(flat), abort_on_failure).drop("_deep")


def field(name: str, default=None) -> Column:
    """Parsed field, null when absent."""
    c = F.try_element_at("parsed", F.lit(name))
    return c if default is None else F.coalesce(c, F.lit(default))


def path(name: str, json_path: str) -> Column:
    """Value inside a nested field, null at any missing step."""
    return F.get_json_object(field(name), json_path)


class _Defined:
    """The variables defined so far, as attributes."""

    def __getattr__(self, name: str) -> Column:
        return defined(name)


def defined(name: str) -> Column:
    """A variable of :func:`define`."""
    return F.col(f"_def.{name}")


def define(df: DataFrame, **variables: Callable[[_Defined], Column]) -> DataFrame:
    """Variables of a rule, each from the parsed body and the variables before it; a repeated name hides the earlier one.

    They ride along in one struct column ``_def`` until the outputs have been set; rows that were aborted have none.
    """
    for name, value in variables.items():
        old = [f.name for f in df.schema["_def"].dataType if f.name != name] if "_def" in df.columns else []
        new = F.when(~F.col("aborted"), value(_Defined()))
        df = df.withColumn("_def", F.struct(*[F.col(f"_def.{n}").alias(n) for n in old], new.alias(name)))
    return df


def extract(df: DataFrame, when: Column | None = None, **fields: Column) -> DataFrame:
    """Set service, instance, endpoint, layer, trace_id, ts or any output field of rows that are still alive."""
    alive = ~F.col("aborted") if when is None else ~F.col("aborted") & F.coalesce(when, F.lit(False))
    for name, value in fields.items():
        old = F.col(name) if name in df.columns else F.lit(None).cast("string")
        if name in df.columns:
            value = value.cast(df.schema[name].dataType)
        df = df.withColumn(name, F.when(alive, value).otherwise(old))
    return df


def timestamp(value: Column, fmt: str | None = None) -> Column:
    """Milliseconds from a text in a date format, or from a number."""
    return F.unix_millis(F.try_to_timestamp(value, F.lit(fmt))) if fmt else value.try_cast("bigint")


def add_tags(df: DataFrame, **tags: Column) -> DataFrame:
    for key, value in tags.items():
        df = df.withColumn("tags", F.when(F.col("aborted") | value.isNull(), F.col("tags")).otherwise(L.put(F.col("tags"), key, value)))
    return df


def abort(df: DataFrame, when: Column | None = None) -> DataFrame:
    return df.withColumn("aborted", F.col("aborted") | (F.lit(True) if when is None else F.coalesce(when, F.lit(False))))


def drop(df: DataFrame, when: Column | None = None) -> DataFrame:
    hit = F.lit(True) if when is None else F.coalesce(when, F.lit(False))
    return df.withColumn("keep", F.when(hit, False).otherwise(F.col("keep")))


def enforce(df: DataFrame, when: Column | None = None) -> DataFrame:
    hit = F.lit(True) if when is None else F.coalesce(when, F.lit(False))
    return df.withColumn("keep", F.when(hit, True).otherwise(F.col("keep")))


def rate_limit(df: DataFrame, sampler: Column, rpm: int, order: Sequence[str] = ("ts",)) -> DataFrame:
    """Keep the first ``rpm`` rows of each sampler id and minute of event time."""
    keyed = df.withColumn("_id", sampler).withColumn("_minute", bucket_of_millis(F.col("ts")))
    return first_per_group(keyed, ["_id", "_minute"], [F.col(c).asc() for c in order], rpm).drop("_id", "_minute")


def possibility(df: DataFrame, percent: int, key: Sequence[str], seed: int = 0) -> DataFrame:
    """Keep a share of rows by a hash of their key, so that a re-run after a lost task keeps the same rows."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key])
    return df.filter(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 100 < percent)


def to_samples(df: DataFrame, name: str, value: Column, labels: Mapping[str, Column], ts: Column | None = None) -> DataFrame:
    """Metric samples from log rows; labels without a value are left out."""
    entries = F.create_map(*[x for k, v in labels.items() for x in (F.lit(k), v.cast("string"))]) if labels else L.empty()
    return df.filter(~F.col("aborted")).select(
        F.lit(name).alias("name"), F.map_filter(entries, lambda _, v: v.isNotNull()).alias("labels"),
        (ts if ts is not None else F.col("ts")).alias("ts"), value.cast("double").alias("value"))


def slow_statements(df: DataFrame, id: Column, statement: Column, latency: Column) -> DataFrame:
    """Slow statement records; rows lacking an id, a statement or a latency of at least 1 are not recorded."""
    return (df.filter(~F.col("aborted") & F.col("keep"))
            .select(id.alias("id"), statement.alias("statement"), latency.try_cast("bigint").alias("latency"),
                    ids.service_id(F.col("service"), False).alias("entity_id"), "trace_id",
                    bucket_of_millis(F.col("ts"), "second").alias("time_bucket"), F.col("ts").alias("timestamp"))
            .filter((F.coalesce("id", F.lit("")) != "") & (F.coalesce("statement", F.lit("")) != "") & (F.col("latency") >= 1)))


def sampled_traces(df: DataFrame, reason: Column, uri: Column, latency: Column, process: Column, dest_process: Column,
                   component: Column, detect_point: Column) -> DataFrame:
    """Slow, 4xx and 5xx sampled traces per process relation; incomplete rows are dropped."""
    filled = lambda c: F.coalesce(c, F.lit("")) != ""
    return (df.filter(~F.col("aborted"))
            .select("trace_id", reason.alias("reason"), uri.alias("uri"), latency.try_cast("bigint").alias("latency"),
                    process.alias("process_id"), dest_process.alias("dest_process_id"), component.try_cast("int").alias("component_id"),
                    detect_point.alias("detect_point"), "ts")
            .filter(filled(F.col("trace_id")) & F.col("reason").isin("SLOW", "STATUS_4XX", "STATUS_5XX") & filled(F.col("uri"))
                    & filled(F.col("process_id")) & filled(F.col("dest_process_id")) & (F.col("component_id") > 0)
                    & F.col("detect_point").isNotNull() & (F.col("ts") > 0) & (F.col("latency") >= 0))
            .withColumn("entity_id", ids.relation_id(F.col("process_id"), F.col("dest_process_id")))
            .withColumn("time_bucket", bucket_of_millis(F.col("ts"), "second")))


def sink(df: DataFrame, auto_layer: bool = False, searchable: Sequence[str] = ("level", "http.status_code")) -> dict[str, DataFrame]:
    """Log records and the inventory they imply. With ``auto_layer`` a row must have been given a layer."""
    live = df.filter(~F.col("aborted") & F.col("keep"))
    if auto_layer:
        live = live.filter(F.coalesce("layer", F.lit("")) != "")
    sid = ids.service_id(F.col("service"))
    tags = F.map_filter("tags", lambda k, v: k.isin(list(searchable)) & v.isNotNull())
    records = live.select(
        "service", "instance", "endpoint", "layer", "trace_id", "segment_id", "span_id", "ts", "body_type", "body", sid.alias("service_id"),
        F.when(F.coalesce("instance", F.lit("")) != "", ids.instance_id(sid, F.col("instance"))).alias("instance_id"),
        F.when(F.coalesce("endpoint", F.lit("")) != "", ids.endpoint_id(sid, F.col("endpoint"))).alias("endpoint_id"),
        F.sort_array(F.transform(F.map_entries(tags), lambda e: F.concat(e["key"], F.lit("="), e["value"]))).alias("tags"),
        bucket_of_millis(F.col("ts"), "second").alias("time_bucket"))
    minute = bucket_of_millis(F.col("ts"))
    services = live.select("service", "layer", minute.alias("time_bucket")).distinct()
    instances = (live.filter(F.coalesce("instance", F.lit("")) != "").groupBy("service", "instance", "layer")
                 .agg(F.max(minute).alias("last_ping"), F.min(minute).alias("time_bucket")))
    endpoints = live.filter(F.coalesce("endpoint", F.lit("")) != "").select("service", "endpoint").distinct()
    return {"records": records, "services": services, "instances": instances, "endpoints": endpoints}


# ---- rules ----

def run_rules(df: DataFrame, rules: Sequence[Callable[[DataFrame], DataFrame]]) -> list[DataFrame]:
    """Every rule sees every log; each returns its own frame."""
    return [rule(prepare(df)) for rule in rules]


# ---- search ----

def search(records: DataFrame, service: str | None = None, instance: str | None = None, endpoint: str | None = None,
           trace_id: str | None = None, segment_id: str | None = None, span_id: int | None = None, tags: Sequence[str] = (),
           bounds: tuple[int, int] | None = None, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    """Log records by any combination of conditions. Words must all occur in the body, excluded ones must not.

    Matching is by substring without regard to case.
    """
    for column, want in (("service", service), ("instance", instance), ("endpoint", endpoint), ("trace_id", trace_id),
                         ("segment_id", segment_id), ("span_id", span_id)):
        if want is not None:
            records = records.filter(F.col(column) == want)
    if bounds:
        records = records.filter(F.col("time_bucket").between(*bounds))
    for t in tags:
        records = records.filter(F.array_contains("tags", t))
    body = F.lower(F.coalesce("body", F.lit("")))
    for word in include:
        records = records.filter(body.contains(word.lower()))
    for word in exclude:
        records = records.filter(~body.contains(word.lower()))
    return records


KNOWN_LABELS = {"service": "service", "service_instance": "instance", "endpoint": "endpoint", "trace_id": "trace_id"}


def select_stream(records: DataFrame, include: Sequence[str] = (), exclude: Sequence[str] = (), **selector: str) -> DataFrame:
    """``{k="v"}`` selector: blank or ``*`` means all, names other than the four known ones are tags."""
    wanted = {k: v for k, v in selector.items() if v not in ("", "*")}
    known = {KNOWN_LABELS[k]: v for k, v in wanted.items() if k in KNOWN_LABELS}
    tags = [f"{k}={v}" for k, v in wanted.items() if k not in KNOWN_LABELS]
    return search(records, tags=tags, include=include, exclude=exclude, **known)


def streams(page: DataFrame) -> DataFrame:
    """Lines of an already limited page, one row per stream."""
    return (page.groupBy("service", "instance", "endpoint", "trace_id")
            .agg(F.sort_array(F.collect_list(F.struct("ts", "body"))).alias("values")))


def label_names(tag_rows: DataFrame) -> DataFrame:
    return tag_rows.select(F.col("tag_key").alias("label")).distinct()


def label_values(tag_rows: DataFrame, label: str) -> DataFrame:
    return tag_rows.filter(F.col("tag_key") == label).select(F.col("tag_value").alias("value")).distinct()


# ---- output builders, the users' extension point ----

BUILDERS: dict[str, Callable[..., DataFrame]] = {"slow_statement": slow_statements, "sampled_trace": sampled_traces}


def register_builder(name: str, fn: Callable[..., DataFrame]) -> None:
    BUILDERS[name] = fn
