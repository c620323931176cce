"""Meter samples: (name, labels, ts in milliseconds, value).

The samples of one name scraped together form a family. Families are told apart by the ``at`` columns, by default the
timestamp, so one plan evaluates an expression over every scrape at once.
"""

from __future__ import annotations

from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ids, predicates, text
from ..functions import labels as L
from ..functions.arith import COMPARATORS, safe_div, to_metric_long
from ..functions.timebucket import bucket_of_millis
from ..plans.runtime import lookup_join

AT = ("ts",)
LK = "_lk"


def family(samples: DataFrame, name: str) -> DataFrame:
    return samples.filter(F.col("name") == name)


# ---- filters and labels ----

def tag_filter(df: DataFrame, op: str, **wanted: str) -> DataFrame:
    """equal, not_equal, match or not_match on labels, all of which must hold; a missing label is empty text."""
    for key, want in wanted.items():
        v = L.get(F.col("labels"), key)
        full = text.whole(want)
        df = df.filter({"equal": lambda: v == want, "not_equal": lambda: v != want,
                        "match": lambda: v.rlike(full), "not_match": lambda: ~v.rlike(full)}[op]())
    return df


def value_filter(df: DataFrame, op: str, x: float) -> DataFrame:
    return df.filter(COMPARATORS[op](F.col("value"), F.lit(float(x))))


def where(df: DataFrame, closure: Callable[[Column], Column]) -> DataFrame:
    return df.filter(F.coalesce(closure(F.col("labels")), F.lit(False)))


def tag(df: DataFrame, closure: Callable[[Column], Column]) -> DataFrame:
    """Rewrite the label map."""
    return df.withColumn("labels", closure(F.col("labels")))


def for_each(df: DataFrame, elements: Sequence[str], closure: Callable[[str, Column], Column]) -> DataFrame:
    """Apply one label rewrite per element, in order. The elements are rule text, so this builds one expression."""
    labels = F.col("labels")
    for e in elements:
        labels = closure(e, labels)
    return df.withColumn("labels", labels)


def retag_by_pod(df: DataFrame, new_label: str, pod_label: str, namespace_label: str, pods: DataFrame) -> DataFrame:
    """Add the service of a pod; blank when unknown. Samples without pod or namespace are unchanged.

    ``pods`` (namespace, pod, service) is an inventory.
    """
    p, n = L.get(F.col("labels"), pod_label), L.get(F.col("labels"), namespace_label)
    right = pods.groupBy(F.col("namespace").alias("_ns"), F.col("pod").alias("_pod")).agg(F.min("service").alias("_svc"))
    joined = lookup_join(df.withColumn("_pod", p).withColumn("_ns", n), right, ["_pod", "_ns"])
    known = (F.col("_pod") != "") & (F.col("_ns") != "")
    return joined.withColumn("labels", F.when(known, L.put(F.col("labels"), new_label, F.coalesce("_svc", F.lit(""))))
                             .otherwise(F.col("labels"))).drop("_pod", "_ns", "_svc")


# ---- arithmetic ----

def scalar(df: DataFrame, op: str, number: float, number_left: bool = False) -> DataFrame:
    v, n = F.col("value"), F.lit(float(number))
    a, b = (n, v) if number_left else (v, n)
    out = {"+": lambda: a + b, "-": lambda: a - b, "*": lambda: a * b, "/": lambda: safe_div(a, b),
           "safe_div": lambda: F.when(b == 0, F.lit(0.0)).otherwise(safe_div(a, b))}[op]()
    return df.withColumn("value", out)


def negative(df: DataFrame) -> DataFrame:
    return df.withColumn("value", -F.col("value"))


def binary(left: DataFrame, op: str, right: DataFrame, at=AT) -> DataFrame:
    """Family with family on equal label maps; the first right sample of a label map counts.

    An absent family follows the operator: a+0=a, 0-b=-b, products and safe_div vanish, a/absent is a/0.0.
    """
    at = list(at)
    lk = L.key_of(F.col("labels")).alias(LK)
    l = left.withColumn(LK, L.key_of(F.col("labels")))
    seq = F.col("seq") if "seq" in right.columns else F.col("value")
    r = right.groupBy(*at, lk).agg(F.min_by("value", seq).alias("_r"))
    a, b = F.col("value"), F.col("_r")
    matched = l.join(r, [*at, LK], "inner").withColumn("value", {
        "+": lambda: a + b, "-": lambda: a - b, "*": lambda: a * b, "/": lambda: safe_div(a, b),
        "safe_div": lambda: F.when(b == 0, F.lit(0.0)).otherwise(safe_div(a, b))}[op]()).drop("_r", LK)
    if op in ("*", "safe_div"):
        return matched
    alone = left.join(right.select(*at).distinct(), at, "left_anti").select(*matched.columns)
    if op == "/":
        alone = alone.withColumn("value", safe_div(F.col("value"), F.lit(0.0)))
        return matched.unionByName(alone)
    other = right.join(left.select(*at).distinct(), at, "left_anti")
    other = (negative(other) if op == "-" else other)
    return matched.unionByName(alone).unionByName(other, allowMissingColumns=True).select(*matched.columns)


# ---- aggregation ----

def aggregate(df: DataFrame, fn: str, by: Sequence[str] | None = None, at=AT) -> DataFrame:
    """sum, max, min or avg of a family; without ``by`` one unlabelled row, else grouped by those labels."""
    agg = {"sum": F.sum, "max": F.max, "min": F.min, "avg": F.avg}[fn]
    cols = [L.get(F.col("labels"), k).alias(f"_l{i}") for i, k in enumerate(by or ())]
    names = [f"_l{i}" for i in range(len(cols))]
    keys = ["name", *at]
    out = df.select(*keys, *cols, "value").groupBy(*keys, *names).agg(agg("value").alias("value"))
    entries = [x for k, n in zip(by or (), names) for x in (F.lit(k), F.col(n))]
    return out.select(*keys, (F.create_map(*entries) if entries else L.empty()).alias("labels"), "value")


def count(df: DataFrame, by: Sequence[str] | None = None, at=AT) -> DataFrame:
    """Rows; or distinct non-blank values of one label; or, of several labels, distinct combinations per group of all
    but the last one."""
    keys = ["name", *at]
    if not by:
        return df.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("value")).select(*keys, L.empty().alias("labels"), "value")
    if len(by) == 1:
        v = F.try_element_at("labels", F.lit(by[0]))
        # families without any such label still report 0
        distinct = df.select(*keys, F.when(F.trim(v) != "", v).alias("_v")).distinct()
        return (distinct.groupBy(*keys).agg(F.count("_v").cast("double").alias("value"))
                .select(*keys, L.empty().alias("labels"), "value"))
    have = predicates.all_of(F.map_contains_key("labels", k) for k in by)
    names = [f"_l{i}" for i in range(len(by))]
    combos = df.filter(have).select(*keys, *[F.col("labels")[k].alias(n) for k, n in zip(by, names)]).distinct()
    out = combos.groupBy(*keys, *names[:-1]).agg(F.count(F.lit(1)).cast("double").alias("value"))
    entries = [x for k, n in zip(by[:-1], names) for x in (F.lit(k), F.col(n))]
    return out.select(*keys, F.create_map(*entries).alias("labels"), "value")


_UNIT_MS = {"ms": 1, "s": 1000, "m": 60_000}


def histogram(df: DataFrame, le: str = "le", unit: str = "s") -> DataFrame:
    """Rename the bucket label to ``le`` and scale its bound to whole milliseconds. Values stay as reported.

    An unbounded last bucket saturates at the largest long.
    """
    bound = F.try_element_at("labels", F.lit(le)).cast("double") * F.lit(float(_UNIT_MS[unit]))
    text = F.when(bound >= float(2 ** 63), F.lit(str(2 ** 63 - 1))).otherwise(bound.cast("bigint").cast("string"))
    scaled = L.put(L.without(F.col("labels"), [le]), "le", text)
    return df.withColumn("labels", F.when(F.map_contains_key("labels", le), scaled).otherwise(F.col("labels")))


# ---- binding to entities ----

def _join_labels(keys: Sequence[str], delimiter: str) -> Column:
    """Values of the non-empty labels, joined."""
    parts = F.filter(F.array(*[L.get(F.col("labels"), k) for k in keys]), lambda x: x != "")
    return F.array_join(parts, delimiter)


def bind_service(df, keys, layer: str, delimiter: str = ".") -> DataFrame:
    name = _join_labels(keys, delimiter)
    return (df.withColumn("service", name).withColumn("layer", F.lit(layer)).withColumn("scope", F.lit("service"))
            .withColumn("entity_id", ids.service_id(F.col("service")))
            .withColumn("labels", L.without(F.col("labels"), keys)))


def bind_instance(df, service_keys, instance_keys, layer: str, delimiter: str = ".", instance_delimiter: str = ".") -> DataFrame:
    return (df.withColumn("service", _join_labels(service_keys, delimiter))
            .withColumn("instance", _join_labels(instance_keys, instance_delimiter))
            .withColumn("layer", F.lit(layer)).withColumn("scope", F.lit("instance"))
            .withColumn("entity_id", ids.instance_id(ids.service_id(F.col("service")), F.col("instance")))
            .withColumn("labels", L.without(F.col("labels"), [*service_keys, *instance_keys])))


def bind_endpoint(df, service_keys, endpoint_keys, layer: str, delimiter: str = ".") -> DataFrame:
    return (df.withColumn("service", _join_labels(service_keys, delimiter))
            .withColumn("endpoint", _join_labels(endpoint_keys, delimiter))
            .withColumn("layer", F.lit(layer)).withColumn("scope", F.lit("endpoint"))
            .withColumn("entity_id", ids.endpoint_id(ids.service_id(F.col("service")), F.col("endpoint")))
            .withColumn("labels", L.without(F.col("labels"), [*service_keys, *endpoint_keys])))


def bind_process(df, service_keys, instance_keys, process_keys, layer_key: str) -> DataFrame:
    used = [*service_keys, *instance_keys, *process_keys, layer_key]
    return (df.withColumn("service", _join_labels(service_keys, "."))
            .withColumn("instance", _join_labels(instance_keys, "."))
            .withColumn("process", _join_labels(process_keys, "."))
            .withColumn("layer", L.get(F.col("labels"), layer_key)).withColumn("scope", F.lit("process"))
            .withColumn("entity_id", ids.process_id(
                ids.instance_id(ids.service_id(F.col("service")), F.col("instance")), F.col("process")))
            .withColumn("labels", L.without(F.col("labels"), used)))


def bind_service_relation(df, detect_point: str, source_keys, dest_keys, layer: str, delimiter: str = ".") -> DataFrame:
    return (df.withColumn("source", _join_labels(source_keys, delimiter)).withColumn("dest", _join_labels(dest_keys, delimiter))
            .withColumn("detect_point", F.lit(detect_point)).withColumn("layer", F.lit(layer))
            .withColumn("scope", F.lit("service_relation"))
            .withColumn("entity_id", ids.relation_id(ids.service_id(F.col("source")), ids.service_id(F.col("dest"))))
            .withColumn("labels", L.without(F.col("labels"), [*source_keys, *dest_keys])))


def bind_instance_relation(df, detect_point: str, source_service, source_instance, dest_service, dest_instance,
                           layer: str, delimiter: str = ".") -> DataFrame:
    side = lambda s, i: ids.instance_id(ids.service_id(_join_labels(s, delimiter)), _join_labels(i, delimiter))
    used = [*source_service, *source_instance, *dest_service, *dest_instance]
    return (df.withColumn("entity_id", ids.relation_id(side(source_service, source_instance), side(dest_service, dest_instance)))
            .withColumn("detect_point", F.lit(detect_point)).withColumn("layer", F.lit(layer))
            .withColumn("scope", F.lit("instance_relation")).withColumn("labels", L.without(F.col("labels"), used)))


def bind_process_relation(df, detect_point_key: str, service_keys, instance_keys, source_process_key: str,
                          dest_process_key: str, component_key: str) -> DataFrame:
    used = [*service_keys, *instance_keys, source_process_key, dest_process_key, detect_point_key, component_key]
    get = lambda k: L.get(F.col("labels"), k)
    return (df.withColumn("service", _join_labels(service_keys, ".")).withColumn("instance", _join_labels(instance_keys, "."))
            .withColumn("detect_point", get(detect_point_key)).withColumn("component", get(component_key))
            .withColumn("scope", F.lit("process_relation"))
            .withColumn("entity_id", ids.relation_id(get(source_process_key), get(dest_process_key)))
            .withColumn("labels", L.without(F.col("labels"), used)))


def decorate(df: DataFrame, **attrs: Callable[[DataFrame], Column]) -> DataFrame:
    """Set attr0..attr5 of service-scope rows."""
    for name, fn in attrs.items():
        old = F.col(name) if name in df.columns else F.lit(None).cast("string")
        df = df.withColumn(name, F.when(F.col("scope") == "service", fn(df)).otherwise(old))
    return df


# ---- emission ----

def to_meter_rows(bound: DataFrame, step: str = "minute") -> DataFrame:
    """Bound samples to meter rows: long values, label text, time bucket. Feed these to ``meter``."""
    return bound.select("*", bucket_of_millis(F.col("ts"), step).alias("time_bucket"),
                        to_metric_long(F.col("value")).alias("metric_value"),
                        L.encode(F.col("labels")).alias("label"))


def labels_to_table(bound: DataFrame, at=AT) -> DataFrame:
    """Labelled samples of one scrape to long form (entity, label text, value); the last of equal label sets wins."""
    rows = to_meter_rows(bound)
    order = F.col("seq") if "seq" in bound.columns else F.col("metric_value")
    return (rows.groupBy("entity_id", *at, "time_bucket", "label")
            .agg(F.max_by("metric_value", order).alias("value")))


def to_bucket_rows(bound: DataFrame, step: str = "minute") -> DataFrame:
    """Histogram samples to (entity, bucket, label text without ``le``, le, value) as reported.

    Minus infinity and bounds beyond a long saturate.
    """
    le = L.get(F.col("labels"), "le").cast("double")
    bound_ms = (F.when(le <= float(-2 ** 63), F.lit(-2 ** 63)).when(le >= float(2 ** 63), F.lit(2 ** 63 - 1))
                .otherwise(le.cast("bigint")).cast("bigint"))
    rest = L.without(F.col("labels"), ["le"])
    return bound.select("entity_id", bucket_of_millis(F.col("ts"), step).alias("time_bucket"), "ts",
                        F.when(F.size(rest) > 0, L.encode(rest)).otherwise(F.lit("")).alias("label"),
                        bound_ms.alias("le"), to_metric_long(F.col("value")).alias("metric_value"))


DOWNSAMPLING = {"AVG": "avg", "SUM": "sum", "LATEST": "latest", "SUM_PER_MIN": "sum_per_min", "MAX": "max", "MIN": "min"}


def meter(rows: DataFrame, downsampling: str = "AVG", labeled: bool = False, ranks: Sequence[int] | None = None,
          histogram: bool = False, report: str | None = None) -> DataFrame:
    """Apply the meter function that the downsampling, label and histogram markers of a rule choose.

    ``report``: the column that names the scrape of a histogram sample; the query then fails where reports of one
    entity and bucket have differing bucket sets, which otherwise add up.
    """
    from . import aggregates as A

    fn = "meter_" + DOWNSAMPLING[downsampling]
    args: dict = {"ts": F.col("ts")}
    if histogram or ranks:
        fn += "_histogram" + ("_percentile" if ranks else "")
        args |= {"label": F.col("label"), "le": F.col("le"), "ranks": tuple(ranks or ())}
    elif labeled:
        fn += "_labeled"
        args |= {"label": F.col("label")}
    out = A.aggregate(rows, fn, F.col("metric_value"), args)
    if report and (histogram or ranks):
        out = A.refuse_incompatible(out, rows.withColumn("report", F.col(report)))
    return out


EXTENSIONS: dict[str, Callable[..., DataFrame]] = {}


def register_extension(namespace: str, name: str, fn: Callable[..., DataFrame]) -> None:
    """Make ``fn(df, *args)`` callable as ``namespace::name`` through :func:`call`."""
    EXTENSIONS[f"{namespace}::{name}"] = fn


def call(df: DataFrame, qualified: str, *args) -> DataFrame:
    return EXTENSIONS[qualified](df, *args)
