"""Metric rules: declarative rows that turn one source frame into many metrics with one shared aggregation."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Any, Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import predicates
from ..functions.timebucket import coarsen, minutes_in
from . import aggregates as A


@dataclass(frozen=True)
class Rule:
    """``metric = source.attr .where(...) .fn(args)``

    ``where`` holds (predicate, attribute, argument...) tuples, all of which must hold. ``args`` values that name a
    condition are such tuples as well.
    """

    name: str
    source: str
    fn: str
    attr: str | None = None
    where: tuple[tuple, ...] = ()
    args: Mapping[str, Any] = field(default_factory=dict)
    cast: str | None = None
    downsample: bool = True

    def filtered(self, *condition) -> "Rule":
        return replace(self, where=self.where + (tuple(condition),))


def attribute(path: str) -> Column:
    """``a.b`` for a nested column and ``a[k]`` for a map entry."""
    if path.endswith("]"):
        col, key = path[:-1].split("[", 1)
        return F.try_element_at(F.col(col), F.lit(key))
    return F.col(path)


def cast_attr(c: Column, to: str | None) -> Column:
    """Text to ``long`` or ``int``; text that is no number gives null."""
    return c if to is None else c.try_cast({"long": "bigint", "int": "int"}[to])


def condition(c) -> Column:
    if isinstance(c, Column):
        return c
    name, path, *rest = c
    return predicates.build(name, attribute(path), *rest)


def _resolve(rule: Rule) -> tuple[Column | None, dict]:
    value = cast_attr(attribute(rule.attr), rule.cast) if rule.attr else None
    args: dict[str, Any] = {}
    for k, v in rule.args.items():
        if k in ("cond", "num", "den", "status"):
            args[k] = condition(v) if isinstance(v, (tuple, Column)) else F.col(v)
        elif k in ("label", "ts", "le"):
            args[k] = F.col(v) if isinstance(v, str) else v
        elif k == "threshold":
            args[k] = F.col(v) if isinstance(v, str) else F.lit(v) if not isinstance(v, Column) else v
        else:
            args[k] = v
    return value, args


def _where(rule: Rule) -> Column:
    return predicates.all_of(condition(c) for c in rule.where)


def is_keyed(rule: Rule) -> bool:
    return A.REGISTRY[rule.fn].key is not None


def enabled(rules: Sequence[Rule], disabled=()) -> list[Rule]:
    return [r for r in rules if r.name not in set(disabled) and r.source not in set(disabled)]


def states(df: DataFrame, rules: Sequence[Rule], extra: Sequence[str] = ()) -> DataFrame:
    """One pass over a source for all its unkeyed rules.

    Returns one row per (entity, bucket) with columns ``<metric>__<state>``. ``extra`` columns (decorations such as
    attr0) ride along as the maximum of the group.
    """
    rows, folds = row_states(df, rules, extra)
    return rows.groupBy(*A.GROUP).agg(*[A.FOLD[how](name).alias(name) for name, how in folds.items()])


def row_states(df: DataFrame, rules: Sequence[Rule], extra: Sequence[str] = ()) -> tuple[DataFrame, dict[str, str]]:
    """What each row adds to the states of all unkeyed rules, and how each state folds; nothing is aggregated yet."""
    cols, folds = [], {}
    for rule in rules:
        value, args = _resolve(rule)
        cond = _where(rule)
        # an unmatched row contributes nothing, and a metric without rows stays absent
        rows = {"__n": (F.lit(1).cast("bigint"), "sum"), **A.REGISTRY[rule.fn].states(value, args)}
        for s, (expr, how) in rows.items():
            name = f"{rule.name}__{s.lstrip('_') if s != '__n' else 'rows'}"
            cols.append((F.when(cond, expr) if rule.where else expr).alias(name))
            folds[name] = how
    return df.select(*A.GROUP, *extra, *cols), folds | {e: "max" for e in extra}


def merge_states(df: DataFrame, rules: Sequence[Rule], extra: Sequence[str] = ()) -> DataFrame:
    """Merge state rows of several batches, nodes or finer buckets."""
    folds = []
    for rule in rules:
        _, args = _resolve(rule)
        for s, how in [("rows", "sum")] + [(s, how) for s, (_, how) in
                                           A.REGISTRY[rule.fn].states(F.lit(0), A._dummy(args)).items()]:
            folds.append(A.FOLD[how](f"{rule.name}__{s}").alias(f"{rule.name}__{s}"))
    folds += [F.max(e).alias(e) for e in extra]
    return df.groupBy(*A.GROUP).agg(*folds)


def rollup(df: DataFrame, rules: Sequence[Rule], levels: int = 1, extra: Sequence[str] = ()) -> DataFrame:
    """Hour or day states from minute states. Rules that opted out of downsampling are left behind."""
    kept = [r for r in rules if r.downsample]
    return merge_states(df.withColumn("time_bucket", coarsen(F.col("time_bucket"), levels)), kept, extra)


def values(state_df: DataFrame, rules: Sequence[Rule], extra: Sequence[str] = ()) -> DataFrame:
    """State rows to one column per metric; null where the metric had no row."""
    out = []
    minutes = minutes_in(F.col("time_bucket"))
    for rule in rules:
        _, args = _resolve(rule)
        spec = A.REGISTRY[rule.fn]
        cols = {s: F.col(f"{rule.name}__{s}") for s in spec.states(F.lit(0), A._dummy(args))}
        n = F.coalesce(F.col(f"{rule.name}__rows"), F.lit(0))
        out.append(F.when(n > 0, spec.value(cols, minutes, args)).alias(rule.name))
    return state_df.select(*A.GROUP, *extra, *out)


def to_rows(wide: DataFrame, rules: Sequence[Rule], extra: Sequence[str] = ()) -> DataFrame:
    """One column per metric to the long metric table (metric, entity_id, time_bucket, value)."""
    items = F.array(*[F.struct(F.lit(r.name).alias("metric"), F.col(r.name).cast("double").alias("value")) for r in rules])
    return (wide.select(*A.GROUP, *extra, F.inline(items)).filter(F.col("value").isNotNull())
            .select("metric", *A.GROUP, *extra, "value"))


def keyed(df: DataFrame, rule: Rule) -> DataFrame:
    """State rows (entity, bucket, key, ...) of one percentile, histogram or label rule."""
    value, args = _resolve(rule)
    return A.fold(df.filter(_where(rule)) if rule.where else df, rule.fn, value, args)


def keyed_values(state_df: DataFrame, rule: Rule) -> DataFrame:
    _, args = _resolve(rule)
    return A.finalise(state_df, rule.fn, args)


#: one row of the shared keyed states: the metric, its group and the key in either of two columns
KEYED = ("metric", *A.GROUP, "label", "le")


def _state_names(rule: Rule) -> dict[str, str]:
    """State name -> column of the shared frame, which also names the fold."""
    _, args = _resolve(rule)
    return {s: f"{s}_{how}" for s, (_, how) in A.REGISTRY[rule.fn].states(F.lit(0), A._dummy(args)).items()}


def keyed_states(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One pass over a source for all its keyed rules: rows (metric, entity, bucket, label, le, ``<state>_<fold>``).

    A row of the source gives one state row per rule that it meets; Spark folds them before the shuffle, so what moves
    is one row per task, metric, group and key. States that a metric lacks are null.
    """
    return _fold_keyed(*keyed_row_states(df, rules))


def keyed_row_states(df: DataFrame, rules: Sequence[Rule], extra: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """The rows of :func:`keyed_states` before they are folded, and their state columns; ``extra`` columns ride along."""
    rules = [r for r in rules if is_keyed(r)]
    columns = sorted({c for r in rules for c in _state_names(r).values()})
    items = []
    for rule in rules:
        value, args = _resolve(rule)
        spec = A.REGISTRY[rule.fn]
        key = spec.key(value, args)
        label, le = {"label": (key, None), "le": (None, key), "both": (key["label"], key["le"])}[spec.key_type]
        states = {f"{s}_{how}": e for s, (e, how) in spec.states(value, args).items()}
        item = F.struct(F.lit(rule.name).alias("metric"), (F.lit(None) if label is None else label).cast("string").alias("label"),
                        (F.lit(None) if le is None else le).cast("bigint").alias("le"),
                        *[states.get(c, F.lit(None)).alias(c) for c in columns])
        items.append(F.when(_where(rule), item) if rule.where else item)
    return df.select(*A.GROUP, *extra, F.inline(F.array_compact(F.array(*items)))), columns


def _fold_keyed(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return rows.groupBy(*KEYED).agg(*[A.FOLD[c.rsplit("_", 1)[1]](c).alias(c) for c in columns])


def merge_keyed(states: DataFrame) -> DataFrame:
    """Merge shared keyed states of several batches, nodes or finer buckets."""
    return _fold_keyed(states, [c for c in states.columns if c not in KEYED and c.rsplit("_", 1)[-1] in A.FOLD])


def rollup_keyed(states: DataFrame, rules: Sequence[Rule], levels: int = 1) -> DataFrame:
    """Hour or day states of the keyed rules that did not opt out of downsampling."""
    kept = [r.name for r in rules if is_keyed(r) and r.downsample]
    return merge_keyed(states.filter(F.col("metric").isin(kept)).withColumn("time_bucket", coarsen(F.col("time_bucket"), levels)))


def _same_finish(rule: Rule) -> tuple:
    """Rules that share a function and its constants are finished together."""
    _, args = _resolve(rule)
    return rule.fn, tuple(sorted((k, repr(v)) for k, v in args.items() if not isinstance(v, Column)))


def keyed_rows(states: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Shared keyed states to the long metric table (metric, entity_id, time_bucket, value, label)."""
    classes: dict[tuple, list[Rule]] = {}
    for rule in rules:
        if is_keyed(rule):
            classes.setdefault(_same_finish(rule), []).append(rule)
    out = None
    group = ("metric", *A.GROUP)
    for same in classes.values():
        _, args = _resolve(same[0])
        spec = A.REGISTRY[same[0].fn]
        key = {"label": F.col("label"), "le": F.col("le"), "both": F.struct("label", "le")}[spec.key_type]
        mine = states.filter(F.col("metric").isin([r.name for r in same])).select(
            *group, key.alias(A.KEY), *[F.col(c).alias(s) for s, c in _state_names(same[0]).items()])
        done = A.finalise(mine, same[0].fn, args, group)
        label = next(c for c in done.columns if c not in (*group, "value"))
        done = done.select(*group, F.col("value").cast("double").alias("value"), F.col(label).cast("string").alias("label"))
        out = done if out is None else out.unionByName(done)
    return out


def run(df: DataFrame, rules: Sequence[Rule], extra: Sequence[str] = (), disabled=()) -> DataFrame:
    """All rules of one source to the long metric table; ``label`` is null for plain values.

    Plain rules read the source once; keyed rules once for each function with its constants.
    """
    rules = enabled(rules, disabled)
    plain = [r for r in rules if not is_keyed(r)]
    keyed_rules = [r for r in rules if is_keyed(r)]
    out = None
    if plain:
        wide = values(states(df, plain, extra), plain, extra)
        out = to_rows(wide, plain, extra).withColumn("label", F.lit(None).cast("string"))
    if keyed_rules:
        rows = keyed_rows(keyed_states(df, keyed_rules), keyed_rules)
        rows = rows.select("metric", *A.GROUP, *[F.lit(None).cast(df.schema[e].dataType).alias(e) for e in extra], "value", "label")
        out = rows if out is None else out.unionByName(rows)
    return out


# ---- users' hooks: columns added to the rows of a source, and rows of a scope sent to several sources ----

DECORATORS: dict[str, list[Callable[[DataFrame], DataFrame]]] = {}
DISPATCHERS: dict[str, dict[str, Callable[[DataFrame], DataFrame]]] = {}


def register_decorator(source: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    """Let ``fn`` add columns (attr0 ...) to the rows of a source before its rules see them; called in this order."""
    known = DECORATORS.setdefault(source, [])
    if fn not in known:
        known.append(fn)


def decorate(df: DataFrame, source: str) -> DataFrame:
    for fn in DECORATORS.get(source, ()):
        df = fn(df)
    return df


def register_dispatcher(scope: str, source: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    """Let rows of ``scope`` feed the rules of ``source`` as the frame that ``fn`` makes of them."""
    DISPATCHERS.setdefault(scope, {})[source] = fn


def dispatch(df: DataFrame, scope: str) -> dict[str, DataFrame]:
    """The decorated frame of each source that the scope feeds; without dispatchers the scope is its own source."""
    makers = DISPATCHERS.get(scope) or {scope: lambda rows: rows}
    return {source: decorate(fn(df), source) for source, fn in makers.items()}


def run_scope(df: DataFrame, scope: str, rules: Sequence[Rule], extra: Sequence[str] = (), disabled=()) -> DataFrame:
    """All rules of the sources that a scope feeds, to the long metric table."""
    out = None
    for source, frame in dispatch(df, scope).items():
        mine = [r for r in enabled(rules, disabled) if r.source == source]
        if mine:
            rows = run(frame, mine, extra)
            out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError(f"no rule reads a source of {scope}")
    return out
