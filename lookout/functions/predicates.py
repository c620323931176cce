"""Filter predicates of metric rules. Each one is a total boolean: it never yields null."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def _unquote(s: str | None) -> str | None:
    return s[1:-1] if isinstance(s, str) and len(s) >= 2 and s[0] == s[-1] == '"' else s


def is_true(c) -> Column:
    return _col(c).eqNullSafe(F.lit(True))


def is_not_true(c) -> Column:
    return ~is_true(c)


def num_eq(c, n) -> Column:
    return F.coalesce(_col(c) == F.lit(n), F.lit(False))


def str_eq(c, s: str | None) -> Column:
    """Null-safe equality with surrounding double quotes removed on both sides."""
    bare = F.regexp_replace(_col(c).cast("string"), r'^"(.*)"$', "$1")
    return bare.eqNullSafe(F.lit(_unquote(s)))


def ne(c, v) -> Column:
    return ~_col(c).eqNullSafe(F.lit(v))


def gt(c, n) -> Column:
    return F.coalesce(_col(c) > F.lit(n), F.lit(False))


def ge(c, n) -> Column:
    return F.coalesce(_col(c) >= F.lit(n), F.lit(False))


def lt(c, n) -> Column:
    return F.coalesce(_col(c) < F.lit(n), F.lit(False))


def le(c, n) -> Column:
    return F.coalesce(_col(c) <= F.lit(n), F.lit(False))


def like(c, pattern: str | None) -> Column:
    """``%x%``, ``%x`` or ``x%``. A pattern without a percent sign matches nothing."""
    pattern = _unquote(pattern)
    if pattern is None:
        return F.lit(False)
    c = _col(c)
    head, tail = pattern.startswith("%"), pattern.endswith("%")
    if head and tail:
        hit = c.contains(pattern[1:-1])
    elif head:
        hit = c.endswith(pattern[1:])
    elif tail:
        hit = c.startswith(pattern[:-1])
    else:
        return F.lit(False)
    return F.coalesce(hit, F.lit(False))


def is_in(c, values) -> Column:
    return F.coalesce(_col(c).isin(list(values)), F.lit(False))


def contains(c, v) -> Column:
    return F.coalesce(F.array_contains(_col(c), F.lit(v)), F.lit(False))


def not_contains(c, v) -> Column:
    """False for a null list as well: an absent list contains nothing and lacks nothing."""
    return F.coalesce(~F.array_contains(_col(c), F.lit(v)), F.lit(False))


#: registry that users extend with ``register``
PREDICATES: dict[str, Callable[..., Column]] = {
    "is_true": is_true, "is_not_true": is_not_true, "num_eq": num_eq, "eq": str_eq, "ne": ne, "gt": gt, "ge": ge,
    "lt": lt, "le": le, "like": like, "in": is_in, "contain": contains, "not_contain": not_contains,
}


def register(name: str, fn: Callable[..., Column]) -> None:
    PREDICATES[name] = fn


def build(name: str, *args) -> Column:
    return PREDICATES[name](*args)


def all_of(conditions) -> Column:
    """Several filters hold together."""
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out
