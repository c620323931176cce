"""Label expressions for rule closures: they take the label map and return a ``Column``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import labels as L
from .text import whole


def tag(key: str):
    return lambda tags: F.try_element_at(tags, F.lit(key))


def matches(fn, pattern: str):
    return lambda tags: F.coalesce(fn(tags).rlike(whole(pattern)), F.lit(False))


def group(fn, pattern: str, n: int = 1):
    return lambda tags: F.regexp_extract(fn(tags), pattern, n)


def ternary(cond, a, b):
    return lambda tags: F.when(cond(tags), _val(a, tags)).otherwise(_val(b, tags))


def elvis(fn, default):
    """First operand unless it is null or empty."""
    return lambda tags: F.when(F.coalesce(fn(tags), F.lit("")) != "", fn(tags)).otherwise(_val(default, tags))


def is_in(fn, values):
    return lambda tags: F.coalesce(fn(tags).isin(list(values)), F.lit(False))


def split_at(fn, sep: str, index: int):
    """Piece of a text split on a literal separator; null when there are fewer pieces."""
    return lambda tags: F.get(F.split(fn(tags), "\\Q" + sep + "\\E"), F.lit(index))


def contains(fn, text: str):
    return lambda tags: F.coalesce(fn(tags).contains(text), F.lit(False))


def index_of(fn, text: str):
    return lambda tags: F.instr(fn(tags), text) - 1


def replaced(fn, old: str, new: str):
    return lambda tags: F.replace(fn(tags), F.lit(old), F.lit(new))


def joined(sep: str, *fns):
    return lambda tags: F.concat_ws(sep, *[_val(f, tags) for f in fns])


def assign(**updates):
    """Closure that sets label keys: ``assign(svc=joined("::", "a", tag("b")))``."""
    def run(tags: Column) -> Column:
        out = tags
        for key, fn in updates.items():
            out = L.put(out, key, _val(fn, tags))
        return out
    return run


def removed(*keys: str):
    return lambda tags: L.without(tags, keys)


def _val(x, tags) -> Column:
    return x(tags) if callable(x) else F.lit(x)
