"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table

#: a word: a longest run of characters other than space, tab, line feed, vertical tab, form feed, carriage return
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """Word targets of sources: ``source, source_size`` in, with ``target`` out.

    Sources by code point, null last, take ``weights`` in turn. They divide ``share`` times all words by weight; a
    target stops at ``most`` times its source's size and the excess goes to the others by weight, until none is above.
    That fixed point is one water level: sources ordered by size per weight are filled up to the level that uses the
    rest. One row per source passes through the window, whatever the number of documents. All sizes zero: targets 0.
    """
    everything = Window.partitionBy()
    ranked = sizes.select("source", "source_size", F.row_number().over(
        Window.orderBy(F.col("source").isNull(), F.col("source"))).alias("_rank"))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("_w", weight.cast("long")).withColumn("_full", F.col("source_size") * most)
    order = Window.orderBy(F.col("_full") / F.col("_w"), "_rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    budget = F.sum("source_size").over(everything) * F.lit(float(share))
    ranked = (ranked.withColumn("_budget", budget)
              .withColumn("_level", (F.col("_budget") - F.coalesce(F.sum("_full").over(before), F.lit(0)))
                          / (F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0))))
              .withColumn("_at", F.row_number().over(order)))
    fits = F.col("_level") * F.col("_w") <= F.col("_full")
    first = F.min(F.when(fits, F.struct("_at", "_level"))).over(everything)
    ranked = ranked.withColumn("_first", first)
    target = F.when(F.col("_first").isNull() | (F.col("_at") < F.col("_first._at")), F.col("_full").cast("double")).otherwise(
        F.col("_first._level") * F.col("_w"))
    return ranked.select("source", "source_size", target.alias("target"))


def queue(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
          weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: int = 2, bucket_digits: int = 3) -> DataFrame:
    """Queue every document of ``docs`` and say how many of its words the mix takes.

    Documents are shuffled by a digest of their key. Each gets a virtual finish time, the words of its source up to and
    with it divided by the source's target. The queue offers each source ``most`` times. Every source reaches its
    target at virtual time 1, so truncating the global order at the total budget is the same as stopping there; the
    document that stands across the end of its source gives only the words still missing.

    Running sums have two levels: words per (source, leading digest digits), added up over the digits, then a window
    within one such bucket. A source that holds a third of all rows is dealt over 16 ** ``bucket_digits`` buckets.

    Returns ``key``, ``source``, and long ``size``, ``source_size``, double ``target``, long ``taken`` and
    double ``finish`` (of the first offer; null where the target is 0). Null or empty text has size 0 and gives 0 words;
    a null source is a source, the last; repeated rows are documents of their own; rows with one digest are taken by
    key, then size; an empty table gives an empty result. Only the named columns are read, so others may have any name.
    """
    out = _queued(docs, key, source, text, weights, share, most, bucket_digits, ())
    return out.withColumnsRenamed({"_key": key, "_source": "source"})


def _queued(docs: DataFrame, key: str, source: str, text: str, weights: Sequence[int], share: float, most: int, bucket_digits: int,
            keep: Sequence[str]) -> DataFrame:
    """``queue`` with columns ``_key``, ``_source`` and, for each of ``keep``, ``_keep_`` and its name."""
    rows = docs.select(F.col(key).alias("_key"), F.col(source).alias("_source"), word_count(F.col(text)).alias("_size"),
                       F.md5(F.coalesce(F.col(key).cast("string"), F.lit("null"))).alias("_digest"),
                       *[F.col(c).alias(f"_keep_{c}") for c in keep])
    rows = rows.withColumn("_bucket", F.substring("_digest", 1, bucket_digits))
    if not keep:  # a few bytes a document; whole documents are read twice instead
        rows, _ = table(rows)
    parts = rows.groupBy("_source", "_bucket").agg(F.sum("_size").alias("_words"))
    parts = parts.withColumn("_before", F.sum("_words").over(Window.partitionBy("_source").orderBy("_bucket")) - F.col("_words"))
    sizes = parts.groupBy(F.col("_source").alias("source")).agg(F.sum("_words").alias("source_size"))
    aims = targets(sizes, weights, share, most).withColumnRenamed("source", "_name")
    parts = parts.join(aims, F.col("_source").eqNullSafe(F.col("_name"))).select(
        F.col("_source").alias("_s"), F.col("_bucket").alias("_b"), "_before", "source_size", "target")
    rows = rows.join(parts, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")))
    inside = Window.partitionBy("_source", "_bucket").orderBy("_digest", "_key", "_size").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_end", F.col("_before") + F.sum("_size").over(inside))
    aim = F.floor("target").cast("long")
    taken = F.lit(0).cast("long")
    for i in range(most):
        start = F.col("_end") - F.col("_size") + F.col("source_size") * i
        taken = taken + F.least(F.greatest(aim - start, F.lit(0)), F.col("_size"))
    return rows.select("_key", *[f"_keep_{c}" for c in keep], "_source", F.col("_size").alias("size"), "source_size", "target", taken.alias("taken"),
                       F.when(F.col("target") > 0, F.col("_end") / F.col("target")).alias("finish"))


def mixed(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
          weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: int = 2, bucket_digits: int = 3) -> DataFrame:
    """The mix itself: the rows of ``docs`` that it takes, once per offer, range-sorted by virtual finish time.

    The columns are those of ``docs``. The document across the end of its source keeps its leading words. Documents
    without words, which the budget cannot count, are kept once when their own offer falls before the end.
    """
    columns = docs.columns
    q = _queued(docs, key, source, text, weights, share, most, bucket_digits, [c for c in columns if c not in (key, source)])
    q = q.withColumnsRenamed({"_key": f"_keep_{key}", "_source": f"_keep_{source}"}).withColumn("_turn", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    part = F.least(F.greatest(F.col("taken") - F.col("_turn") * F.col("size"), F.lit(0)), F.col("size"))
    when = F.col("finish") + F.col("_turn") * F.col("source_size") / F.col("target")
    whole = (F.col("size") == 0) & (F.col("_turn") == 0) & F.coalesce(F.col("finish") <= 1, F.lit(False))
    q = q.withColumn("_part", part).withColumn("_when", when).where((F.col("_part") > 0) | whole)
    head = F.concat(F.lit(r"^[\x20\x09-\x0D]*+(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+){"), F.col("_part").cast("string"), F.lit("}+"))
    cut = F.call_function("regexp_extract", F.col(f"_keep_{text}"), head, F.lit(0))
    body = F.when(F.col("_part") < F.col("size"), cut).otherwise(F.col(f"_keep_{text}"))
    q = q.withColumn(f"_keep_{text}", body).orderBy("_when", f"_keep_{key}", "_turn")
    return q.select(*[F.col(f"_keep_{c}").alias(c) for c in columns])
