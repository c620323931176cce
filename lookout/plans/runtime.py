"""Session helpers: durable intermediate results, lookup tables and joins that bear uneven keys."""

from __future__ import annotations

import atexit
import uuid
from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: lookups up to this many entries become literals in the plan; larger ones stay tables
LITERAL_ENTRIES = 256


_made: list[tuple[SparkSession, str]] = []


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names. Only on a local master, where all tasks share the driver's disk, one
    below the warehouse stands in for it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage through reliable storage, so that a lost executor does not replay earlier rounds."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(checkpoint_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def stored(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` written once as Parquet in the shared folder and read back, with its path. For the state of an iteration:
    the last stage runs once, counts and filters read columns, and :func:`delete` removes a round that is done with.
    What is left goes with the driver program."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/round-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _made.append((spark, path))
    return spark.read.schema(df.schema).parquet(path), path


def stored_by(df: DataFrame, key: str, parts: int) -> DataFrame:
    """:func:`stored` in ``parts`` buckets of ``key``: what is grouped or joined by the key afterwards isn't shuffled. The table that
    names the buckets leaves the catalog at once, the frame keeps them."""
    spark = df.sparkSession
    name = f"round_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}"
    df.write.format("parquet").option("path", path).bucketBy(parts, key).saveAsTable(name)
    _made.append((spark, path))
    out = spark.table(name)
    out.schema  # resolved while the table is there
    spark.sql(f"DROP TABLE {name}")
    return out


@atexit.register
def _delete_all() -> None:
    for spark, path in _made:
        try:
            delete(spark, path)
        except Exception:  # noqa: BLE001  the session has ended; the folder is the cluster's to clean then
            pass


def lookup(df: DataFrame, key: Column, table: Mapping | DataFrame, out: str, default=None,
           table_key: str = "key", table_value: str = "value") -> DataFrame:
    """Add ``out`` = table[key] with a default.

    A rule mapping small enough to be written out becomes one map literal and needs no join. Anything larger is a
    :func:`lookup_join`.
    """
    if isinstance(table, Mapping) and len(table) <= LITERAL_ENTRIES:
        if not table:
            return df.withColumn(out, F.lit(default))
        literal = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
        found = F.try_element_at(literal, key)
        return df.withColumn(out, F.coalesce(found, F.lit(default)) if default is not None else found)
    if isinstance(table, Mapping):
        table = df.sparkSession.createDataFrame(list(table.items()), [table_key, table_value])
    right = table.groupBy(F.col(table_key).alias("_k")).agg(F.max(table_value).alias("_v"))
    joined = lookup_join(df.withColumn("_k", key), right, ["_k"])
    value = F.coalesce(F.col("_v"), F.lit(default)) if default is not None else F.col("_v")
    return joined.withColumn(out, value).drop("_k", "_v")


#: a looked-up table is broadcast up to this many rows and characters of JSON
BROADCAST_ROWS, BROADCAST_CHARS = 100_000, 16 << 20


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind)
    return _hashable(kind.elementType) if isinstance(kind, T.ArrayType) else not isinstance(kind, T.MapType)


def lookup_join(rows: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left", broadcast_rows: int = BROADCAST_ROWS,
                broadcast_chars: int = BROADCAST_CHARS, heavy: float = 0.01, salts: int = 32, fraction: float = 0.02) -> DataFrame:
    """Join ``rows`` with a smaller ``table`` by equality of the columns ``on``, however unevenly the rows spread over keys.

    The table is written out once, so that what is measured is what is joined. Up to ``broadcast_rows`` rows and
    ``broadcast_chars`` it is broadcast and the rows are not moved. A larger one is shuffled: keys with more than the
    share ``heavy`` of a sample of the rows, at most 1 / heavy of them, are dealt by the other columns over ``salts`` parts
    that each get a copy of their table rows, and so are rows with a null key, which match nothing; all other keys are
    hashed as usual. The rows are read once for the sample and once for the join. Streams join as Spark does.
    """
    on = list(on)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a lookup keeps or filters rows, it cannot be {how}")
    if rows.isStreaming:
        return rows.join(table, on, how)
    small, _ = stored(table)
    n, chars = small.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length(F.to_json(F.struct("*")))), F.lit(0))).first()
    if n <= broadcast_rows and chars <= broadcast_chars:
        return rows.join(F.broadcast(small), on, how)
    counts, _ = stored(rows.select(*on).sample(fraction, seed=7).dropna().groupBy(*on).agg(F.count(F.lit(1)).alias("_n")))
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    hot = [r[:len(on)] for r in counts.filter(F.col("_n") > heavy * total).collect()]
    any_of = lambda tests: reduce(lambda a, b: a | b, tests, F.lit(False))
    is_hot = any_of(reduce(lambda a, b: a & b, [F.col(c) == F.lit(v) for c, v in zip(on, values)]) for values in hot)
    others = [f.name for f in rows.schema if f.name not in on and _hashable(f.dataType)] or on
    part = F.pmod(F.xxhash64(*others), F.lit(salts)).cast("int")
    left = rows.withColumn("_salt", F.when(any_of(F.col(c).isNull() for c in on) | is_hot, part).otherwise(0))
    right = small.withColumn("_salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return left.join(right, [*on, "_salt"], how).drop("_salt")
