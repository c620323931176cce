"""Language runtime snapshots to metric source rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ids
from ..functions.timebucket import bucket_of_millis


def _base(rows: DataFrame) -> list:
    sid = ids.service_id(F.col("service"))
    return ["service", F.col("instance").alias("name"), sid.alias("service_id"),
            ids.instance_id(sid, F.col("instance")).alias("entity_id"), bucket_of_millis(F.col("time")).alias("time_bucket")]


def jvm(rows: DataFrame) -> dict[str, DataFrame]:
    """Snapshots (service, instance, time, cpu, memory array, memory_pool array, gc array, thread, clazz) to six frames.

    CPU usage below 1 percent reads as 1.
    """
    base = _base(rows)
    spread = lambda column: rows.select(*base, F.inline(column))
    return {
        "jvm_cpu": rows.select(*base, F.greatest(F.col("cpu"), F.lit(1.0)).alias("use_percent")),
        "jvm_memory": spread("memory"),
        "jvm_memory_pool": spread("memory_pool"),
        "jvm_gc": spread("gc"),
        "jvm_thread": rows.select(*base, "thread.*"),
        "jvm_class": rows.select(*base, "clazz.*"),
    }


def clr(rows: DataFrame) -> dict[str, DataFrame]:
    """Snapshots (service, instance, time, cpu, gc struct, thread struct) to three frames, all named by the instance."""
    base = _base(rows)
    return {"clr_cpu": rows.select(*base, F.col("cpu").alias("use_percent")), "clr_gc": rows.select(*base, "gc.*"),
            "clr_thread": rows.select(*base, "thread.*")}
