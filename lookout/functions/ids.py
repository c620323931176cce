"""Entity and relation identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the id format.
BLANK_NAME = "_blank"
SERVICE_SEP = "."
PART_SEP = "_"
RELATION_SEP = "-"


def _enc(name: Column) -> Column:
    return F.base64(F.encode(name, "UTF-8"))


def _dec(part: Column) -> Column:
    return F.decode(F.unbase64(part), "UTF-8")


def _named(name: Column) -> Column:
    return F.when(F.trim(F.coalesce(name, F.lit(""))) == "", F.lit(BLANK_NAME)).otherwise(name)


def service_id(name: Column, normal: Column | bool = True) -> Column:
    flag = F.lit(1 if normal else 0) if isinstance(normal, bool) else normal.cast("int")
    return F.concat(_enc(_named(name)), F.lit(SERVICE_SEP), flag.cast("string"))


def instance_id(service: Column, name: Column) -> Column:
    return F.concat(service, F.lit(PART_SEP), _enc(_named(name)))


endpoint_id = instance_id


def process_id(instance: Column, name: Column) -> Column:
    return F.sha2(F.concat(_named(name), F.lit("_"), instance), 256)


def relation_id(source: Column, dest: Column) -> Column:
    return F.concat(source, F.lit(RELATION_SEP), dest)


def endpoint_relation_id(source_service: Column, source: Column, dest_service: Column, dest: Column) -> Column:
    return F.concat_ws(RELATION_SEP, source_service, _enc(source), dest_service, _enc(dest))


def hierarchy_relation_id(upper: Column, upper_layer: Column, lower: Column, lower_layer: Column) -> Column:
    return F.concat(upper, F.lit(SERVICE_SEP), upper_layer.cast("string"), F.lit(RELATION_SEP),
                    lower, F.lit(SERVICE_SEP), lower_layer.cast("string"))


def parse_service(sid: Column) -> dict[str, Column]:
    parts = F.split(sid, r"\.")
    return {"name": _dec(parts[0]), "normal": parts[1] == "1"}


def parse_part(iid: Column) -> dict[str, Column]:
    """Instance or endpoint id to its service id and name."""
    parts = F.split(iid, PART_SEP)
    return {"service_id": parts[0], "name": _dec(parts[1])}


def parse_relation(rid: Column) -> dict[str, Column]:
    parts = F.split(rid, RELATION_SEP)
    return {"source": parts[0], "dest": parts[1]}


def parse_endpoint_relation(rid: Column) -> dict[str, Column]:
    parts = F.split(rid, RELATION_SEP)
    return {"source_service": parts[0], "source": _dec(parts[1]), "dest_service": parts[2], "dest": _dec(parts[3])}
