"""Fields of a topic that the declared schema does not know, or no longer gets
(B1, B2): what ``from_json`` would pass over without a word.

Each message is parsed as a variant once and reduced to its type; messages of
one type are counted together, and only the distinct types are taken apart.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tasks get this module's functions by value, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Variant types that the JSON parser reads as a declared type.
READS = {"int": ("BIGINT",), "bigint": ("BIGINT",), "double": ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"),
         "timestamp": ("STRING",), "boolean": ("BOOLEAN",), "struct": ("OBJECT",), "map": ("OBJECT",),
         "array": ("ARRAY", "OBJECT")}  # a lone object is read as an array of one
PATH_TYPES = "array<struct<path:string,type:string>>"


def typed_paths(schema: str) -> list[tuple[str, str]]:
    """``(path, type)`` of every field in a variant's type; elements of arrays
    have the path of the array and ``[]``, the message itself has the path ''."""
    found, at = [], 0

    def name() -> str:
        nonlocal at
        if schema[at] != "`":
            end = schema.index(": ", at)
            out, at = schema[at:end], end
            return out
        out, at = "", at + 1
        while schema[at] != "`" or schema[at + 1:at + 2] == "`":
            out += schema[at]
            at += 2 if schema[at] == "`" else 1
        at += 1
        return out

    def read(path: str) -> None:
        nonlocal at
        end = at
        while end < len(schema) and schema[end] not in "<>,":
            end += 1
        kind, at = schema[at:end], end
        found.append((path, kind))
        if at >= len(schema) or schema[at] != "<":
            return
        at += 1
        while schema[at] != ">":
            if kind == "ARRAY":
                read(path + "[]")
            else:
                field = name()
                at += 2
                read(f"{path}.{field}" if path else field)
            if schema[at] == ",":
                at += 2
        at += 1

    read("")
    return found


def declared_paths(schema: T.DataType, path: str = "") -> list[tuple[str, str]]:
    """``(path, kind)`` of a declared schema: the type's name, without children for maps."""
    kind = schema.typeName() if isinstance(schema, (T.StructType, T.ArrayType, T.MapType)) else schema.simpleString()
    out = [(path, kind)]
    if isinstance(schema, T.StructType):
        for f in schema.fields:
            out += declared_paths(f.dataType, f"{path}.{f.name}" if path else f.name)
    if isinstance(schema, T.ArrayType):
        out += declared_paths(schema.elementType, path + "[]")
    return out


def _paths(schemas: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in schemas:
        yield batch.map(typed_paths)


def observed_fields(messages: DataFrame, by: list[str], value: str = "value") -> DataFrame:
    """``by, path, type, messages``; text that is no JSON has the type ``MALFORMED``
    at the path '', and numbers are ``DECIMAL`` of any size."""
    kind = F.schema_of_variant(F.try_parse_json(F.col(value)))
    kind = F.regexp_replace(kind, r"DECIMAL\(\d+,\d+\)", "DECIMAL")
    kinds = (messages.filter(F.col(value).isNotNull()).select(*by, F.coalesce(kind, F.lit("MALFORMED")).alias("__kind"))
             .groupBy(*by, "__kind").agg(F.count(F.lit(1)).alias("__n")))
    taken = F.pandas_udf(_paths, PATH_TYPES)
    each = kinds.select(*by, F.explode(F.array_distinct(taken("__kind"))).alias("p"), "__n")
    return each.groupBy(*by, "p.path", "p.type").agg(F.sum("__n").alias("messages"))


def schema_drift(messages: DataFrame, declared: T.DataType, by: list[str], value: str = "value") -> DataFrame:
    """``by, path, change, types, messages``: one row per field that was

    * ``added``: not declared (children of declared maps belong to them);
    * ``retyped``: of a type that the parser reads as NULL (``types`` names these);
    * ``missing``: declared and in no message of the group.

    ``messages`` counts the messages with the field, for missing ones all of the
    group.  JSON null is no type of its own.  Everything is readable as a
    declared string."""
    known = declared_paths(declared)
    maps = [p for p, kind in known if kind == "map"]
    names, kinds = [p for p, _ in known], {p: kind for p, kind in known}
    seen = observed_fields(messages, by, value).filter("type <> 'VOID'")
    inside = F.lit(False)
    for p in maps:
        inside = inside | F.col("path").startswith(p + ".")
    readable = F.lit(True)
    for p, kind in kinds.items():
        if kind != "string":
            readable = F.when(F.col("path") == p, F.col("type").isin(*READS.get(kind, ()))).otherwise(readable)
    change = F.when(~F.col("path").isin(*names) & ~inside, "added").when(~readable, "retyped")
    found = seen.withColumn("change", change).filter("change IS NOT NULL").groupBy(*by, "path", "change").agg(
        F.array_join(F.array_sort(F.collect_set("type")), ",").alias("types"), F.sum("messages").alias("messages"))
    groups = messages.filter(F.col(value).isNotNull()).groupBy(*by).agg(F.count(F.lit(1)).alias("messages"))
    wanted = groups.select(*by, "messages", F.explode(F.array(*[F.lit(p) for p in names])).alias("path"))
    gone = wanted.join(seen.select(*by, "path").distinct(), [*by, "path"], "left_anti")
    return found.unionByName(gone.select(*by, "path", F.lit("missing").alias("change"), F.lit("").alias("types"), "messages"))
