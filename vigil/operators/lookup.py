"""Lookup mapping with a default (type renames, party colours).

Small fixed mappings become a ``map`` literal evaluated inside whole-stage
codegen (no join at all). Table-valued lookups are plain left joins: adaptive
execution broadcasts the table where its size at run time allows it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def map_literal(mapping: Mapping[str, str]) -> Column:
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv)


def map_with_default(col, mapping: Mapping[str, str], default=None) -> Column:
    """``mapping[col]`` or ``default`` when the key is unknown or NULL."""
    c = F.col(col) if isinstance(col, str) else col
    v = F.try_element_at(map_literal(mapping), c)
    return v if default is None else F.coalesce(v, F.lit(default))


def lookup_join(df: DataFrame, table: DataFrame, key: str, value: str, out: str,
                default=None) -> DataFrame:
    """Left join a lookup table and fill unknown keys with ``default``."""
    t = table.select(F.col(key).alias("_lk"), F.col(value).alias("_lv"))
    j = df.join(t, df[key] == t["_lk"], "left")
    v = F.col("_lv") if default is None else F.coalesce(F.col("_lv"), F.lit(default))
    return j.withColumn(out, v).drop("_lk", "_lv")
