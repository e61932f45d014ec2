"""Arrays of (name, value) structs used as small maps, and vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def struct_array_get(arr: Column, name: str) -> Column:
    """Value stored under ``name``, NULL if there is none; two entries of one name are an error."""
    hits = F.filter(arr, lambda x: x["name"] == name)
    checked = F.when(F.size(hits) > 1, F.raise_error(F.lit(f"more than one entry named {name}"))).otherwise(hits)
    return F.get(checked, F.lit(0))["value"]


def struct_array_has(arr: Column, name: str) -> Column:
    """Whether an entry named ``name`` exists; false for a NULL array."""
    return F.coalesce(F.exists(arr, lambda x: x["name"] == name), F.lit(False))


def struct_array_drop(arr: Column, name: str) -> Column:
    """All entries but those named ``name``."""
    return F.filter(arr, lambda x: x["name"] != name)


def struct_array_put(arr: Column, other: Column, name: str) -> Column:
    """``arr`` with its entry ``name`` replaced by the first such entry of ``other``."""
    taken = F.slice(F.filter(other, lambda x: x["name"] == name), 1, 1)
    empty = F.array().cast("array<struct<name:string,value:string>>")
    return F.concat(F.coalesce(struct_array_drop(arr, name), empty), F.coalesce(taken, empty))


def vector_has_dim(vec: Column, dim: int) -> Column:
    """Whether the vector has exactly ``dim`` elements; NULL for a NULL vector."""
    return F.array_size(vec) == dim
