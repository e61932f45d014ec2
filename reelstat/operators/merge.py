"""MERGE as a DataFrame operator.

Updates are ``target LEFT JOIN source`` and inserts ``source ANTI JOIN target``, not one full outer join: a small batch
is then broadcast and the large target is not shuffled at all, and when both sides shuffle the adaptive planner can still
split a skewed target (it cannot for a full outer join).

Rules: keys compare with ``=``, so NULL keys never match and are inserted again on every run; all right-hand sides of
``set`` see the target row as it was before the merge; a target row matched by several source rows is an error when there
is an update clause.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.operators.joins import any_null, row_hash, single_row
from reelstat.session import materialise

CARDINALITY_MESSAGE = "merge: a target row is matched by more than one source row"


class MergeCardinalityError(RuntimeError):
    """A target row was matched by more than one source row."""


def _expr(value: str | Column) -> Column:
    return F.expr(value) if isinstance(value, str) else value


def _salted(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """NULL keys match nothing: spread them instead of gathering them in one task."""
    salt = F.when(any_null([F.col(k) for k in keys]), row_hash(df, keys)).otherwise(F.lit(0))
    return df.withColumn("_salt", salt.cast("bigint"))


def _both_salted(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    if any(target.schema[k].nullable and source.schema[k].nullable for k in keys):
        return _salted(target, keys), _salted(source, keys)
    zero = F.lit(0).cast("bigint")
    return target.withColumn("_salt", zero), source.withColumn("_salt", zero)


def _one_per_key(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with the number of rows behind it (pre-combined map-side)."""
    rest = [c for c in source.columns if c not in keys and c != "_salt"]
    return source.groupBy(*keys, "_salt").agg(
        *[F.first(c).alias(c) for c in rest], F.count(F.lit(1)).alias("_matches")
    )


def merge(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str] | bool,
    set: str | Mapping[str, str | Column] | None = None,
    insert: str | Mapping[str, str | Column] | None = None,
    not_matched_by_source: Mapping[str, object] | None = None,
    source_unique: bool = False,
    stage: bool = False,
) -> DataFrame:
    """Result of merging ``source`` into ``target`` with the target's columns.

    ``set`` and ``insert`` are ``"*"`` (same-named columns), a mapping of column to expression over aliases ``t`` and
    ``s``, or None for no such clause. ``on=True`` merges two one-row tables. ``source_unique`` promises that no key
    occurs twice in ``source``, which saves the check. ``stage`` writes the source to the shared folder first: the two
    joins then read it instead of deriving it twice, and the planner knows from its real size whether to broadcast it and
    leave the target unshuffled.
    """
    if stage:
        source = materialise(source, "batch")
    if on is True:
        return _merge_singleton(target, source, set, insert)
    keys, columns = list(on), target.columns
    t, s = _both_salted(target, source, keys)
    join_keys = [*keys, "_salt"]

    updates = target
    if set is not None or not_matched_by_source:
        if set == "*":
            set = {c: f"s.{c}" for c in source.columns if c in columns and c not in keys}
        checked = s.withColumn("_matches", F.lit(1)) if source_unique else _one_per_key(s, keys)
        condition = reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in join_keys])
        joined = t.alias("t").join(checked.alias("s"), condition, "left")
        updates = joined.select(*_updated(columns, set or {}, not_matched_by_source or {}, source_unique))

    if insert is None:
        return updates
    return updates.unionByName(new_rows(target, source, on, insert))


@dataclass
class Change:
    """What an increment wants to merge into a table; ``onto`` gives the merged table, ``SnapshotTable.apply`` writes only what it touches."""

    source: DataFrame
    on: Sequence[str] | bool
    set: str | Mapping[str, str | Column] | None = None
    insert: str | Mapping[str, str | Column] | None = "*"
    source_unique: bool = True

    def onto(self, target: DataFrame) -> DataFrame:
        stage = self.on is not True
        return merge(target, self.source, self.on, self.set, self.insert, source_unique=self.source_unique, stage=stage)


def new_rows(target: DataFrame, source: DataFrame, on: Sequence[str], insert: str | Mapping[str, str | Column] | None) -> DataFrame:
    """The rows a merge inserts: those of ``source`` without a match in ``target``, with the target's columns."""
    keys = list(on)
    t, s = _both_salted(target, source, keys)
    new = s.join(t.select(*keys, "_salt"), [*keys, "_salt"], "left_anti").drop("_salt")
    return _inserted(target, new, "*" if insert is None else insert)


def merge_into(source, table: str, on: Sequence[str], set=None, insert=None, not_matched_by_source=None) -> None:
    """The same merge on a catalog table whose format supports row-level changes, by its own ``MERGE``.

    Expressions use the aliases ``t`` and ``s`` as in ``merge``; the table's format decides what is written again.
    """
    matched = reduce(lambda a, b: a & b, [F.expr(f"t.{k} = s.{k}") for k in on])
    writer = source.alias("s").mergeInto(f"{table} t", matched)
    if set == "*":
        writer = writer.whenMatched().updateAll()
    elif set:
        writer = writer.whenMatched().update({c: _expr(v) for c, v in set.items()})
    if insert == "*":
        writer = writer.whenNotMatched().insertAll()
    elif insert:
        writer = writer.whenNotMatched().insert({c: _expr(v) for c, v in insert.items()})
    if not_matched_by_source:
        values = {c: v if isinstance(v, Column) else F.lit(v) for c, v in not_matched_by_source.items()}
        writer = writer.whenNotMatchedBySource().update(values)
    writer.merge()


def _updated(columns, assignments, defaults, source_unique) -> list[Column]:
    hit = F.col("s._matches").isNotNull()
    if not source_unique:
        too_many = F.raise_error(F.lit(CARDINALITY_MESSAGE)).cast("boolean")
        hit = F.when(F.col("s._matches") > 1, too_many).otherwise(hit)
    out = []
    for c in columns:
        value = F.col(f"t.{c}")
        if c in defaults:
            default = defaults[c] if isinstance(defaults[c], Column) else F.lit(defaults[c])
            value = F.when(~hit, default).otherwise(value)
        if c in assignments:
            value = F.when(hit, _expr(assignments[c])).otherwise(value)
        out.append(value.alias(c))
    return out


def _inserted(target: DataFrame, new: DataFrame, insert) -> DataFrame:
    values = {c: f"s.{c}" for c in new.columns} if insert == "*" else dict(insert)
    out = [
        (_expr(values[f.name]) if f.name in values else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target.schema.fields
    ]
    return new.alias("s").select(*out)


def _merge_singleton(target, source, set, insert) -> DataFrame:
    columns = target.columns
    if set == "*":
        set = {c: f"s.{c}" for c in source.columns if c in columns}
    s = single_row(source).withColumn("_matches", F.lit(1))
    updates = target
    if set is not None:
        joined = target.alias("t").join(F.broadcast(s.alias("s")), F.lit(True), "left")
        updates = joined.select(*_updated(columns, set, {}, True))
    if insert is None:
        return updates
    rows = target.agg(F.count(F.lit(1)).alias("_n"))
    new = s.drop("_matches").crossJoin(F.broadcast(rows)).where("_n = 0").drop("_n")
    return updates.unionByName(_inserted(target, new, insert))
