"""Parquet tables whose current content a small marker file names.

Every write goes to a folder of its own (``_w=<id>``), so writers never touch each other's files; within it, rows lie in folders by date
or by a hash of the key, if the table has such a layout. The marker of the next version then lists the folders that count: a replacement lists
only the new ones, an append adds them, and an overwrite takes the old folders of the dates or hash buckets that were written again out. A
marker is written aside and renamed into place without overwriting, so it is never seen half written, and of two writers of one version one
fails, without harm to the other's rows. Readers see the previous version until the marker is in place, and a query may read the
table it is about to replace.

A marker also records the last batch taken from each stream, which makes a retried micro-batch harmless, and the bounds of a time column in each
folder, from which the table's newest time is known and folders are skipped without a scan.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Collection, Sequence
from datetime import datetime, timedelta

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstat.functions.timex import DATE, EPOCH, high_watermark
from reelstat.operators.joins import any_null, row_hash
from reelstat.operators.merge import CARDINALITY_MESSAGE, Change, MergeCardinalityError, merge, new_rows
from reelstat.session import staged

WRITER = "_w"
BUCKET = "_b"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class CommitConflict(RuntimeError):
    """Another writer committed the same version first."""


class SnapshotTable:
    """A table below ``path``. ``partition_ts`` lays rows out by the date of that column, ``buckets`` by a hash of ``keys``, ``by`` by the values of
    a column; ``cluster`` orders rows within a folder (default: the keys). The markers keep the bounds of ``time`` (default:
    ``partition_ts``), which may be any ordered column."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        partition_ts: str | None = None,
        cluster: Sequence[str] = (),
        keys: Sequence[str] = (),
        buckets: int = 0,
        time: str | None = None,
        by: str | None = None,
    ):
        if sum(map(bool, (partition_ts, buckets, by))) > 1:
            raise ValueError("a table is laid out by date, by key or by a column, not by several")
        self.spark, self.path = spark, path.rstrip("/")
        self.partition_ts, self.buckets, self.keys = partition_ts, buckets, tuple(keys)
        self.cluster, self.time = tuple(cluster) or self.keys, time or partition_ts
        self._folder = DATE if partition_ts else BUCKET if buckets else by

    def _fs(self, name: str):
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def _names(self, folder: str) -> list[str]:
        fs, path = self._fs(folder)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def versions(self) -> list[int]:
        return sorted(int(n) for n in self._names("_commits") if n.isdigit())

    def exists(self) -> bool:
        return bool(self.commit_info())

    def _marker(self, version: int) -> dict:
        """What a marker says; empty if it cannot be read, as after a writer that died while it wrote one in place."""
        fs, path = self._fs(f"_commits/{version:08d}")
        stream = fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        except ValueError:
            return {}
        finally:
            stream.close()

    def commit_info(self, version: int | None = None) -> dict:
        """What the marker of a version (default: the newest readable one) says; empty without one."""
        if version is not None:
            return self._marker(version)
        return next((info for v in reversed(self.versions()) if (info := self._marker(v))), {})

    def read(self, version: int | None = None, dates: bool = False, since: datetime | None = None) -> DataFrame:
        """The rows of a version. ``dates`` keeps the partition column ``dt`` of a table laid out by date: the time bounds of
        ``functions.timex`` then also bound the folders that are read. ``since`` leaves out the folders without a row of that time or later; those
        that are read may hold earlier ones."""
        info = self.commit_info(version)
        if not info:
            raise FileNotFoundError(f"no committed version below {self.path}")
        paths = info["paths"]
        if since is not None:
            bounds = info.get("bounds", {})
            paths = [p for p in paths if p not in bounds or (_time(bounds[p][1]) or datetime.min) >= since]
        return self._rows(paths, info["schema"], dates)

    def _rows(self, paths: Sequence[str], schema: str, dates: bool = False) -> DataFrame:
        """The rows in ``paths``; ``dates`` keeps the date of the folder."""
        return self._raw(paths, schema).drop(WRITER, BUCKET, *([DATE] if self.partition_ts and not dates else []))

    def _raw(self, paths: Sequence[str], schema: str) -> DataFrame:
        reader = self.spark.read.schema(schema).option("basePath", self.path)
        return reader.parquet(*(f"{self.path}/{p}" for p in paths)) if paths else self.spark.createDataFrame([], schema)

    def bounds(self) -> dict[str, list]:
        """Least and largest ``time``, as text, and number of rows of each folder that counts, by its path."""
        return self.commit_info().get("bounds", {})

    def newest(self) -> datetime | None:
        """The largest ``time`` of the table (naive UTC), from the marker; None without any."""
        info = self.commit_info()
        bounds = info.get("bounds", {})
        if any(p not in bounds for p in info.get("paths", [])):  # written before markers had bounds
            return high_watermark(self.read(), self.time)
        return max((t for p in info.get("paths", []) if (t := _time(bounds[p][1]))), default=None)

    def bucket(self, df: DataFrame) -> Column:
        """The bucket of each row. Rows with a NULL key match nothing: they are spread."""
        keys = [F.col(k) for k in self.keys]
        hashed = F.xxhash64(*keys)
        if any(df.schema[k].nullable for k in self.keys):
            hashed = F.when(any_null(keys), row_hash(df)).otherwise(hashed)
        return F.pmod(hashed, F.lit(self.buckets)).cast("int")

    def _write(self, df: DataFrame) -> tuple[list[str], str, dict]:
        """Write ``df`` to a folder of its own; returns the paths in it, the stored schema and the bounds of each path."""
        own = f"{WRITER}={uuid.uuid4().hex}"
        if self.partition_ts or self.buckets:
            df = df.withColumn(self._folder, F.to_date(self.partition_ts) if self.partition_ts else self.bucket(df))
        if self._folder:
            df = df.hint("rebalance", self._folder).sortWithinPartitions(self._folder, *self.cluster)
        writer = df.write.partitionBy(self._folder) if self._folder else df.write
        try:
            writer.parquet(f"{self.path}/{own}")
        except PySparkException as error:
            if CARDINALITY_MESSAGE in str(error):
                raise MergeCardinalityError(CARDINALITY_MESSAGE) from error
            raise
        names = [n for n in self._names(own) if n.startswith(f"{self._folder}=")] if self._folder else []
        paths = [f"{own}/{n}" for n in names] if self._folder else [own]
        schema = f"{_ddl(df)}, `{WRITER}` string" if df.columns else f"`{WRITER}` string"
        return paths, schema, self._bounds(own, paths, schema)

    def _bounds(self, own: str, paths: Sequence[str], schema: str) -> dict:
        """Least and largest time and number of rows of each path just written: one column of it is read."""
        if not self.time or not paths:
            return {}
        rows = self._raw(paths, schema)
        kind = rows.schema[self.time].dataType

        def text(c: Column) -> Column:
            return F.unix_micros(c) if isinstance(kind, T.TimestampType) else c.cast("string")

        found = rows.groupBy(*([F.col(self._folder).cast("string").alias("at")] if self._folder else [])).agg(
            text(F.min(self.time)).alias("low"), text(F.max(self.time)).alias("high"), F.count("*").alias("rows")
        )
        out = {}
        for r in found.collect():  # as many rows as folders were written
            path = f"{own}/{self._folder}={NO_VALUE if r['at'] is None else r['at']}" if self._folder else own
            out[path] = [_time_text(r["low"]), _time_text(r["high"]), r["rows"]]
        return out

    def _commit(self, version: int, paths: list[str], schema: str, info: dict) -> int:
        content = json.dumps({**info, "paths": sorted(paths), "schema": schema, "at": time.time()}).encode()
        fs, aside = self._fs(f"_commits/.{version:08d}-{uuid.uuid4().hex}")
        _, path = self._fs(f"_commits/{version:08d}")
        stream = fs.create(aside, False)
        try:
            stream.write(bytearray(content))
        finally:
            stream.close()
        try:
            self._rename(fs, aside, path)
        except Exception as error:
            fs.delete(aside, False)
            if not fs.exists(path):
                raise
            raise CommitConflict(f"version {version} of {self.path} was committed by another writer") from error
        return version

    def _rename(self, fs, source, target) -> None:
        """Rename without overwriting; an error if the target exists."""
        jvm = self.spark._jvm
        kinds = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(kinds, 1)
        options[0] = kinds.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(fs.makeQualified(source), fs.makeQualified(target), options)

    def _next(self) -> tuple[int, dict]:
        return max(self.versions(), default=-1) + 1, self.commit_info()

    @staticmethod
    def _carried(before: dict, stream: tuple[str, int] | None, info: dict | None = None) -> dict:
        streams = dict(before.get("streams", {}))
        if stream is not None:
            streams[stream[0]] = stream[1]
        kept = {k: v for k, v in before.items() if k not in ("paths", "schema", "at", "streams", "bounds")}
        return {**kept, **(info or {}), "streams": streams}

    def _committed(self, df: DataFrame, keep: Callable[[str], bool], stream, info: Callable[[DataFrame], dict] | dict | None = None) -> int:
        """Write ``df`` and commit it beside the current folders that ``keep`` names."""
        version, before = self._next()
        paths, schema, bounds = self._write(df)
        kept = [p for p in before.get("paths", []) if keep(p)]
        found = info(self._rows(paths, schema)) if callable(info) else info
        old = {p: b for p, b in before.get("bounds", {}).items() if p in set(kept)}
        return self._commit(version, [*kept, *paths], schema, {**self._carried(before, stream, found), "bounds": {**old, **bounds}})

    def replace(self, df: DataFrame, stream: tuple[str, int] | None = None, info: Callable[[DataFrame], dict] | dict | None = None) -> int:
        """Write ``df`` (which may read this table) as the next version and make it current."""
        return self._committed(df, lambda path: False, stream, info)

    def append(self, df: DataFrame, stream: tuple[str, int] | None = None, info: Callable[[DataFrame], dict] | dict | None = None) -> int:
        """Add rows; no file of the table is written again. What ``info`` is, or makes of the rows as written, goes to the marker, and
        stays in later ones."""
        return self._committed(df, lambda path: True, stream, info)

    def overwrite_dates(self, df: DataFrame, dates: Sequence[str], stream: tuple[str, int] | None = None) -> int:
        """Replace the rows of ``dates`` (texts as in the folder names) by those of ``df``, and add its rows of other dates. Files of
        all other dates stay as they are."""
        return self._overwrite(df, dates, stream)

    def _overwrite(self, df: DataFrame, values: Collection, stream: tuple[str, int] | None) -> int:
        return self._committed(df, lambda path: not self._holds(path, values), stream)

    def _holds(self, path: str, values: Collection) -> bool:
        """Whether a path is the folder of one of the dates or buckets."""
        return any(part in {f"{self._folder}={v}" for v in values} for part in path.split("/"))

    def taken(self, stream: tuple[str, int] | None) -> bool:
        """Whether this batch of the stream is in the table already."""
        if stream is None:
            return False
        done = self.commit_info().get("streams", {}).get(stream[0])
        return done is not None and stream[1] <= done

    def create_or_merge(
        self,
        build_initial: Callable[[], DataFrame],
        build_increment: Callable[[DataFrame], DataFrame],
        stream: tuple[str, int] | None = None,
        added_only: bool = False,
    ) -> str:
        """Initial build when the table is absent or empty, else the increment from its current content.

        With ``added_only`` the increment gives only the rows to add, and nothing is written again. A batch of a stream that was
        taken already is skipped.
        """
        if self.taken(stream):
            return "skipped"
        if self.exists():
            current = self.read()
            if not current.isEmpty():
                (self.append if added_only else self.replace)(build_increment(current), stream)
                return "merged"
        self.replace(build_initial(), stream)
        return "created"

    def merge(self, source: DataFrame, on: Sequence[str] | bool, set=None, insert=None, stream: tuple[str, int] | None = None, **options) -> int:
        """Merge ``source``, writing as little as the layout allows.

        A merge that only inserts appends. In a table laid out by key only the buckets that hold a key of ``source`` are read and written again. In
        one laid out by date these are the dates that hold a matched row; finding them reads the keys alone, or nothing if the date comes
        from a key. Otherwise the table is replaced. Rows with a NULL key match nothing and are added beside what is there.
        """
        with staged(source, "batch") as batch:
            if on is True or options.get("not_matched_by_source") or not (self.partition_ts or self.buckets):
                if on is not True and set is None and not options.get("not_matched_by_source"):
                    return self.append(new_rows(self.read(), batch, on, insert), stream)
                return self.replace(merge(self.read(), batch, on, set=set, insert=insert, **options), stream)
            values = self._touched(batch, list(on), set is not None)
            info = self.commit_info()
            current = self._rows([p for p in info["paths"] if self._holds(p, values)], info["schema"])
            if set is None:
                return self.append(new_rows(current, batch, on, insert), stream)
            # rows of the source that match nothing in these folders match nothing elsewhere either
            return self._overwrite(merge(current, batch, on, set=set, insert=insert, **options), values, stream)

    def apply(self, change: Change, stream: tuple[str, int] | None = None) -> int:
        """Merge what a plan wants to change."""
        return self.merge(change.source, change.on, change.set, change.insert, stream, source_unique=change.source_unique)

    def _touched(self, source: DataFrame, on: list[str], updates: bool) -> list[str]:
        """The dates or buckets in which rows of ``source`` can have a match; at most as many as the table has folders."""
        known = source.where(~any_null([F.col(k) for k in on]))
        if self.buckets:
            if list(self.keys) != on:
                return [str(b) for b in range(self.buckets)]
            return [str(r["b"]) for r in known.select(self.bucket(known).alias("b")).distinct().collect()]
        if self.partition_ts in on:
            dates = known.select(F.to_date(self.partition_ts).cast("string").alias(DATE)).distinct()
        elif not updates:  # all keys are looked at, none is written
            return [v for p in self.commit_info()["paths"] for v in [p.split("=")[-1]]]
        else:
            matched = self.read(dates=True).join(known.select(*on).distinct(), on, "left_semi")
            dates = matched.select(F.col(DATE).cast("string").alias(DATE)).distinct()
        return [r[DATE] or NO_VALUE for r in dates.collect()]

    def vacuum(self, keep: int = 2, older_than: float = 3600.0, orphans_older_than: float = 86400.0) -> None:
        """Drop the folders that none of the newest ``keep`` versions needs, and the markers before them, if the version that
        last needed them was superseded ``older_than`` seconds ago: readers of it may still be at work. Folders that no version names, left by
        writers that lost or died, go ``orphans_older_than`` seconds after they were made; no write may take longer."""
        versions = self.versions()
        infos = {v: self._marker(v) for v in versions}
        limit = time.time() - older_than
        old = [v for v, after in zip(versions[:-1], versions[1:], strict=True) if v in versions[:-keep] and infos[after].get("at", 0) <= limit]
        needed = {p for v in versions if v not in old for p in infos[v].get("paths", [])}
        gone = {p for v in old for p in infos[v].get("paths", [])} - needed
        named = {p.split("/")[0] for info in infos.values() for p in info.get("paths", [])}
        used = {p.split("/")[0] for p in needed}
        whole = {w for p in gone if (w := p.split("/")[0]) not in used and w.startswith(f"{WRITER}=")}
        for name in {p for p in gone if p.split("/")[0] not in whole} | whole | {f"_commits/{v:08d}" for v in old}:
            fs, path = self._fs(name)
            fs.delete(path, True)
        for folder, prefix in (("", f"{WRITER}="), ("_commits", ".")):
            fs, root = self._fs(folder)
            for status in fs.listStatus(root) if fs.exists(root) else []:
                name, made = status.getPath().getName(), status.getModificationTime() / 1000
                if name.startswith(prefix) and name not in named and made <= time.time() - orphans_older_than:
                    fs.delete(status.getPath(), True)


def _ddl(df: DataFrame) -> str:
    return df._jdf.schema().toDDL()


def _time_text(value: int | str | None) -> str | None:
    """Microseconds, or the text of a zone-less time or date, as ISO text."""
    return (EPOCH + timedelta(microseconds=value)).isoformat(sep=" ") if isinstance(value, int) else value


def _time(text: str | None) -> datetime | None:
    return None if text is None else datetime.fromisoformat(text)
