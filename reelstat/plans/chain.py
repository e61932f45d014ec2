"""All tables in dependency order, each kept as a snapshot, and their serving copies.

Raw events are parsed once, into a typed table by date that all plans read. Every later run merges what is new: a table laid out by date
writes the dates it touches again, one laid out by key the hash buckets it touches. Watermarks come from the tables' markers.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from reelstat.functions.timex import high_watermark, lookback, since_watermark
from reelstat.operators.merge import Change
from reelstat.plans import counts, embeddings, graph, ingest, metrics, moderation, popularity, relation, retraction, uploads, users
from reelstat.schemas import TABLE_KEYS
from reelstat.session import staged
from reelstat.sources import serving
from reelstat.sources.snapshots import SnapshotTable

#: Hash buckets of the tables laid out by key.
BUCKETS = 64
UPDATED = metrics.UPDATED
#: Layout of the tables: by the date of a time column, with the order of rows, or by key; and the time column kept in the marker.
LAYOUT: dict[str, dict] = {
    "events": {"partition_ts": "timestamp", "cluster": ("event",)},
    "user_video_relation": {"partition_ts": "last_watched_timestamp", "cluster": ("user_id",)},
    "user_video_metrics": {"keys": ("user_id",), "time": UPDATED},
    "video_statistics": {"keys": ("video_id",), "time": UPDATED},
    "global_video_stats": {"time": UPDATED},
    "video_statistics_normalized": {"keys": ("video_id",), "time": UPDATED},
    "follower_graph": {"partition_ts": "last_updated_timestamp", "cluster": ("follower_id", "following_id")},
    "video_upload_stats": {"partition_ts": "timestamp", "cluster": ("video_id",)},
    "ai_ugc": {"partition_ts": "upload_timestamp", "cluster": ("video_id",)},
    "bot_uploaded_content": {"partition_ts": "timestamp", "cluster": ("video_id",)},
    "video_reports": {"partition_ts": "report_timestamp", "cluster": ("video_id",)},
    "excluded_videos": {"partition_ts": "excluded_at", "cluster": ("video_id",)},
    "user_base_facts": {"keys": ("user_id",)},
    "video_embeddings": {"keys": ("uri",)},
    "video_index": {"keys": ("uri",)},
    "daily_event_counts": {"partition_ts": "event_date", "cluster": ("event_name",)},
}
#: Serving copies kept by overlapping increments, by their time column; the others are reloaded.
SYNCED = {
    "user_video_relation": "last_watched_timestamp",
    "video_statistics": "last_update_timestamp",
    "follower_graph": "last_updated_timestamp",
    "bot_uploaded_content": "timestamp",
    "ai_ugc": "upload_timestamp",
    "excluded_videos": "excluded_at",
}
#: When an upload document was received.
RECEIVED = "publish_time"
RELOADED = ("global_popular_videos_l7d", "ugc_content_approval", "video_nsfw_agg")


@dataclass
class Inputs:
    """The tables the chain starts from; a table whose inputs are not given is left out."""

    events: DataFrame
    nsfw_agg: DataFrame
    analytics: DataFrame | None = None
    shards: DataFrame | None = None
    approvals: DataFrame | None = None
    shard_tie: tuple[str, ...] = ()
    objects: Objects | None = None


@dataclass
class Objects:
    """Stored video objects (uri, metadata and whatever ``model_fn`` reads) with their moderation scores, and the model that embeds them."""

    listed: DataFrame
    nsfw: DataFrame
    model_fn: embeddings.ModelFn
    columns: tuple[str, ...] = ("uri",)
    dim: int = embeddings.EMBEDDING_DIM
    limit: int | None = None


class Chain:
    """The tables below a folder. ``run`` brings them up to date: its first run builds them, later ones merge what is new.

    With ``retract`` a pair that is watched again counts once (``plans.retraction``): statistics of users and videos equal those built anew from
    the relation, and the global ones and z-scores are built from them in each run.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS, retract: bool = False):
        self.spark, self.root, self.buckets, self.retract = spark, root.rstrip("/"), buckets, retract

    def table(self, name: str) -> SnapshotTable:
        layout = LAYOUT.get(name, {})
        return SnapshotTable(self.spark, f"{self.root}/{name}", buckets=self.buckets if "keys" in layout else 0, **layout)

    def read(self, name: str, dates: bool = False, since: datetime | None = None) -> DataFrame:
        return self.table(name).read(dates=dates, since=since)

    def _kept(self, name: str, build: Callable[[], DataFrame], change: Callable[[datetime | None], Change], timed: bool = True) -> str:
        """Initial build of a table that is absent or empty, else the change since its newest time. A ``timed`` table without any
        time is built anew as well."""
        table = self.table(name)
        if not table.exists() or table.read().isEmpty() or (timed and table.newest() is None):
            table.replace(build())
            return "created"
        table.apply(change(table.newest() if table.time else None))
        return "merged"

    def run(self, inputs: Inputs, as_of: datetime) -> dict[str, str]:
        """Bring every table up to date; returns what was done to each derived table."""
        self._ingest(inputs.events)
        events = self.read("events", dates=True)
        done = {}
        for name, (build, change) in self._core(events, inputs, as_of).items():
            if self.retract and name in ("global_video_stats", "video_statistics_normalized"):
                self.table(name).replace(build())
                done[name] = "replaced"
            else:
                done[name] = self._kept(name, build, change)
        if inputs.analytics is not None:
            done |= self._uploads(inputs, events, as_of)
        if inputs.shards is not None:
            tie, shards = list(inputs.shard_tie), inputs.shards
            done["user_base_facts"] = self._kept(
                "user_base_facts",
                lambda: users.user_base_facts(shards, tie, tie),
                lambda _: users.user_base_facts_change(shards, as_of.date(), tie, tie),
                timed=False,
            )
        if inputs.objects is not None:
            done |= self._embeddings(inputs.objects)
        for name, built in self._rankings(inputs, as_of).items():
            self.table(name).replace(built)
            done[name] = "replaced"
        return done

    def _embeddings(self, objects: Objects) -> dict[str, str]:
        """Embed the moderated objects that have no vector yet, and add the vectors fit for it to the searchable index; both only grow. The
        model runs once for each object: what it made is stored before anything reads it."""
        done = {}
        stored, index = self.table("video_embeddings"), self.table("video_index")
        known = stored.read().select("uri") if stored.exists() else objects.listed.select("uri").limit(0)
        new = embeddings.embed_new_videos(objects.listed, objects.nsfw, known, objects.model_fn, objects.limit, objects.columns)
        done["video_embeddings"] = "merged" if stored.exists() else "created"
        stored.append(new)
        fit = embeddings.index_rows(stored.read(), objects.dim)
        done["video_index"] = "merged" if index.exists() else "created"
        if index.exists():
            index.merge(fit, ["uri"], insert="*")
        else:
            index.replace(fit)
        return done

    def _ingest(self, events: DataFrame) -> None:
        """Parse the events that the typed table does not hold yet."""
        table = self.table("events")
        if table.exists() and (newest := table.newest()) is not None:
            table.append(ingest.typed_events(ingest.new_events(table.read(dates=True, since=newest - ingest.LATENESS), events, newest)))
        else:
            table.replace(ingest.typed_events(events))

    def _core(self, events: DataFrame, inputs: Inputs, as_of: datetime) -> dict[str, tuple]:
        read, day = self.read, as_of.date() - timedelta(days=1)

        def pairs(last: datetime) -> DataFrame:
            return read("user_video_relation", dates=True, since=last)

        changes = {
            "user_video_metrics": lambda last: metrics.user_video_metrics_change(pairs(last), last),
            "video_statistics": lambda last: metrics.video_statistics_change(pairs(last), read("user_video_metrics"), last),
        }
        if self.retract:
            changes |= self._retracting()
        return {
            "user_video_relation": (
                lambda: relation.user_video_relation(events),
                lambda last: relation.user_video_relation_change(events, last),
            ),
            "user_video_metrics": (
                lambda: metrics.user_video_metrics(read("user_video_relation")),
                changes["user_video_metrics"],
            ),
            "video_statistics": (
                lambda: metrics.video_statistics(read("user_video_relation"), read("user_video_metrics")),
                changes["video_statistics"],
            ),
            "global_video_stats": (
                lambda: metrics.global_video_stats(read("video_statistics")),
                lambda last: metrics.global_video_stats_change(read("video_statistics", since=last), last),
            ),
            "video_statistics_normalized": (
                lambda: metrics.video_statistics_normalized(read("video_statistics"), read("global_video_stats")),
                lambda last: metrics.video_statistics_normalized_change(
                    read("video_statistics", since=last), read("global_video_stats"), last
                ),
            ),
            "follower_graph": (lambda: graph.follower_graph(events), lambda last: graph.follower_graph_change(events, last)),
            "video_reports": (
                lambda: moderation.video_reports(events),
                lambda _: moderation.video_reports_change(events, as_of),
            ),
            "excluded_videos": (
                lambda: moderation.excluded_videos(events, inputs.nsfw_agg),
                lambda _: moderation.excluded_videos_change(events, inputs.nsfw_agg, as_of),
            ),
            "bot_uploaded_content": (
                lambda: uploads.bot_uploaded_content(events),
                lambda last: uploads.bot_content_change(events, last),
            ),
            "daily_event_counts": (
                lambda: counts.daily_event_counts(events),
                lambda _: counts.daily_event_counts_change(events, day),
            ),
        }

    def _retracting(self) -> dict[str, Callable]:
        """The changes of the user and video tables that take back what their pairs gave before, from the tables as they are now."""
        version = {n: max(self.table(n).versions(), default=None) for n in ("user_video_relation", "user_video_metrics")}

        def sides(last: datetime) -> tuple[DataFrame, DataFrame, DataFrame]:
            now = self.read("user_video_relation", dates=True)
            changed = since_watermark(self.read("user_video_relation", dates=True, since=last), metrics.WATCHED, last, None)
            return self.table("user_video_relation").read(version["user_video_relation"], dates=True), now, changed

        def users(last: datetime) -> Change:
            before, _, changed = sides(last)
            return retraction.user_video_metrics_change(retraction.pairs_before(before, changed), changed)

        def videos(last: datetime) -> Change:
            before, now, changed = sides(last)
            known = self.table("user_video_metrics").read(version["user_video_metrics"])
            rows = [retraction.rows_of_users(df, changed) for df in (before, now)]
            return retraction.video_statistics_change(rows[0], known, rows[1], self.read("user_video_metrics"))

        return {"user_video_metrics": users, "video_statistics": videos}

    def _uploads(self, inputs: Inputs, events: DataFrame, as_of: datetime) -> dict[str, str]:
        done = {
            "video_upload_stats": self._ingest_uploads(inputs.analytics),
            "ai_ugc": self._kept(
                "ai_ugc",
                lambda: uploads.ai_ugc(inputs.analytics, events),
                lambda _: uploads.ai_ugc_change(inputs.analytics, events, as_of),
                timed=False,
            ),
        }
        return done

    def _ingest_uploads(self, documents: DataFrame) -> str:
        """Take the documents received since the last run, by the position kept in the marker; no other one is parsed again.

        Documents of the very time of the position are read once more: some may have arrived after the last run.
        """
        table = self.table("video_upload_stats")
        position = table.commit_info().get("position")
        at = None if position is None else datetime.fromisoformat(position)
        new = documents if at is None else lookback(documents, RECEIVED, at, timedelta(0))
        reached = high_watermark(new, RECEIVED) or at  # before the documents are read: what arrives in between is read again
        info = {"position": None if reached is None else reached.isoformat(sep=" ")}
        if at is None:
            table.replace(uploads.video_upload_stats(new), info=info)
            return "created"
        with staged(since_watermark(uploads.video_upload_stats(new), "timestamp", table.newest()), "uploads") as batch:
            # later than all rows of the table, so the table holds none of them
            table.append(batch, info=info)
        return "merged"

    def _rankings(self, inputs: Inputs, as_of: datetime) -> dict[str, DataFrame]:
        pairs = self.read("user_video_relation", dates=True)
        out = {"global_popular_videos_l90d": popularity.popular_videos(pairs, as_of, 90)}
        if inputs.analytics is not None:
            ups = self.read("video_upload_stats").select("video_id", "region", "upload_type", "timestamp")
            out["region_popular_videos_l7d"] = popularity.region_popular_videos(pairs, ups, as_of, 7)
            if inputs.approvals is not None:
                bots = self.read("bot_uploaded_content")
                out["global_popular_videos_l7d"] = popularity.popular_videos_enriched(
                    pairs, inputs.nsfw_agg, ups, bots, inputs.approvals, as_of, 7
                )
        if inputs.shards is not None:
            known = self.read("user_base_facts")
            for days in (7, 90):
                out[f"local_popular_videos_l{days}d"] = popularity.local_popular_videos(pairs, known, as_of, days)
        return out

    def serving_copy(self, name: str) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root}/serving/{name}")

    def sync(self, inputs: Inputs, as_of: datetime) -> dict[str, int | None]:
        """Bring the serving copies up to date; returns the rows sent to each."""
        sent = {}
        for name, ts in SYNCED.items():
            if self.table(name).exists():
                copy, source = self.serving_copy(name), self.read(name)
                if copy.exists():
                    sent[name] = serving.sync_incremental(source, copy, ts, serving.OVERLAPS[name], as_of)
                else:
                    sent[name] = serving.append_batch(source, copy, as_of, ts)
        whole = {"ugc_content_approval": inputs.approvals, "video_nsfw_agg": inputs.nsfw_agg}
        for name in RELOADED:
            source = whole.get(name) if name in whole else (self.read(name) if self.table(name).exists() else None)
            if source is not None:
                sent[name] = serving.sync_full(source, self.serving_copy(name), as_of)
        return sent

    def view(self, name: str) -> DataFrame:
        """What readers of an incrementally synced copy see."""
        return serving.current_view(self.serving_copy(name).read(), TABLE_KEYS[name]).drop(serving.VERSION)
