"""Bucketed tables: plans without a shuffle, equal results, and files that another session can take up."""

import random

import pytest
from pyspark.sql import functions as F

from reelstat.plans import metrics
from reelstat.sources.bucketed import BucketedTable
from tests.conftest import at, rows

PAIRS = "user_id string, video_id string, liked boolean, shared boolean, mean_percentage_watched double, last_watched_timestamp timestamp_ntz"


def pairs(spark):
    rng = random.Random(3)
    seen = {(f"u{rng.randrange(60)}", f"v{rng.randrange(40)}") for _ in range(900)}
    data = [(u, v, rng.random() < 0.5, rng.random() < 0.2, rng.randrange(101) / 100, at("02 10:00")) for u, v in sorted(seen)]
    return spark.createDataFrame([*data, (None, "v1", True, False, 0.5, at("02 10:00"))], PAIRS)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange" in line]


@pytest.fixture
def stored(spark, tmp_path):
    relation = BucketedTable(spark, str(tmp_path / "relation"), ["user_id"], 4).write(pairs(spark))
    users = BucketedTable(spark, str(tmp_path / "users"), ["user_id"], 4).write(metrics.user_video_metrics(relation.read()))
    yield relation, users
    relation.drop()
    users.drop()


def test_grouping_and_join_by_the_key_plan_no_exchange(stored):
    relation, users = (t.read() for t in stored)
    assert not exchanges(metrics.user_video_metrics(relation))
    assert not exchanges(relation.join(users.hint("merge"), "user_id", "left"))
    (only,) = exchanges(metrics.video_statistics(relation, users, colocated=True))
    assert "video_id" in only  # the grouping by video, combined before it


def test_a_batch_is_shuffled_to_the_buckets_not_the_table(spark, stored):
    users = stored[1].read()
    batch = spark.createDataFrame([("u1", 1), ("u2", 2)], "user_id string, v int").hint("merge")
    found = exchanges(users.join(batch, "user_id", "left"))
    assert len(found) == 1 and "hashpartitioning(user_id" in found[0] and ", 4)" in found[0]


def test_results_equal_those_of_plain_tables(spark, stored):
    relation, users = (t.read() for t in stored)
    plain = pairs(spark)
    assert rows(relation, "user_id", "video_id") == rows(plain, "user_id", "video_id")
    expected = metrics.video_statistics(plain, metrics.user_video_metrics(plain))
    got = metrics.video_statistics(relation, users, colocated=True)
    digits = lambda df: rows(df.select(*[F.round(c, 9).alias(c) if t == "double" else c for c, t in df.dtypes]), "video_id")
    assert digits(got) == digits(expected)


def test_a_bucket_is_one_file_and_can_be_registered_again(spark, stored, tmp_path):
    assert len(list((tmp_path / "relation").glob("part-*"))) <= 4
    again = BucketedTable(spark, str(tmp_path / "relation"), ["user_id"], 4)
    with pytest.raises(FileNotFoundError):
        again.read()
    again.register(PAIRS)
    assert rows(again.read(), "user_id", "video_id") == rows(pairs(spark), "user_id", "video_id")
    assert not exchanges(again.read().groupBy("user_id").count())
    again.drop()
    assert (tmp_path / "relation").exists()
