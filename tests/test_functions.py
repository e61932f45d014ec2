import math
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from reelstat.functions import arrays, jsonx, numeric, timex
from tests.conftest import rows


def one(spark, expr, schema="i int", row=(1,)):
    return spark.createDataFrame([row], schema).select(expr.alias("v")).first()["v"]


DOC = '{"a": {"$id": "x", "n": 1.50, "t": true, "o": {"k": 1}, "l": [1, {"z": 2}], "s": "{not json", "q": "[1]", "u": null}}'


@pytest.mark.parametrize(
    "path, want",
    [
        ("$.a['$id']", "x"),
        ("$.a.t", "true"),
        ("$.a.o", None),
        ("$.a.l", None),
        ("$.a.s", "{not json"),
        ("$.a.q", "[1]"),
        ("$.a.u", None),
        ("$.a.missing", None),
        ("$.missing.b", None),
    ],
)
def test_scalars_are_text_and_containers_are_null(spark, path, want):
    df = spark.createDataFrame([(DOC,)], "doc string")
    assert jsonx.extract_json(df, "doc", {"v": path}).first()["v"] == want
    assert df.select(jsonx.json_scalar(F.col("doc"), path)).first()[0] == want


def test_numbers_read_as_numbers(spark):
    df = spark.createDataFrame([(DOC,)], "doc string")
    assert float(jsonx.extract_json(df, "doc", {"v": "$.a.n"}).first()["v"]) == 1.5


@pytest.mark.parametrize("doc", [None, "", "not json", "[1, 2]", "3", '{"a": "text"}'])
def test_unreadable_documents_give_null(spark, doc):
    df = spark.createDataFrame([(doc,)], "doc string")
    out = rows(jsonx.extract_json(df, "doc", {"v": "$.a.b", "w": "$.c"}, "doc"))
    assert out == [{"v": None, "w": None, "doc": doc}]


def test_bad_paths_are_refused():
    for path in ("a.b", "$", "$.a[0]", "$.a..b"):
        with pytest.raises(ValueError):
            jsonx.path_steps(path)


def test_explode_keeps_documents_without_rows(spark):
    docs = ['{"r": [{"x": 1}, {"x": {"y": 2}}]}', '{"r": []}', "{}", '{"r": "text"}', None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, doc string")
    out = jsonx.explode_json_outer(df, "doc", "$.r", "row")
    assert [(r["i"], r["row"]) for r in rows(out, "i", "row")] == [
        (0, '{"x":1}'),
        (0, '{"x":{"y":2}}'),
        (1, None),
        (2, None),
        (3, None),
        (4, None),
    ]


def test_least_or_null_and_floor(spark):
    schema = "a double, b double"
    assert one(spark, numeric.least_or_null(F.col("a"), F.col("b")), schema, (1.0, None)) is None
    assert one(spark, numeric.least_or_null(F.col("a"), F.col("b")), schema, (1.0, -2.0)) == -2.0
    assert one(spark, numeric.floor_at(F.col("a"), 0.01), schema, (None, 1.0)) is None
    assert one(spark, numeric.floor_at(F.col("a"), 0.01), schema, (0.001, 1.0)) == 0.01


def test_standardise_guards(spark):
    x, m, s = (F.col(c) for c in ("x", "m", "s"))

    def z(guard, sd):
        return one(spark, numeric.standardise(x, m, s, guard), "x double, m double, s double", (3.0, 1.0, sd))

    assert z("none", 2.0) == z("zero", 2.0) == z("flat", 2.0) == 1.0
    assert z("none", None) is None
    assert z("zero", 0.0) == z("zero", None) == 0.0
    assert z("flat", 0.0) == z("flat", None) == 0.02
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        z("none", 0.0)
    with pytest.raises(ValueError):
        z("other", 1.0)


def test_popularity_score_depends_on_the_gap_only(spark):
    pairs = [(a / 7, b / 3) for a in range(-9, 10, 3) for b in range(-9, 10, 3)]
    df = spark.createDataFrame(pairs, "a double, b double")
    for r in df.select("a", "b", numeric.popularity_score(F.col("a"), F.col("b")).alias("v")).collect():
        low, high = 1 + 1e-9, 1 + abs(r["a"] - r["b"]) + 1e-9
        assert math.isclose(r["v"], 2 / (1 / low + 1 / high), rel_tol=1e-12)
        assert 1 <= r["v"] < 2 + 1e-8


def test_pooled_moments_equal_the_whole(spark):
    values = [0.3, 1.7, 2.2, 9.1, 4.4, 4.5, 0.2]
    df = spark.createDataFrame([(v, i < 3) for i, v in enumerate(values)], "v double, first boolean")
    whole = df.agg(F.avg("v").alias("m"), F.stddev_samp("v").alias("s")).first()
    parts = df.groupBy().agg(
        *[
            f(F.when(F.col("first") == side, F.col("v"))).alias(f"{name}{i}")
            for i, side in ((1, True), (2, False))
            for name, f in (("m", F.avg), ("s", F.stddev_samp), ("n", F.count))
        ]
    )
    c = {k: F.col(k) for k in parts.columns}
    got = parts.select(
        numeric.pooled_mean(c["m1"], c["n1"], c["m2"], c["n2"]).alias("m"),
        numeric.pooled_stddev(c["m1"], c["s1"], c["n1"], c["m2"], c["s2"], c["n2"]).alias("s"),
    ).first()
    assert math.isclose(got["m"], whole["m"]) and math.isclose(got["s"], whole["s"])


def test_pooled_stddev_of_huge_counts_does_not_overflow(spark):
    row = (0.5, 0.1, 10**11, 0.5, 0.1, 10**11)
    c = [F.col(x) for x in "abcdef"]
    value = one(spark, numeric.pooled_stddev(*c), "a double, b double, c bigint, d double, e double, f bigint", row)
    assert math.isclose(value, 0.1, rel_tol=1e-9)


META = [("post_id", "1"), ("timestamp", "9")]
META_SCHEMA = "m array<struct<name:string,value:string>>, o array<struct<name:string,value:string>>"


def test_struct_array_map(spark):
    m, o = F.col("m"), F.col("o")
    row = (META, [("publisher_user_id", "a"), ("publisher_user_id", "b")])
    assert one(spark, arrays.struct_array_get(m, "post_id"), META_SCHEMA, row) == "1"
    assert one(spark, arrays.struct_array_get(m, "none"), META_SCHEMA, row) is None
    assert one(spark, arrays.struct_array_has(m, "timestamp"), META_SCHEMA, (None, None)) is False
    put = one(spark, arrays.struct_array_put(m, o, "publisher_user_id"), META_SCHEMA, row)
    assert [(x.name, x.value) for x in put] == [*META, ("publisher_user_id", "a")]
    replaced = one(spark, arrays.struct_array_put(o, m, "publisher_user_id"), META_SCHEMA, row)
    assert replaced == []
    with pytest.raises(Exception, match="more than one entry"):
        one(spark, arrays.struct_array_get(o, "publisher_user_id"), META_SCHEMA, row)


def test_vector_length(spark):
    assert one(spark, arrays.vector_has_dim(F.col("v"), 2), "v array<double>", ([1.0, 2.0],)) is True
    assert one(spark, arrays.vector_has_dim(F.col("v"), 2), "v array<double>", (None,)) is None


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_time_bounds_follow_the_column_type(spark, kind):
    start = datetime(2024, 1, 10)
    data = [(i, str(start + timedelta(hours=i))) for i in range(60)]
    df = spark.createDataFrame(data, "i int, t string").select("i", F.col("t").cast(kind).alias("t"))
    assert timex.high_watermark(df, "t") == start + timedelta(hours=59)
    assert timex.high_watermark(df.where("i < 0"), "t") is None
    assert timex.lookback(df, "t", start + timedelta(hours=59), timedelta(hours=9)).count() == 10  # bound included
    assert timex.on_day(df, "t", date(2024, 1, 11)).count() == 24
    assert timex.since_watermark(df, "t", start + timedelta(hours=50)).count() == 9  # strictly later
    assert timex.since_watermark(df, "t", None).count() == 60
    assert timex.since_watermark(df, "t", None, default=None).count() == 0


def test_timestamp_and_date_parsing(spark):
    parsed = one(spark, F.unix_micros(timex.parse_offset_timestamp(F.col("s"))), "s string", ("2024-01-02T03:04:05.678901+05:30",))
    assert parsed == 1704144845678901
    assert one(spark, timex.parse_offset_timestamp(F.col("s")), "s string", ("soon",)) is None
    assert one(spark, timex.parse_compact_date(F.col("i")), "i int", (20240229,)) == date(2024, 2, 29)
