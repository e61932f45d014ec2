"""Packing, archives, and the pipeline."""

import hashlib
import random
import re
import struct
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reelstat.llm.packing import pack, plan_bins, token_pieces
from reelstat.llm.warc import archived, page_records, register

from .conftest import text_of

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def pieces_of(texts, capacity):
    from tokenizers import Tokenizer

    tokenizer, out = Tokenizer.from_file(PATH), []
    for i, t in texts:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), capacity):
            own = ids[k : k + capacity]
            out.append((i, k // capacity, k, len(own), zlib.crc32(struct.pack(f"<{len(own)}I", *own))))
    return out


def test_pieces_and_sequences(spark, awkward, texts, tmp_path):
    odd = [(700, "<|endoftext|> a<|startoftext|>b"), (701, "Été×, don't 'S x\x01y \x01 İ. KK ß,"), (702, "a" * 3000)]
    docs = awkward.select("doc_id", "text", "rank", "length").unionByName(spark.createDataFrame(odd, "doc_id long, text string"), True)
    token_pieces(docs, PATH, 256).write.parquet(str(tmp_path / "pieces"))
    pieces = spark.read.parquet(str(tmp_path / "pieces"))
    placed = pack(pieces, 256).withColumn("crc", F.crc32("ids")).collect()
    key = lambda r: (r[0] is None, r)
    found = sorted(((r.doc_id, r.piece, r.start, r.length, r.crc) for r in placed), key=key)
    assert found == sorted(pieces_of([*texts, *odd], 256), key=key)
    end: dict[int, int] = {}
    for r in sorted(placed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == end.get(r.sequence_id, 0)
        end[r.sequence_id] = r.offset + r.length
    total = sum(end.values())
    assert max(end.values()) <= 256 and len(end) <= 1.05 * -(-total // 256)


def fill(plan):
    bins: dict[int, list[int]] = {}
    for length, low, high, first, per, at in plan:
        for r in range(low, high):
            own = bins.setdefault(first + (r - low) // per, [])
            assert sum(own) == at + (r - low) % per * length
            own.append(length)
    return bins


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize(("documents", "attention"), [(None, None), (5, None), (None, 3000), (4, 2600)])
def test_plans_keep_every_capacity(rule, documents, attention):
    rng = random.Random(1)
    histogram = {n: rng.randint(1, 400) for n in rng.sample(range(1, 51), 30)}
    bins = fill(plan_bins(histogram, 100, documents, attention, (1.0, 0.5, 0.5), rule))
    assert sum(map(len, bins.values())) == sum(histogram.values()) and sorted(bins) == list(range(len(bins)))
    for own in bins.values():
        assert sum(own) <= 100 and len(own) <= (documents or 100) and sum(n * n for n in own) <= (attention or 10**4)
    if not documents and not attention and rule == "norm":
        assert len(bins) <= 1.02 * sum(n * c for n, c in histogram.items()) / 100 + 1


def test_all_sizes_weigh_in_the_choice_of_a_bin():
    rng = random.Random(3)
    histogram = {n: rng.randint(1, 40) for n in range(2, 101)}
    plans = [plan_bins(histogram, 100), plan_bins(histogram, 100, weights=(1.0, 0.0, 0.0)), plan_bins(histogram, 100, 4), plan_bins(histogram, 100, rule="dot")]
    assert all(a != b for k, a in enumerate(plans) for b in plans[:k])
    assert len(fill(plans[0])) <= 1.01 * len(fill(plans[1])) + 1


def test_plans_of_few_lengths():
    assert plan_bins({}) == [] and len(fill(plan_bins({2048: 3}))) == 3 and len(fill(plan_bins({1024: 5}))) == 3
    assert len(plan_bins({1: 10**12})) <= 2
    with pytest.raises(ValueError):
        plan_bins({30: 1}, 100, attention=500)


def pages_table(spark):
    rng = random.Random(7)
    same, small = text_of(rng, 30), "x" * 999
    rows = [(i, f"http://a/{i}", text_of(rng, rng.randint(1, 40))) for i in range(20)]
    rows += [(50, "http://b", same), (51, "http://c\r\nX: y", same), (49, None, same), (60, "u", small), (61, "u", small)]
    rows += [(70, "u", None), (71, "u", ""), (72, "u", "é\r\n\r\nWARC/1.1\r\n" * 100), (51, "again", same), (None, "u", same), (None, "u", "alone")]
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string"), rows


def expected_pages(rows):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        ids = [j for j, _, h in rows if (h or "").encode() == data and j is not None]
        again = len(data) >= 1000 and ids and i != max(ids)
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", max(ids) if again else None))
    return sorted(out, key=str)


def test_archives_round_trip(spark, tmp_path):
    pages, rows = pages_table(spark)
    found = archived(pages.repartition(3), path=str(tmp_path / "a")).collect()
    assert sorted((tuple(r) for r in found), key=str) == expected_pages(rows)
    assert archived(pages.where("false"), path=str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_predicates_and_columns(spark, tmp_path, compression):
    register(spark)
    pages, _ = pages_table(spark)
    path = str(tmp_path / "b")
    page_records(pages).write.format("warc").option("compression", compression).mode("append").save(path)
    everything = spark.read.format("warc").load(path)
    rows = everything.collect()
    assert len(rows) == pages.count()
    one = everything.where("target_uri = 'http://a/3' and warc_type in ('response', 'other') and record_id like '<urn%' and payload_bytes > 0")
    assert [r.payload for r in one.collect()] == [r.payload for r in rows if r.target_uri == "http://a/3"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    left = [x for x in plan.split("\n") if re.search(r"\bFilter \(", x)]
    assert len(left) == 1 and "payload_bytes" in left[0] and "target_uri" not in left[0] and "StartsWith" not in left[0]
    headers = spark.read.format("warc").schema("refers_to string, file string").load(path).where("refers_to is not null")
    assert {r.refers_to for r in headers.collect()} == {"<urn:x-page:51>"}
    page_records(pages.limit(2)).write.format("warc").option("compression", compression).mode("append").save(path)
    assert spark.read.format("warc").load(path).count() == len(rows) + 2


def test_archives_of_other_writers(spark, tmp_path):
    """Members without lengths, record types without HTTP, and a file that no manifest names."""
    import gzip

    register(spark)
    head = "WARC/1.0\r\nWARC-Type: {}\r\nWARC-Record-ID: <urn:{}>\r\nContent-Length: {}\r\n\r\n{}\r\n\r\n"
    records = [head.format("warcinfo", 1, 5, "a\r\nbc"), head.format("resource", 2, 70000, "z" * 70000), head.format("resource", 3, 0, "")]
    (tmp_path / "x.warc.gz").write_bytes(b"".join(gzip.compress(r.encode()) for r in records))
    (tmp_path / "y.warc").write_bytes("".join(records).encode())
    found = spark.read.format("warc").load(str(tmp_path)).where("warc_type = 'resource'").collect()
    assert sorted((r.record_id, r.payload_bytes, len(r.payload)) for r in found) == [("<urn:2>", 70000, 70000)] * 2 + [("<urn:3>", 0, 0)] * 2


def test_pipeline(spark, tmp_path, awkward):
    rng = random.Random(11)
    bench = [(i, text_of(rng, 2, 16)) for i in range(4)]
    clean = [(1000 + i, text_of(rng, 8)) for i in range(60)]
    rude = [(2000 + i, text_of(rng, 6) + " nitwit blockhead") for i in range(30)]
    near = [(3000 + i, " ".join("new" if k % 80 == i + 5 else w for k, w in enumerate(clean[0][1].replace("\n", " ").split()))) for i in range(3)]
    leak = [(4000, clean[1][1] + "\n" + bench[0][1])]
    rows = [(i, t, "en", "s", len(t)) for i, t in [*clean, *rude, *near, *leak]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").unionByName(awkward.drop("n"), True)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    labels = [(i, 1, 0) for i, *_ in clean] + [(i, 1, 1) for i, *_ in rude[:20]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "best_fit_packing"]
    now, left = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        before = now.columns
        stage(spark, now, str(tmp_path)).write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        left[name] = {r.doc_id for r in now.collect()}
        assert name == names[-1] or now.columns == before
    ids = lambda x: {i for i, *_ in x}
    assert not left["toxicity"] & ids(rude) and ids(clean) <= left["toxicity"]
    assert ids(clean) <= left["line_dedup"] and 109 not in left["line_dedup"]  # an exact copy has no line of its own
    assert ids(clean) <= left["ngram_jaccard_join"] and not left["ngram_jaccard_join"] & ids(near)
    assert ids(clean) <= left["benchmark_decontamination"] and 4000 not in left["benchmark_decontamination"]
    assert left["best_fit_packing"] == left["benchmark_decontamination"]
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == left["best_fit_packing"]
