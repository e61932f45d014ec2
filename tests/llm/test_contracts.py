"""Every registered query of the subpackage on the smallest tables: the columns of its contract, a row for each thing, and what can be said of every row."""

import os
import re
import struct
import zlib

import pytest

import __spark_entry__ as entry_point

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")

COLUMNS = {
    "op1_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op5_best_fit_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op6_ngram_jaccard_join": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op7_warc": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op9_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op10_lm_scoring": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op11_vector_codes": "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string",
    "op12_merkle_manifest": "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    "op13_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
}


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def found(spark, name):
    df = entry_point.queries()[name](spark, SF)
    kinds = dict(df.dtypes)
    for column, kind in (c.split(" ") for c in COLUMNS[name].split(", ")):
        assert kinds[column] == kind, (name, column)
    return df.collect()


def one_each(rows, documents):
    assert sorted(r.doc_id for r in rows) == sorted(documents)


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def test_quality_rules(spark, documents):
    rows = found(spark, "op1_quality_rules")
    one_each(rows, documents)
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", documents[r.doc_id].text or "")
        assert r.n_words == len(words) and r.word_chars == sum(map(len, words))
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id: r.kept for r in rows}
    good, bad = ([kept[i] for i, q in quality.items() if q == want and i in kept] for want in (1, 0))
    assert sum(good) >= 0.9 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_packing(spark, documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    rows = found(spark, "op5_best_fit_packing")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = set()
    for i, d in documents.items():
        ids = [*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            own = ids[k : k + 2048]
            want.add((i, k // 2048, k, len(own), zlib.crc32(struct.pack(f"<{len(own)}I", *own))))
    assert {(r.doc_id, r.piece, r.start, r["length"], r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r["length"]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= 1.02 * sum(r["length"] for r in rows) / 2048 + 1


def test_similarity_join(spark, documents):
    rows = found(spark, "op6_ngram_jaccard_join")
    one_each(rows, documents)
    assert all(r.component_id <= r.doc_id for r in rows) and any(r.component_id < r.doc_id for r in rows)


def test_archives(spark):
    rows = found(spark, "op7_warc")
    assert sorted(r.page_id for r in rows) == sorted(r.page_id for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id").collect())
    assert all((r.record_type == "revisit") == (r.refers_to is not None) for r in rows)


def test_languages(spark, documents):
    rows = found(spark, "op9_language_id")
    one_each(rows, documents)
    known = {d.lang for d in documents.values()} - {None}
    for r in rows:
        text = documents[r.doc_id].text
        assert r.held_out == (crc(r.doc_id) % 3 == 1) and 0 <= r.score <= 1
        assert r.lang_pred in known | {"und"}
        if not any(c.isalpha() for c in text or ""):
            assert r.lang_pred == "und"
    judged = [r.lang_pred == documents[r.doc_id].lang for r in rows if r.held_out and documents[r.doc_id].lang and r.lang_pred != "und"]
    assert sum(judged) >= 0.95 * len(judged) > 0


def test_language_model(spark, documents):
    rows = found(spark, "op10_lm_scoring")
    one_each(rows, documents)
    assert all(r.held_out == (crc(r.doc_id) % 7 == 2) and r.score < 0 and r.n_known <= r.n_tokens for r in rows)
    assert len({r.train_tokens for r in rows}) == 1


@pytest.mark.parametrize("name", ["op11_vector_codes", "op12_merkle_manifest", "op13_sharding"])
def test_columns_and_rows(spark, documents, name):
    rows = found(spark, name)
    if name == "op11_vector_codes":
        assert len(rows) == spark.read.parquet(f"{SF}/embeddings.parquet").count() and all(re.fullmatch("[0-9a-f]{8}", r.code) for r in rows)
    else:
        one_each(rows, documents)
