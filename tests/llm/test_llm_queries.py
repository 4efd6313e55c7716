"""The registered queries on the smallest tables: against DuckDB where SQL can
express them, else against their brute-force versions; and the pipeline."""

import hashlib
from array import array

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from lakemart.llm.common import staged
from tests.llm.test_alignment import brute as brute_alignment
from tests.llm.test_mixing import check as check_mix
from tests.llm.test_near import want_documents, want_lines
from tests.llm.test_repeats import brute as brute_repeats
from tests.llm.test_whitening import check as check_whitening
from tests.llm.test_whitening import integers

SF_DIR = "/root/testdata/sf0.001"
QUERIES = contract.queries()


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def test_names():
    assert [n for n in QUERIES if n.startswith("op")] == [
        "op1_token_counts", "op2_repeats", "op3_vector_topk", "op4_trie_bpe", "op5_html_text", "op6_mixing",
        "op7_near_dedup", "op8_quality", "op9_exact_dedup", "op10_line_dedup",
        "op11_substring_dedup", "op12_alignment", "op13_whitening"]
    assert "pipeline" in QUERIES


@pytest.mark.parametrize("name", ["op3_vector_topk", "op6_mixing", "op9_exact_dedup", "op11_substring_dedup"])
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    df = QUERIES[name](spark, SF_DIR)
    rel = con.sql(contract.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert sorted(map(str, (tuple(r) for r in df.select(*rel.columns).collect()))) == sorted(map(str, rel.fetchall()))


def test_token_queries(spark, documents):
    byte = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    for r in QUERIES["op1_token_counts"](spark, SF_DIR).collect():
        n = len(byte.encode(documents[r["doc_id"]], add_special_tokens=False))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(documents[r["doc_id"]].encode()), n, n > 1024)
    word = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    for r in QUERIES["op4_trie_bpe"](spark, SF_DIR).collect():
        ids = word.encode(documents[r["doc_id"]], add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(),
            hashlib.sha256(word.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_repeats_query(spark, documents):
    want = brute_repeats(list(documents.items()))
    for r in QUERIES["op2_repeats"](spark, SF_DIR).collect():
        spans, kept = want[r["doc_id"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (
            len(documents[r["doc_id"]].encode()), sum(b - a for a, b in spans), len(spans),
            hashlib.sha256(kept).hexdigest())


def test_near_and_line_queries(spark, documents):
    rows = list(documents.items())
    want = want_documents(rows)
    for r in QUERIES["op7_near_dedup"](spark, SF_DIR).collect():
        assert (r["class_id"], r["class_size"]) == want[r["doc_id"], documents[r["doc_id"]]]
    gone = want_lines(rows)
    for r in QUERIES["op10_line_dedup"](spark, SF_DIR).collect():
        assert r["removed"] == gone[r["doc_id"]]


def test_alignment_query(spark, documents):
    want = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "")
            for r in brute_alignment(list(documents.items()))]
    df = QUERIES["op12_alignment"](spark, SF_DIR)
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, df.collect())) == sorted(want)


def test_whitening_query(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    df = QUERIES["op13_whitening"](spark, SF_DIR)
    assert dict(df.dtypes)["deviation"] == "bigint"
    check_whitening(df.collect(), {r["vec_id"]: integers(r["embedding"]) for r in rows})


def test_quality_query(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    rows = [r for r in QUERIES["op8_quality"](spark, "/root/testdata/sf0.1").collect() if r["doc_id"] in labels]
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows)
    out = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in out) / len(out) > 0.97
    good = [r for r in out if labels[r["doc_id"]] == 1]
    assert sum(r["predicted"] for r in good) / len(good) > 0.98


def test_pipeline_stages(spark):
    """Each stage on what the one before kept, against its brute-force version."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        seen[name] = before, docs = docs, staged(stage(spark, docs, SF_DIR), "stage")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    texts = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}
    before, after = map(texts, seen["quality classifier"])
    assert after.items() <= before.items() and 0.75 < len(after) / len(before) < 1
    before, after = map(texts, seen["line dedup"])
    gone = want_lines(list(before.items()))
    assert after == {i: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i])
                     for i, t in before.items()}
    before, after = map(texts, seen["near-duplicates"])
    want = want_documents(list(before.items()))
    assert after == {i: t for i, t in before.items() if want[i, t][0] == i}
    before, after = seen["source mixing"]
    copies = {r["row"]["doc_id"]: r["copies"] for r in check_mix(before)}
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(i for i, n in copies.items() for _ in range(n))
    before, after = seen["BPE encoding"]
    word = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    own = texts(before)
    for r in after.collect():
        assert list(array("I", r["token_ids"])) == word.encode(own[r["doc_id"]], add_special_tokens=False).ids


def test_run_applies_the_stages_in_order(spark, monkeypatch):
    def stage(n):
        return lambda spark, docs, sf_dir: docs.withColumn(f"s{n}", F.lit(len(docs.columns)))

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(f"stage {n}", stage(n)) for n in range(3)])
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.columns[-3:] == ["s0", "s1", "s2"]
    assert out.first()["s2"] == len(out.columns) - 1
    assert out.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
