"""Nulls, empty and long texts, ties, repeated rows, empty tables and extra
columns with clashing names, for every query and every pipeline stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm.registry import QUERIES

from .conftest import edge_documents

PER_DOCUMENT = ["op3_pii", "op5_pieces", "op6_licences", "op7_quality", "op8_mixing", "op9_near_dup", "op10_simhash", "op12_secrets"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).count() == 0


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_every_row_is_returned(spark, edge_dir, name):
    got = sorted(str(r["doc_id"]) for r in QUERIES[name](spark, edge_dir).collect())
    assert got == sorted(str(d[0]) for d in edge_documents())


def test_personal_data(spark, edge_dir):
    rows = {r["doc_id"]: r for r in QUERIES["op3_pii"](spark, edge_dir).collect() if r["doc_id"] is not None}
    r = rows[100]
    assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == (1, 1, 1, 1)
    assert [x.split(":")[0] for x in r["spans"].split(",")] == ["email", "card", "phone", "ip", "iban", "ssn"]
    assert rows[1]["spans"] == "" and rows[200]["spans"] == ""


def test_licences(spark, edge_dir):
    rows = {r["doc_id"]: r for r in QUERIES["op6_licences"](spark, edge_dir).collect() if r["doc_id"] is not None}
    r = rows[101]
    assert r["base_labels"] == "cc-by,gpl,reserved" and r["n_base"] == 3 and r["first_word"] == 2
    assert set(r["labels"].split(",")) >= {"cc-by-nc-4.0", "gpl-3.0"}
    assert rows[1]["n_words"] == 0 and rows[3]["n_words"] == 0 and rows[4]["n_words"] == 1 and rows[1]["first_word"] is None


def test_near_duplicates(spark, edge_dir):
    rows = [(r["doc_id"], r["class_id"], r["class_size"]) for r in QUERIES["op9_near_dup"](spark, edge_dir).collect()]
    assert rows.count((6, 5, 3)) == 2 and (5, 5, 3) in rows  # copies, one of them a repeated row
    assert (10, 9, 2) in rows and (4, 4, 1) in rows
    assert (2, 1, 4) in rows and (None, 1, 4) in rows  # blank texts are copies


def test_passages(spark, edge_dir):
    rows = QUERIES["op1_passages"](spark, edge_dir).collect()
    got = {(r["doc_id"], r["start_word"], r["end_word"], r["class_doc_id"]) for r in rows}
    assert {(11, 30, 100, 11), (12, 40, 110, 11), (5, 0, 30_000, 5), (6, 0, 30_000, 5)} <= got
    assert {r["doc_id"] for r in rows} == {5, 6, 9, 10, 11, 12}


def test_mixing_takes_no_document_too_often(spark, edge_dir):
    rows = QUERIES["op8_mixing"](spark, edge_dir).collect()
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)


def test_encoding_round_trips(spark, edge_dir):
    assert all(r["round_trip"] for r in QUERIES["op5_pieces"](spark, edge_dir).collect())


def test_language_of_pages(spark, edge_dir):
    rows = QUERIES["op2_language"](spark, edge_dir).collect()
    pages = [r for r in rows if r["doc_id"] is None and r["host"] is not None and not r["host"].startswith("source:")]
    assert sorted((r["page_id"], r["declared"], r["host"]) for r in pages) == [
        (2, "fr", "a.example.fr"), (2, "fr", "a.example.fr"), (3, None, "b.example.de")] or len(pages) == 3
    assert len(rows) == 5 + len(edge_documents())


def test_topk_ties_and_invalid_vectors(spark, edge_dir):
    rows = [tuple(r) for r in QUERIES["op4_topk"](spark, edge_dir).select("query_id", "rank", "vec_id").collect()]
    assert {q for q, _, _ in rows} == {0, 100, 300}
    assert not {v for _, _, v in rows} & {3, 4, 5, 6}
    assert [v for _, _, v in sorted(r for r in rows if r[0] == 100)][:2] == [0, 1]
    assert sorted(v for q, _, v in rows if q == 300) == [0, 1, 2, 7, 8, 100]  # all, if fewer than k


@pytest.mark.parametrize("which", ["edge_dir", "empty_dir"])
def test_pipeline_stages(spark, which, request, tmp_path):
    sf = request.getfixturevalue(which)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if i + 1 < len(corpus_pipeline.STAGES):
            assert docs.columns == columns
    assert docs.count() == 0 if which == "empty_dir" else docs.count() > 0


def test_near_duplicate_stage_keeps_one_of_each(spark, edge_dir):
    from tessera.llm.near_dup import drop_near_duplicates
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    kept = [r["doc_id"] for r in drop_near_duplicates(docs).collect()]
    assert kept.count(5) == 1 and 6 not in kept and 10 not in kept and kept.count(12) == 2
    repeated = docs.filter("doc_id = 6")  # the row to keep is itself repeated
    assert drop_near_duplicates(repeated).count() == 1


def test_mix_shares_copies_among_repeated_rows(spark):
    from tessera.llm.mixing import apply_mix
    rows = [(1, "a b c", "x", "en"), (1, "a b c", "x", "en"), (2, "a", "y", "en"), (3, "b " * 40, "z", "en")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, t string")
    got = [r["doc_id"] for r in apply_mix(docs).collect()]
    from tessera.llm.mixing import mixed
    want = {}
    for r in mixed(docs).collect():
        want[r["doc_id"]] = want.get(r["doc_id"], 0) + r["copies"]
    assert {i: got.count(i) for i in want} == want


CLASHES = ["__d", "__id", "__digest", "__rn", "own_digest", "kept_id", "__k", "__n", "__t", "__c", "k", "n", "t", "times", "c0", "content_score", "score",
           "__score", "__q_text", "__a_digits", "__pii_spans", "a.b", "digest", "root", "hub"]


def test_stages_leave_columns_of_any_name_alone(spark, edge_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    extra = docs.select("*", *[F.lit(7).alias(c) for c in CLASHES])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, extra, edge_dir)
        assert rows.columns == extra.columns, name
        plain = sorted(str(tuple(r)[:5]) for r in rows.collect())
        assert plain == sorted(str(tuple(r)) for r in stage(spark, docs, edge_dir).collect()), name
        assert all(tuple(r)[5:] == (7,) * len(CLASHES) for r in rows.collect()), name
