"""Every operator and stage on odd rows: nulls, empty and long texts, repeats, no rows, clashing columns."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from feedwright.llm import (
    bytebpe,
    decontam,
    exact,
    langid,
    licenses,
    linkgraph,
    merkle,
    minmax,
    packing,
    pii,
    prefixes,
    quality,
    substring,
)
from feedwright.llm.queries import RANKS, tokenizer_path

LONG = " ".join(f"word{i % 5000} the" for i in range(30_000))
ROWS = [
    (1, None, "en"),
    (2, "", "en"),
    (3, "  \n\t ", None),
    (4, "x", "en"),
    (5, "The end of the long day and the night", "en"),
    (5, "The end of the long day and the night", "en"),
    (6, "the END of the long day and the night", None),
    (7, LONG, "en"),
    (8, "Der Anfang und das Ende der langen Nacht und des Tages", "de"),
    (None, "the end of the long day and the night", "en"),
    (None, None, None),
    (9, "123 456 !!! ???", "de"),
]
CLASH = "digest row id key text2 winner words spans label n hashes bands doc salt item marks".split()
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string, lang string")
    return df.select("*", F.lit("s").alias("source"), F.length("text").cast("bigint").alias("n_chars"), *[F.lit("c").alias(c) for c in CLASH])


@pytest.fixture(scope="module")
def bench(spark):
    rows = [(1, "of the long day and"), (None, "x"), (2, None), (3, "!!"), (1, "of the long day and")]
    return spark.createDataFrame(rows, "item_id bigint, text string").withColumn("doc_id", F.lit(0))


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(4, 1, 0), (5, 1, 0), (8, 0, 0), (8, 1, 0), (7, None, None), (None, 1, 0), (9, 0, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def operators(bench, labels):
    return {
        "langid": lambda d: langid.predict(d, langid.learn(d)),
        "pii": pii.report,
        "pii_spans": pii.personal_data,
        "packing": lambda d: packing.pack(d, tokenizer_path()),
        "packed_ids": lambda d: packing.packed_ids(d, tokenizer_path()),
        "decontam": lambda d: decontam.contamination(d, bench),
        "substring": substring.report,
        "exact": exact.judged,
        "minmax": minmax.near_components,
        "licenses": lambda d: licenses.scan(d, licenses.template_table(d.sparkSession)),
        "quality": lambda d: quality.score(d, quality.learn(d, labels)),
        "bytebpe": lambda d: bytebpe.digests(bytebpe.encoded(d, tokenizer_path(RANKS), r"\p{L}+|[^\p{L}]", with_bytes=True)),
        "merkle": lambda d: merkle.verified(merkle.document_manifest(d)),
    }


PER_ROW = "langid pii pii_spans decontam substring exact minmax quality bytebpe merkle".split()


@pytest.mark.parametrize("name", [*PER_ROW, "packing", "packed_ids", "licenses"])
def test_odd_rows_and_no_rows(name, odd, bench, labels):
    run = operators(bench, labels)[name]
    found = run(odd).collect()
    if name in PER_ROW:
        assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in ROWS)
    assert run(odd.limit(0)).collect() == []


def test_conversations_of_odd_rows(spark):
    rows = [(None, 1, "u", "lost"), (20, None, None, None), (20, 1, "u", ""), (21, None, None, None), (21, 1, "u", ""), (21, 1, "u", "")]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    for c in ("a", "b", "depth", "conv", "node", "part", "at", "digest"):
        table = table.withColumn(c, F.lit("clash"))
    found = {(r["conv_id"], r["depth"]): r["n_convs"] for r in prefixes.trie(table).collect()}
    assert found == {(20, 0): 2, (20, 1): 2, (20, 2): 2, (21, 3): 1}


def by_id(df, *columns):
    return {(r["doc_id"], *(r[c] for c in columns)) for r in df.collect()}


def test_defined_results(odd, bench, labels):
    ops = operators(bench, labels)
    lang = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in ops["langid"](odd).where("doc_id is not null").collect()}
    assert all(lang[i] == ("und", 0.0) for i in (1, 2, 3, 9)) and lang[8][0] == "de" and lang[7][0] == "en"
    judged = {(r["doc_id"], r["winner"], r["size"]) for r in ops["exact"](odd).collect()}
    assert {(5, 6, 4), (6, 6, 4), (None, 6, 4), (1, 2, 3), (2, 2, 3), (None, 2, 3)} <= judged
    near = by_id(ops["minmax"](odd), "n_shingles", "component_id")
    assert {(5, 5, 5), (6, 5, 5), (None, 5, None), (1, 0, 1), (2, 0, 2), (4, 1, 4), (None, 0, None)} <= near
    hits = by_id(ops["decontam"](odd), "n_words", "n_hit", "n_items")
    assert {(5, 9, 5, 1), (6, 9, 5, 1), (4, 1, 1, 0), (1, 0, 0, 0), (9, 2, 0, 0)} <= hits
    cut = by_id(ops["substring"](odd), "n_words", "n_removed", "kept_sha256")
    assert {(1, 0, 0, EMPTY_SHA), (3, 0, 0, EMPTY_SHA)} <= cut and sum(1 for r in cut if r[2]) == 0
    spans = by_id(ops["pii"](odd), "n_email", "spans")
    assert (1, 0, "") in spans


def test_null_and_empty_tables(spark, odd, bench, labels):
    assert decontam.contamination(odd, bench.limit(0)).where("contaminated").count() == 0
    assert licenses.scan(odd, licenses.template_table(spark, {"none": "!!"})).count() == 0
    scores = quality.score(odd, quality.learn(odd, labels.limit(0))).select("score").distinct().collect()
    assert [r["score"] for r in scores] == [0.5]
    assert {r["lang_pred"] for r in langid.predict(odd, langid.learn(odd.where("lang is null"))).collect()} == {"und"}
    pages = [(1, None, None), (2, "no scheme", ""), (3, "HTTP://Org/", "<a href='//B.example.org/x'>"), (3, "HTTP://Org/", None), (None, "a://", "x")]
    found = linkgraph.judge(spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("host", F.lit(1)))
    rows = {(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in found.collect()}
    assert rows == {(1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "org", "/", "org/", "allow"), (None, "", "", None, "allow")}
    assert found.count() == 5
    none = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert linkgraph.judge(none).count() == 0


def test_stages_keep_columns_and_rows(spark, odd, tmp_path):
    spark.createDataFrame([(1, "of the long day and")], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            rows = out.collect()
            ids = sorted(str(r["doc_id"]) for r in rows)
            if docs is not odd:
                assert rows == []
            elif name == "language_id":
                assert not {"1", "2", "3", "9"} & set(ids) and {"5", "6", "7", "8"} <= set(ids)
            elif name == "exact_dedup":
                assert ids == sorted(["2", "3", "4", "6", "7", "8", "9"])
            elif name == "near_dedup":
                assert ids == sorted(["1", "2", "3", "4", "5", "7", "8", "9", "None", "None"])
            else:
                left = {r["doc_id"]: r for r in rows}
                assert left[5]["text"] == "The end  the night" and left[5]["n_chars"] == 18 and left[7]["text"] == LONG
        out = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
        assert out.groupBy("doc_id").count().count() == (10 if docs is odd else 0)
