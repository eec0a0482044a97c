"""One registered query per operator, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

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
from feedwright.llm.common import table, text_crc

REGISTERED: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TOKENIZER = "word_bpe_49k.json"
RANKS = "byte_bpe_multi_50k.tiktoken"


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTERED[fn.__name__] = fn
    return fn


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query
def op1_language_filters(spark, sf):
    docs = table(spark, sf, "documents")
    return langid.predict(docs, langid.learn(docs))


@query
def op2_personal_data(spark, sf):
    return pii.report(table(spark, sf, "documents"))


@query
def op3_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"), tokenizer_path())


@query
def op4_decontamination(spark, sf):
    return decontam.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op5_substring_dedup(spark, sf):
    return substring.report(table(spark, sf, "documents"))


@query
def op6_link_graph(spark, sf):
    return linkgraph.judge(table(spark, sf, "pages"))


@query
def op7_exact_dedup(spark, sf):
    judged = exact.judged(table(spark, sf, "documents"))
    return judged.select(
        "doc_id",
        F.col("winner").alias("keep_id"),
        F.col("size").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("winner")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


@query
def op8_minmax_near_dedup(spark, sf):
    found = minmax.near_components(table(spark, sf, "documents"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


@query
def op9_license_scan(spark, sf):
    return licenses.scan(table(spark, sf, "documents"), licenses.template_table(spark))


@query
def op10_quality(spark, sf):
    docs = table(spark, sf, "documents")
    return quality.score(docs, quality.learn(docs, table(spark, sf, "labels")))


@query
def op11_byte_bpe(spark, sf):
    import public_tokenizers

    model = tokenizer_path(RANKS), public_tokenizers.PATTERN
    return bytebpe.digests(bytebpe.encoded(table(spark, sf, "documents"), *model, with_bytes=True))


@query
def op12_merkle_manifest(spark, sf):
    # A tampered row claims one more character than the manifest was built from.
    more = F.col("n_chars").cast("bigint") + F.when(text_crc() % 7 == 0, 1).otherwise(0)
    made = merkle.document_manifest(table(spark, sf, "documents"), merkle.document_leaf({"n_chars": more}))
    checked = merkle.verified(made)
    shown = {n: F.lower(F.hex(c)) for n, c in (("leaf", "leaf"), ("subroot", "subroot"), ("proof_sha256", "proof_sha256"))}
    return checked.select(
        "doc_id",
        *[c.alias(n) for n, c in shown.items()],
        F.lit(made.root.hex() if made.root else None).cast("string").alias("root"),
        F.lower(F.hex("folded")).alias("folded_root"),
        "verified",
    )


@query
def op13_prefix_trie(spark, sf):
    return prefixes.report(table(spark, sf, "conversations"))
