"""The operators' queries, each over the whole of its table, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import (
    alignment,
    bytepair,
    html,
    language,
    licenses,
    minhash,
    mixing,
    packing,
    pii,
    quality,
    spelling,
    toxicity,
    vectors,
)
from .common import stage, table

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op5_packing(spark, sf_dir):
    return packing.packed_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op6_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    metrics = stage(quality.measured(docs).drop("text"), "metrics")
    return quality.judged(metrics, quality.host_rates(metrics)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


@query
def op8_pii(spark, sf_dir):
    rows = pii.personal_data(table(spark, sf_dir, "documents", "doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])
    counts = [
        F.size(_of_kind(base, k)).cast("long").alias(f"n_{name}")
        for k, name in enumerate(pii.KINDS[:4])
    ]
    return rows.select(
        "doc_id",
        *counts,
        F.sha2(pii.written(base), 256).alias("base_sha256"),
        pii.written(F.col("spans")).alias("spans"),
    )


def _of_kind(spans, kind: int):
    return F.filter(spans, lambda s: s["kind"] == kind)


@query
def op9_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity.toxicity(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))


@query
def op10_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    return mixing.places(docs).drop("position")


@query
def op10_positions(spark, sf_dir):
    return mixing.places(table(spark, sf_dir, "documents", "doc_id", "source", "text"))


@query
def op1_licenses(spark, sf_dir):
    return licenses.scanned(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op2_vectors(spark, sf_dir):
    return vectors.near_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding")).drop("recall")


@query
def op3_html(spark, sf_dir):
    return html.extracted(table(spark, sf_dir, "pages"))


@query
def op7_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return language.predicted(docs, language.learned(docs))


@query
def op11_alignment(spark, sf_dir):
    return alignment.alignments(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op12_spelling(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op13_bytepair(spark, sf_dir):
    rows = bytepair.decoded(bytepair.encoded(table(spark, sf_dir, "documents", "doc_id", "text")))
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
