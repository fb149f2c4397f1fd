"""Registered queries of the corpus operators and, where SQL can express one, its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import codebooks, conversations, exact_dedup, html_text, langid, line_dedup, lm, mixing, ngram_join, pieces, pii, secrets, topk
from .common import documents


def op1_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir)
    held = langid.held_out()
    model = langid.fit(docs.where(~held))
    return langid.identify(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op2_ngram_join(spark, sf_dir):
    return ngram_join.jaccard_components(documents(spark, sf_dir), n=3, num=90, den=100)


PII_KEY = b"corpus pseudonyms, key 1"  # a deployment passes its own


def op3_pii(spark, sf_dir):
    return pii.pseudonymise(documents(spark, sf_dir), PII_KEY)


def op4_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op5_topk_search(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0)


def op6_secret_scan(spark, sf_dir):
    return secrets.report(secrets.find_secrets(documents(spark, sf_dir)))


def op7_lm_score(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return lm.score(docs, lm.fit(docs))


def op8_mixing(spark, sf_dir):
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op9_line_dedup(spark, sf_dir):
    out = line_dedup.line_dedup(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_sentencepiece(spark, sf_dir):
    return pieces.round_trip(documents(spark, sf_dir), pieces.load_pieces()).select("doc_id", F.size("ids").alias("n_tokens"), "ids", F.sha2("text", 256).alias("decoded_sha256"))


def op11_vector_codes(spark, sf_dir):
    return codebooks.compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_html_text(spark, sf_dir):
    return html_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op13_conversation_repair(spark, sf_dir):
    return conversations.repair_damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_ngram_join": op2_ngram_join,
    "op3_pii": op3_pii,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_topk_search": op5_topk_search,
    "op6_secret_scan": op6_secret_scan,
    "op7_lm_score": op7_lm_score,
    "op8_mixing": op8_mixing,
    "op9_line_dedup": op9_line_dedup,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_vector_codes": op11_vector_codes,
    "op12_html_text": op12_html_text,
    "op13_conversation_repair": op13_conversation_repair,
}

SQL = {
    "op2_ngram_join": ngram_join.SQL,
    "op4_exact_dedup": exact_dedup.SQL,
    "op5_topk_search": topk.SQL,
    "op8_mixing": mixing.SQL,
    "op9_line_dedup": line_dedup.SQL,
    "op11_vector_codes": codebooks.SQL,
    "op13_conversation_repair": conversations.SQL,
}
