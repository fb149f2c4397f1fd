"""Corpus pipeline: the documents table through operators of ``starmart.llm``.

``STAGES`` are (name, function) in order; a function takes (spark, docs,
sf_dir) and returns a DataFrame, which ``run`` writes as Parquet and rereads as
the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from starmart.llm import langid, line_dedup, mixing, ngram_join, pieces
from starmart.llm.common import WORD, materialize, without


def language_id(spark, docs, sf_dir):
    """Documents whose text is rejected (no letters, or like no learned language) go."""
    return langid.keep_identified(docs, langid.fit(docs))


def line_dedup_stage(spark, docs, sf_dir):
    """Lines that many documents share stay in the last of them only."""
    return line_dedup.drop_repeated_lines(docs)


def near_duplicates(spark, docs, sf_dir):
    """Of the rows that five-word shingles link at 0.8 or more, one stays: that of
    the least id (nulls last), then of the least row number. Rows without words
    link with nothing; of those that repeat id and text, one stays."""
    row, key = (name + "_" * sum(c.startswith(name) for c in docs.columns) for name in ("row", "row_key"))
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()))
    keyed = numbered.withColumn(key, F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(row).alias("row")))
    found = ngram_join.jaccard_components(keyed, id_col=key, n=5, num=80, den=100)
    near = found.where("doc_id != component_id").select(F.col("doc_id.row").alias("doc_id"))
    blank = numbered.where(~F.coalesce("text", F.lit("")).rlike(WORD)).select("doc_id", "text", F.col(row).alias("row"))
    first = blank.groupBy("doc_id", "text").agg(F.min("row").alias("row")).select("row")
    again = blank.select("row").join(first, "row", "left_anti").select(F.col("row").alias("doc_id"))
    return without(numbered, materialize(near.unionByName(again)), row).drop(row)


def mix_sources(spark, docs, sf_dir):
    """Every document as often as the mix takes it."""
    return mixing.mixed(docs)


def sentencepiece(spark, docs, sf_dir):
    """The token ids of every document, and the digest of the text they decode to."""
    return pieces.round_trip(docs, pieces.load_pieces()).select("doc_id", F.size("ids").alias("n_tokens"), "ids", F.sha2("text", 256).alias("decoded_sha256"))


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", sentencepiece),
]

# Models and dictionaries of the first and last stage are beyond SQL; the tests
# hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
