"""Corpus pipeline: from ``documents`` to packed training sequences.

STAGES are (name, function) pairs; each function takes (spark, docs, sf_dir)
and returns a DataFrame, which a caller may write and read again as the next
stage's docs.  ``run`` does so under the session's checkpoint folder, so that
a lost executor never repeats a finished stage.

1. quality_classifier: documents that the classifier, trained on ``labels``,
   rejects go.
2. ngram_jaccard_join: of each group of near copies the document with the
   smallest id stays; documents without words all stay.
3. source_mixing: the sources' words are taken by target weight; a row for
   each document and pass, with the text that the pass takes.
4. best_fit_packing: doc_id, piece, start, length, ids_crc32, sequence_id and
   offset of every piece of the mixed texts.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runoff.llm import mixing, ngram_join, packing, quality
from runoff.llm.common import written

TOKENIZER = "word_bpe_49k.json"


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.select(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_texts(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(docs, public_tokenizers.path(TOKENIZER))
    pieces = written(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces")
    return packing.pack(pieces, ["doc_id", "piece", "ids_crc32", "length"])


STAGES = [("quality_classifier", select_quality), ("ngram_jaccard_join", drop_near_copies),
          ("source_mixing", mix_sources), ("best_fit_packing", pack_sequences)]

#: SQL expresses neither the trained classifier nor the tokenizer; the stages
#: are tested against brute force instead (tests/llm).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
