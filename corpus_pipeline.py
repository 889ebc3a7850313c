"""Corpus pipeline: from raw documents to packed training sequences.

Each stage reads what its predecessor kept, written as Parquet. The first four return rows
with the columns of ``documents``; the last one returns the pieces of the packed sequences.
Null texts and texts without a letter go with their language; texts of any length are read
whole; rows without doc_id are documents like others; rows that repeat a doc_id and text are
one from the near-duplicate stage on; an empty table gives no rows.

* quality: documents whose perplexity the Kneser-Ney classifier rejects go;
* language: documents whose language is unknown or rejected go;
* lines: lines of templates that recur across documents go (``n_chars`` follows the text);
  near copies count as one document, and one carrier keeps a line that is most of a document;
  a document of which nothing but white space is left goes;
* near_duplicates: one row of each group of near copies stays, of the document of smallest id;
* packing: token ids of all documents in sequences of 4096.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.llm.langid import known_language, train
from spendlens.llm.linedup import op6_line_dedup
from spendlens.llm.neardup import op4_near_duplicates
from spendlens.llm.packing import op7_pack
from spendlens.llm.quality_lm import op9_quality
from spendlens.llm.shared import one_of_each, rows_of, stage, table

#: Documents of a resemblance of so many hundredths are near copies (the query op4_ has its own).
NEAR = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rows_of(docs, op9_quality(docs, table(spark, sf_dir, "labels")).where("kept"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return known_language(docs, train(docs.select("doc_id", "text", "lang")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    classes = op4_near_duplicates(docs, NEAR).where("node IS NOT NULL").select("text_hash", F.col("node").alias("group"))
    clean = op6_line_dedup(docs, groups=classes)
    dropped = F.col(clean.columns[-1]) > 0
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    blank = ~F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]"))
    return (clean.where(~(dropped & blank) | F.col("text").isNull())
            .withColumn("n_chars", F.when(dropped, length).otherwise(F.col("n_chars"))).select(docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs, op4_near_duplicates(docs, NEAR))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op7_pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("language", language), ("lines", lines),
          ("near_duplicates", near_duplicates), ("packing", packing)]

#: SQL cannot express these stages; tests compare them with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over the whole table ``documents``."""
    out = table(spark, sf_dir, "documents")
    for k, (name, function) in enumerate(STAGES):
        out = function(spark, out if k == 0 else stage(out, name), sf_dir)
    return out
