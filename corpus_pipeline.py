"""From raw documents to token ids: five stages, each an operator of gridrisk.llm.

Every stage gets all rows that the one before it kept. Rows with null or empty
texts have no letter and go in the first stage, very long texts are read whole. Rows that share an id
become one in the second, rows without id all stay there. Columns beyond those of documents pass through, whatever their names, up to
the last stage, which returns doc_id, n_tokens and ids. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridrisk.llm import decontaminate, language_id, near_dedup, sentencepiece_bpe, suffix_dedup
from gridrisk.llm.textops import crc_mod, stored

#: SQL has no hyperdimensional, chosen-path or byte-pair operators; tests compare the stages with brute force.
ORACLE_SQL = None
#: Languages that the corpus is made of, and the least cosine: twice the spread of the cosine of vectors that have nothing in common.
LANGUAGES, MIN_SCORE = ("de", "en", "es", "fr"), 2 / language_id.DIMS**0.5
#: Similarity from which the near-duplicate stage links documents.
NEAR_PERCENT = 80


def _place(docs: DataFrame, column: str) -> str:
    return f"c{docs.columns.index(column)}"


def _unnamed(docs: DataFrame) -> DataFrame:
    """docs with its columns named by place, so that none clashes with what an operator adds."""
    return docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose predicted language is one of LANGUAGES with a score of MIN_SCORE or more; `lang` becomes the prediction.

    Prototypes are learned from the rows that op9 may learn from. Where there are none, nothing can be told and all documents stay.
    """
    known = docs.where((crc_mod("doc_id", 3) != 1) & F.col("lang").isNotNull())
    prototypes = language_id.learn(known)
    if prototypes.isEmpty():
        return docs
    found = language_id.identify(_unnamed(docs), prototypes, text=_place(docs, "text"))
    kept = found.where(F.col("lang_pred").isin(*LANGUAGES) & (F.col("score") >= MIN_SCORE)).withColumn(_place(docs, "lang"), F.col("lang_pred"))
    return kept.drop("lang_pred", "score").toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each near-duplicate component, five words and NEAR_PERCENT."""
    return near_dedup.one_of_each(docs, percent=NEAR_PERCENT)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts bytes that repeat a smaller id's out of the texts; parts of a cut character go too."""
    text, chars = _place(docs, "text"), _place(docs, "n_chars")
    left = suffix_dedup.remove_repeats(_unnamed(docs), _place(docs, "doc_id"), text, returns=("kept_text",))
    return left.withColumn(text, F.col("kept_text")).withColumn(chars, F.length(text).cast("long")).drop("kept_text").toDF(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with dropout."""
    return sentencepiece_bpe.encode(docs.select("doc_id", "text"), sentencepiece_bpe.Pieces.load()).select("doc_id", F.size("ids").alias("n_tokens"), "ids")


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", drop_repeated_passages),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
