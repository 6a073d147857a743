"""From raw documents to token ids: five stages, each on all that the one before it kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next one's docs. All but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm import bpe, decontaminate, jaccard_join, language_id, toxicity
from lexloom.llm.queries import VOCABULARY
from lexloom.llm.scratch import Scratch


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told (no text or no letter) go. The others have the language that their
    text is predicted to have; what was stated before only trains the model."""
    seen = language_id.predict(docs, language_id.train(docs)).where("lang_pred <> 'und'")
    return seen.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity of at least the threshold go."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).where(F.col("toxic_score") < toxicity.THRESHOLD).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents chained by a Jaccard similarity of 0.8 the one of smallest id stays."""
    return jaccard_join.one_of_each(docs).select(*docs.columns)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items are cut out; n_chars follows the text."""
    clean = decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text: doc_id, n_tokens, ids, and the hash of the bytes that they decode to."""
    import public_tokenizers

    path = public_tokenizers.path(VOCABULARY)
    coded = bpe.encode(docs, path, public_tokenizers.PATTERN, check=True)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("text_sha256"))


STAGES = [("language_id", identify_language), ("toxicity", drop_toxic), ("jaccard_join", drop_near_copies), ("decontamination", remove_benchmark), ("byte_bpe", tokenize)]

#: Trained models decide in two stages, which SQL can't express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = scratch.write(docs)
    return docs
