"""From raw documents to a training mix: stages over whole tables, each written as Parquet and read again by the next.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns what is kept.  All but the last return
the columns of ``documents``; the last returns the mix, one row a document with the words taken from it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.llm import decontaminate, language_id, mixing, pii, simhash_dedup
from newsflow.llm.common import ensure_checkpoint_dir, table

#: Fixed by the contract of the SimHash stage: words a shingle, differing bits.
SHINGLE, MAX_BITS = 3, 2


def _row(docs: DataFrame) -> Column:
    """All columns as one, so that none can clash with an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any text in a known language go; without any labelled one, those without letters."""
    model = language_id.fit(docs)
    if not model.languages:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    found = language_id.predict(docs, model, keep=[_row(docs)])
    return found.where(F.col("__lang_pred") != language_id.UNDETERMINED).select("__row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash_dedup.keep_first_of_group(docs, shingle=SHINGLE, max_bits=MAX_BITS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold passages of the benchmark go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars follows the text."""
    found = pii.find_pii(docs, [_row(docs)])
    text = F.col("__row.text")
    masked = F.when(text.isNotNull(), pii.masked(text.cast("string"), F.col("spans")))
    out = found.select(*[masked.alias(c) if c == "text" else F.col("__row").getField(c).alias(c) for c in docs.columns])
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources at their target weights."""
    return mixing.mix(docs)


STAGES = [("language_id", identify_language), ("simhash_dedup", drop_near_copies), ("decontaminate", drop_contaminated), ("pii", mask_personal_data), ("mix", mix_sources)]

#: The stages learn models and hash texts in ways that SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; intermediate tables go to the folder that the cluster shares."""
    ensure_checkpoint_dir(spark)
    shared = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    folder = f"{shared}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
