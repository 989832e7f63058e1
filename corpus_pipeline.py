"""From documents to packed sequences: toxicity, line dedup, near-dedup, decontamination, packing.

Each stage works on all that its predecessor kept. Its result is written as Parquet in the shared
folder and read again, so a later stage never repeats an earlier one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.llm import decontaminate, lines, minhash, packing, toxicity
from cartulary.sources.storage import drop_path, stage

#: SQL can't express the classifier, the SimHash links or the tokens; the tests compare with plain versions.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier calls toxic go. Null and empty texts are scored like any other; repeated rows go or stay together."""
    model = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet").where(~toxicity.held_out()))
    return toxicity.score(docs, model).where("predicted = 0").select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose every line stands elsewhere go; n_chars follows the text. Null and empty texts lose no line and stay."""
    found = lines.dedup_lines(docs)
    kept = found.where("size(removed_lines) = 0 or text rlike '[^\\\\s]'").select(docs.columns)
    return kept.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each class stays, that of the smallest doc_id. Null and empty texts are classes of their own kind; of rows
    that tie in id and text one stays."""
    return minhash.one_of_each(docs, by_family=True)


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Contaminated documents go. Null and empty texts have no words and stay; repeated rows go or stay together."""
    return decontaminate.remove_documents(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of all documents in sequences. A null or empty text is one piece, its end id; repeated rows are packed as often as they occur."""
    import public_tokenizers

    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    """The stages over documents, each one's rows written and read again."""
    docs, before = spark.read.parquet(f"{folder}/documents.parquet"), None
    for name, function in STAGES:
        docs, at = stage(function(spark, docs, folder), f"pipeline-{name}")
        if before:
            drop_path(spark, before)
        before = at
    return docs
