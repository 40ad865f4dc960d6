"""From raw documents to token ids in five stages, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns the columns of ``documents``; the last returns token ids. ``run`` cuts the plan between stages through the
checkpoint folder; callers may as well write each stage as Parquet and read it again.

Null and empty texts pass through all stages (they are neither low in quality by themselves nor like another text); rows without an id pass the stages that compare ids.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortsmith.llm import mixing, nearby, passages, pieces, preference
from cohortsmith.session import checkpointed

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def packed(docs: DataFrame) -> DataFrame:
    """Id and text beside all other columns as one, so that no column name can clash with an operator's."""
    rest = [c for c in docs.columns if c != "text"]
    return docs.select(F.struct(*rest).alias("_rest"), F.col("doc_id").alias("_key"), F.col("text").alias("_body"))


def unpacked(rows: DataFrame, names: list[str], **new) -> DataFrame:
    """The columns as they were, with new values for some."""
    new = {"text": F.col("_body"), **new}
    return rows.select(*[new[c].alias(c) if c in new else F.col(f"_rest.`{c}`") for c in names])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the cut go on; the model is fitted as for the query."""
    scored = preference.score(packed(docs), ["_rest", "_body"], preference.op6_model(spark, sf_dir), text_col="_body")
    return unpacked(scored.where(F.col("score") >= 0.3), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that share 80 % of their shingles of five words: the one of smallest id."""
    dropped = nearby.near_duplicates(docs, shingle=5, percent=80).where("not kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def passages_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words stay in their first document only; a cut text is its remaining words joined by a space."""
    cut = passages.remove_repeats(packed(docs), ["_rest", "_body"], id_col="_key", text_col="_body")
    gone = F.col("n_removed") > 0
    return unpacked(cut, docs.columns, text=F.when(gone, F.col("kept_text")).otherwise(F.col("_body")),
                    n_chars=F.when(gone, F.length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("_rest.n_chars")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in order of training, once per copy that their source's target asks for."""
    return mixing.trained(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, number of tokens, their ids, and digests of the ids and of their decoding."""
    return pieces.encode_texts(docs, ["doc_id", "source"], pieces.default_model(), ids=True, memory=150_000)


STAGES = [("quality classifier", quality), ("MinHash near-dedup", near_duplicates), ("substring dedup", passages_once), ("mixing sources to target weights", mix),
          ("SentencePiece encoding and decoding", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = checkpointed(docs)
    return docs


#: The classifier, the trees and the vocabulary are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None
