"""Queries p7 (packing), p8 (leakage) and p9 (reading level)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import Stored, table
from .leakage import leaked_items
from .packing import CAPACITY, pack_documents, pack_texts, token_counts
from .reading import fit_model, reading_levels


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold passages of evaluation items."""
    return leaked_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"), "doc_id", "text", "item_id", "text")


def p7_sequences(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 1,024 tokens."""
    return pack_documents(table(spark, folder, "documents"), "doc_id", "text")


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Reading grade of the English documents of fifty words or more."""
    documents = table(spark, folder, "documents")
    model = fit_model(documents, table(spark, folder, "labels"), "doc_id", "text", "grade")
    # Words are what white space separates; Java's \\s is ASCII, so the flag for Unicode is given.
    n_words = F.size(F.regexp_extract_all("text", F.lit(r"(?U)\S+"), F.lit(0)))
    english = documents.where(F.lower("lang").startswith("en") & (F.length("text") >= 99) & (n_words >= 50))
    return reading_levels(english, model, "doc_id", "text").select("doc_id", "grade")


def p7_invariants(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold of the packed sequences of all documents, as one row of counts.

    ``documents`` and ``empty`` count the texts packed and those without tokens; ``broken`` the texts whose pieces do not make
    up all their tokens in order, ``split`` the texts cut although they fit, ``overfull`` the sequences beyond their room or
    with overlapping pieces; ``filled`` tells whether the sequences hold 99 % of what they could (all but the last one).
    """
    documents = table(spark, folder, "documents")
    counts = Stored(token_counts(documents, "doc_id", "text"), "tokens").df
    packed = Stored(pack_texts(counts, "doc_id"), "packed").df
    pieces = packed.groupBy("doc_id").agg(F.sum("n_tokens").alias("got"), F.count("*").alias("k"), F.max(F.col("start") + F.col("n_tokens")).alias("end"), F.count("sequence").alias("placed"))
    both = counts.join(pieces, "doc_id", "full")
    text = both.agg(
        F.count_if(F.col("placed") > 0).alias("documents"), F.count_if(F.col("n_tokens") == 0).alias("empty"),
        F.count_if(~F.coalesce((F.col("got") == F.col("n_tokens")) & (F.col("end") == F.col("n_tokens")), F.lit(False))).alias("broken"),
        F.count_if((F.col("n_tokens") <= CAPACITY) & (F.col("k") > 1)).alias("split"),
    )
    room = packed.where("sequence is not null").groupBy("sequence").agg(F.sum("n_tokens").alias("n"), F.max(F.col("position") + F.col("n_tokens")).alias("end"))
    full = room.agg(F.count_if((F.col("n") > CAPACITY) | (F.col("end") != F.col("n"))).alias("overfull"), (F.sum("n") >= 0.99 * CAPACITY * (F.count("*") - 1)).alias("filled"))
    # Both sides are one row.
    return text.join(F.broadcast(full), F.lit(True)).select("documents", "empty", "broken", "split", "overfull", F.coalesce("filled", F.lit(True)).alias("filled"))


QUERIES = {"p7_sequences": p7_sequences, "p7_invariants": p7_invariants, "p8_found": p8_found, "p9_found": p9_found}

SQL = {
    "p7_invariants": """
        SELECT count(*) FILTER (length(text) > 0) documents, count(*) FILTER (coalesce(length(text), 0) = 0) AS empty, 0::BIGINT broken, 0::BIGINT AS split, 0::BIGINT overfull, true filled
        FROM documents""",
}
