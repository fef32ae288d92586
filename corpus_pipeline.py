"""A corpus pipeline of the operators in ``tallyrec.llm``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrec.llm.batches import unused
from tallyrec.llm.bpe import encode_documents
from tallyrec.llm.language import UNKNOWN, own_model, tagged
from tallyrec.llm.mixing import mixed_documents
from tallyrec.llm.simhash import without_near_duplicates
from tallyrec.llm.substrings import remove_repeats
from tallyrec.session import delete, shared_folder, workspace

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

RANKS = "byte_bpe_50k.tiktoken"
SLICE_BYTES = 2 << 20  # of texts a worker encodes at a time, beside a heap that the stages before have filled


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language go: those without any letter."""
    lang, score = (unused(docs.columns, name) for name in ("_lang_pred", "_score"))
    found = tagged(docs, own_model(docs), lang, score)
    return found.where(F.col(lang) != UNKNOWN).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return without_near_duplicates(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that start earlier go; a document without any stays as it is. ``n_chars`` is set anew
    if it is there."""
    # the operator's own columns come by other names than those of the table
    carry = [name for name in docs.columns if name not in ("doc_id", "text")]
    inner = {name: f"column_{i}" for i, name in enumerate(carry)}
    found = remove_repeats(docs.withColumnsRenamed(inner), list(inner.values()))
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    found = found.withColumn("text", text)
    back = {"doc_id": F.col("doc_id"), "text": F.col("text")}
    back |= {name: F.col(own) for name, own in inner.items()}
    if "n_chars" in back:
        back["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return found.select(*(back[name].alias(name) for name in docs.columns))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their source takes them."""
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, and a digest of the text decoded from them."""
    columns = ("n_tokens", "ids", "decoded_sha256")
    ranks = public_tokenizers.path(RANKS)
    return encode_documents(docs, ranks, public_tokenizers.PATTERN, columns, SLICE_BYTES)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", known_languages),
    ("simhash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing to target weights", mixture),
    ("byte-level BPE", tokens),
]

# The language model, fingerprints, difference-cover windows and byte pairs have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; each result is written and read again.

    A stage's own tables, and the result it read, are deleted once its result is written; the last
    result stays.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        with workspace(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        if number:
            delete(spark, f"{folder}/{number - 1}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
