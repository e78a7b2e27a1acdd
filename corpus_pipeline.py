"""A corpus from raw documents to packed windows, in five stages.

Each stage takes all that the one before kept and its decisions take effect: rejected
rows go, copies and near copies go, secrets are replaced in the text.  Every stage but the last gives
the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.llm.dedup import keep_first_copies
from rosterflow.llm.jaccard import keep_one_of_each
from rosterflow.llm.language import UNDETERMINED, fit, identify
from rosterflow.llm.packing import pack
from rosterflow.llm.queries import tokenizer_file
from rosterflow.llm.secrets import redact_secrets
from rosterflow.session import shared_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LETTER = r"\p{L}"
#: Parts of texts that a packing worker remembers, within a task: workers stand beside an executor that other stages have filled.
REMEMBERED = 250_000


def documents(docs: DataFrame) -> DataFrame:
    """Only the columns of ``documents``, whatever else there is."""
    return docs.select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose text has no language: null, empty or without a letter.

    The text alone decides, so nothing is lost if there is no language to learn from.
    """
    docs = documents(docs)
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = fit(docs.where(~held_out))
    rows = docs.select(F.struct(*COLUMNS).alias("row"), "text")
    found = identify(rows, model, "row", "text")
    return found.where((F.col("lang_pred") != UNDETERMINED) if model is not None else F.col("key.text").rlike(LETTER)).select("key.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of equal texts the one with the largest id."""
    return keep_first_copies(documents(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near copies the document with the smallest id."""
    return keep_one_of_each(documents(docs))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document and replaces its secrets."""
    return redact_secrets(documents(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token windows, without the ids: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    files = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("byte_bpe_50k.tiktoken")
    pieces = pack(documents(docs), *files, keep_ids=False, cached=REMEMBERED, keep_parts=False)
    return pieces.withColumnRenamed("key", "doc_id")


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("secret scans", secret_scan),
    ("packing", packing),
]

#: The language model, the tokenizer and the packing can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{base}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
