"""The corpus pipeline: documents in, packed token sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the caller
writes it as Parquet and reads it again as the next stage's docs.  All stages
but the last return the columns of documents.  An empty table passes through
every stage as one; further columns are carried along up to the mix, whatever
their names."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import langid
from tidemart.llm.common import read_table
from tidemart.llm.line_dedup import line_dedup
from tidemart.llm.mixing import emit, mix
from tidemart.llm.packing import pack
from tidemart.llm.queries import TRAIN_CHARS, TRAIN_ROWS
from tidemart.llm.simhash import simhash_dedup
from tidemart.session import checkpoint_root


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts whose language the model tells; the rest (no text, no letter, or
    a calibrated score under the rejection score) goes; so null, empty and
    blank texts go.  Rows are judged one by one, repeated rows alike; a row
    without an id is judged but never learned from."""
    fold = langid.held_out(F.col("doc_id"))
    model = langid.fit(docs.filter(~fold & F.col("doc_id").isNotNull()), train_rows=TRAIN_ROWS, train_chars=TRAIN_CHARS)
    told = docs.select(F.struct("*").alias("row"), langid.language(model, docs, F.col("text")).alias("p"))
    return told.filter((F.col("p.lang") != langid.UNKNOWN) & (F.col("p.score") >= model.reject)).select("row.*")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete later copies of repeated line runs; a document all of whose
    words are such copies goes.  n_chars follows the text.  Null and empty
    texts stay as they are; of repeated rows and equal ids the first row
    keeps its lines, null ids come last."""
    out = line_dedup(docs).filter("NOT emptied")
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return out.select(*[(changed[c] if c in changed else F.col("row")[c]).alias(c) for c in docs.columns])


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the smallest doc_id,
    null ids last, of rows with equal ids any one.  Texts without a word
    share fingerprint 0 and so are one group."""
    return simhash_dedup(docs, shingle=3, max_bits=3)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.  A null source is a source
    of its own; sources without words are taken no time; rows with equal ids
    draw alike."""
    return emit(mix(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens, with their ids.  Null and empty
    texts are the end token alone; repeated rows are packed each."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", language_stage), ("line_dedup", line_dedup_stage), ("near_dedup", near_dedup_stage), ("mixing", mixing_stage), ("packing", packing_stage)]

#: The language model, the fingerprints and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{checkpoint_root(spark).rstrip('/')}/pipeline/{name}-{uuid.uuid4().hex}"
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
