"""A training corpus from raw documents, in five stages of the llm operators.

Each stage works on all that its predecessor kept, is written as Parquet in the
session's shared folder and read again. All but the last keep the columns of
documents; a stage that changes a text sets n_chars to its length. Columns that
documents have beside their own stay, whatever their names, and an empty table gives
empty ones. A stage's table goes when the next one's is written.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm import decontam, line_dedup, minhash, pieces, toxicity
from loomline.llm.common import cut, shared_folder, table, unused

#: Removed documents whose ids are broadcast at most; more are joined.
BROADCAST_REMOVED = 500_000


def _apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with other names for the columns that an operator's results would replace, and those names."""
    results = {"score", "predicted", "clean_text", "n_lines", "n_dropped", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"}
    names = {}
    for c in docs.columns:
        if c.lower() in results:
            names[c] = unused(docs, c)
            docs = docs.withColumnRenamed(c, names[c])
    return docs, names


def _again(made: DataFrame, docs: DataFrame, names: dict[str, str], clean: bool = False) -> DataFrame:
    """The columns of docs of an operator's result; clean: with clean_text as the text."""
    if clean:
        made = made.withColumn("text", F.col("clean_text")).withColumn("n_chars", F.length("text").cast("long"))
    return made.select(*[F.col(f"`{names.get(c, c)}`").alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that are predicted toxic.

    Null and empty texts score 0 and stay; repeated rows go or stay together; a score
    on the threshold is toxic; a text of any length is scored in all its windows.
    """
    apart, names = _apart(docs)
    scored = toxicity.toxicity(apart, table(spark, sf_dir, "labels"))
    return _again(scored.filter("predicted = 0"), docs, names)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that ten documents or more have.

    A null text is one empty line and becomes empty; each row is a document, so
    repeated rows count each; a line in just ten goes; no document does.
    """
    apart, names = _apart(docs)
    return _again(line_dedup.line_dedup(apart), docs, names, clean=True)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least doc_id.

    Texts are compared by shingles of five words, as near-duplicate stages do by
    default; op5's query takes two because its contract says so. Null and empty texts
    are copies of none and stay. Rows are told apart by doc_id and text: of equal
    rows one stays, of one doc_id's texts in a group that with the least hash, and a
    text that isn't in the group stays whatever its doc_id. A null doc_id comes last.
    """
    hashed = unused(docs, "text_hash")
    found = cut(minhash.near_duplicates(docs).filter("n_shingles > 0").select("doc_id", "text_hash", "group_id"))
    first = found.groupBy("group_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first"))
    own = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    judged = found.join(first, "group_id").groupBy("doc_id", "text_hash").agg(F.count("*").alias("n"), F.bool_or(own).alias("stays")).filter("not stays or n > 1")
    some = cut(judged.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"), F.col("stays").alias("__stays")))
    repeated = not some.filter("__stays").isEmpty()
    if some.limit(BROADCAST_REMOVED + 1).count() <= BROADCAST_REMOVED:
        some = F.broadcast(some)
    joined = docs.withColumn(hashed, F.xxhash64("text")).join(some, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col(hashed) == F.col("__hash")), "left")
    left = joined.filter("__stays is null")
    if repeated:  # of equal rows one
        left = left.unionByName(joined.filter("__stays").dropDuplicates(["doc_id", hashed]))
    return left.select(*[f"`{c}`" for c in docs.columns])


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without contaminated documents, and texts without spans of test items.

    A null text becomes empty and stays; repeated rows are judged alike; two items with
    a window in a document make it contaminated; texts of any length pass whole.
    """
    apart, names = _apart(docs)
    made = decontam.decontaminate(apart, table(spark, sf_dir, "benchmark"))
    return _again(made.filter("not contaminated"), docs, names, clean=True)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their piece ids, the n best segmentations and the decoding check.

    A null text has nulls; ties go as the operator says; columns named like its results
    are replaced.
    """
    return pieces.encode(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("minhash_dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("sentencepiece", encode_pieces),
]

#: A trained network and a lattice search aren't expressible in SQL; tests compare run() with a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of documents."""
    docs = table(spark, sf_dir, "documents")
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}")
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    last = None
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder.toString()}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if last is not None:
            store.delete(spark._jvm.org.apache.hadoop.fs.Path(last), True)
        last = path
    return docs
