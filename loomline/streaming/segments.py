"""Segments of a growing corpus, file by file.

New files are segmented once and appended; the stream's checkpoint is what resumes.
Segments have no state across documents, so no watermark is needed; counts a length bucket
keep a bounded state of one row a bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomline.operators import sample, segment


def stream_segments(spark: SparkSession, folder: str, schema: str, cfg: dict, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """A streaming frame of segments with length and bucket."""
    docs = spark.readStream.schema(schema).parquet(folder)
    named = docs.select(F.col(doc).alias("doc_ord"), F.col(doc).cast("string").alias("doc_id"), F.col(text).alias("text"))
    return sample.with_source_id(sample.with_length(segment.segments(named, cfg), cfg))


def append_segments(spark: SparkSession, folder: str, schema: str, out: str, checkpoint: str, cfg: dict) -> StreamingQuery:
    """Take what is new and end; run again for what comes later."""
    found = stream_segments(spark, folder, schema, cfg)
    return found.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def bucket_counts(segs: DataFrame) -> DataFrame:
    """Segments of each type and length bucket so far."""
    return segs.groupBy("segment_type", "length_bucket_id").agg(F.count("*").alias("segments"))
