"""Reading corpora and stage tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ID_COLUMNS = ("doc_id", "document_id", "document_key", "id", "record_id")


def read_corpus(spark: SparkSession, paths: str | list[str], lang: str | None = None, split: str | None = None, options: dict | None = None) -> DataFrame:
    """A corpus by path. {lang} and {split} in it are filled in, so other languages' files aren't listed; a lang column is filtered.

    A list is tried in order, the first readable one counts; if none is, the error
    names each and why. Endpoint and time-out settings of a store are reader options.
    """
    errors = []
    for path in [paths] if isinstance(paths, str) else paths:
        place = path.replace("{lang}", lang or "").replace("{split}", split or "")
        try:
            read = spark.read.options(**(options or {}))
            df = read.json(place) if re.search(r"\.jsonl?(\.\w+)?$", place) else read.parquet(place)
        except Exception as e:
            errors.append(f"{place}: {str(e).splitlines()[0]}")
            continue
        return df.filter(F.col("lang") == lang) if lang and "lang" in df.columns and "{lang}" not in path else df
    raise FileNotFoundError("no corpus could be read:\n" + "\n".join(errors))


def doc_id(df: DataFrame, ordinal: str | None = None) -> Column:
    """The first id column that isn't null, as text; else doc_ and the row's ordinal."""
    found = [F.col(c).cast("string") for c in ID_COLUMNS if c in df.columns]
    return F.coalesce(*found, F.concat(F.lit("doc_"), F.col(ordinal).cast("string"))) if ordinal else F.coalesce(*found)


def text_column(df: DataFrame) -> str | None:
    """text where the corpus has it, even if it is null; else content."""
    return next((c for c in ("text", "content") if c in df.columns), None)


def with_ordinal(df: DataFrame, name: str = "ordinal") -> DataFrame:
    """Rows numbered in file order. Only a corpus without ids needs it: it costs a pass that counts the rows of each partition."""
    row = F.monotonically_increasing_id()
    sizes = df.select(F.shiftright(row, 33).alias("__part")).groupBy("__part").agg(F.count("*").alias("__rows"))
    before = F.sum("__rows").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))  # a row a partition
    firsts = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__first"))
    numbered = df.withColumn("__row", row).withColumn("__part", F.shiftright("__row", 33)).join(F.broadcast(firsts), "__part")
    return numbered.withColumn(name, F.expr("__first + (__row & 8589934591)")).drop("__row", "__part", "__first")


def corpus_documents(df: DataFrame) -> DataFrame:
    """(doc_ord, doc_id, text) of a corpus; rows without text are left out."""
    text = text_column(df)
    if text is None:
        return df.sparkSession.createDataFrame([], "doc_ord string, doc_id string, text string")
    ids = [c for c in ID_COLUMNS if c in df.columns]
    numbered = df if ids else with_ordinal(df)
    order = F.col(ids[0]) if ids else F.col("ordinal")
    return numbered.filter(F.col(text).isNotNull()).select(order.alias("doc_ord"), doc_id(numbered, None if ids else "ordinal").alias("doc_id"), F.col(text).alias("text"))


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place) or [])


def resolve_inputs(spark: SparkSession, path: str) -> list[str]:
    """The path if it exists, else its shards root.shardNN.ext in order."""
    if _exists(spark, path):
        return [path]
    root, dot, ext = path.rpartition(".")
    glob = spark._jvm.org.apache.hadoop.fs.Path(f"{root}.shard*.{ext}" if dot else f"{path}.shard*")
    found = glob.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(glob) or []
    if not found:
        raise FileNotFoundError(path)
    return sorted(str(f.getPath()) for f in found)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines under a schema; blank lines are skipped, malformed ones fail."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(resolve_inputs(spark, path))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(*resolve_inputs(spark, path))


def read_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def mapped_lang(column: Column, mapping: dict[str, str]) -> Column:
    """Mapped codes; others as they are."""
    if not mapping:
        return column
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, column), column)
