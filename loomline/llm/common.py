"""Helpers that the training-data operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: The white space of every contract: space, and tab to carriage return.
SPACE = b" \t\n\x0b\x0c\r"

#: Text that one call of a map_text function gets at most, unless a row alone has more.
SLICE_BYTES = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it.

    One is made here only where spark.checkpoint.dir is unset, none was set before and
    driver and executors are one process, as in tests; a cluster has to name one.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="loomline-checkpoint-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Lineage cut by a reliable checkpoint.

    Spark's cleaner deletes shuffle files when the driver's collector finds that no
    plan needs them; it is asked to look, as a small heap would seldom do by itself.
    """
    shared_folder(df.sparkSession)
    made = df.checkpoint()
    df.sparkSession.sparkContext._jvm.System.gc()
    return made


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with up to SLICE_BYTES in a column, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and held + size > SLICE_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def release() -> None:
    """Give memory that is free back to the machine: a reused worker keeps it from one operator to the next otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no malloc_trim
        ctypes.CDLL(None).malloc_trim(0)


def map_text(
    df: DataFrame,
    fn: Callable[[list[bytes | None]], dict[str, list | pa.Array]],
    fields: list[T.StructField],
    column: str = "text",
    keep: list[str] | None = None,
    state: dict | None = None,
) -> DataFrame:
    """Add columns computed from one text column, batch by batch, without a shuffle.

    fn gets the UTF-8 bytes of the column (None for null) and returns a value
    per row for each of fields. An input column with the name of a new one is
    replaced; names are compared as Spark resolves them, without case. state is what
    fn keeps from call to call; it is cleared when a task ends.
    """
    new = {f.name.lower() for f in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    wanted = kept if column in kept else [*kept, column]
    schema = T.StructType([df.schema[c] for c in kept] + fields)
    arrow = {f.name: to_arrow_type(f.dataType) for f in fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in (part for whole in batches for part in slices(whole, wanted.index(column))):
                texts = batch.column(wanted.index(column)).cast(pa.binary()).to_pylist()
                out = fn(texts)
                cols = [batch.column(wanted.index(c)) for c in kept]
                for name, kind in arrow.items():
                    value = out[name]
                    cols.append(value if isinstance(value, pa.Array) else pa.array(value, kind))
                yield pa.RecordBatch.from_arrays(cols, names=[*kept, *arrow])
        finally:
            if state is not None:
                state.clear()
            batch = texts = out = cols = value = None
            release()

    return df.select(*[f"`{c}`" for c in wanted]).mapInArrow(run, schema)


def unused(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    have = {c.lower() for c in df.columns}
    while (name := f"__{name}").lower() in have:
        pass
    return name


def column(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind, True)
