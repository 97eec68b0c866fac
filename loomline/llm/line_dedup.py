"""Reversible line dedup: sharded cuckoo filters over an exact reference-count table.

The index of a corpus is a table (shard, key, n): for every line key the exact
number of documents that hold it. insert() and delete() add and take away whole
document sets by summing signed counts, so a deletion restores every line that it
made rare again. Each shard also has a cuckoo filter of the keys that reached the
threshold; a filter takes insertions and deletions of keys that cross it. Cleaning
asks the filter first and confirms each hit in the exact table: the filters and the
frequent keys are broadcast while those are few; beyond BROADCAST_KEYS each line goes to its
shard's filter, and what the filter knows is joined with the table. Both give the same rows.

Defined cases: null or empty text is one empty line; keys under min_chars are
never dropped; a row is a document, so repeated rows count each, and a key found in
just min_docs documents is dropped; texts and lines of any length are read whole; an
empty table gives no rows; input columns named like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.llm.common import SPACE, column, cut, map_text, shuffle_parts, unused

MIN_DOCS = 10
MIN_CHARS = 1
#: Shards of an index that is kept. line_dedup() takes as many as the session has shuffle partitions if those are more.
SHARDS = 16
#: Frequent keys that are broadcast at most (some 100 bytes each in a worker, and their filters).
BROADCAST_KEYS = 200_000
#: Lines that one task asks a shard's filter for, about.
ASKED_LINES = 1_000_000
#: Distinct keys that a counting task holds before it passes them on.
HELD_KEYS = 400_000

INDEX = "shard int, key binary, n long"


def line_key(line: bytes) -> bytes:
    return line.strip(SPACE).lower()


def key_hash(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars <= 1 or len(key.decode("utf-8", "replace")) >= min_chars)


class CuckooFilter:
    """Four 16-bit fingerprints a bucket; partial-key displacement, so deletions need no key list."""

    SLOTS, KICKS = 4, 500

    def __init__(self, buckets: int, table: np.ndarray | None = None):
        self.mask = buckets - 1
        self.table = np.zeros((buckets, self.SLOTS), np.uint16) if table is None else table

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 4
        while buckets * cls.SLOTS * 0.8 < keys:
            buckets *= 2
        return cls(buckets)

    @classmethod
    def of(cls, payload: bytes) -> CuckooFilter:
        table = np.frombuffer(payload, np.uint16).reshape(-1, cls.SLOTS).copy()
        return cls(len(table), table)

    def payload(self) -> bytes:
        return self.table.tobytes()

    def _places(self, h: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(h[:2], "little") or 1
        one = int.from_bytes(h[2:8], "little") & self.mask
        return mark, one, self._other(one, mark)

    def _other(self, at: int, mark: int) -> int:
        return at ^ ((mark * 0x5BD1E995 >> 3) & self.mask)

    def insert(self, h: bytes) -> bool:
        """False when the filter is too full; the caller then builds a larger one."""
        mark, one, two = self._places(h)
        for at in (one, two):
            free = np.flatnonzero(self.table[at] == 0)
            if len(free):
                self.table[at, free[0]] = mark
                return True
        at = one
        undo = []
        for kick in range(self.KICKS):
            slot = (mark + kick) % self.SLOTS
            undo.append((at, slot, int(self.table[at, slot])))
            mark, self.table[at, slot] = int(self.table[at, slot]), mark
            at = self._other(at, mark)
            free = np.flatnonzero(self.table[at] == 0)
            if len(free):
                self.table[at, free[0]] = mark
                return True
        for at, slot, old in reversed(undo):
            self.table[at, slot] = old
        return False

    def delete(self, h: bytes) -> bool:
        mark, one, two = self._places(h)
        for at in (one, two):
            found = np.flatnonzero(self.table[at] == mark)
            if len(found):
                self.table[at, found[0]] = 0
                return True
        return False

    def __contains__(self, h: bytes) -> bool:
        mark, one, two = self._places(h)
        return mark in self.table[one] or mark in self.table[two]

    @classmethod
    def build(cls, hashes: list[bytes]) -> CuckooFilter:
        made = cls.sized(max(1, len(hashes)))
        while not all(made.insert(h) for h in hashes):
            made = cls(2 * (made.mask + 1))
        return made


def shard_of(key: bytes, shards: int) -> int:
    return int.from_bytes(key[8:12], "little") % shards


def empty_index(spark) -> DataFrame:
    return spark.createDataFrame([], INDEX)


def line_counts(docs: DataFrame, text: str = "text", shards: int = SHARDS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(shard, key, n): documents that hold each key, summed within each task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def out() -> Iterator[pa.RecordBatch]:
            keys = list(held)
            for at in range(0, len(keys), 50_000):
                part = keys[at : at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard_of(k, shards) for k in part], pa.int32()), pa.array(part, pa.binary()), pa.array([held[k] for k in part], pa.int64())],
                    names=["shard", "key", "n"],
                )
            held.clear()

        for batch in batches:
            for data in batch.column(0).cast(pa.binary()).to_pylist():
                for key in {line_key(x) for x in data.split(b"\n")} if data else ():
                    if long_enough(key, min_chars):
                        h = key_hash(key)
                        held[h] = held.get(h, 0) + 1
                if len(held) > HELD_KEYS:
                    yield from out()
        yield from out()

    part = docs.select(F.col(text).alias("text")).mapInArrow(count, INDEX)
    return part.groupBy("shard", "key").agg(F.sum("n").alias("n"))


def _summed(signed: DataFrame) -> DataFrame:
    return signed.groupBy("shard", "key").agg(F.sum("n").alias("n")).filter("n > 0")


def insert(index: DataFrame, docs: DataFrame, **how) -> DataFrame:
    return _summed(index.unionByName(line_counts(docs, **how)))


def delete(index: DataFrame, docs: DataFrame, **how) -> DataFrame:
    """The index without these documents; they have to be as they were inserted."""
    return _summed(index.unionByName(line_counts(docs, **how).withColumn("n", -F.col("n"))))


def build_filters(frequent: DataFrame) -> DataFrame:
    """One cuckoo filter a shard, over the keys that reached the threshold."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        made = CuckooFilter.build([bytes(k) for k in pdf["key"]])
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "payload": [made.payload()]})

    return frequent.groupBy("shard").applyInPandas(build, "shard int, payload binary")


def update_filters(filters: DataFrame, before: DataFrame, after: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Filters after an insertion or deletion: only keys that crossed the threshold are touched."""
    was = before.filter(F.col("n") >= min_docs).select("shard", "key", F.lit(1).alias("was"))
    now = after.filter(F.col("n") >= min_docs).select("shard", "key", F.lit(1).alias("now"))
    moved = was.join(now, ["shard", "key"], "full").filter("was is null or now is null").select("shard", "key", F.col("now").isNotNull().alias("up"))

    def update(key: tuple, old: pd.DataFrame, changes: pd.DataFrame) -> pd.DataFrame:
        made = CuckooFilter.of(bytes(old["payload"].iloc[0])) if len(old) else CuckooFilter.sized(max(1, len(changes)))
        for h, up in zip(changes["key"], changes["up"]):
            if not up:
                made.delete(bytes(h))
        full = not all(made.insert(bytes(h)) for h, up in zip(changes["key"], changes["up"]) if up)
        return pd.DataFrame({"shard": [int(key[0])], "payload": [b"" if full else made.payload()]})

    fresh = filters.groupBy("shard").cogroup(moved.groupBy("shard")).applyInPandas(update, "shard int, payload binary")
    fresh = cut(fresh)
    again = after.filter(F.col("n") >= min_docs).join(fresh.filter(F.length("payload") == 0).select("shard"), "shard", "left_semi")
    return fresh.filter(F.length("payload") > 0).unionByName(build_filters(again))


OUT = [column("clean_text", T.StringType()), column("n_lines", T.LongType()), column("n_dropped", T.LongType())]


def clean(docs: DataFrame, index: DataFrame, text: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, filters: DataFrame | None = None, broadcast_keys: int = BROADCAST_KEYS, shards: int = SHARDS) -> DataFrame:
    """docs with clean_text, n_lines and n_dropped: without the lines found in min_docs documents or more."""
    frequent = cut(index.filter(F.col("n") >= min_docs))
    filters = build_filters(frequent) if filters is None else filters
    if frequent.limit(broadcast_keys + 1).count() > broadcast_keys:
        return _clean_by_join(docs, frequent, filters, text, min_chars, shards)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(
        ({r["shard"]: bytes(r["payload"]) for r in filters.collect()}, {bytes(r["key"]) for r in frequent.select("key").collect()}),
    )
    return _clean_by_broadcast(docs, shared, text, min_chars, shards)


def _clean_by_broadcast(docs: DataFrame, shared, text: str, min_chars: int, shards: int) -> DataFrame:
    state: dict = {}

    def frequent(key: bytes) -> bool:
        if not long_enough(key, min_chars):
            return False
        h = key_hash(key)
        own = state["filters"].get(shard_of(h, shards))
        return own is not None and h in own and h in state["exact"]

    def fn(texts: list[bytes | None]) -> dict[str, list]:
        if not state:
            payloads, exact = shared.value
            state["filters"] = {shard: CuckooFilter.of(p) for shard, p in payloads.items()}
            state["exact"] = exact
        known: dict[bytes, bool] = {}
        out: dict[str, list] = {f.name: [] for f in OUT}
        for data in texts:
            lines = (data or b"").split(b"\n")
            kept = []
            for line in lines:
                key = line_key(line)
                if (gone := known.get(key)) is None:
                    gone = frequent(key)
                    if len(known) < HELD_KEYS:
                        known[key] = gone
                if not gone:
                    kept.append(line)
            out["clean_text"].append(b"\n".join(kept).decode("utf-8"))
            out["n_lines"].append(len(lines))
            out["n_dropped"].append(len(lines) - len(kept))
        return out

    return map_text(docs, fn, OUT, text, state=state)


def _asked(lines: DataFrame, filters: DataFrame) -> DataFrame:
    """The lines (a, b, shard, key, nos) that their shard's filter knows. A filter goes to each task that has some of its shard's lines."""
    lines = cut(lines)
    tasks = cut(lines.groupBy("shard").agg(F.ceil(F.count("*") / ASKED_LINES).cast("long").alias("tasks")))
    dealt = lines.join(tasks, "shard").select("shard", F.pmod(F.col("a"), F.col("tasks")).alias("task"), F.lit(None).cast("binary").alias("payload"), "a", "b", "key", "nos")
    heads = filters.join(tasks, "shard").select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1)).alias("task"), "payload")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = None, None
        for batch in batches:
            known = []
            for shard, task, payload, key in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 5))):
                if (shard, task) != at:
                    at, own = (shard, task), None
                if payload is not None:
                    own = CuckooFilter.of(payload)
                known.append(payload is None and own is not None and key in own)
            yield batch.select([3, 4, 5, 6]).filter(pa.array(known, pa.bool_()))

    both = heads.unionByName(dealt, allowMissingColumns=True).select("shard", "task", "payload", "a", "b", "key", "nos")
    placed = both.repartition("shard", "task").sortWithinPartitions("shard", "task", F.col("payload").isNull())
    return placed.mapInArrow(ask, "a long, b string, key binary, nos array<int>")


def _clean_by_join(docs: DataFrame, frequent: DataFrame, filters: DataFrame, text: str, min_chars: int, shards: int) -> DataFrame:
    """The same rows when the frequent keys are too many to broadcast: lines meet their shard's filter, then the exact table by key."""
    new = {f.name for f in OUT}
    mark, gone, rows = unused(docs, "doc"), unused(docs, "nos"), unused(docs, "lines")
    doc = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    marked = docs.withColumn(mark, F.struct(doc.alias("a"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("b")))

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, data = (batch.column(i).to_pylist() for i in range(3))
            for at in range(batch.num_rows):
                keys: dict[bytes, list[int]] = {}
                for no, line in enumerate((data[at] or "").encode().split(b"\n")):
                    key = line_key(line)
                    if long_enough(key, min_chars):
                        keys.setdefault(key_hash(key), []).append(no)
                n = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([a[at]] * n, pa.int64()),
                        pa.array([b[at]] * n, pa.string()),
                        pa.array([shard_of(k, shards) for k in keys], pa.int32()),
                        pa.array(list(keys), pa.binary()),
                        pa.array(list(keys.values()), pa.list_(pa.int32())),
                    ],
                    names=["a", "b", "shard", "key", "nos"],
                )

    texts = marked.select(F.col(mark)["a"].alias("a"), F.col(mark)["b"].alias("b"), F.col(text).alias("text")).dropDuplicates(["a", "b"])
    asked = _asked(texts.mapInArrow(lines, "a long, b string, shard int, key binary, nos array<int>"), filters)
    hits = asked.join(frequent.select("key"), "key", "left_semi")
    dropped = hits.groupBy("a", "b").agg(F.array_sort(F.flatten(F.collect_list("nos"))).alias(gone)).select(F.struct("a", "b").alias(mark), gone)
    joined = marked.join(dropped, mark, "left").withColumn(gone, F.coalesce(gone, F.array().cast("array<int>"))).withColumn(rows, F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1))
    kept = F.expr(rf"array_join(transform(array_except(sequence(0, size({rows}) - 1), {gone}), i -> {rows}[i]), '\n')")
    made = [c for c in docs.columns if c.lower() not in new]
    return joined.select(*[f"`{c}`" for c in made], kept.alias("clean_text"), F.size(rows).cast("long").alias("n_lines"), F.size(gone).cast("long").alias("n_dropped"))


def line_dedup(docs: DataFrame, text: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Index a corpus and clean it by its own index."""
    shards = max(SHARDS, shuffle_parts(docs.sparkSession))
    return clean(docs, line_counts(docs, text, shards, min_chars), text, min_docs, min_chars, shards=shards)
