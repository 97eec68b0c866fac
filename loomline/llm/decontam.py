"""Benchmark decontamination by a generalised suffix automaton of the test items.

The items' normalised words become one automaton. Documents stream through it word
by word; wherever the longest match is as long as a window (eight words, or a
whole shorter item), those words are hit and the items that own the window are
noted. Hit spans are removed, and a document with windows of max_items items or
more is contaminated as a whole.

Only stretches whose word pairs are all pairs of some item run through the
automaton: outside them no match can reach a window's length.

Items of at most BROADCAST_BYTES of text are broadcast as one automaton, which takes
some AUTOMATON_BYTES of memory for each byte. More are dealt over blocks, and texts
come to them: a bitmap of the hashes of the items' windows is broadcast, of a bounded
size whatever the items; the few windows of documents that it knows meet the items'
in a join, which names the blocks that a text has to pass; each block's automaton is
built once a task, and its texts stream through. Both ways give the same rows.

Defined cases: null or empty text has no words and no hits; items without words,
null items and null item ids have no windows; items with equal texts each count, so
there are no ties; repeated rows are judged alike; input columns named like a result
column are replaced; a text of any length passes whole, and an item too; an empty
corpus gives no rows, an empty benchmark no hits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from loomline.llm.automaton import SuffixAutomaton
from loomline.llm.common import column, cut, map_text, slices, unused
from loomline.llm.minhash import WordHashes, mix

WINDOW = 8
MAX_ITEMS = 2
#: Items' text that is broadcast at most, and that one block has of a larger test set; the memory that an automaton takes for each byte.
BROADCAST_BYTES, BLOCK_BYTES, AUTOMATON_BYTES = 2_000_000, 1_000_000, 100
#: The bitmap of window hashes has 16 bits a window, of these powers of two.
LEAST_BITS, MOST_BITS = 20, 29
#: Texts that one task takes past a block's automaton, about.
BLOCK_TEXTS = 20_000

#: Bytes of words: 0-9, a-z and all of multi-byte characters; A-Z is lower-cased, the rest separates.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(data: bytes | None) -> list[bytes]:
    return data.translate(WORDS).split() if data else []


class Items:
    """The automaton of a block of items, and what each of its windows belongs to."""

    PAIR_BITS = 20

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.ids: dict[bytes, int] = {}
        seqs = []
        for item, words in items:
            if words:
                seqs.append((item, [self.ids.setdefault(w, len(self.ids) + 1) for w in words]))
        self.sam = SuffixAutomaton()
        for _, seq in seqs:
            self.sam.add(seq)
        #: Window lengths, and for each the items by the state that holds a window.
        self.owners: dict[int, dict[int, set[str]]] = {}
        for item, seq in seqs:
            n = min(window, len(seq))
            own = self.owners.setdefault(n, {})
            for at, state in enumerate(self.sam.prefixes(seq), 1):
                if at >= n:
                    own.setdefault(self.sam.holding(state, n), set()).add(item)
        self.shortest = min(self.owners, default=0)
        self.pairs = np.zeros(1 << self.PAIR_BITS, bool)
        for _, seq in seqs:
            for a, b in pairwise(seq):
                self.pairs[self._pair(np.int64(a), np.int64(b))] = True

    def _pair(self, a, b):
        return (a * 1_000_003 + b * 7_919) & ((1 << self.PAIR_BITS) - 1)

    def stretches(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Maximal runs [from, to) of known words whose pairs are items' pairs, long enough for a window."""
        if not self.shortest or len(ids) < self.shortest:
            return []
        known = ids > 0
        joined = known[1:] & known[:-1] & self.pairs[self._pair(ids[:-1].astype(np.int64), ids[1:].astype(np.int64))]
        edge = np.diff(np.concatenate(([0], joined.view(np.int8), [0])))
        runs = list(zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) + 1).tolist()))
        if self.shortest == 1:
            alone = known.copy()
            for a, b in runs:
                alone[a:b] = False
            runs = sorted(runs + [(int(a), int(a) + 1) for a in np.flatnonzero(alone)])
        return [(a, b) for a, b in runs if b - a >= self.shortest]

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans [from, to) of hit words, and the items with occurring windows."""
        get = self.ids.get
        ids = np.fromiter((get(w, 0) for w in words), np.int32, len(words))
        spans, items = [], set()
        for a, b in self.stretches(ids):
            for end, (state, length) in enumerate(self.sam.matches(ids[a:b].tolist()), a + 1):
                for n, own in self.owners.items():
                    if length >= n and (found := own.get(self.sam.holding(state, n))):
                        spans.append((end - n, end))
                        items |= found
        return spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def without(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    """data without the bytes from the first to the last byte of each span of words."""
    plain = data.translate(WORDS)
    bounds, at = [], 0
    for w in plain.split():
        at = plain.index(w, at)
        bounds.append((at, at + len(w)))
        at += len(w)
    parts, last = [], 0
    for a, b in spans:
        parts.append(data[last : bounds[a][0]])
        last = bounds[b - 1][1]
    return b"".join([*parts, data[last:]])


OUT = [
    column("n_words", T.LongType()),
    column("n_hit", T.LongType()),
    column("n_items", T.LongType()),
    column("items_sha256", T.StringType()),
    column("contaminated", T.BooleanType()),
    column("clean_text", T.StringType()),
]


def verdict(data: bytes | None, n_words: int, spans: list[tuple[int, int]], items: set[str], max_items: int) -> tuple:
    """The values of OUT."""
    spans = merged(spans)
    named = ",".join(sorted(items))
    clean = (without(data, spans) if spans else data or b"").decode("utf-8")
    return n_words, sum(b - a for a, b in spans), len(items), hashlib.sha256(named.encode()).hexdigest(), len(items) >= max_items, clean


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    max_items: int = MAX_ITEMS,
    block_bytes: int = BLOCK_BYTES,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """docs with hit counts, the contaminated flag and clean_text, the text without its hit spans."""
    items = benchmark.select(F.col(item).cast("string").alias("item"), F.col(item_text).alias("text")).filter("item is not null and text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if total > broadcast_bytes:
        return _by_blocks(docs, items, text, window, max_items, -(-total // block_bytes))
    shared = docs.sparkSession.sparkContext.broadcast([(r["item"], r["text"].encode()) for r in items.collect()])
    state: dict = {}

    def fn(texts: list[bytes | None]) -> dict[str, list]:
        if not state:
            state["items"] = Items([(i, words_of(d)) for i, d in shared.value], window)
        rows = []
        for data in texts:
            words = words_of(data)
            rows.append(verdict(data, len(words), *state["items"].hits(words), max_items))
        return {f.name: list(v) for f, v in zip(OUT, zip(*rows))} if rows else {f.name: [] for f in OUT}

    return map_text(docs, fn, OUT, text, state=state)


def window_hashes(words: list[bytes], n: int, hashes: WordHashes) -> np.ndarray:
    """A 64-bit hash of each n words in a row; n is part of it."""
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if len(w) < n:
        return np.empty(0, np.uint64)
    h = np.full(len(w) - n + 1, n, np.uint64)
    for i in range(n):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + w[i : i + len(h)])
    return h


def _item_windows(items: DataFrame, window: int) -> DataFrame:
    """(hash, block, n), distinct, of (item, text, block)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for data, block in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(data)
                n = min(window, len(words))
                found = np.unique(window_hashes(words, n, hashes)) if n else np.empty(0, np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array([block] * len(found), pa.int64()), pa.array([n] * len(found), pa.int32())], names=["hash", "block", "n"])

    return items.select("text", "block").mapInArrow(run, "hash long, block long, n int").distinct()


def _bitmap(windows: DataFrame, bits: int) -> np.ndarray:
    """2**bits bits, of which those at the first bits of the hashes are set. Its size is bounded by bits."""
    place = F.shiftrightunsigned("hash", 64 - bits)

    def run(table: pa.Table) -> pa.Table:
        part = np.zeros(1 << 16, bool)
        part[np.asarray(table["at"])] = True
        return pa.table({"chunk": pa.array([table["chunk"][0].as_py()], pa.int64()), "part": pa.array([np.packbits(part).tobytes()], pa.binary())})

    parts = windows.select(F.shiftrightunsigned(place, 16).alias("chunk"), place.bitwiseAND(0xFFFF).alias("at")).distinct().groupBy("chunk").applyInArrow(run, "chunk long, part binary")
    made = np.zeros(1 << (bits - 3), np.uint8)
    for r in parts.collect():
        made[r["chunk"] << 13 : (r["chunk"] + 1) << 13] = np.frombuffer(r["part"], np.uint8)
    return made


def _by_blocks(docs: DataFrame, items: DataFrame, text: str, window: int, max_items: int, blocks: int) -> DataFrame:
    """The same for items that are too many to broadcast. Equal texts are one until the end."""
    items = cut(items.withColumn("block", F.pmod(F.xxhash64("text"), F.lit(blocks))))
    windows = cut(_item_windows(items, window))
    lengths = sorted(r["n"] for r in windows.select("n").distinct().collect())  # one to window of them
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * windows.count()).bit_length()))
    shared = docs.sparkSession.sparkContext.broadcast((_bitmap(windows, bits), lengths))
    whole = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(F.xxhash64(whole).alias("a"), F.md5(whole).alias("b"), F.col(text).alias("text")).filter("text is not null")

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (bitmap, lengths), hashes = shared.value, WordHashes()
        for batch in batches:
            for part in slices(batch, 2):
                found = []
                for data in part.column(2).cast(pa.binary()).to_pylist():
                    words = words_of(data)
                    h = np.unique(np.concatenate([window_hashes(words, n, hashes) for n in lengths])) if lengths else np.empty(0, np.uint64)
                    at = h >> np.uint64(64 - bits)
                    found.append(h[bitmap[at >> np.uint64(3)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8)) & 1 > 0].view(np.int64))
                hit = pa.array([len(x) > 0 for x in found], pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, pa.list_(pa.int64()))], names=["a", "b", "hashes"]).filter(hit)

    candidates = texts.mapInArrow(known, "a long, b string, hashes array<long>").dropDuplicates(["a", "b"])
    passing = cut(candidates.select("a", "b", F.explode("hashes").alias("hash")).join(windows.select("hash", "block"), "hash").select("a", "b", "block").distinct())
    tasks = cut(passing.groupBy("block").agg(F.ceil(F.count("*") / BLOCK_TEXTS).cast("long").alias("tasks")))
    wanted = texts.join(passing.select("a", "b").distinct(), ["a", "b"], "left_semi").dropDuplicates(["a", "b"])
    streams = wanted.join(passing, ["a", "b"]).join(tasks, "block").select("block", F.pmod(F.col("a"), F.col("tasks")).alias("task"), F.lit(None).cast("string").alias("item"), "a", "b", "text")
    heads = items.join(tasks, "block").select("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1)).alias("task"), "item", F.lit(None).cast("long").alias("a"), F.lit(None).cast("string").alias("b"), "text")

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, automaton = None, [], None
        for batch in batches:
            out: list[tuple] = []
            rows = zip(*(batch.column(i).to_pylist() for i in range(5)), batch.column(5).cast(pa.binary()).to_pylist())
            for block, task, item, a, b, data in rows:
                if (block, task) != at:
                    at, held, automaton = (block, task), [], None
                if item is not None:
                    held.append((item, words_of(data)))
                    continue
                if automaton is None:
                    automaton, held = Items(held, window), []
                spans, found = automaton.hits(words_of(data))
                if spans:
                    out.append((a, b, [x for span in merged(spans) for x in span], sorted(found)))
            cols = list(zip(*out)) if out else [()] * 4
            kinds = (pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["a", "b", "spans", "items"])

    both = heads.unionByName(streams).repartition("block", "task").sortWithinPartitions("block", "task", F.col("item").isNull())
    hits = both.mapInArrow(match, "a long, b string, spans array<int>, items array<string>")
    listed = hits.groupBy("a", "b").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    key, spans, found = unused(docs, "key"), unused(docs, "spans"), unused(docs, "items")
    listed = listed.select(F.struct("a", "b").alias(key), F.col("spans").alias(spans), F.col("items").alias(found))
    joined = docs.withColumn(key, F.struct(F.xxhash64(whole).alias("a"), F.md5(whole).alias("b"))).join(listed, key, "left").drop(key)
    new = {f.name.lower() for f in OUT}
    kept = [c for c in docs.columns if c.lower() not in new]
    schema = T.StructType([docs.schema[c] for c in kept] + OUT)
    wide = joined.select(*[f"`{c}`" for c in kept], F.col(text).alias(unused(joined, "text")), spans, found)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(kept)
            rows = []
            for data, own, named in zip(batch.column(n).cast(pa.binary()).to_pylist(), batch.column(n + 1).to_pylist(), batch.column(n + 2).to_pylist()):
                own = own or []
                rows.append(verdict(data, len(words_of(data)), list(zip(own[::2], own[1::2])), set(named or ()), max_items))
            cols = list(zip(*rows)) if rows else [()] * len(OUT)
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *(pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(cols, OUT))], names=schema.names)

    return wide.mapInArrow(finish, schema)
