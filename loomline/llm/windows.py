"""Repeated windows of a corpus, found shard by shard.

A window is a fixed number of units (bytes or words) in a row. Each has an anchor:
the least hash among its shorter grams of units. Equal windows have equal anchors,
so they meet in the shard of their anchor, and a run of windows with one anchor
travels as one piece of text. Five steps:

1. scan     each task sends the anchors it saw, once for each bucket of documents;
2. repeated each shard tells the buckets which of their anchors occur twice or more;
3. pieces   buckets send the runs of those anchors, each distinct text once a bucket;
4. resolve  shards find, by the operator's own index, the windows that occur earlier;
5. apply    buckets mark windows of their documents and cut them.

A passage that very many documents share is sent once by each bucket, so a hot group
costs a shard the number of buckets, not of its copies. Buckets and shards are as many
as the session's shuffle partitions, or as it takes for each to have GROUP_BYTES of text;
nothing is collected by the driver. A shard's pieces come to its task one bucket's at a
time; their texts go to a file of the task's past HELD_BYTES, and numbers of some fifty
bytes a piece stay in memory. A bucket and a single text must fit there.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator, Sequence
from contextlib import AbstractContextManager
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from loomline.llm.common import shuffle_parts, unused
from loomline.llm.minhash import mix

#: Anchors that a scanning task holds before it sends them.
HELD_ANCHORS = 500_000
#: Text of a shard's pieces that is held in memory.
HELD_BYTES = 64_000_000
#: Text of a bucket, on average at most.
GROUP_BYTES = 16_000_000
#: The place of a null doc_id in the order: before all others.
NO_ID = np.iinfo(np.int64).min


class Units:
    """How an operator sees a text. Subclasses say what its units are."""

    window: int
    gram: int  # units of an anchor's gram, a power of two
    same_doc = False  # whether windows of the document itself count as earlier

    def read(self, data: bytes) -> tuple[object, np.ndarray]:
        """The text in units, and a 64-bit hash of each."""
        raise NotImplementedError

    def piece(self, units: object, start: int, end: int) -> bytes:
        """The text of units start to end."""
        raise NotImplementedError

    def key(self, units: object, hashes: np.ndarray, start: int, end: int) -> int:
        """64 bits that tell pieces of units start to end apart."""
        return xxhash.xxh3_64_intdigest(self.piece(units, start, end))

    def runs(self, hashes: np.ndarray, twice: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the runs of windows with one anchor, and the anchors.

        twice: give a run whose anchor stands in it more than once two times; windows
        of such a run may be equal.
        """
        n = len(hashes) - self.window + 1
        if n <= 0:
            none = np.empty(0, np.int64)
            return none, none, np.empty(0, np.uint64)
        # Each doubling has a factor of its own, so every unit of a gram has; one mixing at the end makes their order random.
        grams, span = hashes, 1
        while span < self.gram:
            grams = grams[:-span] * np.uint64((0x9E3779B97F4A7C15 * (2 * span + 1) | 1) & 0xFFFFFFFFFFFFFFFF) + grams[span:]
            span *= 2
        grams = mix(grams)
        width, least, have = self.window - self.gram + 1, grams, 1
        while 2 * have <= width:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        if have < width:
            least = np.minimum(least[: have - width], least[width - have :])
        edges = np.flatnonzero(least[1:] != least[:-1]) + 1
        starts, ends = np.concatenate(([0], edges)), np.concatenate((edges, [n]))
        anchors = least[starts]
        if twice:
            spans = ends - starts + width - 1
            offsets = np.cumsum(spans) - spans
            at = np.arange(int(spans.sum())) + np.repeat(starts - offsets, spans)
            count = np.add.reduceat(grams[at] == np.repeat(anchors, spans), offsets, dtype=np.int32)
            both = np.concatenate((np.arange(len(starts)), np.flatnonzero(count > 1)))
            starts, ends, anchors = starts[both], ends[both], anchors[both]
        return starts, ends, anchors


def _ints(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.asarray(column.fill_null(int(NO_ID)) if column.null_count else column, np.int64)


def _joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _scan(units: Units, shards: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        count = 0

        def out() -> Iterator[pa.RecordBatch]:
            found, owner = [], []
            for bucket, parts in held.items():
                values, times = np.unique(np.concatenate(parts), return_counts=True)
                found.append(np.repeat(values, np.minimum(times, 2)))
                owner.append(np.full(len(found[-1]), bucket, np.int32))
            held.clear()
            if not found:
                return
            h, b = np.concatenate(found), np.concatenate(owner)
            shard = (h % np.uint64(shards)).astype(np.int32)
            order = np.argsort(shard, kind="stable")
            h, b, shard = h[order], b[order], shard[order]
            cuts = np.flatnonzero(np.diff(shard)) + 1
            at = np.concatenate(([0], cuts, [len(h)]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shard[at[:-1]], pa.int32()),
                    pa.array([h[i:j].tobytes() for i, j in zip(at, at[1:])], pa.binary()),
                    pa.array([b[i:j].tobytes() for i, j in zip(at, at[1:])], pa.binary()),
                ],
                names=["shard", "anchors", "owners"],
            )

        for batch in batches:
            buckets = batch.column(0).to_pylist()
            for bucket, data in zip(buckets, batch.column(1).cast(pa.binary()).to_pylist()):
                if data:
                    anchors = units.runs(units.read(data)[1], units.same_doc)[2]
                    if len(anchors):
                        held.setdefault(bucket, []).append(anchors)
                        count += len(anchors)
                if count >= HELD_ANCHORS:
                    yield from out()
                    count = 0
        yield from out()

    return run


def _repeated(table: pa.Table) -> pa.Table:
    h, b = _joined(table["anchors"], np.uint64), _joined(table["owners"], np.int32)
    order = np.argsort(h)
    h, b = h[order], b[order]
    same = h[1:] == h[:-1]
    twice = np.concatenate((same, [False])) | np.concatenate(([False], same))
    h, b = h[twice], b[twice]
    order = np.lexsort((h, b))
    h, b = h[order], b[order]
    cuts = np.flatnonzero(np.diff(b)) + 1
    at = np.concatenate(([0], cuts, [len(h)])) if len(h) else np.zeros(1, int)
    return pa.table(
        {
            "bucket": pa.array(b[at[:-1]], pa.int32()),
            "anchors": pa.array([np.unique(h[i:j]).tobytes() for i, j in zip(at, at[1:])], pa.binary()),
        },
    )


class Bucket:
    """Documents of a bucket in their order, with their runs of repeated anchors."""

    def __init__(self, units: Units, docs: pa.Table, anchors: list[bytes]):
        self.units = units
        self.ids = _ints(docs["doc_id"])
        self.order = np.argsort(self.ids, kind="stable")
        self.texts = docs["text"].cast(pa.binary())
        self.anchors = np.sort(np.frombuffer(b"".join(anchors), np.uint64))

    def documents(self) -> Iterator[tuple[int, int, bytes, object, np.ndarray, list[tuple[int, int, int]]]]:
        """(row, doc_id, data, units, their hashes, [(start, end, anchor)])."""
        for row in self.order.tolist():
            data = self.texts[row].as_py() or b""
            units, hashes = self.units.read(data)
            starts, ends, found = self.units.runs(hashes)
            if len(found) and len(self.anchors):
                at = np.minimum(np.searchsorted(self.anchors, found), len(self.anchors) - 1)
                hit = np.flatnonzero(self.anchors[at] == found)
                runs = list(zip(starts[hit].tolist(), ends[hit].tolist(), found[hit].tolist()))
            else:
                runs = []
            yield row, int(self.ids[row]), data, units, hashes, runs


PIECES = "shard int, bucket int, anchors binary, keys binary, docs binary, starts binary, sizes binary, texts binary"


def _pieces(units: Units, shards: int, owner: str) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(docs: pa.Table, repeated: pa.Table) -> pa.Table:
        out: dict[int, tuple[list, ...]] = {}
        if repeated.num_rows and docs.num_rows:
            bucket = Bucket(units, docs, repeated["anchors"].to_pylist())
            seen: set[int] = set()
            for _, doc, _, text, hashes, runs in bucket.documents():
                for start, end, anchor in runs:
                    key = units.key(text, hashes, start, end + units.window - 1)
                    if key not in seen:
                        seen.add(key)
                        a, k, d, s, t = out.setdefault(anchor % shards, ([], [], [], [], []))
                        a.append(anchor)
                        k.append(key)
                        d.append(doc)
                        s.append(start)
                        t.append(units.piece(text, start, end + units.window - 1))
        number = docs[owner][0].as_py() if docs.num_rows else -1
        rows = list(out.items())
        packed = lambda i, kind: pa.array([np.array(v[i], kind).tobytes() for _, v in rows], pa.binary())
        return pa.table(
            {
                "shard": pa.array([k for k, _ in rows], pa.int32()),
                "bucket": pa.array([number] * len(rows), pa.int32()),
                "anchors": packed(0, np.uint64),
                "keys": packed(1, np.uint64),
                "docs": packed(2, np.int64),
                "starts": packed(3, np.int64),
                "sizes": pa.array([np.array([len(t) for t in v[4]], np.int64).tobytes() for _, v in rows], pa.binary()),
                "texts": pa.array([b"".join(v[4]) for _, v in rows], pa.binary()),
            },
        )

    return run


class Texts(Sequence):
    """Pieces of text that lie behind each other in a buffer, in an order of their own; each is read when it is asked for."""

    def __init__(self, buffer: bytes | np.ndarray, begins: np.ndarray, sizes: np.ndarray):
        self.buffer, self.begins, self.sizes = buffer, begins, sizes

    def __len__(self) -> int:
        return len(self.sizes)

    def __getitem__(self, i):
        if isinstance(i, slice):
            return [self[k] for k in range(*i.indices(len(self)))]
        at = int(self.begins[i])
        return bytes(self.buffer[at : at + int(self.sizes[i])])


#: What an operator's index gets and gives while it is open: of pieces sorted by (anchor, doc, start) their anchors, docs,
#: starts, texts and keys; and for each a boolean array over its windows, by number.
Resolver = Callable[[np.ndarray, np.ndarray, np.ndarray, Sequence, np.ndarray], AbstractContextManager[Sequence]]


class Shard:
    """A shard's pieces: some fifty bytes of numbers each in memory, and their texts in memory or, beyond HELD_BYTES, in a file of the task's own."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.blob = bytearray()
        self.folder: tempfile.TemporaryDirectory | None = None

    @property
    def path(self) -> Path:
        return Path(self.folder.name, "pieces")

    def add(self, bucket: int, anchors: bytes, keys: bytes, docs: bytes, starts: bytes, sizes: bytes, texts: bytes) -> None:
        n = len(anchors) // 8
        self.parts.append((np.full(n, bucket, np.int32), *(np.frombuffer(x, k) for x, k in ((anchors, np.uint64), (keys, np.uint64), (docs, np.int64), (starts, np.int64), (sizes, np.int64)))))
        self.blob += texts
        if len(self.blob) > HELD_BYTES:
            self.flush()

    def flush(self) -> None:
        if self.folder is None:
            self.folder = tempfile.TemporaryDirectory()
        with self.path.open("ab") as f:
            f.write(self.blob)
        self.blob = bytearray()

    def settled(self, resolver: Resolver) -> Iterator[pa.RecordBatch]:
        """(bucket, keys, sizes, bits): of each bucket's pieces with windows to cut, which ones."""
        try:
            bucket, anchors, keys, docs, starts, sizes = (np.concatenate(x) for x in zip(*self.parts))
            self.parts = []
            order = np.lexsort((starts, docs, anchors))
            begins = (np.cumsum(sizes) - sizes)[order]
            bucket, anchors, keys, docs, starts, sizes = (x[order] for x in (bucket, anchors, keys, docs, starts, sizes))
            if self.folder is not None:
                self.flush()
            buffer = self.blob if self.folder is None else np.memmap(self.path, np.uint8, "r")
            with resolver(anchors, docs, starts, Texts(buffer, begins, sizes), keys) as found:
                by = np.argsort(bucket, kind="stable")
                for part in np.split(by, np.flatnonzero(np.diff(bucket[by])) + 1) if len(by) else []:
                    some, bits = [], []
                    for i in part.tolist():
                        if (windows := found[i]).any():
                            some.append(i)
                            bits.append(windows)
                    row = (int(bucket[part[0]]), keys[some].tobytes(), np.array([len(x) for x in bits], np.int64).tobytes(), np.packbits(np.concatenate(bits)).tobytes() if some else b"")
                    yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, (pa.int32(), pa.binary(), pa.binary(), pa.binary()))], names=["bucket", "keys", "sizes", "bits"])
        finally:
            if self.folder is not None:
                self.folder.cleanup()


def _resolve(resolver: Resolver) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of PIECES, a shard's together, one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, Shard()
        for batch in batches:
            for i in range(batch.num_rows):
                shard, bucket, anchors, keys, docs, starts, sizes, texts = (batch.column(k)[i].as_py() for k in range(8))
                if shard != at:
                    if at is not None:
                        yield from held.settled(resolver)
                    at, held = shard, Shard()
                held.add(bucket, anchors, keys, docs, starts, sizes, texts)
        if at is not None:
            yield from held.settled(resolver)

    return run


#: Makes the result of a document: (data, units, removed boolean a unit) -> values of the new columns.
Finish = Callable[[bytes, object, np.ndarray], tuple]


def covered(windows: np.ndarray, window: int) -> np.ndarray:
    """Units inside a marked window."""
    sums = np.concatenate(([0], np.cumsum(windows)))
    at = np.arange(len(windows) + window - 1)
    return sums[np.minimum(at + 1, len(windows))] > sums[np.maximum(at - window + 1, 0)]


def _apply(units: Units, finish: Finish, schema: pa.Schema, new: list[str]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        anchors = [x for x in told["anchors"].to_pylist() if x is not None]
        verdicts: dict[int, np.ndarray] = {}
        for keys, sizes, bits in zip(told["keys"].to_pylist(), told["sizes"].to_pylist(), told["bits"].to_pylist()):
            if keys:
                n = np.frombuffer(sizes, np.int64)
                all_bits = np.unpackbits(np.frombuffer(bits, np.uint8), count=int(n.sum())).view(bool)
                verdicts.update(zip(np.frombuffer(keys, np.uint64).tolist(), np.split(all_bits, np.cumsum(n)[:-1])))
        out: list = [None] * docs.num_rows
        first: dict[int, tuple[int, int]] = {}
        for row, doc, data, text, hashes, runs in Bucket(units, docs, anchors).documents():
            count = len(hashes)
            removed = np.zeros(count, bool)
            if runs:
                marked = np.zeros(count - units.window + 1, bool)
                for start, end, _ in runs:
                    key = units.key(text, hashes, start, end + units.window - 1)
                    at = first.setdefault(key, (doc, start))
                    if doc != at[0] or units.same_doc and start != at[1]:
                        marked[start:end] = True  # an equal piece came before in this bucket
                    elif (verdict := verdicts.get(key)) is not None:
                        marked[start:end] = verdict
                removed = covered(marked, units.window)
            out[row] = finish(data, text, removed)
        made = [docs[name] for name in schema.names if name not in new]
        values = list(zip(*out)) if out else [()] * len(new)
        return pa.Table.from_arrays([*made, *(pa.array(v, schema.field(n).type) for n, v in zip(new, values))], schema=schema)

    return run


def cut_repeats(docs: DataFrame, units: Units, resolver: Resolver, finish: Finish, fields: list[T.StructField], doc: str, text: str) -> DataFrame:
    """docs with fields: each text without the windows that occur earlier."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = max(shuffle_parts(docs.sparkSession), -(-total // GROUP_BYTES))
    new = [f.name for f in fields]
    owner = unused(docs, "bucket")
    kept = [c for c in docs.columns if c.lower() not in {*(n.lower() for n in new), "doc_id", "text"}]
    named = docs.select(
        F.pmod(F.xxhash64(F.col(doc)), F.lit(parts)).cast("int").alias(owner),
        F.col(doc).cast("long").alias("doc_id"),
        F.col(text).alias("text"),
        *[F.col(f"`{c}`") for c in kept],
    )
    anchors = named.select(owner, "text").mapInArrow(_scan(units, parts), "shard int, anchors binary, owners binary")
    repeated = anchors.groupBy("shard").applyInArrow(_repeated, "bucket int, anchors binary")
    by_bucket = named.groupBy(owner)
    pieces = by_bucket.cogroup(repeated.groupBy("bucket")).applyInArrow(_pieces(units, parts, owner), PIECES)
    found = pieces.repartition("shard").sortWithinPartitions("shard", "bucket").mapInArrow(_resolve(resolver), "bucket int, keys binary, sizes binary, bits binary")
    none = F.lit(None).cast("binary")
    told = repeated.select("bucket", "anchors", none.alias("keys"), none.alias("sizes"), none.alias("bits")).unionByName(found.select("bucket", none.alias("anchors"), "keys", "sizes", "bits"))
    schema = T.StructType([named.schema[c] for c in ("doc_id", "text", *kept)] + fields)
    return by_bucket.cogroup(told.groupBy("bucket")).applyInArrow(_apply(units, finish, to_arrow_schema(schema), new), schema)
