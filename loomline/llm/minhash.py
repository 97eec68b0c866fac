"""Near-duplicate documents by HyperMinHash sketches, confirmed on full shingle sets.

Each document's shingles fall into 128 buckets by hash; a bucket keeps the leading
zeros and ten mantissa bits of its least hash, two bytes in all. Empty buckets of a
small set borrow by a fixed preference among the full ones. Bands of four registers
are hashed; documents with an equal band are candidates, their Jaccard similarity is
estimated from equal registers less those expected by chance, and pairs that may
reach the threshold are compared on their full sets.

Documents with one and the same set are one node. Candidates aren't all pairs of a
band: each node is compared with the band's least node first; components of the
confirmed links follow. Only where a band's nodes still stand in different
components, those outside the band's largest component are compared with all that
the estimate allows, in blocks of a bounded size. A block's intersections are counted
from what each set has other than most of the block's, so a pair of near copies costs
some nanoseconds; links so found are confirmed on full sets. Bands with one and the
same largest component, as near copies have them by the dozen, are put together
where that makes fewer pairs. A band with many nodes outside is split where that
makes fewer rows than blocks: two sets that reach the threshold share one of the
first shingles of each, by rarity in the band, so only nodes that share such a
shingle meet. No link between components is lost within a band; nodes outside a
component of near copies still meet each of it, once and by the cheap count.
Bands miss a pair at the threshold with probability
under 1e-7 where both sets fill the registers. Registers of smaller sets are borrowed
and their estimates wider, so such candidates are compared on full sets at once.

Defined cases: null or empty text has no shingles, is its own component and kept; a
text with fewer words than a shingle has its whole sequence as one shingle; repeated
rows share a component; a null doc_id is never a component's id unless all are null;
ties have no say, since all that link are one component; other columns of docs aren't
read, so none can clash; texts of any length are read whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.llm.common import column, cut, map_text
from loomline.llm.components import components

SHINGLE = 5
SIMILARITY = 80
REGISTERS = 128
BAND = 4
MANTISSA = 10
#: Standard errors that an estimate may lie below the threshold.
ERRORS = 5
#: Nodes on either side of a task's block of comparisons.
BLOCK = 500
#: Nodes outside a band's largest component above which the band may be split by rare shingles.
SPLIT = 500
#: Rows of single shingles that cost about as much as a row of a block, which holds a text.
SHINGLES_A_ROW = 4
#: Bytes of registers, or entries of sets, that are compared at once.
AT_ONCE = 1 << 22
#: Parts that the join of bands with their least nodes is dealt in beside the band itself.
SALTS = 16
#: Nodes whose ids are broadcast to fetch their texts at most (some 100 bytes each).
BROADCAST_NODES = 500_000
#: Words whose hash a task remembers.
WORDS_HELD = 400_000

_PREFERENCE = np.random.default_rng(20_231).permuted(np.tile(np.arange(REGISTERS, dtype=np.int32), (REGISTERS, 1)), axis=1)


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_HELD:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(words: list[bytes], k: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a document's k-word shingles."""
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(w) - k + 1)
    h = np.zeros(n, np.uint64)
    for i in range(min(k, len(w))):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + w[i : i + n])
    return np.unique(h)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Registers of a set: leading zeros above ten bits of mantissa."""
    bucket = (hashes & np.uint64(REGISTERS - 1)).astype(np.intp)
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, bucket, hashes >> np.uint64(11))  # 53 bits, exact as floats
    full = np.flatnonzero(least != np.iinfo(np.uint64).max)
    low = least[full]
    bits = np.frexp(low.astype(np.float64))[1].astype(np.int64)
    shift = bits - 1 - MANTISSA
    mantissa = np.where(shift >= 0, low >> np.maximum(shift, 0).astype(np.uint64), low << np.maximum(-shift, 0).astype(np.uint64)) & np.uint64((1 << MANTISSA) - 1)
    registers = np.zeros(REGISTERS, np.uint16)
    registers[full] = ((53 - bits) << MANTISSA).astype(np.uint16) | mantissa.astype(np.uint16)
    if len(full) < REGISTERS:
        empty = np.setdiff1d(np.arange(REGISTERS), full)
        registers[empty] = registers[full[_PREFERENCE[np.ix_(empty, full)].argmin(axis=1)]]
    return registers


def mass(n: np.ndarray) -> np.ndarray:
    """Probabilities of a register's leading zeros in sets of n elements, along a new last axis."""
    at = np.arange(0, 40, dtype=np.float64)
    x = np.maximum(1.0, np.asarray(n, np.float64) / REGISTERS)[..., None]
    return (1 - 2.0 ** -(at + 1)) ** x - (1 - 2.0**-at) ** x


def chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Probability that registers of disjoint sets of n and m elements are equal."""
    return (mass(n) * mass(m)).sum(-1) / 2**MANTISSA


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity from registers, corrected for equality by chance."""
    equal = (a == b).mean(-1)
    by_chance = chance(n, m)
    return np.clip((equal - by_chance) / (1 - by_chance), 0, 1)


def least_estimate(similarity: int) -> float:
    j = similarity / 100
    return j - ERRORS * (j * (1 - j) / REGISTERS) ** 0.5


NODE = [column("digest", T.BinaryType()), column("n_shingles", T.LongType()), column("sketch", T.BinaryType())]


def words_of(data: bytes | None) -> list[bytes]:
    """ASCII lower-cased words between white space."""
    return data.lower().split() if data else []


def sketches(docs: DataFrame, doc: str, text: str, shingle: int) -> DataFrame:
    """(doc_id, text_hash, digest, n_shingles, sketch); the digest of the set is null with the sketch where it is empty."""

    def fn(texts: list[bytes | None]) -> dict[str, list]:
        hashes = WordHashes()
        out: dict[str, list] = {f.name: [] for f in NODE}
        for data in texts:
            h = shingle_hashes(words_of(data), shingle, hashes)
            out["n_shingles"].append(len(h))
            out["digest"].append(xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None)
            out["sketch"].append(sketch(h).tobytes() if len(h) else None)
        return out

    named = docs.select(F.col(doc).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text"))
    return map_text(named, fn, NODE, "text", ["doc_id", "text_hash"])


def bands(nodes: DataFrame) -> DataFrame:
    count = REGISTERS // BAND
    keys = F.expr(f"transform(sequence(0, {count - 1}), i -> xxhash64(substring(sketch, i * {2 * BAND} + 1, {2 * BAND}), i))")
    return nodes.select("node", F.posexplode(keys).alias("number", "band"))


def may_link(pairs: DataFrame, nodes: DataFrame, similarity: int) -> DataFrame:
    """Pairs (a, b) whose estimate leaves the threshold possible."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("sketch").alias(f"s{x}"), F.col("n_shingles").alias(f"n{x}"))
    least = least_estimate(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.stack([np.frombuffer(x, np.uint16) for x in batch.column(i).to_pylist()]) for i in (2, 3))
                n, m = batch.column(4).to_numpy(), batch.column(5).to_numpy()
                good = (estimate(a, b, n, m) >= least) | (np.minimum(n, m) < REGISTERS)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good))

    joined = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "sa", "sb", "na", "nb")
    return joined.mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: int) -> DataFrame:
    """Pairs whose full shingle sets reach the threshold. texts: (node, packed), a row for each node that pairs name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress

        def shingles(packed: bytes) -> set:
            w = words_of(unpack(packed))
            return set(zip(*(w[i:] for i in range(shingle)))) if len(w) >= shingle else {tuple(w)}

        last: tuple = (None, None)
        for batch in batches:
            good = []
            for a, ta, tb in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
                if last[0] != a:
                    last = (a, shingles(ta.as_py()))
                x, y = last[1], shingles(tb.as_py())
                both = len(x & y)
                good.append(100 * both >= similarity * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    side = lambda x: texts.select(F.col("node").alias(x), F.col("packed").alias(f"t{x}"))
    joined = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "ta", "tb")
    return joined.mapInArrow(run, "a long, b long")


def packed_texts(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(node, packed): a compressed text of each wanted (node, digest, first_id).

    docs has (doc_id, text). Few enough wanted nodes are broadcast; more are joined.
    A repeated doc_id may have other texts too, so the digest decides.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, pack = WordHashes(), zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            nodes, packed = [], []
            for node, digest, data in zip(*(batch.column(i).to_pylist() for i in (0, 1)), batch.column(2).cast(pa.binary()).to_pylist()):
                if xxhash.xxh3_128_digest(shingle_hashes(words_of(data), shingle, hashes).tobytes()) == digest:
                    nodes.append(node)
                    packed.append(pack(data))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(packed, pa.binary())], names=["node", "packed"])

    if wanted.limit(BROADCAST_NODES + 1).count() <= BROADCAST_NODES:
        wanted = F.broadcast(wanted)
    found = docs.join(wanted, F.expr("doc_id <=> first_id")).select("node", "digest", "text")
    return found.mapInArrow(run, "node long, packed binary").dropDuplicates(["node"])


def shared_counts(sets: list[np.ndarray], rows: Iterable[int]) -> Iterator[np.ndarray]:
    """For each of rows, the sizes of its set's intersections with all sets; each set's items are distinct.

    Items that most sets have are counted where they lack, the others where they are.
    The sizes of two sets' differences from the set of those items, and of what these
    have in common, give the sizes of intersections.
    """
    m, size = len(sets), np.array([len(x) for x in sets])
    _, item, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(m, dtype=np.int32), size)
    most = 2 * count > m
    number = np.cumsum(most) - 1
    held = most[item]
    lacking = np.ones((int(most.sum()), m), bool)  # no more than twice the entries, as each has a row for half the sets
    lacking[number[item[held]], owner[held]] = False
    differs = lacking.sum(0) + np.bincount(owner[~held], minlength=m)
    lacked, lacker = np.nonzero(lacking)
    met = ~held & (count[item] > 1)
    items = np.concatenate([item[met], np.flatnonzero(most)[lacked]])
    owners = np.concatenate([owner[met], lacker.astype(np.int32)])
    by_item, by_owner = owners[np.argsort(items, kind="stable")], items[np.argsort(owners, kind="stable")]
    length = np.bincount(items, minlength=len(count))
    start, own = np.cumsum(length) - length, np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=m))])
    for i in rows:
        mine, common = by_owner[own[i] : own[i + 1]], np.zeros(m, np.int64)
        for some in np.array_split(mine, 1 + int(length[mine].sum()) // AT_ONCE):
            n = length[some]
            places = np.repeat(start[some] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            common += np.bincount(by_item[places], minlength=m)
        common[i] = differs[i]
        yield (size + size[i] - (differs + differs[i] - 2 * common)) // 2


def settled_links(rows: DataFrame, shingle: int, similarity: int) -> DataFrame:
    """Confirmed links between components of one block of a band, as many as join them.

    rows: (band, number, block, outside, node, root, sketch, n_shingles, packed), blocks
    together and sorted. Each node outside the band's largest component meets the
    nodes of other components that the estimate allows. Their intersections are counted
    by hashes of shingles; one link to a component, confirmed on full sets, is enough.
    Two nodes are compared only in the first band that they share.
    """
    least = least_estimate(similarity)

    def candidates(number: int, regs: np.ndarray, sizes: np.ndarray, comp: np.ndarray, outside: np.ndarray, across: np.ndarray) -> np.ndarray:
        """Whether each node outside (a row) is to be compared with each node (a column)."""
        whole, by_zeros = regs.view(np.uint64)[:, :number], mass(sizes)  # the bands before this one, a band in eight bytes
        found = np.zeros((len(outside), len(sizes)), bool)
        step = max(1, AT_ONCE // (2 * REGISTERS * len(sizes)))
        for k in range(0, len(outside), step):
            some = outside[k : k + step]
            smaller = np.minimum.outer(sizes[some], sizes)
            able = (comp[some][:, None] != comp) & across & (100 * smaller >= similarity * np.maximum.outer(sizes[some], sizes))
            x, y = np.nonzero(able)
            if number and len(x):
                new = ~(whole[some[x]] == whole[y]).any(1)
                x, y = x[new], y[new]
            by_chance = (by_zeros[some] @ by_zeros.T)[x, y] / 2**MANTISSA
            est = ((regs[some[x]] == regs[y]).mean(1) - by_chance) / (1 - by_chance)
            near = (est >= least) | (smaller[x, y] < REGISTERS)
            found[k + x[near], y[near]] = True
        return found

    def compare(number: int, block: int, group: list[tuple]) -> Iterator[pa.RecordBatch]:
        outside = np.flatnonzero([bool(r[0]) for r in group])
        if not len(outside) or len(group) < 2:
            return
        regs = np.stack([np.frombuffer(r[3], np.uint16) for r in group])
        sizes = np.array([r[4] for r in group])
        _, comp = np.unique([r[2] for r in group], return_inverse=True)
        # In a block of kind 2 the nodes outside have met each other elsewhere.
        across = ~np.array([bool(r[0]) for r in group]) if block >> 60 == 2 else np.ones(len(group), bool)
        able = candidates(number, regs, sizes, comp, outside, across)
        meets = able.any(1)
        outside, able = outside[meets], able[meets]
        if not len(outside):
            return
        unpack, hashes = zstandard.ZstdDecompressor().decompress, WordHashes()

        def shingles(i: int) -> set:
            w = words_of(unpack(group[i][5]))
            return set(zip(*(w[k:] for k in range(shingle)))) if len(w) >= shingle else {tuple(w)}

        used = np.union1d(outside, np.flatnonzero(able.any(0)))
        able, sizes, comp = able[:, used], sizes[used], comp[used]
        sets = [shingle_hashes(words_of(unpack(group[i][5])), shingle, hashes) for i in used.tolist()]
        places = np.searchsorted(used, outside).tolist()
        a, b = [], []
        for i, can, both in zip(places, able, shared_counts(sets, places)):
            x = None
            for j in np.flatnonzero(can & (100 * both >= similarity * (sizes + sizes[i] - both))).tolist():
                if comp[j] == comp[i]:
                    continue
                x = shingles(used[i]) if x is None else x
                y = shingles(used[j])
                both = len(x & y)
                if 100 * both >= similarity * (len(x) + len(y) - both):
                    comp[comp == comp[j]] = comp[i]
                    a.append(group[used[i]][1])
                    b.append(group[used[j]][1])
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, group = None, []
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            for row in zip(*cols):
                if row[:3] != at:
                    if at is not None:
                        yield from compare(at[1], at[2], group)
                    at, group = row[:3], []
                group.append(row[3:])
        if at is not None:
            yield from compare(at[1], at[2], group)

    return rows.mapInArrow(run, "a long, b long")


def _mixed(rooted: DataFrame) -> DataFrame:
    """Bands that hold several components, with the largest one. Counts are aggregated before the shuffle."""
    held = rooted.groupBy("band", "root").agg(F.count("*").alias("n"))
    return held.groupBy("band").agg(F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("all"), F.count("*").alias("roots")).filter("roots > 1 and all > 2")


def _gathered(rooted: DataFrame, mixed: DataFrame) -> DataFrame:
    """rooted's mixed bands, those with one largest component put together as a band 0 where that makes fewer pairs."""
    at = rooted.join(mixed.select("band", F.col("top.root").alias("largest")), "band")
    apart = mixed.groupBy(F.col("top.root").alias("largest")).agg(F.sum(F.expr("(all - top.n) * all")).alias("pairs"))
    members = cut(at.select("largest", "node", "root").distinct())
    whole = members.groupBy("largest").agg(F.count("*").alias("n"), F.count_if(F.col("root") != F.col("largest")).alias("outside"))
    chosen = cut(whole.join(apart, "largest").filter("outside * n < pairs").select("largest"))
    together = members.join(chosen, "largest").select(F.xxhash64("largest", F.lit("largest")).alias("band"), F.lit(0).alias("number"), "node", "root")
    return at.join(chosen, "largest", "left_anti").select("band", "number", "node", "root").unionByName(together)


def _crowds(rooted: DataFrame, mixed: DataFrame, nodes: DataFrame) -> DataFrame:
    """Bands with many nodes outside whose shingles are fewer rows, by their cost, than their blocks."""
    outer, inner = f"ceil((all - top.n) / {BLOCK})", f"ceil(top.n / {BLOCK})"
    rows = F.expr(f"(all - top.n) * ({outer} + {inner}) + top.n * {outer}")
    many = mixed.filter(f"all - top.n > {SPLIT}").select("band", rows.alias("rows"))
    shingles = rooted.join(many, "band").join(nodes.select("node", "n_shingles"), "node").groupBy("band").agg(F.sum("n_shingles").alias("shingles"), F.first("rows").alias("rows"))
    return shingles.filter(F.col("shingles") < SHINGLES_A_ROW * F.col("rows")).select("band")


def _dealt(rooted: DataFrame, mixed: DataFrame) -> DataFrame:
    """(band, number, node, root, outside, block): each node outside the largest component meets every other node of the band in one block.

    Nodes outside are cut into parts, the largest component into others. A block is
    the whole band if it is small (kind 0), two parts of those outside (1), or a part
    of them and one of the largest component (2).
    """
    parts = mixed.select(
        "band",
        F.col("top.root").alias("top"),
        F.col("all").alias("size"),
        F.greatest(F.lit(1), F.ceil((F.col("all") - F.col("top.n")) / BLOCK)).cast("long").alias("outer"),
        F.greatest(F.lit(1), F.ceil(F.col("top.n") / BLOCK)).cast("long").alias("inner"),
    )
    placed = rooted.join(parts, "band").withColumn("outside", F.col("root") != F.col("top"))
    key = "cast({} as long) * 1152921504606846976L + {} * 1073741824L + {}"
    own = "pmod(xxhash64(node), {})"
    blocks = F.expr(
        f"case when size <= {BLOCK} then array(0L)"
        f" when outside then concat(transform(sequence(0L, outer - 1), j -> {key.format(1, f'least(j, {own.format("outer")})', f'greatest(j, {own.format("outer")})')}),"
        f" transform(sequence(0L, inner - 1), j -> {key.format(2, own.format('outer'), 'j')}))"
        f" else transform(sequence(0L, outer - 1), j -> {key.format(2, 'j', own.format('inner'))}) end"
    )
    return placed.select("band", "number", "node", "root", "outside", F.explode(blocks).alias("block"))


def _split(rooted: DataFrame, texts: DataFrame, shingle: int, similarity: int) -> DataFrame:
    """rooted with a band for each rare shingle that nodes of a band share.

    Of a set of n shingles, all but similarity percent and one more come first by
    rarity in the band. If two sets share none of those, they can't reach the threshold.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, hashes = zstandard.ZstdDecompressor().decompress, WordHashes()
        for batch in batches:
            found = [shingle_hashes(words_of(unpack(x.as_py())), shingle, hashes).view(np.int64) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["node", "shingles"])

    members = cut(rooted)
    sets = texts.join(members.select("node").distinct(), "node", "left_semi").select("node", "packed").mapInArrow(run, "node long, shingles array<long>")
    rows = cut(members.join(sets, "node").select("band", "number", "node", "root", F.explode("shingles").alias("shingle")))
    often = rows.groupBy("band", "shingle").agg(F.count("*").alias("n"))
    listed = rows.join(often, ["band", "shingle"]).groupBy("band", "number", "node", "root").agg(F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("ranked"))
    first = listed.withColumn("ranked", F.expr(f"slice(ranked, 1, size(ranked) - cast(ceil(size(ranked) * {similarity} / 100) as int) + 1)"))
    shared = first.select("band", "number", "node", "root", F.explode("ranked").alias("r")).filter("r.n > 1")
    return shared.select(F.xxhash64("band", "r.shingle").alias("band"), "number", "node", "root")


def _blocks(banded: DataFrame, nodes: DataFrame, links: DataFrame, texts: DataFrame, shingle: int, similarity: int) -> DataFrame:
    """Bands that still hold several components, as settled_links takes them."""
    rooted = cut(banded.join(links, "node", "left").select("band", "number", "node", F.coalesce("root", "node").alias("root")))
    rooted = cut(_gathered(rooted, cut(_mixed(rooted))))
    mixed = cut(_mixed(rooted))
    dealt = _dealt(rooted, mixed)
    if not mixed.filter(f"all - top.n > {SPLIT}").isEmpty() and not (crowds := cut(_crowds(rooted, mixed, nodes))).isEmpty():
        finer = cut(_split(rooted.join(crowds, "band", "left_semi"), texts, shingle, similarity))
        dealt = _dealt(rooted, mixed.join(crowds, "band", "left_anti")).unionByName(_dealt(finer, _mixed(finer)))
    full = dealt.join(nodes.select("node", "sketch", "n_shingles"), "node").join(texts, "node")
    wanted = full.select("band", "number", "block", "outside", "node", "root", "sketch", "n_shingles", "packed")
    return wanted.repartition("band", "block").sortWithinPartitions("band", "number", "block", "node")


def near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text", shingle: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_hash, group_id), a row for each row of docs.

    Where doc_ids repeat, text_hash, the xxhash64 of the text, tells their rows apart, and
    group_id their components; it is null for empty sets and differs from run to run.
    """
    made = cut(sketches(docs, doc, text, shingle))
    sets = made.filter("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.first("sketch").alias("sketch"), F.first("n_shingles").alias("n_shingles"))
    # The cut table has its rows in fixed places, so these numbers are the same whenever they are made.
    nodes = cut(sets).withColumn("node", F.monotonically_increasing_id())
    # A smaller set than this reaches the threshold with its equal alone, which is the same node.
    banded = bands(nodes.filter(F.col("n_shingles") * (100 - similarity) >= similarity))
    heads = banded.groupBy("band").agg(F.min("node").alias("head"), F.count("*").alias("n")).filter("n > 1")
    # A band that very many nodes have is dealt in parts; its least node goes to each.
    salted = heads.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    shared = cut(banded.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(salted, ["band", "salt"]).drop("salt"))
    pairs = shared.filter("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    wanted = nodes.select("node", "digest", "first_id").join(shared.select("node").distinct(), "node")
    texts = cut(packed_texts(docs.select(F.col(doc).alias("doc_id"), F.col(text).alias("text")), wanted, shingle))

    def link(pairs: DataFrame) -> DataFrame:
        return cut(confirmed(may_link(pairs, nodes, similarity), texts, shingle, similarity))

    links = link(pairs)
    roots = cut(components(links))
    crowded = shared.filter("n > 2").select("band", "number", "node")
    more = cut(settled_links(_blocks(crowded, nodes, roots, texts, shingle, similarity), shingle, similarity).distinct())
    if not more.isEmpty():
        roots = cut(components(links.unionByName(more)))
    of_node = nodes.select("node", "digest", "first_id").join(roots, "node", "left").select("digest", "first_id", F.coalesce("root", "node").alias("root"))
    ids = of_node.groupBy("root").agg(F.min("first_id").alias("component_id"))
    component = of_node.join(ids, "root").select("digest", "component_id", F.col("root").alias("group_id"))
    out = made.select("doc_id", "text_hash", "digest", "n_shingles").join(component, "digest", "left")
    alone = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", alone.alias("component_id"), alone.eqNullSafe(F.col("doc_id")).alias("kept"), "text_hash", "group_id")
