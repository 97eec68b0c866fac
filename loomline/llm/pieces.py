"""SentencePiece encoding to n-best segmentations, and decoding.

A text becomes units: a run of the space mark and the characters up to the next one.
No piece of a vocabulary crosses a unit, and characters that no piece has are units
of their own, so a text's lattice is a chain of its units' lattices. In each,
forward Viterbi scores are the exact heuristics of an A* search backward from the
end, which pops segmentations from best to worst. The n best of a text combine the
n best of its units; only the n - 1 units that lose least by their second best can
differ from the best, so the others are left alone.

Characters without a piece cost UNKNOWN below the lowest score and encode as bytes,
or as the unknown piece where the vocabulary has no bytes.

Defined cases: null is null throughout; an empty text has no pieces, score 0 and one
segmentation; ties go to the longer last piece, then the earlier unit; the space
mark in a text decodes as a space; repeated rows are encoded alike; an empty table
gives no rows; input columns named like a result column are replaced; a very long
text without spaces is one unit, and takes time and memory in proportion to its length.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import partial
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from loomline.llm.common import column, map_text
from loomline.llm.minhash import mix

#: The vocabulary where neither a call nor the session's spark.loomline.pieces.model names one.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BEST = 4
MARK = "▁"
UNKNOWN = 10.0
#: Units, and characters of them, that a task remembers.
UNITS_HELD, CHARS_HELD = 150_000, 4_000_000


class Vocabulary:
    """Pieces, scores and bytes of a SentencePiece model. How it was trained doesn't matter: scores are log weights of a path."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(sp.get_piece_size())
        plain = [i for i in ids if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.pieces = {sp.id_to_piece(i): (i, sp.get_score(i)) for i in plain}
        self.longest = max(map(len, self.pieces))
        self.bytes = {int(sp.id_to_piece(i)[3:-1], 16): i for i in ids if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        self.penalty = min(s for _, s in self.pieces.values()) - UNKNOWN
        #: Every start of a piece; the whole ones with ids and score.
        self.starts: dict[str, tuple] = {p[:n]: () for p in self.pieces for n in range(1, len(p))}
        self.starts |= {p: ((i,), s) for p, (i, s) in self.pieces.items()}
        if any(MARK in p.lstrip(MARK) for p in self.pieces):
            raise ValueError("a piece crosses a space mark")
        known = "".join(re.escape(c) for c in sorted({c for p in self.pieces for c in p} - {MARK}))
        #: A run of marks with the known characters behind it, such a run alone, or one unknown character.
        self.unit = re.compile(f"{MARK}*[{known}]+|{MARK}+|(?s:.)")
        self.out = {i: p.replace(MARK, " ").encode() for p, (i, _) in self.pieces.items()}
        self.out |= {i: bytes([b]) for b, i in self.bytes.items()} | {self.unknown: " ⁇ ".encode()}

    def units(self, text: str) -> list[str]:
        return self.unit.findall(MARK + text.replace(" ", MARK)) if text else []

    def edges(self, unit: str) -> list[tuple[int, int, tuple[int, ...], float]]:
        """(start, end, ids, score) by start, then end."""
        out = []
        size, starts = len(unit), self.starts
        for i in range(size):
            for j in range(i + 1, size + 1):
                found = starts.get(unit[i:j])
                if found is None:
                    break
                if found:
                    out.append((i, j, *found))
            if unit[i] not in self.pieces:
                ids = tuple(self.bytes[b] for b in unit[i].encode()) if self.bytes else (self.unknown,)
                out.append((i, i + 1, ids, self.penalty))
        return out

    def into(self, unit: str, end: int) -> Iterator[tuple[int, tuple[int, ...], float]]:
        """(start, ids, score) of the edges that end at a place, longest first."""
        for start in range(max(0, end - self.longest), end):
            if (found := self.pieces.get(unit[start:end])) is not None:
                yield start, (found[0],), found[1]
        if unit[end - 1] not in self.pieces:
            yield end - 1, tuple(self.bytes[b] for b in unit[end - 1].encode()) if self.bytes else (self.unknown,), self.penalty

    def decode(self, ids: Iterable[int]) -> bytes:
        data = b"".join(map(self.out.__getitem__, ids))
        return data[1:] if data[:1] == b" " else data


def forward(edges: list[tuple], size: int) -> list[float]:
    """Best score up to each place."""
    best = [0.0] + [float("-inf")] * size
    for i, j, _, score in edges:
        if (total := best[i] + score) > best[j]:
            best[j] = total
    return best


def backward(into: Callable[[int], Iterator[tuple]], best: Sequence[float], n: int) -> Iterator[tuple[float, list[int]]]:
    """The n best segmentations from best to worst by A* from the end: what is left to the start costs best exactly.

    into gives (start, ids, score) of the edges that end at a place. Since the heuristic
    is exact, each open state stands for a segmentation of its own with that very
    score, so only as many states as segmentations are still wanted stay open. A state
    points to the one that it came from; ids are put together for the winners alone.
    """
    open_: list[tuple] = [(-best[-1], 0, len(best) - 1, 0.0, None)]
    made = 0
    while open_ and n:
        total, _, at, behind, came = heapq.heappop(open_)
        if at == 0:
            n -= 1
            ids: list[int] = []
            while came is not None:
                ids += came[0]
                came = came[1]
            yield -total, ids
            continue
        for start, piece, score in into(at):
            made += 1
            heapq.heappush(open_, (-(best[start] + score + behind), made, start, score + behind, (piece, came)))
        if len(open_) > n:
            open_ = heapq.nsmallest(n, open_)


class Batch:
    """The forward and backward scores of many units at a time.

    Units stand one behind the other; hashes of their substrings are looked up among
    the pieces' for one length after the other, and the scores advance by places.
    """

    BASE = np.uint64(0x9E3779B97F4A7C15)
    BITS = 20
    LONGEST_UNIT = 48
    BLOCK = 1 << 15

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        names = list(vocabulary.pieces)
        self.longest = vocabulary.longest
        self.powers = self.BASE ** np.arange(self.longest + 1, dtype=np.uint64)
        chars = np.frombuffer("".join(names).encode("utf-32-le"), np.uint32)
        sizes = np.array([len(n) for n in names])
        ends = np.cumsum(sizes)
        sums = self._sums(chars)
        hashes = sums[ends] - sums[ends - sizes] * self.powers[sizes]
        self.keys = np.zeros(1 << self.BITS, np.uint64)
        self.piece = np.full(1 << self.BITS, -1, np.int32)
        for h, name in zip(hashes.tolist(), names):
            slot = h >> (64 - self.BITS)
            while self.piece[slot] >= 0:
                if self.keys[slot] == h:
                    raise ValueError("two pieces have one hash")
                slot = (slot + 1) % (1 << self.BITS)
            self.keys[slot], self.piece[slot] = h, vocabulary.pieces[name][0]
        self.score = np.full(max(i for i, _ in vocabulary.pieces.values()) + 2, -np.inf)
        for i, score in vocabulary.pieces.values():
            self.score[i] = score

    def _sums(self, chars: np.ndarray) -> np.ndarray:
        """Polynomial hashes of the prefixes. Their steps are made by doubling, since each builds on the last."""
        sums, span, power = mix(chars.astype(np.uint64) + np.uint64(1)), 1, int(self.BASE)
        while span < len(sums):
            sums[span:] = sums[span:] + sums[:-span] * np.uint64(power)
            span, power = 2 * span, power * power % (1 << 64)
        return np.concatenate((np.zeros(1, np.uint64), sums))

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        slot = (hashes >> np.uint64(64 - self.BITS)).astype(np.int64)
        found = np.where(self.keys[slot] == hashes, self.piece[slot], -1)
        open_ = np.flatnonzero((found < 0) & (self.piece[slot] >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.BITS) - 1)
            at = slot[open_]
            found[open_] = np.where(self.keys[at] == hashes[open_], self.piece[at], -1)
            open_ = open_[(found[open_] < 0) & (self.piece[at] >= 0)]
        return found

    def bytes_of(self, char: int) -> tuple[int, ...]:
        """The ids of a character without a piece."""
        return tuple(self.v.bytes[b] for b in chr(char).encode()) if self.v.bytes else (self.v.unknown,)

    def solve(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids of the best of each unit in a row, how many each has, its score, what the second best loses); units longest first.

        The units that have a place stand in front, so places are slabs: the units'
        first characters, then their second ones, and so on.
        """
        sizes = np.array([len(u) for u in units])
        top, total = int(sizes[0]), int(sizes.sum())
        live = np.searchsorted(-sizes, -np.arange(1, top + 1), "right").tolist()  # units with a place
        slab = np.concatenate(([0], np.cumsum(live))).tolist()
        starts = np.cumsum(sizes) - sizes
        chars = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
        place = np.arange(total) - np.repeat(starts, sizes)
        slabs = np.empty(total, np.uint32)
        slabs[np.array(slab)[place] + np.repeat(np.arange(len(units)), sizes)] = chars
        mixed = mix(slabs.astype(np.uint64) + np.uint64(1))
        sums = [np.zeros(len(units), np.uint64)]
        for p, n in enumerate(live):
            sums.append(sums[p][:n] * self.BASE + mixed[slab[p] : slab[p + 1]])
        widest = min(self.longest, top)
        ids: list[np.ndarray] = [np.empty(0, np.int32)]  # of the pieces of a width, slab by slab from the first that has it
        scores: list[np.ndarray] = [np.empty(0)]
        for width in range(1, widest + 1):
            ids.append(self._find(np.concatenate([sums[e] - sums[e - width][: live[e - 1]] * self.powers[width] for e in range(width, top + 1)])))
            scores.append(self.score[ids[width]])
        scores[1][ids[1] < 0] = self.v.penalty
        part = lambda width, e: slice(slab[e - 1] - slab[width - 1], slab[e] - slab[width - 1])
        best = [np.zeros(len(units))]
        via = [np.zeros(len(units), np.int8)]
        for e, n in enumerate(live, 1):
            most, by = np.full(n, -np.inf), np.zeros(n, np.int8)
            for width in range(min(widest, e), 0, -1):
                score = best[e - width][:n] + scores[width][part(width, e)]
                more = score > most
                np.copyto(most, score, where=more)
                by[more] = width
            best.append(most)
            via.append(by)
        left = [np.full(len(b), -np.inf) for b in best]
        on = [np.zeros(len(b), bool) for b in best]
        final, second = np.empty(len(units)), np.full(len(units), -np.inf)
        live.append(0)
        paths: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for e in range(top, 0, -1):
            n, longer = live[e - 1], live[e]
            on[e][longer:], left[e][longer:] = True, 0.0  # the units that end here
            final[longer:n] = best[e][longer:]
            for width in range(1, min(widest, e) + 1):
                score = left[e] + scores[width][part(width, e)]
                np.maximum(left[e - width][:n], score, out=left[e - width][:n])
                score += best[e - width][:n]
                own = np.flatnonzero(on[e] & (via[e] == width))
                score[own] = -np.inf
                np.maximum(second[:n], score, out=second[:n])
                if len(own):
                    on[e - width][own] = True
                    paths.append((own, np.full(len(own), e), ids[width][part(width, e)][own]))
        unit, end, chosen = (np.concatenate(x) for x in zip(*paths))
        order = np.lexsort((end, unit))
        unit, end, chosen = unit[order], end[order], chosen[order]
        counts = np.bincount(unit, minlength=len(units))
        if len(unknown := np.flatnonzero(chosen < 0)):
            spelt = [self.bytes_of(int(chars[starts[u] + e - 1])) for u, e in zip(unit[unknown].tolist(), end[unknown].tolist())]
            lengths = np.ones(len(chosen), np.int64)
            lengths[unknown] = [len(x) for x in spelt]
            chosen = np.repeat(chosen, lengths)
            chosen[chosen < 0] = list(chain.from_iterable(spelt))
            counts = np.bincount(np.repeat(unit, lengths), minlength=len(units))
        return chosen, counts, final, final - second

    def edges(self, sums: np.ndarray, reverse: bool = False) -> Iterator[tuple[list[int], list[int], list[float], list[int]]]:
        """Blocks of (end, width, score, id) by end, longest first; id is -1 for a character without a piece. reverse: the same from behind."""
        size = len(sums) - 1
        blocks = range(0, size, self.BLOCK)
        for low in reversed(blocks) if reverse else blocks:
            ends = np.arange(low + 1, min(low + self.BLOCK, size) + 1)
            ids = np.full((len(ends), self.longest), -1, np.int32)  # by width from behind
            for width in range(1, min(self.longest, int(ends[-1])) + 1):
                some = ends[max(0, width - int(ends[0])) :]
                ids[len(ends) - len(some) :, self.longest - width] = self._find(sums[some] - sums[some - width] * self.powers[width])
            scores = self.score[ids]
            scores[ids[:, -1] < 0, -1] = self.v.penalty
            row, col = np.nonzero(scores > -np.inf)
            found = (ends[row], self.longest - col, scores[row, col], ids[row, col])
            yield tuple((x[::-1] if reverse else x).tolist() for x in found)

    def forward(self, sums: np.ndarray) -> tuple[array, bytearray]:
        """Best score up to each place of one long unit, and the width of the piece that gives it."""
        size = len(sums) - 1
        best, via = array("d", [-np.inf]) * (size + 1), bytearray(size + 1)
        best[0] = 0.0
        for block in self.edges(sums):
            for end, width, score, _ in zip(*block):
                if (total := best[end - width] + score) > best[end]:
                    best[end], via[end] = total, width
        return best, via

    def chars(self, unit: str) -> np.ndarray:
        return np.frombuffer(unit.encode("utf-32-le"), np.uint32)

    def solve_long(self, unit: str) -> tuple[np.ndarray, float, float]:
        """As solve() for one unit of any length: some 50 bytes a character, and time in proportion."""
        sums = self._sums(self.chars(unit))
        best, via = self.forward(sums)
        size = len(unit)
        left, on = array("d", [-np.inf]) * (size + 1), bytearray(size + 1)
        left[size], on[size] = 0.0, 1
        second = -np.inf
        path = array("i")
        for block in self.edges(sums, reverse=True):
            for end, width, score, piece in zip(*block):
                start = end - width
                total = score + left[end]
                if total > left[start]:
                    left[start] = total
                if on[end] and via[end] == width:
                    on[start] = 1
                    path.extend((piece,) if piece >= 0 else reversed(self.bytes_of(ord(unit[start]))))
                elif (whole := best[start] + total) > second:
                    second = whole
        return np.array(path, np.int32)[::-1], best[size], best[size] - second


class Segmenter:
    """N-best segmentations with a bounded memory of units."""

    def __init__(self, vocabulary: Vocabulary, n: int = BEST):
        self.v, self.n = vocabulary, n
        self.batch = Batch(vocabulary)
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}  # number of each unit, by which the others are
        self.chars = 0
        self.ids, self.ends = np.empty(0, np.int32), np.zeros(1, np.int64)
        self.scores, self.losses = np.empty(0), np.empty(0)

    def learn(self, texts: list[list[str]]) -> None:
        """Solve the units of texts that aren't held, together."""
        new = {u for units in texts for u in units if u not in self.at}
        if len(self.at) + len(new) > UNITS_HELD or self.chars > CHARS_HELD:
            self.clear()
            new = {u for units in texts for u in units}
        ordered = sorted(new, key=len, reverse=True)
        long = next((i for i, u in enumerate(ordered) if len(u) <= Batch.LONGEST_UNIT), len(ordered))
        made = []
        for u in ordered[:long]:
            ids, score, loss = self.batch.solve_long(u)
            made.append((ids, np.array([len(ids)]), np.array([score]), np.array([loss])))
        made += [self.batch.solve(ordered[i : i + 8192]) for i in range(long, len(ordered), 8192)]
        if made:
            ids, counts, scores, losses = (np.concatenate(x) for x in zip(*made))
            self.at.update(zip(ordered, range(len(self.at), len(self.at) + len(ordered))))
            self.chars += sum(map(len, ordered))
            self.ids = np.concatenate((self.ids, ids))
            self.ends = np.concatenate((self.ends, self.ends[-1] + np.cumsum(counts)))
            self.scores, self.losses = np.concatenate((self.scores, scores)), np.concatenate((self.losses, losses))

    def alternatives(self, unit: str, first: list[int]) -> list[tuple[float, list[int]]]:
        """(loss, ids) of the n best segmentations of a unit, of which first stands first."""
        if len(unit) <= Batch.LONGEST_UNIT:
            edges = self.v.edges(unit)
            best: Sequence[float] = forward(edges, len(unit))
            ends: list[list] = [[] for _ in best]
            for i, j, ids, score in edges:
                ends[j].append((i, ids, score))
            into = ends.__getitem__
        else:
            best, _ = self.batch.forward(self.batch._sums(self.batch.chars(unit)))
            into = partial(self.v.into, unit)
        out = [(best[-1] - score, ids) for score, ids in backward(into, best, self.n)]
        out.sort(key=lambda x: (x[0], x[1] != first))
        return out

    def text(self, units: list[str]) -> tuple[np.ndarray, float, list[dict]]:
        """(ids, score, the n best as {score, edits}); an edit puts other ids in the place of drop ids."""
        try:
            at = np.fromiter(map(self.at.__getitem__, units), np.int64, len(units))
        except KeyError:
            self.learn([units])
            at = np.fromiter(map(self.at.__getitem__, units), np.int64, len(units))
        begins, sizes = self.ends[at], self.ends[at + 1] - self.ends[at]
        places = np.cumsum(sizes) - sizes
        ids = self.ids[np.repeat(begins - places, sizes) + np.arange(int(sizes.sum()))]
        score, losses = float(self.scores[at].sum()), self.losses[at]
        few = min(self.n - 1, len(units))
        near = np.flatnonzero(losses <= np.partition(losses, few - 1)[few - 1]) if few else np.empty(0, np.int64)
        near = near[np.argsort(losses[near], kind="stable")[:few]]
        combined: list[tuple[float, dict[int, list[int]]]] = [(0.0, {})]
        for i in near[np.isfinite(losses[near])].tolist():
            options = self.alternatives(units[i], ids[places[i] : places[i] + sizes[i]].tolist())
            combined = heapq.nsmallest(self.n, ((a + lost, changed | {i: other} if k else changed) for a, changed in combined for k, (lost, other) in enumerate(options)), key=lambda x: x[0])
        best = [{"score": score - lost, "edits": [{"at": int(places[i]), "drop": int(sizes[i]), "ids": other} for i, other in sorted(c.items())]} for lost, c in combined]
        return ids, score, best


EDIT = T.StructType([column("at", T.IntegerType()), column("drop", T.IntegerType()), column("ids", T.ArrayType(T.IntegerType()))])
ALTERNATIVE = T.StructType([column("score", T.DoubleType()), column("edits", T.ArrayType(EDIT))])
OUT = [
    column("piece_ids", T.ArrayType(T.IntegerType())),
    column("score", T.DoubleType()),
    column("n_best", T.ArrayType(ALTERNATIVE)),
    column("decoded_same", T.BooleanType()),
]


def model_bytes(path: str) -> bytes:
    return Path(path).read_bytes()


def _shared(df: DataFrame, model: str | None):
    """The vocabulary's file, which is some hundred kB to a few MB whatever the data."""
    spark = df.sparkSession
    return spark.sparkContext.broadcast(model_bytes(model or spark.conf.get("spark.loomline.pieces.model", MODEL)))


def encode(docs: DataFrame, text: str = "text", model: str | None = None, n: int = BEST) -> DataFrame:
    """docs with the best piece_ids and score, the n best scores with their edits of piece_ids, and whether the ids decode to the text.

    The model is read by the driver and sent to the tasks: a vocabulary's size doesn't
    grow with the data.
    """
    shared = _shared(docs, model)
    state: dict = {}

    def fn(texts: list[bytes | None]) -> dict[str, list | pa.Array]:
        if not state:
            state["segmenter"] = Segmenter(Vocabulary(shared.value), n)
        seg: Segmenter = state["segmenter"]
        units = [None if t is None else seg.v.units(t.decode("utf-8")) for t in texts]
        seg.learn([u for u in units if u])
        out: dict[str, list] = {f.name: [] for f in OUT}
        for data, own in zip(texts, units):
            if own is None:
                for values in out.values():
                    values.append(None)
                continue
            ids, score, best = seg.text(own)
            out["piece_ids"].append(pa.array(ids, pa.int32()))
            out["score"].append(score)
            out["n_best"].append(best)
            out["decoded_same"].append(seg.v.decode(ids.tolist()) == data.replace(MARK.encode(), b" "))
        return {**out, "piece_ids": _lists(out["piece_ids"])}

    return map_text(docs, fn, OUT, text, state=state)


def _lists(arrays: list[pa.Array | None]) -> pa.Array:
    """One list array; ids stay in Arrow memory, four bytes each."""
    ends, total = [0], 0
    for i, a in enumerate(arrays):
        total += 0 if a is None else len(a)
        ends.append(total)
    offsets = pa.array([None if i < len(arrays) and arrays[i] is None else e for i, e in enumerate(ends)], pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.concat_arrays([a for a in arrays if a is not None] or [pa.array([], pa.int32())]))


def decode(encoded: DataFrame, ids: str = "piece_ids", out: str = "decoded", model: str | None = None) -> DataFrame:
    """encoded with the text of its ids; null ids give null, ids outside the vocabulary fail."""
    shared = _shared(encoded, model)
    schema = T.StructType([f for f in encoded.schema if f.name.lower() != out.lower()] + [column(out, T.StringType())])
    kept = schema.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(shared.value)
        for batch in batches:
            texts = [None if x is None else vocabulary.decode(x).decode("utf-8", "replace") for x in batch.column(batch.schema.names.index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.names.index(c)) for c in kept), pa.array(texts, pa.string())], names=schema.names)

    return encoded.mapInArrow(run, schema)


def applied(ids: Sequence[int], edits: list[dict]) -> list[int]:
    """The ids of an alternative."""
    out, last = [], 0
    for e in edits:
        out += [*ids[last : e["at"]], *e["ids"]]
        last = e["at"] + e["drop"]
    return out + list(ids[last:])


