"""Suffix-array dedup of bytes: windows that also start earlier are cut.

Texts that can share a window meet in a shard (see windows). There the distinct ones
are laid behind each other on disk and their suffixes sorted by external induced
sorting up to a window's length. Neighbours with a common prefix of a whole window
are one group; all of a group but its first place in the corpus go.

Matches never cross documents: texts are parted by a symbol that bytes don't have.

Defined cases: null or empty text has no bytes; texts shorter than a window lose
nothing; rows of one doc_id are one document, so equal places of theirs don't make
each other later; a null doc_id comes before all others; what is left may not be
UTF-8, so it is binary; an empty table gives no rows; input columns named like a
result column or like doc_id and text are replaced; of windows that tie, the first in
the corpus stays; a text of any length is read whole in one task.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from loomline.llm.common import column
from loomline.llm.minhash import mix
from loomline.llm.suffix_sort import CHUNK, SuffixSorter
from loomline.llm.windows import Units, cut_repeats

WINDOW = 100
GRAM = 32
#: Bytes of a shard's text that are held in memory; a larger one is mapped from its file.
HELD_BYTES = 64_000_000

_BYTES = mix(np.arange(1, 257, dtype=np.uint64))


class Bytes(Units):
    same_doc = True

    def __init__(self, window: int, gram: int):
        self.window, self.gram = window, gram

    def read(self, data: bytes) -> tuple[bytes, np.ndarray]:
        return data, _BYTES[np.frombuffer(data, np.uint8)]

    def piece(self, units: bytes, start: int, end: int) -> bytes:
        return units[start:end]


class Found(Sequence):
    """For each piece a boolean array over its windows: those of its text's first place, or all if it stands elsewhere, where every window has come before. Rows of one place are one."""

    def __init__(self, later: np.ndarray, keys: np.ndarray, first: np.ndarray, begins: np.ndarray, ends: np.ndarray, window: int):
        self.later, self.keys, self.first, self.begins, self.ends, self.window = later, keys, first, begins, ends, window

    def __len__(self) -> int:
        return len(self.first)

    def __getitem__(self, i):
        at, place = self.first[i]
        a, b = int(self.begins[at]), int(self.ends[at]) - self.window
        return np.array(self.later[a:b]) if self.keys[i] == self.keys[place] else np.ones(b - a, bool)


def resolver(window: int, held_bytes: int):
    @contextmanager
    def resolve(anchors: np.ndarray, docs: np.ndarray, starts: np.ndarray, texts: Sequence, keys: np.ndarray) -> Iterator[Sequence]:
        if not len(texts):
            yield []
            return
        _, doc_rank = np.unique(docs, return_inverse=True)
        sizes = texts.sizes
        stride = int((starts + sizes).max()) + 1
        places = doc_rank.astype(np.int64) * stride + starts  # the order of places in the corpus
        by_place = np.argsort(places, kind="stable")
        # Equal texts by their keys: each one's first piece, and its number among the distinct ones.
        _, at, number = np.unique(keys[by_place], return_index=True, return_inverse=True)
        own = by_place[at]
        first = np.empty((len(keys), 2), np.int64)
        first[by_place, 0], first[by_place, 1] = number, own[number]
        ends = np.cumsum(sizes[own] + 1)
        begins = ends - sizes[own] - 1
        with tempfile.TemporaryDirectory() as folder:
            path = Path(folder, "text")
            with path.open("wb") as f:
                shift = bytes(min(b + 1, 255) for b in range(256))  # UTF-8 has no byte above 0xF4
                for i in own.tolist():
                    f.write(texts[i].translate(shift) + b"\0")
            size = int(ends[-1])
            text = np.fromfile(path, np.uint8) if size <= held_bytes else np.memmap(path, np.uint8, "r")
            later = np.zeros(size, bool) if size <= held_bytes else np.memmap(Path(folder, "later"), bool, "w+", shape=(size,))
            _mark(SuffixSorter(text, window, Path(folder)), window, begins, ends, places[own], later)
            yield Found(later, places, first, begins, ends, window)
            del text, later

    return resolve


def _mark(sorter: SuffixSorter, window: int, begins: np.ndarray, ends: np.ndarray, keys: np.ndarray, later: np.ndarray) -> None:
    """Mark all but the first place of every group of equal windows."""
    held: list[np.ndarray] = []  # of the group that may go on

    def settle(places: np.ndarray, group: np.ndarray) -> None:
        piece = np.searchsorted(ends, places, "right")
        whole = places + window < ends[piece]
        places, piece, group = places[whole], piece[whole], group[whole]
        if len(places):
            key = keys[piece] + places - begins[piece]
            start = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            least = np.minimum.reduceat(key, start)
            later[places] = key > np.repeat(least, np.diff(np.append(start, len(group))))

    for places, lcp in sorter.sorted():
        new = lcp < window
        starts = np.flatnonzero(new)
        if not len(starts):
            held.append(places)
            continue
        before = np.concatenate([*held, places[: starts[0]]])
        if len(before) > 1:
            settle(before, np.zeros(len(before), np.int64))
        group = np.cumsum(new)
        inner = slice(starts[0], starts[-1])
        same = np.zeros(len(places), bool)
        same[1:] = ~new[1:]
        same[:-1] |= ~new[1:]
        chosen = np.flatnonzero(same[inner]) + starts[0]
        for at in range(0, len(chosen), CHUNK):  # one chunk, as the sorter gives no more
            settle(places[chosen[at : at + CHUNK]], group[chosen[at : at + CHUNK]])
        held = [places[starts[-1] :]]
    last = np.concatenate(held) if held else np.empty(0, np.int64)
    if len(last) > 1:
        settle(last, np.zeros(len(last), np.int64))


OUT = [column("n_bytes", T.LongType()), column("n_removed", T.LongType()), column("n_spans", T.LongType()), column("kept", T.BinaryType())]


def finish(data: bytes, units: bytes, removed: np.ndarray) -> tuple:
    if not removed.any():
        return len(data), 0, 0, data
    spans = int(removed[0]) + int((removed[1:] & ~removed[:-1]).sum())
    return len(data), int(removed.sum()), spans, np.frombuffer(data, np.uint8)[~removed].tobytes()


def suffix_dedup(docs: DataFrame, doc: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM, held_bytes: int = HELD_BYTES) -> DataFrame:
    """docs (as doc_id, text and the other columns) with n_bytes, n_removed, n_spans and kept, the bytes left."""
    return cut_repeats(docs, Bytes(window, gram), resolver(window, held_bytes), finish, OUT, doc, text)
