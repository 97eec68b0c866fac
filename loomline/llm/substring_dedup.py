"""Substring dedup over words by suffix automata of reference shards.

The reference is the corpus itself: a window of words goes where its sequence also
starts in a document of smaller doc_id. Reference texts are dealt by content (see
windows), so each shard's automata hold every text that can share a window with
the texts that stream through them; a whole-corpus automaton would have to be
broadcast to every document, which grows with the square of the corpus. Within a shard
one automaton holds REFERENCE_WORDS words of distinct texts; these stream through it for
their matching statistics, and states that hold a whole window know the smallest document it was
seen in. An anchor with more reference text than that gets several automata, and its
texts stream through each.

Defined cases: null or empty text has no words; texts shorter than a window lose
nothing; rows of one doc_id are one document and never make each other's windows
earlier; a null doc_id comes before all others; an empty table gives no rows; input
columns named like a result column or like doc_id and text are replaced; ties of
doc_id are no earlier; a text of any length is read whole in one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from loomline.llm.automaton import SuffixAutomaton
from loomline.llm.common import SPACE, column
from loomline.llm.minhash import mix
from loomline.llm.windows import Units, cut_repeats

WINDOW = 13
GRAM = 4
REFERENCE_WORDS = 60_000


_SPACE = np.isin(np.arange(256), np.frombuffer(SPACE, np.uint8))
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text, and 64-bit hashes of their bytes, eight at a time."""
    a = np.frombuffer(data + b" " * 8, np.uint8)
    space = _SPACE[a]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edges = np.concatenate(([0], edges))
    starts, ends = edges[::2], edges[1::2]
    sizes = ends - starts
    eight = np.ndarray((len(a) - 7,), "<u8", a, strides=(1,))
    hashes = mix((eight[starts] & _MASK[np.minimum(sizes, 8)]) + sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    at, more = 8, np.flatnonzero(sizes > 8)
    while len(more):
        part = eight[starts[more] + at] & _MASK[np.minimum(sizes[more] - at, 8)]
        hashes[more] = mix(hashes[more] * np.uint64(0xD6E8FEB86659FD93) + part)
        at += 8
        more = more[sizes[more] > at]
    return starts, ends, hashes


class Words(Units):
    """Words as places in the text; a piece is the text from its first word to its last."""

    def __init__(self, window: int, gram: int):
        self.window, self.gram = window, gram

    def read(self, data: bytes) -> tuple[tuple[bytes, np.ndarray, np.ndarray], np.ndarray]:
        starts, ends, hashes = word_hashes(data)
        return (data, starts, ends), hashes

    def piece(self, units: tuple[bytes, np.ndarray, np.ndarray], start: int, end: int) -> bytes:
        data, starts, ends = units
        return data[starts[start] : ends[end - 1]]

    def key(self, units: object, hashes: np.ndarray, start: int, end: int) -> int:
        """By words, so that white space between them doesn't matter."""
        return xxhash.xxh3_64_intdigest(hashes[start:end].tobytes())


def matching(reference: list[tuple[int, list[int]]], streamed: list[tuple[int, list[int]]], window: int) -> list[np.ndarray]:
    """For each streamed text the smallest document of every window; both sides are (doc, words), the reference by doc."""
    sam = SuffixAutomaton()
    for _, words in reference:
        sam.add(words)
    holder: list[int] = [-1] * len(sam.len)  # the state that holds a state's last window
    owner: dict[int, int] = {}
    link, length = sam.link, sam.len

    def held(state: int) -> int:
        at = state
        while length[link[at]] >= window:
            at = link[at]
        holder[state] = at
        return at

    for doc, words in reference:
        for at, state in enumerate(sam.prefixes(words), 1):
            if at >= window:
                owner.setdefault(holder[state] if holder[state] >= 0 else held(state), doc)
    none = np.iinfo(np.int64).max
    out = []
    for _, words in streamed:
        first = [owner[holder[s] if holder[s] >= 0 else held(s)] if n >= window else none for s, n in sam.matches(words)]
        out.append(np.array(first[window - 1 :], np.int64))
    return out


def resolver(window: int, reference_words: int):
    @contextmanager
    def resolve(anchors: np.ndarray, docs: np.ndarray, starts: np.ndarray, texts: Sequence, keys: np.ndarray) -> Iterator[list[np.ndarray]]:
        out: list[np.ndarray] = []
        bounds = np.concatenate(([0], np.flatnonzero(np.diff(anchors)) + 1, [len(texts)])).tolist() if texts else []
        block: list[int] = []
        held = 0

        def settle() -> None:
            ids: dict[bytes, int] = {}
            own: dict[bytes, int] = {}  # the first place of each distinct text
            read = {i: texts[i] for i in block}
            for i in sorted(block, key=lambda i: int(docs[i])):
                own.setdefault(read[i], i)
            pairs = [(int(docs[i]), [ids.setdefault(w, len(ids)) for w in t.split()]) for t, i in own.items()]
            least = None
            part: list[tuple[int, list[int]]] = []
            size = 0
            for k, pair in enumerate(pairs):
                part.append(pair)
                size += len(pair[1])
                if size >= 2 * reference_words or k == len(pairs) - 1:
                    found = matching(part, pairs, window)
                    least = found if least is None else [np.minimum(a, b) for a, b in zip(least, found)]
                    part, size = [], 0
            of_text = dict(zip(own, least))
            out.extend(of_text[read[i]] < docs[i] for i in block)

        for a, b in zip(bounds, bounds[1:]):
            block += range(a, b)
            held += sum(map(len, set(texts[a:b]))) // 6  # some six bytes a word
            if held >= reference_words:
                settle()
                block, held = [], 0
        if block:
            settle()
        yield out

    return resolve


OUT = [column("n_words", T.LongType()), column("n_removed", T.LongType()), column("clean_text", T.StringType())]


def finish(data: bytes, units: object, removed: np.ndarray) -> tuple:
    words = data.split()
    kept = words if not removed.any() else [w for w, gone in zip(words, removed.tolist()) if not gone]
    return len(words), int(removed.sum()), b" ".join(kept).decode("utf-8")


def substring_dedup(docs: DataFrame, doc: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM, reference_words: int = REFERENCE_WORDS) -> DataFrame:
    """docs (as doc_id, text and the other columns) with n_words, n_removed and clean_text, the words left."""
    return cut_repeats(docs, Words(window, gram), resolver(window, reference_words), finish, OUT, doc, text)
