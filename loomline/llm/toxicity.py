"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word's input is the sum of the embeddings of itself and its starts, as far as they are known,
beside what a bidirectional GRU with attention pooling makes of its bytes; a second such
network reads the words. Every text is scored in all windows of WINDOW words, one from
each word on: attention pools the states of a window's words, and overlapping windows
share the states, which are made once for each span of SPAN words. Sums along a span
give every window's pooled value, so a window costs a few additions. A logistic
regression on the three highest windows at least GAP words apart, the mean of all and
their number gives the text's score.

Training takes a bounded sample of labelled documents, at most SAMPLE of each label and
SAMPLE_BYTES of their text, the least by hash. A label belongs to a document, so training picks windows, read with
up to CONTEXT words on either side: of toxic documents those with the words or word
starts that toxic documents have most over others, later the ones that score highest,
of other documents the hardest and some at random, and repeats that for some rounds.
Toxic documents without a telling word are left out as mislabelled until one of their
windows scores a half. Documents whose crc32 leaves HELD_OUT are never learnt from.

Defined cases: null and empty texts score 0; labels that are null, or whose document
is missing or null, teach nothing; without both labels every text scores 0;
repeated rows score alike; a null doc_id isn't held out; an empty table gives no
rows; input columns named like a result column are replaced; a score on the threshold
is toxic, and of windows that tie the first counts; a text of any length is scored
whole, in memory in proportion to it. Words over 16 bytes count as several.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.llm.common import column, map_text

WINDOW = 32
#: Words that are read together, and how many of them lie before and behind a window in training.
SPAN, CONTEXT = 128, 16
#: Words between the starts of windows that count as different places of a text.
GAP = 24
WORD_BYTES = 16
WORD_DIM, CHAR_DIM, CHAR_HIDDEN, HIDDEN = 12, 8, 8, 12
#: Words and word starts with embeddings: the EMBEDDINGS most frequent of those in KNOWN sampled documents or more. All others are read by their bytes alone.
EMBEDDINGS, KNOWN = 16_384, 4
#: Bytes of a word's starts.
STARTS = (4, 5, 6, 7)
#: Log odds that the most telling word of a toxic document has at least. Those without are taken as mislabelled until a window scores a half, unless they are more than DOUBTED of all.
EVIDENT, DOUBTED = 3.0, 0.25
#: Part of the embeddings that training leaves out at each step.
DROPPED = 0.3
#: Labelled documents of each label that training takes at most: toxic, other.
SAMPLE = (800, 1500)
#: Text of either label at which training takes no further documents: what the driver gets is bounded, however long they are.
SAMPLE_BYTES = 32_000_000
#: Part of the sample that the network doesn't learn from: it fits how windows make up a document's score.
APART = 0.25
ROUNDS = 8
RATE = 0.01
#: Steps of a round at least.
LEAST_STEPS = 50
#: Rounds before which the sample's windows are scored anew, and the first that takes toxic windows by score.
MINED, BY_SCORE = (1, 3, 5), 3
HELD_OUT = 1
THRESHOLD = 0.7
#: Words whose input a scoring task remembers, and spans that it reads at a time.
WORDS_HELD, BATCH = 150_000, 512

TOKEN = re.compile(rb"[0-9A-Za-z_\x80-\xff]+")
PIECE = re.compile(rb"(?s).{1,%d}" % WORD_BYTES)


Model = tuple[dict[str, np.ndarray], dict[bytes, int]]


def tokens(data: bytes | None) -> list[bytes]:
    if not data:
        return []
    found = TOKEN.findall(data.decode("utf-8", "replace").lower().encode())
    return [p for w in found for p in ((w,) if len(w) <= WORD_BYTES else PIECE.findall(w))]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Gru:
    """One direction. Inputs come projected: (steps, rows, 3 * hidden) with reset, update and candidate parts."""

    def __init__(self, params: dict, name: str, hidden: int):
        self.w, self.h, self.name = params, hidden, name

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool) -> np.ndarray:
        h, u = self.h, self.w[f"{self.name}_u"]
        state = np.zeros((x.shape[1], h), np.float32)
        out = np.empty((*x.shape[:2], h), np.float32)
        self.saved = []
        for t in range(len(x)):
            g = state @ u
            rz = sigmoid(x[t, :, : 2 * h] + g[:, : 2 * h])
            r, z = rz[:, :h], rz[:, h:]
            n = np.tanh(x[t, :, 2 * h :] + r * g[:, 2 * h :])
            m = mask[t]
            if keep:
                self.saved.append((state, r, z, n, g[:, 2 * h :]))
            state = state + m * (1 - z) * (n - state)
            out[t] = state
        return out

    def backward(self, dout: np.ndarray, mask: np.ndarray, grads: dict) -> np.ndarray:
        u, h = self.w[f"{self.name}_u"], self.h
        dx = np.empty((*dout.shape[:2], 3 * h), np.float32)
        du = np.zeros_like(u)
        ds = np.zeros(dout.shape[1:], np.float32)
        for t in range(len(dout) - 1, -1, -1):
            state, r, z, n, gn = self.saved[t]
            ds = ds + dout[t]
            dm = ds * mask[t]
            dn = dm * (1 - z) * (1 - n * n)
            dz = -dm * (n - state) * z * (1 - z)
            dr = dn * gn * r * (1 - r)
            dx[t, :, :h], dx[t, :, h : 2 * h], dx[t, :, 2 * h :] = dr, dz, dn
            dg = np.concatenate([dr, dz, dn * r], 1)
            du += state.T @ dg
            ds = ds - dm * (1 - z) + dg @ u.T
        grads[f"{self.name}_u"] += du
        return dx


class Pooled:
    """Both directions over projected inputs, pooled by attention."""

    def __init__(self, params: dict, name: str, hidden: int):
        self.w, self.name, self.h = params, name, hidden
        self.fore, self.back = Gru(params, f"{name}_f", hidden), Gru(params, f"{name}_b", hidden)

    def states(self, x: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """States, and the attention's hidden layer and scores. x: (steps, rows, 6 * hidden); mask: (steps, rows, 1). The backward half reads from the end."""
        w, k = self.w, 3 * self.h
        f = self.fore.forward(x[:, :, :k], mask, keep)
        b = self.back.forward(x[::-1, :, k:], mask[::-1], keep)[::-1]
        hs = np.concatenate([f, b], 2)
        a = np.tanh(hs @ w[f"{self.name}_a"] + w[f"{self.name}_ab"])
        return hs, a, a @ w[f"{self.name}_v"]

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False, pool: np.ndarray | None = None) -> np.ndarray:
        """The states under pool (steps, rows), or all under mask, by attention."""
        hs, a, s = self.states(x, mask, keep)
        s = s + ((mask[:, :, 0] if pool is None else pool) - 1) * 1e4
        s = np.exp(s - s.max(0))
        p = (s / s.sum(0))[:, :, None]
        if keep:
            self.saved = (hs, a, p, mask)
        return (p * hs).sum(0)

    def backward(self, dout: np.ndarray, grads: dict) -> np.ndarray:
        w, name = self.w, self.name
        hs, a, p, mask = self.saved
        dp = (dout[None] * hs).sum(2, keepdims=True)
        dscore = p * (dp - (p * dp).sum(0))
        grads[f"{name}_v"] += (dscore * a).sum((0, 1))
        da = dscore * w[f"{name}_v"] * (1 - a * a)
        grads[f"{name}_a"] += np.tensordot(hs, da, ((0, 1), (0, 1)))
        grads[f"{name}_ab"] += da.sum((0, 1))
        dh = p * dout[None] + da @ w[f"{name}_a"].T
        df = self.fore.backward(dh[:, :, : self.h], mask, grads)
        db = self.back.backward(dh[::-1, :, self.h :], mask[::-1], grads)[::-1]
        return np.concatenate([df, db], 2)


def fresh(seed: int = 7, vocabulary: dict[bytes, int] | None = None) -> dict:
    """Parameters, beside the vocabulary that embeddings belong to; row 0 is of unknown words and stays 0."""
    rng = np.random.default_rng(seed)

    def draw(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    params = {"embed": 0.1 * draw(len(vocabulary or {}) + 1, WORD_DIM), "chars": draw(256, CHAR_DIM) * np.float32(4)}
    for name, size, hidden in (("c", CHAR_DIM, CHAR_HIDDEN), ("w", WORD_DIM + 2 * CHAR_HIDDEN, HIDDEN)):
        params |= {f"{name}_x": draw(size, 6 * hidden), f"{name}_xb": np.zeros(6 * hidden, np.float32), f"{name}_f_u": draw(hidden, 3 * hidden), f"{name}_b_u": draw(hidden, 3 * hidden)}
        params |= {f"{name}_a": draw(2 * hidden, hidden), f"{name}_ab": np.zeros(hidden, np.float32), f"{name}_v": draw(hidden)}
    params["embed"][0] = 0
    return params | {"out": draw(2 * HIDDEN), "out_b": np.full(1, -1.0, np.float32), "doc": HIGHEST}


class Known:
    """The words and word starts that have embeddings."""

    def __init__(self, vocabulary: dict[bytes, int]):
        self.words = vocabulary
        starts = sorted((self._key(f[1:], len(f) - 1), i) for f, i in vocabulary.items() if f[:1] == b"^")
        self.keys, self.ids = np.array([k for k, _ in starts], np.uint64), np.array([i for _, i in starts], np.int64)

    @staticmethod
    def _key(start: bytes, size: int) -> int:
        return int.from_bytes(start[:size], "little") | size << 56

    def ids_of(self, words: list[bytes], eight: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Ids of each word and its starts; eight holds the words' first eight bytes."""
        out = np.zeros((len(words), 1 + len(STARTS)), np.int64)
        out[:, 0] = np.fromiter((self.words.get(x, 0) for x in words), np.int64, len(words))
        for k, size in enumerate(STARTS, 1) if len(self.keys) else ():
            key = eight & np.uint64((1 << 8 * size) - 1) | np.uint64(size << 56)
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            out[:, k] = np.where((self.keys[at] == key) & (sizes > size), self.ids[at], 0)
        return out


class Network:
    def __init__(self, params: dict[str, np.ndarray], vocabulary: dict[bytes, int] | Known, drop: np.random.Generator | None = None):
        self.w, self.drop = params, drop
        self.known = vocabulary if isinstance(vocabulary, Known) else Known(vocabulary)
        self.chars, self.words = Pooled(params, "c", CHAR_HIDDEN), Pooled(params, "w", HIDDEN)

    def vectors(self, words: list[bytes], keep: bool = False) -> np.ndarray:
        """What distinct words are to the second network."""
        w = self.w
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        size = max(8, int(sizes.max()))
        rows = np.frombuffer(b"".join(x.ljust(size, b"\0") for x in words), np.uint8).reshape(len(words), size)
        ids = self.known.ids_of(words, np.ascontiguousarray(rows[:, :8]).view(np.uint64)[:, 0], sizes)
        at = rows.T[: sizes.max()]
        mask = (np.arange(len(at))[:, None] < sizes).astype(np.float32)[:, :, None]
        pooled = self.chars.forward((w["chars"] @ w["c_x"] + w["c_xb"])[at], mask, keep)
        if self.drop is not None:
            ids[self.drop.random(ids.shape) < DROPPED] = 0
        x = np.concatenate([w["embed"][ids].sum(1), pooled], 1)
        if keep:
            self.saved = (at, ids, x)
        return x

    def word_inputs(self, words: list[bytes], keep: bool = False) -> np.ndarray:
        """Projected inputs of distinct words."""
        return self.vectors(words, keep) @ self.w["w_x"] + self.w["w_xb"]

    def windows(self, inputs: np.ndarray, at: np.ndarray, keep: bool = False, pool: np.ndarray | None = None) -> np.ndarray:
        """Probabilities of one window a row of at (rows, steps), which are rows of inputs; -1 is padding. pool: the window's places, all by default."""
        mask = (at.T >= 0).astype(np.float32)[:, :, None]
        pooled = self.words.forward(inputs[np.maximum(at.T, 0)], mask, keep, None if pool is None else pool.T)
        if keep:
            self.pooled = pooled
        return sigmoid(pooled @ self.w["out"] + self.w["out_b"])

    def all_windows(self, vectors: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Probabilities (rows, steps) of the windows from every place of the spans at on; a window ends where its span's words do."""
        steps, rows = at.shape[1], len(at)
        mask = (at.T >= 0).astype(np.float32)[:, :, None]
        hs, _, s = self.words.states(vectors[np.maximum(at.T, 0)] @ self.w["w_x"] + self.w["w_xb"], mask)
        weight = np.exp((s - s.max(0)).astype(np.float64)) * mask[:, :, 0]
        value = weight * (hs @ self.w["out"])
        end = np.minimum(np.arange(steps) + WINDOW, steps)
        sums = [np.concatenate([np.zeros((1, rows)), np.cumsum(x, 0)]) for x in (value, weight)]
        value, weight = (x[end] - x[:-1] for x in sums)
        return sigmoid(value / np.maximum(weight, 1e-300) + self.w["out_b"]).T

    def gradients(self, words: list[bytes], at: np.ndarray, labels: np.ndarray, weights: np.ndarray, pool: np.ndarray | None = None) -> dict[str, np.ndarray]:
        w = self.w
        grads = {k: np.zeros_like(v) for k, v in w.items() if k != "doc"}
        inputs = self.word_inputs(words, True)
        probs = self.windows(inputs, at, True, pool)
        d = ((probs - labels) * weights / len(labels)).astype(np.float32)
        grads["out"] += self.pooled.T @ d
        grads["out_b"] += d.sum()
        dx = self.words.backward(d[:, None] * w["out"], grads)
        flat, where = dx.reshape(-1, dx.shape[2]), at.T.reshape(-1)
        dproj = np.zeros_like(inputs)
        np.add.at(dproj, where[where >= 0], flat[where >= 0])
        chars, ids, x = self.saved
        grads["w_x"] += x.T @ dproj
        grads["w_xb"] += dproj.sum(0)
        dx = dproj @ w["w_x"].T
        np.add.at(grads["embed"], ids, dx[:, None, :WORD_DIM])
        grads["embed"][0] = 0
        dc = self.chars.backward(np.ascontiguousarray(dx[:, WORD_DIM:]), grads)
        per_char = np.zeros((256, dc.shape[2]), np.float32)
        np.add.at(per_char, chars.reshape(-1), dc.reshape(-1, dc.shape[2]))
        grads["c_xb"] += per_char.sum(0)
        grads["c_x"] += w["chars"].T @ per_char
        grads["chars"] += per_char @ w["c_x"].T
        return grads


def windows_of(n: int) -> int:
    """Windows over n words: one from each word on, the last ends with the text."""
    return max(1, n - WINDOW + 1) if n else 0


def peaks(probs: np.ndarray, count: int) -> list[int]:
    """The highest windows that start GAP words apart or more, highest first."""
    left, out = probs.astype(np.float64), []
    while len(out) < count and left.max() >= 0:
        out.append(int(left.argmax()))
        left[max(0, out[-1] - GAP + 1) : out[-1] + GAP] = -1
    return out


class Scorer:
    """Scores texts with inputs of words remembered up to a bound."""

    def __init__(self, model: Model):
        self.net = Network(*model)
        self.rows: dict[bytes, int] = {}
        self.vectors = np.empty((0, WORD_DIM + 2 * CHAR_HIDDEN), np.float32)

    def rows_of(self, words: list[bytes]) -> np.ndarray:
        rows = self.rows
        if missing := {w for w in words if w not in rows}:
            if len(rows) + len(missing) > WORDS_HELD:
                rows.clear()
                missing = set(words)
            ordered = sorted(missing, key=len)  # words of a length together need little padding
            made = [self.net.vectors(ordered[i : i + 4096]) for i in range(0, len(ordered), 4096)]
            self.vectors = np.concatenate([self.vectors[: len(rows)], *made])
            rows.update(zip(ordered, range(len(rows), len(rows) + len(ordered))))
        return np.fromiter(map(rows.__getitem__, words), np.int64, len(words))

    def window_scores(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        """The scores of each text's windows. Texts are taken together while their words fit in what is remembered."""
        out: list[np.ndarray] = []
        group: list[list[bytes]] = []
        size = 0
        for text in texts:
            if group and size + len(text) > WORDS_HELD // 2:
                out += self._scored(group)
                group, size = [], 0
            group.append(text)
            size += len(text)
        return out + (self._scored(group) if group else [])

    def _scored(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        flat = self.rows_of([w for t in texts for w in t])
        sizes = np.array([len(t) for t in texts])
        counts = np.array([windows_of(n) for n in sizes.tolist()])
        step = SPAN - WINDOW + 1  # a span's windows that no other span has
        spans = -(-counts // step)
        first = np.arange(spans.sum()) - np.repeat(np.cumsum(spans) - spans, spans)
        begins = np.repeat(np.cumsum(sizes) - sizes, spans) + first * step
        lengths = np.minimum(np.repeat(np.cumsum(sizes), spans) - begins, SPAN)
        have = np.minimum(np.repeat(counts, spans) - first * step, step)
        place = np.cumsum(have) - have
        probs = np.empty(int(have.sum()), np.float32)
        order = np.argsort(-lengths, kind="stable")
        for i in range(0, len(order), BATCH):
            rows = order[i : i + BATCH]
            at = begins[rows, None] + np.arange(lengths[rows[0]])
            inside = np.arange(lengths[rows[0]]) < lengths[rows, None]
            found = self.net.all_windows(self.vectors, np.where(inside, flat[np.where(inside, at, 0)], -1))
            wanted = np.arange(found.shape[1]) < have[rows, None]
            probs[(place[rows, None] + np.arange(found.shape[1]))[wanted]] = found[wanted]
        return np.split(probs, np.cumsum(counts)[:-1])

    def scores(self, texts: list[list[bytes]]) -> list[float]:
        weights = self.net.w["doc"]
        return [float(sigmoid(summary(p) @ weights)) if len(p) else 0.0 for p in self.window_scores(texts)]


def features(word: bytes) -> tuple[bytes, ...]:
    """A word and its starts, each told apart; a start that is the word itself is empty."""
    return (word, *(b"^" + word[:n] if len(word) > n else b"" for n in STARTS))


def evidence(docs: list[tuple[list[bytes], int]]) -> dict[bytes, float]:
    """Log odds of words and word starts, by documents of either label that have them."""
    count: dict[bytes, list[int]] = {}
    for text, y in docs:
        for f in {f for w in set(text) for f in features(w) if f}:
            count.setdefault(f, [0, 0])[y] += 1
    toxic = sum(y for _, y in docs)
    ratio = max(1, len(docs) - toxic) / max(1, toxic)
    return {f: float(np.log((t + 0.1) * ratio / (n + 0.5))) for f, (n, t) in count.items() if t >= 3}


def vocabulary_of(docs: list[tuple[list[bytes], int]]) -> dict[bytes, int]:
    seen: dict[bytes, int] = {}
    for text, _ in docs:
        for f in {f for w in set(text) for f in features(w) if f}:
            seen[f] = seen.get(f, 0) + 1
    known = sorted((w for w, n in seen.items() if n >= KNOWN), key=lambda w: (-seen[w], w))[:EMBEDDINGS]
    return {w: i for i, w in enumerate(known, 1)}


def train(texts: list[list[bytes]], labels: list[int], seed: int = 7, rounds: int = ROUNDS) -> Model | None:
    """Parameters and vocabulary, or None without documents of both labels."""
    rng = np.random.default_rng(seed)
    docs = [(t, y) for t, y in zip(texts, labels) if t]
    docs = [docs[i] for i in rng.permutation(len(docs))]
    apart, docs = docs[: int(APART * len(docs))], docs[int(APART * len(docs)) :]
    if len({y for _, y in docs}) < 2:
        return None
    vocabulary = vocabulary_of(docs)
    known = Known(vocabulary)
    params = fresh(seed, vocabulary)
    odds = evidence(docs)
    best: list[int] = []
    evident: list[bool] = []
    for text, y in docs:
        found = np.array([max(odds.get(f, 0.0) for f in features(w)) for w in text]) if y else None
        best.append(max(0, min(int(found.argmax()) - WINDOW // 2, len(text) - WINDOW)) if y else -1)
        evident.append(not y or bool(found.max() >= EVIDENT))
    if evident.count(False) > DOUBTED * sum(y for _, y in docs):
        evident = [True] * len(docs)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items() if k != "doc"}
    step, scored = 0, None
    for turn in range(rounds):
        if turn in MINED:
            scored = Scorer((params, vocabulary)).window_scores([t for t, _ in docs])
        picked: list[tuple[list[bytes], int, int]] = []  # words with their context, where the window starts, the label
        for i, (text, y) in enumerate(docs):
            if y:
                if not (evident[i] or turn >= BY_SCORE and scored[i].max() >= 0.5):
                    continue
                some = {best[i] if turn < BY_SCORE else int(scored[i].argmax())}
            else:
                hardest = [] if scored is None else peaks(scored[i], 2)
                some = {*hardest, int(rng.integers(windows_of(len(text))))}
            for s in some:
                shift = int(rng.integers(-8, 9)) if y and 8 <= s < len(text) - WINDOW - 8 and turn < BY_SCORE - 1 else 0
                start = max(0, s + shift - CONTEXT)
                picked.append((text[start : s + shift + WINDOW + CONTEXT], s + shift - start, y))
        share = sum(y for _, _, y in picked) / len(picked)
        batches = max(1, len(picked) // 64)
        passes = -(-LEAST_STEPS // batches)  # a small sample is passed several times a round
        for part in (part for _ in range(passes) for part in np.array_split(rng.permutation(len(picked)), batches)):
            chosen = [picked[i] for i in part]
            ids: dict[bytes, int] = {}
            at = np.full((len(chosen), WINDOW + 2 * CONTEXT), -1, np.int64)
            pool = np.zeros(at.shape, np.float32)
            for row, (words, start, _) in enumerate(chosen):
                at[row, : len(words)] = [ids.setdefault(w, len(ids)) for w in words]
                pool[row, start : min(start + WINDOW, len(words))] = 1
            y = np.array([y for _, _, y in chosen], np.float32)
            weights = np.where(y > 0, min(4.0, 0.5 / max(share, 0.01)), 1.0).astype(np.float32)
            grads = Network(params, known, rng).gradients(list(ids), at, y, weights, pool)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            step += 1
            for k, g in grads.items():
                g = g * min(1.0, 2.0 / (norm + 1e-9))
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.005 * (g * g - v)
                params[k] -= RATE * (1 - turn / (rounds + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.995**step)) + 1e-8)
    params["doc"] = _document_weights(Scorer((params, vocabulary)).window_scores([t for t, _ in apart]), np.array([y for _, y in apart], np.float64))
    return params, vocabulary


def summary(probs: np.ndarray) -> np.ndarray:
    """What a document's score is made of: the log odds of its three highest windows GAP words apart (the lowest stands in for missing ones) and of its mean window, its number of windows, and 1."""
    top = probs[peaks(probs, 3)].astype(np.float64)
    top = np.concatenate([top, np.full(3 - len(top), top[-1]), [probs.mean(dtype=np.float64)]]).clip(1e-6, 1 - 1e-6)
    return np.array([*np.log(top / (1 - top)), np.log(len(probs)), 1.0])


#: Weights of summary() before any are fitted: the highest window counts alone.
HIGHEST = np.array([1.0, 0, 0, 0, 0, 0])


def _document_weights(windows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Logistic regression of labels on summaries, drawn towards HIGHEST."""
    w = HIGHEST.copy()
    if len(y) == 0:
        return w
    x = np.stack([summary(p) for p in windows])
    pull = np.array([1.0, 1, 1, 1, 1, 0.1])
    loss = lambda w: np.logaddexp(0, x @ w).sum() - y @ (x @ w) + 0.5 * (pull * (w - HIGHEST) ** 2).sum()
    for _ in range(30):
        p = 1 / (1 + np.exp(-(x @ w).clip(-30, 30)))
        step, size = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull), x.T @ (p - y) + pull * (w - HIGHEST)), 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):  # a whole step may lead away
            size /= 2
        w -= size * step
    return w


def held_out(doc: str):
    return F.coalesce(F.crc32(F.col(doc).cast("string").cast("binary")) % 3 == HELD_OUT, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, doc: str, text: str, label: str, sample: tuple[int, int]) -> list[tuple[str, int]]:
    """The bounded training sample. It is chosen among the labels, so few texts are joined."""
    usable = labels.select(F.col(doc).alias("__id"), F.col(label).cast("int").alias("y"), held_out(doc).alias("held")).filter("not held and y is not null and __id is not null")
    order = [F.xxhash64("__id"), "__id", "y"]
    chosen = usable.filter("y = 1").orderBy(*order).limit(sample[0]).unionByName(usable.filter("y = 0").orderBy(*order).limit(sample[1]))
    joined = docs.select(F.col(doc).alias("doc"), F.col(text).alias("text")).join(F.broadcast(chosen), F.col("doc") == F.col("__id"))
    before = F.sum(F.octet_length("text")).over(Window.partitionBy("y").orderBy(*order, "text")) - F.octet_length("text")
    bounded = joined.filter("text is not null").withColumn("before", before).filter(F.col("before") < SAMPLE_BYTES)
    return [(r["text"], r["y"]) for r in bounded.orderBy(*order, "text").select("text", "y").collect()]


OUT = [column("score", T.DoubleType()), column("predicted", T.IntegerType())]


def score_toxicity(docs: DataFrame, model: Model | None, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs with score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    state: dict = {}

    def fn(texts: list[bytes | None]) -> dict[str, list]:
        if "scorer" not in state:
            state["scorer"] = None if shared.value is None else Scorer(shared.value)
        scores = [0.0] * len(texts) if state["scorer"] is None else state["scorer"].scores([tokens(t) for t in texts])
        return {"score": scores, "predicted": [int(s >= threshold) for s in scores]}

    return map_text(docs, fn, OUT, text, state=state)


def toxicity(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", label: str = "toxic", sample: tuple[int, int] = SAMPLE) -> DataFrame:
    """docs with score and predicted, by a network trained on the labelled documents that aren't held out."""
    rows = labelled(docs, labels, doc, text, label, sample)
    return score_toxicity(docs, train([tokens(t.encode()) for t, _ in rows], [y for _, y in rows]), text)
