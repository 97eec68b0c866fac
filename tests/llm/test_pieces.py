from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from loomline.llm import pieces

pytestmark = pytest.mark.skipif(not os.path.exists(pieces.MODEL), reason="no vocabulary")


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary(pieces.model_bytes(pieces.MODEL))


def every(v, text: str) -> list[tuple[float, tuple]]:
    s = pieces.MARK + text.replace(" ", pieces.MARK)
    found = []

    def walk(i, ids, score):
        if i == len(s):
            found.append((score, ids))
            return
        for j in range(i + 1, min(len(s), i + 16) + 1):
            if (p := v.pieces.get(s[i:j])) is not None:
                walk(j, (*ids, p[0]), score + p[1])
        if s[i] not in v.pieces:
            walk(i + 1, (*ids, *(v.bytes[b] for b in s[i].encode())), score + v.penalty)

    walk(0, (), 0.0)
    return sorted(found, key=lambda x: -x[0])


def test_n_best_of_all_segmentations(vocabulary):
    rng = random.Random(3)
    texts = ["hello", "a  b", "né\nx 漢q", "   ", "x", "in in in"] + ["".join(rng.choice("thein ao\n") for _ in range(9)) for _ in range(30)]
    for text in texts:
        seg = pieces.Segmenter(vocabulary, 4)
        ids, score, best = seg.text(vocabulary.units(text))
        whole = every(vocabulary, text)
        assert score == whole[0][0] and [b["score"] for b in best] == [w[0] for w in whole[:4]]
        made = [tuple(pieces.applied(ids, b["edits"])) for b in best]
        scores = {w[1]: w[0] for w in whole}
        assert len(set(made)) == len(made) and all(scores[m] == b["score"] for m, b in zip(made, best))
        assert vocabulary.decode(ids).decode() == text


def test_batches_equal_single_units(vocabulary):
    """Units solved together, and each by the way of long ones."""
    rng = random.Random(4)
    units = vocabulary.units(" ".join("".join(rng.choice("abcdehinorst漢é\n.") for _ in range(rng.randrange(1, 14))) for _ in range(400)))
    units = sorted(set(units), key=len, reverse=True)
    batch = pieces.Batch(vocabulary)
    ids, counts, scores, losses = batch.solve(units)
    ends = counts.cumsum()
    for u, end, n, score, loss in zip(units, ends, counts, scores, losses):
        one, own_score, own_loss = batch.solve_long(u)
        assert one.tolist() == ids[end - n : end].tolist() and own_score == score and own_loss == loss


def test_long_units_in_blocks(vocabulary):
    """A unit over several blocks, with the ways between them: the n best equal those of plain dynamic programming."""
    rng = random.Random(5)
    unit = pieces.MARK + "".join(rng.choice("abehinrst=漢é") for _ in range(500))
    seg = pieces.Segmenter(vocabulary)
    seg.batch.BLOCK = 7
    ids, score, best = seg.text([unit])
    n_best = [[(0.0, ())]] + [[] for _ in unit]
    for end in range(1, len(unit) + 1):
        found = [(s + score, (*before, *own)) for start, own, score in vocabulary.into(unit, end) for s, before in n_best[start]]
        n_best[end] = sorted(found, key=lambda x: -x[0])[: pieces.BEST]
    assert [b["score"] for b in best] == [s for s, _ in n_best[-1]] and score == best[0]["score"]
    assert len({tuple(pieces.applied(ids, b["edits"])) for b in best}) == pieces.BEST
    assert vocabulary.decode(ids).decode() == unit[1:]


def test_very_long_text_without_spaces(vocabulary):
    """Time and memory grow with the length."""
    import time
    import tracemalloc

    rng = random.Random(6)
    texts = ["".join(rng.choice("ABCDEFabcdef0123456789+/") for _ in range(200_000)), "=" * 200_000]
    begun = time.process_time()
    for text in texts:
        ids, _, best = pieces.Segmenter(vocabulary).text(vocabulary.units(text))
        assert vocabulary.decode(ids).decode() == text and len(best) == pieces.BEST
    assert time.process_time() - begun < 120
    for text in texts:
        seg = pieces.Segmenter(vocabulary)
        tracemalloc.start()
        seg.text(vocabulary.units(text[:20_000]))
        held = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert held < 20_000 * 500 + 20_000_000


def test_encode_and_decode(spark):
    rows = [(1, "The cat\nsat  on \U0001f600"), (2, None), (3, ""), (4, "word " * 20_000), (5, "x" * 300), (1, "The cat\nsat  on \U0001f600")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    out = pieces.decode(pieces.encode(docs)).collect()
    assert len(out) == 6
    for r in out:
        assert r["decoded"] == r["text"]
        assert (r["piece_ids"] is None) == (r["text"] is None)
    assert next(r for r in out if r["doc_id"] == 3)["piece_ids"] == []
    assert pieces.encode(docs.limit(0)).count() == 0


def test_registered_query(spark, vocabulary):
    """Best and last scores of the query's rows equal those of plain dynamic programming over whole texts, which keeps the n best up to each place."""
    import hashlib

    from loomline.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op7_sentencepiece_nbest"](spark, sf).collect()
    assert len(rows) == len(texts)
    encoded = {r["doc_id"]: r["piece_ids"] for r in pieces.encode(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")).collect()}
    worth = {i: s for i, s in vocabulary.pieces.values()}
    for r in rows:
        text = texts[r["doc_id"]]
        ids = encoded[r["doc_id"]]
        assert r["decoded_same"] and vocabulary.decode(ids).decode() == text and r["n_pieces"] == len(ids)
        assert r["pieces_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        if len(text) > 4000:  # the plain way takes too long; the score of the ids still has to be the best one's
            continue
        line = pieces.MARK + text.replace(" ", pieces.MARK) if text else ""
        best = [[0.0]] + [[]] * len(line)
        for end in range(1, len(line) + 1):
            best[end] = sorted((s + score for start, _, score in vocabulary.into(line, end) for s in best[start]), reverse=True)[: pieces.BEST]
        assert r["score"] == best[-1][0] and r["last_score"] == best[-1][-1] and r["n_segmentations"] == len(best[-1])
        if all(i in worth for i in ids):
            assert sum(worth[i] for i in ids) == r["score"]
