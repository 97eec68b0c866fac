from __future__ import annotations

import random
from zlib import crc32

import numpy as np

from loomline.llm import toxicity


def test_gradients():
    rng = np.random.default_rng(0)
    vocabulary = {b"hello": 1, b"abc": 2}
    params = {k: v.astype(np.float64) for k, v in toxicity.fresh(1, vocabulary).items()}
    words, at, y = [b"abc", b"hello", b"x", b"toxicword"], np.array([[0, 1, 2, -1], [3, 1, 0, 2]]), np.array([1.0, 0.0])
    grads = toxicity.Network(params, vocabulary).gradients(words, at, y, np.ones(2))

    def loss() -> float:
        net = toxicity.Network(params, vocabulary)
        p = net.windows(net.word_inputs(words), at)
        return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())

    for name, grad in grads.items():
        spot = {"embed": (1, 3), "chars": (ord("l"), 2)}.get(name) or tuple(int(rng.integers(n)) for n in params[name].shape)
        old, step = params[name][spot], 1e-3
        params[name][spot] = old + step
        up = loss()
        params[name][spot] = old - step
        down = loss()
        params[name][spot] = old
        assert abs((up - down) / (2 * step) - grad[spot]) < 2e-5 + 2e-3 * abs(grad[spot]), name


def corpus(n: int = 700):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        w = [f"{rng.choice('bdfgk')}{rng.choice('aeiou')}{rng.choice('lmnrst')}{rng.choice('aeiou')}" for _ in range(rng.randrange(20, 120))]
        if toxic:
            for _ in range(3):
                w[rng.randrange(len(w))] = f"zarg{rng.choice('aeiou')}{rng.choice('lmnrst')}"
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    more = [*rows[:5], (5000, None), (5001, ""), (5002, " ".join(t for _, t in rows)), (None, rows[0][1])]  # repeated rows, nulls, a long text
    docs = spark.createDataFrame([*rows, *more], "doc_id long, text string").selectExpr("*", "'clash' as score")
    known = spark.createDataFrame([*labels, (6000, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    scored = toxicity.toxicity(docs, known).withColumn("held_out", toxicity.held_out("doc_id")).collect()
    assert len(scored) == len(rows) + len(more)
    assert all(r["held_out"] == (r["doc_id"] is not None and crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in scored)
    of_text = {}
    assert all(abs(of_text.setdefault(r["text"], r["score"]) - r["score"]) < 1e-6 for r in scored)
    out = {r["doc_id"]: r for r in scored}
    assert out[5000]["score"] == out[5001]["score"] == 0.0
    apart = [(out[i]["predicted"], y) for i, y in labels if out[i]["held_out"]]
    assert sum(p for p, y in apart if y) >= 0.8 * sum(y for _, y in apart)
    assert sum(p for p, y in apart if not y) <= 0.05 * len(apart)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in scored)


def test_sample_is_bounded(spark, monkeypatch):
    rows, labels = corpus(200)
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    whole = toxicity.labelled(docs, known, "doc_id", "text", "toxic", (15, 40))
    assert sum(y for _, y in whole) == 15 and len(whole) == 55
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 2000)
    part = toxicity.labelled(docs, known, "doc_id", "text", "toxic", (15, 40))
    for y in (0, 1):
        own, all_of = ([t for t, label in found if label == y] for found in (part, whole))
        assert own == all_of[: len(own)] and sum(map(len, own[:-1])) < 2000 <= sum(map(len, own))


def test_without_both_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.toxicity(docs, labels).collect()} == {0.0}
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_every_window_is_scored():
    """A window's score is the attention over its own words alone, whose states are read from its span."""
    net = toxicity.Network(toxicity.fresh(3), {})
    words = [f"w{i}".encode() for i in range(300)]
    [whole] = toxicity.Scorer((net.w, {})).window_scores([words])
    inputs, step = net.word_inputs(words), toxicity.SPAN - toxicity.WINDOW + 1
    assert len(whole) == 269
    for start in range(269):
        first = start // step * step
        at = np.arange(first, min(first + toxicity.SPAN, 300))[None]
        pool = ((at >= start) & (at < start + toxicity.WINDOW)).astype(np.float32)
        assert np.allclose(net.windows(inputs, at, pool=pool), whole[start], atol=1e-6)
    assert [len(p) for p in toxicity.Scorer((net.w, {})).window_scores([[], words[:5], [], words[:33]])] == [0, 1, 0, 2]
    assert toxicity.peaks(np.array([0.1, 0.9, 0.8] + [0.2] * 30 + [0.5]), 3) == [1, 33]


def test_texts_score_alike_in_any_company():
    """Long, short and empty texts together score as they do alone."""
    model = (toxicity.fresh(3), {})
    texts = [[f"w{i * k}".encode() for i in range(n)] for k, n in enumerate((500, 0, 3, 128, 129, 40, 1))]
    together = toxicity.Scorer(model).scores(texts)
    assert np.allclose(together, [toxicity.Scorer(model).scores([t])[0] for t in texts], atol=1e-6)


def test_held_out_recall_on_the_tables(spark):
    """The registered query finds the held-out toxic documents and leaves others alone."""
    from loomline.llm.queries import QUERIES

    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op8_toxicity"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    judged = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    toxic, other = [p for y, p in judged if y == 1], [p for y, p in judged if y == 0]
    assert sum(toxic) >= 0.85 * len(toxic) and sum(other) <= 0.02 * len(other)


def test_document_weights_settle():
    """Documents that their windows tell apart far off: whole Newton steps run away here."""
    rng = np.random.default_rng(4)
    y = np.array([0, 0, 0, 0, 1] * 80, np.float64)
    windows = [np.clip(rng.beta(0.05, 3, 250), 1e-7, 1) for _ in y]
    for p, toxic in zip(windows, y):
        p[rng.integers(250)] = 0.999999 if toxic and rng.random() < 0.9 else p.max()
    w = toxicity._document_weights(windows, y)
    x = np.stack([toxicity.summary(p) for p in windows])
    pull = np.array([1.0, 1, 1, 1, 1, 0.1])
    p = 1 / (1 + np.exp(-(x @ w)))
    assert np.abs(x.T @ (p - y) + pull * (w - toxicity.HIGHEST)).max() < 1e-3
