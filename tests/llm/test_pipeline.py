"""The pipeline's stages over the cases that their docstrings define."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark):
    """Copies, near copies, one doc_id with two texts, repeated rows, nulls, empty and long texts, and columns named like results."""
    rng = random.Random(1)
    word = lambda: f"{rng.choice('bdfgk')}{rng.choice('aeiou')}{rng.choice('lmnrst')}{rng.choice('aeiou')}{rng.randrange(40)}"
    text = lambda n: " ".join(word() for _ in range(n))
    long, near = text(5000), text(60)
    rows = [(i, f"{text(30)}\nShared line.\n{text(5)}") for i in range(12)]
    rows += [(20, near), (21, near + " more"), (22, near), (23, "other " + near), (23, text(40)), (24, long), (25, None), (26, ""), (25, None), (None, text(30)), (None, near)]
    rows += [(20, near), (27, text(20)), (27, rows[-4][1] or "x")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    return docs.withColumn("score", F.lit("own")).withColumn("n_lines", F.lit(-7)).withColumn("Predicted", F.lit("own")), rows


@pytest.mark.parametrize("name", [n for n, _ in cp.STAGES])
def test_stage(spark, name):
    if name == "sentencepiece" and not os.path.exists(cp.pieces.MODEL):
        pytest.skip("no vocabulary")
    docs, rows = documents(spark)
    stage = dict(cp.STAGES)[name]
    made = stage(spark, docs, SF)
    out = [(r["doc_id"], r["text"]) for r in made.collect()]
    assert stage(spark, docs.limit(0), SF).count() == 0
    key = lambda x: (x[0] is None, x[0] or 0, x[1] or "")
    if name != "sentencepiece":
        assert made.columns == docs.columns and made.schema.simpleString() == docs.schema.simpleString()
        assert {(r["score"], r["n_lines"], r["Predicted"]) for r in made.collect()} == {("own", -7, "own")}
    if name == "toxicity":
        assert len(out) >= 0.9 * len(rows) and set(out) <= set(rows)
    elif name == "line_dedup":
        want = [(i, "\n".join(x for x in (t or "").split("\n") if x != "Shared line.")) for i, t in rows]
        assert sorted(out, key=key) == sorted(want, key=key)
        assert all(r["n_chars"] == len(r["text"]) for r in made.collect())
    elif name == "minhash_dedup":
        near = rows[12][1]
        gone = [(21, near + " more"), (22, near), (23, "other " + near), (None, near), (20, near)]  # one row of 20 stays
        want = list(rows)
        for r in gone:
            want.remove(r)
        assert sorted(out, key=key) == sorted(want, key=key)
    elif name == "decontamination":
        assert sorted(out, key=key) == sorted(((i, t or "") for i, t in rows), key=key)
    else:
        assert len(out) == len(rows) and all(r["decoded_same"] is (None if r["text"] is None else True) for r in made.collect())


def test_tables_of_earlier_stages_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cp, "shared_folder", lambda spark: str(tmp_path))
    assert cp.run(spark, SF).count() > 0
    [folder] = tmp_path.iterdir()
    assert [p.name for p in folder.iterdir()] == ["4-sentencepiece"]
