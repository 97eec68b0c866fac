"""Quality scores of translations: backends, and a table that remembers scores."""

from __future__ import annotations

import json
import subprocess
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions import prompts
from loomline.functions import text as X

#: Takes (source, hypothesis) columns and gives a score; lower is better.
Scorer = Callable[[Column, Column], Column]


def dummy(source: Column, hypothesis: Column) -> Column:
    return F.abs(F.length(source) - F.length(hypothesis)).cast("double")


def by_model(load: Callable[[], Callable[[list[str], list[str]], list[float]]]) -> Scorer:
    """A model's scores; load runs once a worker and gives the function that scores a batch."""

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = load()
        for source, hypothesis in batches:
            values = model(source.tolist(), hypothesis.tolist())
            if len(values) != len(source):
                raise RuntimeError("the scorer gave another number of scores than it got texts")
            yield pd.Series(values, dtype="float64")

    return lambda source, hypothesis: score(source, hypothesis)


def _seq2seq(m: dict):
    def load():
        import torch
        from transformers import AutoModelForSeq2SeqLM, AutoTokenizer

        tokenizer = AutoTokenizer.from_pretrained(m["checkpoint"], use_fast=True)
        device = m["device"] if m["device_id"] is None else f"{m['device']}:{m['device_id']}"
        model = AutoModelForSeq2SeqLM.from_pretrained(m["checkpoint"]).to(device).eval()

        def score(sources: list[str], hypotheses: list[str]) -> list[float]:
            out: list[float] = []
            for at in range(0, len(sources), m["batch_size"]):
                asked = [prompts.SCORER.format(source=s, hypothesis=h, reference="") for s, h in zip(sources[at : at + m["batch_size"]], hypotheses[at : at + m["batch_size"]])]
                inputs = tokenizer(asked, return_tensors="pt", padding=True, truncation=True).to(device)
                with torch.no_grad():
                    made = model.generate(**inputs, max_new_tokens=m["max_new_tokens"], do_sample=False)
                out += [first_decimal(t) for t in tokenizer.batch_decode(made, skip_special_tokens=True)]
            return out

        return score

    return load


def _regression(m: dict):
    def load():
        import sys

        import torch
        from transformers import AutoTokenizer

        sys.path.insert(0, m["repo_path"])
        from metricx24.models import MT5ForRegression

        tokenizer = AutoTokenizer.from_pretrained(m["tokenizer"])
        device = m["device"] if m["device_id"] is None else f"{m['device']}:{m['device_id']}"
        model = MT5ForRegression.from_pretrained(m["checkpoint"], torch_dtype="auto").to(device).eval()

        def score(sources: list[str], hypotheses: list[str]) -> list[float]:
            out: list[float] = []
            for at in range(0, len(sources), m["batch_size"]):
                asked = [f"source: {s} candidate: {h}" for s, h in zip(sources[at : at + m["batch_size"]], hypotheses[at : at + m["batch_size"]])]
                # The model was trained without the closing token.
                rows = [tokenizer(t, truncation=True, max_length=m["max_input_length"])["input_ids"][:-1] for t in asked]
                batch = tokenizer.pad({"input_ids": rows}, return_tensors="pt").to(device)
                with torch.inference_mode():
                    out += model(input_ids=batch["input_ids"], attention_mask=batch["attention_mask"]).predictions.float().cpu().tolist()
            return out

        return score

    return load


def _command(m: dict):
    def load():
        def score(sources: list[str], hypotheses: list[str]) -> list[float]:
            with tempfile.TemporaryDirectory() as folder:
                asked, got = Path(folder, "in.jsonl"), Path(folder, "out.jsonl")
                asked.write_text("".join(json.dumps({"source": s, "hypothesis": h, "reference": ""}, ensure_ascii=False) + "\n" for s, h in zip(sources, hypotheses)), encoding="utf-8")
                command = [m["python_bin"], "-m", "metricx24.predict", "--tokenizer", m["tokenizer"], "--model_name_or_path", m["checkpoint"], "--max_input_length", str(m["max_input_length"])]
                subprocess.run([*command, "--batch_size", str(m["batch_size"]), "--input_file", str(asked), "--output_file", str(got), "--qe"], check=True, cwd=m["repo_path"])
                return [float(json.loads(line)["prediction"]) for line in got.read_text(encoding="utf-8").splitlines()]

        return score

    return load


def scorer(cfg: dict) -> Scorer:
    m = cfg["metricx"]
    loaders = {"hf": _seq2seq, "official_cli": _command, "official_python": _regression}
    if m["backend"] == "dummy":
        return dummy
    if m["backend"] not in loaders:
        raise ValueError(f"unknown scorer: {m['backend']}")
    return by_model(loaders[m["backend"]](m))


def first_decimal(text: str) -> float:
    import re

    found = re.search(r"-?\d+(?:\.\d+)?", text)
    if not found:
        raise RuntimeError(f"no score in: {text}")
    return float(found[0])


def scorer_id(cfg: dict) -> str:
    return f"{cfg['metricx']['backend']}:{cfg['metricx']['checkpoint']}"


def with_key(pairs: DataFrame) -> DataFrame:
    """pairs (source, hypothesis, ...) with their key in the table of scores."""
    return pairs.withColumn("key", F.expr(X.stable_hash("concat(source, '||', hypothesis)")))


def split_known(pairs: DataFrame, cache: DataFrame, scorer_id: str) -> tuple[DataFrame, DataFrame]:
    """(pairs with known scores, distinct pairs without)."""
    known = with_key(pairs).join(cache.filter(F.col("scorer_id") == scorer_id).select("key", "score"), "key", "left")
    return known.filter("score is not null"), known.filter("score is null").dropDuplicates(["key"]).select("key", "source", "hypothesis")


def upserted(cache: DataFrame, new: DataFrame) -> DataFrame:
    """cache with new rows in place of old ones of their key."""
    return cache.join(new, ["scorer_id", "key"], "left_anti").unionByName(new)


def scored_with_cache(pairs: DataFrame, cache: DataFrame, score: Scorer, scorer_id: str) -> tuple[DataFrame, DataFrame]:
    """(pairs with score, new rows for the cache); each distinct unknown pair is scored once in each of the two.

    A costly scorer's new rows are better written before they are joined, as a run's stages do.
    """
    _, missing = split_known(pairs, cache, scorer_id)
    new = missing.select(F.lit(scorer_id).alias("scorer_id"), "key", score(F.col("source"), F.col("hypothesis")).alias("score"))
    table = upserted(cache, new).filter(F.col("scorer_id") == scorer_id).select("key", "score")
    return with_key(pairs).join(table, "key").drop("key"), new
