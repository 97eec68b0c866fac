"""Final rows with their provenance."""

from __future__ import annotations

import importlib.metadata
import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PACKAGES = ("torch", "transformers", "datasets", "openai", "pyspark", "pyarrow")


def versions() -> dict[str, str | None]:
    out: dict[str, str | None] = {"python": sys.version.split()[0]}
    for name in PACKAGES:
        try:
            out[name] = importlib.metadata.version(name)
        except importlib.metadata.PackageNotFoundError:
            out[name] = None
    return out


def pair_id(cfg: dict) -> str:
    return f"{cfg['data']['src_lang']}->{cfg['data']['tgt_lang']}"


def _constant(value) -> Column:
    if isinstance(value, dict):
        return F.struct(*[_constant(v).alias(k) for k, v in value.items()])
    return F.lit(value) if value is not None else F.lit(None).cast("string")


def final_rows(filtered: DataFrame, selected: DataFrame, cfg: dict) -> DataFrame:
    """filtered with what selected knows of each source; a source it doesn't know has nulls."""
    known = selected.dropDuplicates(["source_id"]).select("source_id", "improvement", "score_greedy", "score_sample")
    joined = filtered.drop("improvement", "score_greedy", "score_sample").join(known, "source_id", "left")
    names = versions()
    packages = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v).cast("string"))])
    teacher, metricx, filters = cfg["teacher"], cfg["metricx"], cfg["filters"]
    return joined.select(
        F.lit(pair_id(cfg)).alias("pair_id"),
        F.lit(cfg["data"]["src_lang"]).alias("source_lang_code"),
        F.lit(cfg["data"]["tgt_lang"]).alias("target_lang_code"),
        "source_text",
        "target_text",
        "metricx_qe_score_best",
        F.struct("source_id", "length_bucket_id", "segment_type", "improvement", "score_greedy", "score_sample").alias("selection"),
        "madlad",
        _constant({"backend": teacher["backend"], "base_url": teacher["base_url"], "model": teacher["model"], "sampling_params": teacher["generation"]}).alias("teacher"),
        F.struct(F.lit(metricx["checkpoint"]).alias("checkpoint"), F.lit(metricx["backend"]).alias("backend"), packages.alias("versions")).alias("metricx"),
        F.struct(F.lit(filters["rule_based"]).alias("rule_based"), F.lit(filters["llm_judge"]["enabled"]).alias("llm_judge")).alias("filters"),
    )
