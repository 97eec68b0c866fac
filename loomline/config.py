"""Settings of a run: defaults, a YAML file over them, and checks."""

from __future__ import annotations

import copy
from pathlib import Path
from typing import Any

from loomline.functions.text import ERROR_SUBSTRINGS

# The defaults that runs are configured against.
DEFAULTS: dict[str, Any] = {
    "run": {"out_dir": "./runs/exp001", "seed": 1234, "log_level": "INFO", "log_file": None, "log_every": 10000, "commit_rows": 20000},
    "data": {
        "path": None,
        "madlad_dataset": "allenai/MADLAD-400",
        "madlad_split": "clean",
        "src_lang": "kor",
        "tgt_lang": "eng",
        "lang_map": {"kor": "ko", "eng": "en", "jpn": "ja", "cmn": "zh"},
        "target_examples_total": 10000,
        "sample_pool_size": 1000000,
        "reader_options": {},
    },
    "segmentation": {"mode": "auto", "min_chars": 20, "max_chars": 5000, "merge_short": True, "allow_html": False},
    "bucketing": {
        "boundaries": [0, 10, 20, 40, 80, 120, 200, 400, 800, 999999],
        "measure": "approx_tokens",
        "per_bucket_quota": "auto",
        "spillover_reservoir": 200000,
        "tokenizer_name": None,
    },
    "teacher": {
        "backend": "vllm_openai_compatible",
        "base_url": "http://localhost:8000/v1",
        "api_key_env": "VLLM_API_KEY",
        "model": "Qwen/Qwen3-235B-A22B-Instruct-2507",
        "request_timeout_s": 120,
        "max_concurrency": 32,
        "retry": {"max_attempts": 6, "backoff_s": [1, 2, 4, 8, 16, 32]},
        "unset_proxies_before_request": True,
        "validation": {"min_chars": 1, "error_substrings": list(ERROR_SUBSTRINGS)},
        "generation": {"max_tokens": 512, "top_p": 1.0, "greedy_temperature": 0.0, "sample_temperature": 1.0, "final_temperature": 1.0, "seed": None, "seed_step": 0},
    },
    "prefilter": {"store_translations": False},
    "selection": {"per_bucket": False},
    "final_generation": {"num_candidates": 128, "store_top_k": 1, "strategy": "auto", "blob": {"enabled": True, "blob_ratio": 0.5, "blob_max_tokens": 512}},
    "metricx": {
        "backend": "official_python",
        "checkpoint": "google/metricx-24-hybrid-xxl-v2p6",
        "tokenizer": "google/mt5-xl",
        "max_input_length": 1536,
        "batch_size": 64,
        "device": "cuda",
        "device_id": None,
        "cache_db": "./runs/exp001/metricx_cache",
        "repo_path": "./third_party/metricx",
        "python_bin": "./.metricx-venv/bin/python",
        "max_new_tokens": 8,
    },
    "filters": {
        "rule_based": True,
        "llm_judge": {"enabled": True, "model": "Qwen/Qwen3-235B-A22B-Instruct-2507", "temperature": 0.0, "max_tokens": 128, "fail_policy": "conservative"},
        "length_ratio": {"min": 0.25, "max": 4.0},
        "overlap_threshold": 0.9,
        "min_chars": 1,
        "max_chars": 20000,
    },
    "export": {"format": "jsonl", "parquet_compression": "zstd"},
}


def merged(base: dict, over: dict) -> dict:
    """base with over's values; mappings merge, everything else is replaced."""
    out = copy.deepcopy(base)
    for key, value in over.items():
        out[key] = merged(out[key], value) if isinstance(value, dict) and isinstance(out.get(key), dict) else copy.deepcopy(value)
    return out


def load(path: str | None = None, **over: Any) -> dict:
    import yaml

    read = (yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}) if path else {}
    cfg = merged(merged(DEFAULTS, read), over)
    if path:
        cfg = resolved(cfg, Path(path).resolve().parent)
    check(cfg)
    return cfg


def resolved(cfg: dict, folder: Path) -> dict:
    """Relative output and cache paths stand under the settings file; store addresses stay."""
    out = copy.deepcopy(cfg)
    for group, key in (("run", "out_dir"), ("metricx", "cache_db")):
        value = str(out[group][key])
        if "://" not in value and not Path(value).is_absolute():
            out[group][key] = str(folder / value)
    return out


#: What a run's settings have to be: where a value stands, whether it will do, and what it should be.
CHECKS = (
    (("bucketing", "boundaries"), lambda x: len(x) >= 2 and all(a <= b for a, b in zip(x, x[1:])), "two or more ascending numbers"),
    (("final_generation", "num_candidates"), lambda x: x > 0, "positive"),
    (("data", "sample_pool_size"), lambda x: x > 0, "positive"),
    (("final_generation", "blob", "blob_ratio"), lambda x: 0 <= x <= 1, "from 0 to 1"),
    (("run", "commit_rows"), lambda x: x > 0, "positive"),
    (("teacher", "max_concurrency"), lambda x: x > 0, "positive"),
)


def check(cfg: dict) -> None:
    """Fails with all settings that won't do."""
    wrong = []
    for place, good, what in CHECKS:
        value = cfg
        for key in place:
            value = value[key]
        if not good(value):
            wrong.append(f"{'.'.join(place)} must be {what}, not {value}")
    if wrong:
        raise ValueError("; ".join(wrong))


def dry_run(cfg: dict) -> dict:
    """Small caps, for trying a configuration."""
    out = copy.deepcopy(cfg)
    for group, key, most in (("data", "sample_pool_size", 1000), ("data", "target_examples_total", 100), ("final_generation", "num_candidates", 8)):
        out[group][key] = min(out[group][key], most)
    return out


def languages(cfg: dict) -> tuple[str, str]:
    """The source language as configured, and as the corpus names it."""
    raw = cfg["data"]["src_lang"]
    return raw, cfg["data"]["lang_map"].get(raw, raw)
