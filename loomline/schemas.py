"""The columns of each stage's table."""

from __future__ import annotations

MADLAD = "struct<lang: string, split: string, doc_id: string, segment_index: int, segment_span: array<int>>"
SAMPLED = f"source_id string, source_text string, length int, length_bucket_id int, segment_type string, madlad {MADLAD}"
PREFILTERED = f"source_id string, source_text string, length_bucket_id int, segment_type string, madlad {MADLAD}, score_greedy double, score_sample double, improvement double"
CANDIDATES = "source_id string, translations array<string>"
BEST = f"source_id string, source_text string, target_text string, metricx_qe_score_best double, madlad {MADLAD}, length_bucket_id int, segment_type string"
TOP_K = "top_k array<struct<score: double, translation: string>>"
REJECTED = f"{BEST}, reject_reason string"
CACHE = "scorer_id string, key string, score double"
