"""A whole run as one plan, with expressions in the model's place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.functions import text as X
from loomline.operators import filters, sample, segment, select, teacher


def fused(docs: DataFrame, cfg: dict, lang: str = "en") -> DataFrame:
    """Judged pairs of (doc_ord, doc_id, text), with each source's scores and reject_reason.

    Every step but the sample works on its row alone, so the plan has no join: a
    source carries its translations, scores and verdicts along.
    """
    sources = sample.sampled_sources(segment.segments(docs, cfg), cfg, lang)
    scored = sources.withColumns({"score_greedy": F.expr(X.dummy_score("source_text", teacher.stub_greedy("source_text"))), "score_sample": F.expr(X.dummy_score("source_text", teacher.stub_sample("source_text", "source_id")))})
    selected = select.top_sources(scored.withColumn("improvement", F.expr("score_greedy - score_sample")), cfg["data"]["target_examples_total"])
    candidates = selected.withColumn("translations", F.expr(teacher.stub_candidates("source_text", cfg["final_generation"]["num_candidates"])))
    best = select.best_of(candidates, X.dummy_score("source_text", "t"))
    ruled = filters.with_rule_reason(best, cfg).withColumn("reply", F.expr(teacher.stub_reply("source_id")))
    return ruled.withColumn("reject_reason", F.coalesce("reject_reason", filters.judge_reason("reply"))).drop("reply")
