"""Acceptance of pairs: rules, then a judge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions import text as X


def rule_reason(cfg: dict, source: str = "source_text", target: str = "target_text") -> Column:
    f = cfg["filters"]
    ratio = f["length_ratio"]
    return F.expr(X.rule_reason(source, target, f["min_chars"], f["max_chars"], ratio["min"], ratio["max"], f["overlap_threshold"]))


def with_rule_reason(pairs: DataFrame, cfg: dict) -> DataFrame:
    reason = rule_reason(cfg) if cfg["filters"].get("rule_based", True) else F.lit("pass")
    return pairs.withColumn("reject_reason", F.when(reason != "pass", reason))


def judge_reason(reply: str, fail_policy: str = "conservative") -> Column:
    """Why the judge rejects a pair, from its reply; null where it passes."""
    permissive = fail_policy == "permissive"
    return F.when(~F.expr(X.judge_pass(reply, permissive)), F.expr(X.judge_reason(reply, permissive)))


def with_judgement(pairs: DataFrame, replies: DataFrame, fail_policy: str = "conservative") -> DataFrame:
    """Pairs with the judge's reason where it rejects. replies: (source_id, reply), only of pairs that passed the rules."""
    permissive = fail_policy == "permissive"
    judged = replies.select("source_id", F.expr(X.judge_pass("reply", permissive)).alias("__pass"), F.expr(X.judge_reason("reply", permissive)).alias("__why"))
    joined = pairs.join(judged, "source_id", "left")
    why = F.when(F.col("__pass"), F.lit(None)).otherwise(F.coalesce("__why", F.lit("judge_failed_permissive" if permissive else "judge_failed")))
    kept = F.coalesce("__pass", F.lit(permissive))
    return joined.withColumn("reject_reason", F.when(~kept, why)).drop("__pass", "__why")


def split_rejected(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(filtered, rejected) of rows with a reject_reason."""
    return judged.filter("reject_reason is null").drop("reject_reason"), judged.filter("reject_reason is not null")


def reason_counts(judged: DataFrame) -> DataFrame:
    return judged.groupBy(F.coalesce("reject_reason", F.lit("pass")).alias("reason")).agg(F.count("*").alias("n"))


#: Quantiles of lengths that are reported.
QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)


def length_distribution(pairs: DataFrame) -> DataFrame:
    """Exact quantiles of both sides' lengths, between neighbours in proportion. Lengths are counted before they are shuffled, so a task has a row for each length."""
    at = F.array(*[F.lit(q) for q in QUANTILES])
    return pairs.agg(F.percentile(F.length("source_text"), at).alias("source_chars"), F.percentile(F.length("target_text"), at).alias("target_chars"))
