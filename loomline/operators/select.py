"""Top-n selection of sources and of candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _order() -> list:
    """Greatest improvement first; ties by source_id, so the order is total."""
    return [F.desc("improvement"), F.asc("source_id")]


def top_sources(scored: DataFrame, n: int, per_bucket: bool = False, buckets: int | None = None) -> DataFrame:
    """The n sources with most to gain, or the best of each bucket's even share and then the n best of those."""
    if per_bucket:
        share = max(1, n // buckets)
        ranked = Window.partitionBy("length_bucket_id").orderBy(*_order())
        scored = scored.withColumn("__rank", F.row_number().over(ranked)).filter(F.col("__rank") <= share).drop("__rank")
    return scored.orderBy(*_order()).limit(n)


def latest(df: DataFrame, key: str, ordinal: str) -> DataFrame:
    """The last row of each key by an ordinal; it is aggregated before it is shuffled."""
    kept = F.max_by(F.struct(*[c for c in df.columns if c != key]), F.col(ordinal)).alias("row")
    return df.groupBy(key).agg(kept).select(key, "row.*")


def best_candidates(sources: DataFrame, candidates: DataFrame, score: str, top_k: int = 1) -> DataFrame:
    """Each source with its best-scored translation; the earliest wins ties.

    score: SQL over source_text and t for one translation's score. Candidates stay
    nested, so neither an explosion nor a second shuffle is needed.
    """
    return best_of(candidates.join(sources.dropDuplicates(["source_id"]), "source_id"), score, top_k)


def best_of(rows: DataFrame, score: str, top_k: int = 1) -> DataFrame:
    """The same of rows that have source_text and translations already; their other columns stay.

    Ranks come out of a generator of one row: a filter on the best translation would else be
    pushed below them, with the ranking of all in each place that it names one.
    """
    made = f"array_sort(transform(translations, (t, i) -> named_struct('score', {score}, 'i', i, 'translation', t)))"
    ranked = rows.select("*", F.expr(f"inline(array(named_struct('ranked', {made})))")).filter(F.size("ranked") > 0)
    return _best(ranked.drop("translations"), top_k)


def best_scored(sources: DataFrame, scored: DataFrame, top_k: int = 1) -> DataFrame:
    """The same from (source_id, i, translation, score) rows, as a model scorer gives them."""
    lists = scored.groupBy("source_id").agg(F.array_sort(F.collect_list(F.struct("score", "i", "translation"))).alias("ranked"))
    return _best(lists.join(sources.dropDuplicates(["source_id"]), "source_id"), top_k)


def _best(ranked: DataFrame, top_k: int) -> DataFrame:
    best = F.element_at("ranked", 1)
    made = {"target_text": best["translation"], "metricx_qe_score_best": best["score"]}
    if top_k > 1:
        made["top_k"] = F.expr(f"transform(slice(ranked, 1, {top_k}), r -> named_struct('score', r.score, 'translation', r.translation))")
    return ranked.withColumns(made).drop("ranked")


def not_done(todo: DataFrame, *done: DataFrame, key: str = "source_id") -> DataFrame:
    """Rows whose key no finished table has."""
    for d in done:
        todo = todo.join(d.select(key).distinct(), key, "left_anti")
    return todo
