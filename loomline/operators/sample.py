"""Stratified quota sampling of segments by length bucket.

A bucket keeps its first quota segments by arrival; a segment type that has fewer than
its total then takes overflow in arrival order. One pass counts all segments and takes quantiles of
arrival; these drop the documents that come too late for any place before they are cut into segments
again, and all windows are bounded by a rank, so what is shuffled follows the sample's size and not
the corpus's. Where a type takes overflow and that is more than a reservoir holds, it is a uniform
sample by hash instead of the first arrivals; without a reservoir it never is.

Rows with a null doc_ord arrive first, in the order of segment_index and then of a hash of the
row; quantiles don't tell them apart, so none of them is dropped unseen.
"""

from __future__ import annotations

import math
import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.functions import text as X


def quota_of(total: int, boundaries: list[int], quota: int | str) -> int:
    return math.ceil(total / (len(boundaries) - 1)) if quota == "auto" else int(quota)


def targets(pool: int, blob_ratio: float, blobs: bool) -> dict[str, int]:
    blob = int(pool * blob_ratio) if blobs else 0
    return {"sentence": pool - blob, "blob": blob}


def with_length(segs: DataFrame, cfg: dict) -> DataFrame:
    """length and length_bucket_id by the configured measure.

    The count comes out of a generator of one row: a filter on it or on the bucket would
    else be pushed below it, with the count in each of the bucket's bounds.
    """
    measure = cfg["bucketing"]["measure"]
    if measure == "approx_tokens":
        measured = segs.select("*", F.expr(f"inline(array(named_struct('length', {X.token_len('source_text')})))"))
    elif measure == "tokenizer":
        measured = segs.withColumn("length", tokenizer_length(cfg["bucketing"]["tokenizer_name"])("source_text"))
    else:
        raise ValueError(f"unknown length measure: {measure}")
    return measured.withColumn("length_bucket_id", F.expr(X.bucket_of("length", cfg["bucketing"]["boundaries"])))


def tokenizer_length(name: str):
    """Token counts by a tokenizer, loaded once a worker: a file's, or a model's by its name."""

    @F.pandas_udf("int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(name) if os.path.exists(name) else Tokenizer.from_pretrained(name)
        for texts in batches:
            yield pd.Series([len(e.ids) for e in tokenizer.encode_batch(texts.fillna("").tolist(), add_special_tokens=False)])

    return count


def with_source_id(segs: DataFrame) -> DataFrame:
    return segs.withColumn("source_id", F.expr(X.record_hash("doc_id", "segment_index", "segment_type", "source_text")))


def stratified(segs: DataFrame, totals: dict[str, int], boundaries: list[int], quota: int | str, reservoir: int | None = 200_000, seed: int = 1234, seen: Observation | None = None) -> DataFrame:
    """The sampled rows of segs with sample_rank, their place within the segment type.

    segs: (doc_ord, segment_type, segment_index, length_bucket_id, ...), one row a segment.
    seen gets the number of all rows of segs, as segments, by the time that this returns.
    """
    key = ["doc_ord", "segment_type", "segment_index"]
    buckets = len(boundaries) - 1
    quotas = {kind: quota_of(n, boundaries, quota) for kind, n in totals.items()}
    by_kind = lambda values: F.expr("case segment_type " + " ".join(f"when {X.text_lit(k)} then {n}" for k, n in values.items()) + " else 0 end")
    total_of, quota_by = by_kind(totals), by_kind(quotas)
    most, widest = max(totals.values()), max(quotas.values())
    rest = [c for c in segs.columns if c not in key and not isinstance(segs.schema[c].dataType, T.MapType)]
    tie = F.when(F.col("doc_ord").isNull(), F.xxhash64(F.lit(seed), *rest))  # documents without an id have equal keys
    within = lambda rows: rows.filter(F.col("length_bucket_id").between(0, buckets - 1) & (total_of > 0)).withColumn("tie", tie)
    inside = within(segs)
    arrivals = _arrivals(within(segs.observe(seen, F.count("*").alias("segments"))) if seen else inside)
    counts = arrivals[0]
    lacks = {k: n - sum(min(c, quotas[k]) for (kind, _), c in counts.items() if kind == k) for k, n in totals.items()}
    overflows = {k: sum(max(0, c - quotas[k]) for (kind, _), c in counts.items() if kind == k) for k in totals}
    spread = [k for k in totals if reservoir is not None and lacks[k] > 0 and overflows[k] > reservoir]

    by_bucket = Window.partitionBy("segment_type", "length_bucket_id").orderBy("doc_ord", "segment_index", "tie")
    final = Window.partitionBy("segment_type").orderBy("spill", "place", "doc_ord", "segment_index", "tie")
    of = lambda rows, kinds: rows.filter(F.col("segment_type").isin(kinds)) if spread else rows
    plain = [k for k in totals if k not in spread]
    both = None
    if plain:
        first = _up_to(of(inside, plain), _ends({k: totals[k] for k in plain}, quotas, lacks, arrivals))
        ranked = first.withColumn("rank", F.row_number().over(by_bucket)).filter(F.col("rank") <= widest + most)
        spill = F.col("rank") > quota_by
        both = ranked.withColumn("spill", spill.cast("int")).withColumn("place", F.when(spill, 0).otherwise(F.col("length_bucket_id")).cast("long"))
    if spread:
        own = tuple({at: v for at, v in x.items() if at[0] in spread} for x in arrivals)
        drawn = _with_reservoir(of(inside, spread), {k: quotas[k] for k in spread}, quota_by, by_bucket, by_kind, own, widest * buckets + min(most, reservoir), reservoir, seed)
        both = both.unionByName(drawn) if both is not None else drawn
    return both.withColumn("sample_rank", F.row_number().over(final)).filter((F.col("sample_rank") <= most) & (F.col("sample_rank") <= total_of)).drop("rank", "spill", "place", "tie")


def _with_reservoir(inside: DataFrame, quotas: dict, quota_by: Column, by_bucket: WindowSpec, by_kind: Callable[[dict], Column], arrivals: tuple[dict, dict, dict], reach: int, reservoir: int, seed: int) -> DataFrame:
    """Heads of the buckets, and of all other rows a uniform sample by hash, as many as the reservoir holds."""
    counts = arrivals[0]
    key = ["doc_ord", "segment_type", "segment_index"]
    first = _up_to(inside, {at: _last(at, quotas[at[0]], arrivals) for at in counts})
    heads = first.withColumn("rank", F.row_number().over(by_bucket)).filter((F.col("rank") <= max(quotas.values())) & (F.col("rank") <= quota_by))
    heads = heads.withColumn("spill", F.lit(0)).withColumn("place", F.col("length_bucket_id").cast("long"))
    all_of = {k: sum(n for (kind, _), n in counts.items() if kind == k) for k in quotas}
    # Hashes are uniform, so a share of them holds about that share of the rows: twice what is needed, or all.
    shares = {k: min(1.0, 2 * reach / max(1, n) + 1e-6) for k, n in all_of.items()}
    placed = inside.withColumn("place", F.xxhash64(F.lit(seed), *key, "tie"))
    early = placed.filter(F.pmod("place", F.lit(1 << 40)) < by_kind({k: int(v * (1 << 40)) for k, v in shares.items()})) if min(shares.values()) < 0.5 else placed
    early = early.withColumn("place", F.pmod("place", F.lit(1 << 40)))
    by_type = Window.partitionBy("segment_type").orderBy("place", "doc_ord", "segment_index", "tie")
    early = early.withColumn("rank", F.row_number().over(by_type)).filter(F.col("rank") <= reach)
    # Null ids are equal here, and of equal rows as many go as are heads.
    copy = F.row_number().over(Window.partitionBy(*key, "tie").orderBy("rank"))
    early, taken = early.withColumn("copy", copy), heads.withColumn("copy", copy).select(*key, "tie", "copy")
    same = [early[c].eqNullSafe(taken[c]) for c in taken.columns]
    overflow = early.join(taken, same, "left_anti").withColumn("spill", F.lit(1)).select(*heads.columns)
    both = heads.unionByName(overflow)
    spilled = Window.partitionBy("segment_type", "spill").orderBy("place", "doc_ord", "segment_index", "tie")
    return both.withColumn("rank", F.row_number().over(spilled)).filter((F.col("spill") == 0) | (F.col("rank") <= reservoir))


#: Quantiles of arrival that are taken of each bucket, and their accuracy.
QUANTILES, ACCURACY = 200, 10_000


def _arrivals(segs: DataFrame) -> tuple[dict, dict, dict]:
    """Rows of each (type, bucket), quantiles of doc_ord where it is a number, and rows where it is null: a row a bucket, whatever the corpus."""
    numeric = isinstance(segs.schema["doc_ord"].dataType, T.NumericType)
    at = F.array(*[F.lit((i + 1) / QUANTILES) for i in range(QUANTILES)])
    quantiles = F.percentile_approx("doc_ord", at, ACCURACY) if numeric else F.lit(None)
    rows = segs.groupBy("segment_type", "length_bucket_id").agg(F.count("*").alias("n"), quantiles.alias("q"), F.count_if(F.col("doc_ord").isNull()).alias("nulls")).collect()
    at_of = lambda r: (r["segment_type"], r["length_bucket_id"])
    return {at_of(r): r["n"] for r in rows}, {at_of(r): r["q"] for r in rows if r["q"] is not None}, {at_of(r): r["nulls"] for r in rows}


#: Where a bucket's rows are needed to: a doc_ord, NONE of them, or all of them where it is None.
NONE = -math.inf


def _last(at: tuple, need: int, arrivals: tuple[dict, dict, dict]) -> float | None:
    """A doc_ord by which the first need rows of a bucket have come for certain.

    A quantile's rank is off by 1 / ACCURACY of the rows at most, so one a step
    beyond what is needed holds enough; no rank is decided here. Quantiles are of the
    rows that have a doc_ord, so need is counted in them.
    """
    counts, spots, nulls = arrivals
    if need <= 0:
        return NONE
    step = -(-need * QUANTILES // max(1, counts[at] - nulls[at])) + 1 + QUANTILES // 100
    return spots[at][step - 1] if at in spots and step < QUANTILES else None


def _ends(totals: dict, quotas: dict, lacks: dict, arrivals: tuple[dict, dict, dict]) -> dict:
    """Where each bucket's rows are needed to, as heads or as overflow in arrival order.

    Heads fill the total from the first bucket on. What they lack is overflow of all
    buckets in one order, so none comes later than the one bucket that could fill it alone.
    """
    ends: dict[tuple, float | None] = {}
    for kind, total in totals.items():
        own = sorted(at for at in arrivals[0] if at[0] == kind)
        lack = lacks[kind]
        alone = [x for at in own if lack > 0 and (x := _last(at, quotas[kind] + lack, arrivals)) is not None]
        spilled = NONE if lack <= 0 else min(alone, default=None)
        left = total
        for at in own:
            heads = min(arrivals[0][at], quotas[kind], left)
            left -= heads
            last = _last(at, heads, arrivals)
            ends[at] = None if last is None or spilled is None else max(last, spilled)
    return ends


def _up_to(segs: DataFrame, ends: dict) -> DataFrame:
    """segs without rows behind the ends of their buckets; rows without a doc_ord all stay.

    The latest end is a filter of its own, which goes below the cutting of documents.
    """
    bounds = {at: x for at, x in ends.items() if x is not None}
    if not bounds:
        return segs
    arms = " ".join(f"when segment_type = {X.text_lit(kind)} and length_bucket_id = {bucket} then doc_ord is null" + (f" or doc_ord <= {x}" if x != NONE else "") for (kind, bucket), x in bounds.items())
    if len(bounds) == len(ends) and (latest := max(bounds.values())) != NONE:
        segs = segs.filter(F.expr(f"doc_ord is null or doc_ord <= {latest}"))
    return segs.filter(F.expr(f"case {arms} else true end"))


def sampled_sources(segs: DataFrame, cfg: dict, lang: str, seen: Observation | None = None) -> DataFrame:
    """The table of sampled sources; seen gets the number of all segments."""
    blob = cfg["final_generation"]["blob"]
    totals = targets(cfg["data"]["sample_pool_size"], blob["blob_ratio"], blob["enabled"])
    bucketing = cfg["bucketing"]
    picked = stratified(with_length(segs, cfg), totals, bucketing["boundaries"], bucketing["per_bucket_quota"], bucketing["spillover_reservoir"], cfg["run"]["seed"], seen)
    madlad = F.struct(F.lit(lang).alias("lang"), F.lit(cfg["data"]["madlad_split"]).alias("split"), "doc_id", F.col("segment_index").cast("int").alias("segment_index"), "segment_span")
    return with_source_id(picked).select("source_id", "source_text", F.col("length").cast("int").alias("length"), F.col("length_bucket_id").cast("int").alias("length_bucket_id"), "segment_type", madlad.alias("madlad"))
