"""The seven stages of a run, each a table in its folder, resumable one by one."""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loomline import config, schemas
from loomline.functions import text as X
from loomline.operators import export, filters, sample, score, select, segment, teacher
from loomline.sources import corpus, sinks


@dataclass
class Options:
    limit: int | None = None
    resume: bool = False
    overwrite: bool = False
    shard_id: int = 0
    num_shards: int = 1
    #: A factory for the model's client; None takes the configured server, "stub" expressions instead of a model.
    client: teacher.ClientFactory | str | None = None


class Run:
    """A run's folder and its tables."""

    def __init__(self, spark: SparkSession, cfg: dict, options: Options | None = None):
        self.spark, self.cfg, self.options = spark, cfg, options or Options()
        self.folder = cfg["run"]["out_dir"].rstrip("/")
        self.log = logger(cfg["run"]["log_level"], cfg["run"]["log_file"])
        #: Requests that clients made again in the stage that runs; a task that is run again counts again.
        self.retries = spark.sparkContext.accumulator(0)

    def path(self, name: str, sharded: bool = False) -> str:
        path = f"{self.folder}/{name}.jsonl"
        return sinks.shard_path(path, self.options.shard_id, self.options.num_shards) if sharded else path

    def has(self, path: str) -> bool:
        return corpus._exists(self.spark, f"{path}/_SUCCESS")

    def read(self, name: str, schema: str) -> DataFrame:
        return corpus.read_jsonl(self.spark, self.path(name), schema)

    def own_shard(self, rows: DataFrame) -> DataFrame:
        n = self.options.num_shards
        return rows if n <= 1 else rows.filter(F.expr(f"{X.shard_of('source_id', n)} = {self.options.shard_id}"))

    def first(self, rows: DataFrame, *order: str) -> DataFrame:
        return rows.orderBy(*order).limit(self.options.limit) if self.options.limit else rows

    def client(self, model: str | None = None) -> teacher.ClientFactory:
        return self.options.client or teacher.http_client(self.cfg, model)

    @property
    def stub(self) -> bool:
        return self.options.client == "stub"

    def keep(self, stage: str, path: str, rows: DataFrame, counts: dict | None = None, write: Callable[[DataFrame, str], None] | None = None) -> str:
        """Write a stage's table whole."""
        start, seen = time.time(), Observation(stage)
        observed = rows.observe(seen, F.count("*").alias("rows"))
        (write or sinks.write_jsonl)(observed, path)
        self.stats(stage, {"rows": seen.get["rows"], **_pace(seen.get["rows"], start), **(counts or {})})
        return path

    def stats(self, stage: str, values: dict) -> None:
        """One small file a stage and shard under stats, so shards never overwrite each other's."""
        name = f"{self.folder}/stats/{stage}.shard{self.options.shard_id:02d}"
        self.spark.createDataFrame([(json.dumps({stage: values}),)], "value string").coalesce(1).write.mode("overwrite").text(name)
        self.log.info("%s: %s", stage, values)

    def ready(self, path: str) -> bool:
        """Whether a whole-table stage may keep what it finds. Without resume or overwrite an existing table is an error."""
        if not self.has(path) or self.options.overwrite:
            return False
        if self.options.resume:
            return True
        raise FileExistsError(f"{path} exists: resume or overwrite")

    @property
    def appends(self) -> bool:
        return self.options.resume and not self.options.overwrite

    def todo(self, rows: DataFrame, schema: str, *own: str) -> DataFrame:
        """Of rows those of this shard that the stage's own tables don't have yet, and of these the first up to the limit: so a limited run goes on where the last one ended."""
        rows, own = self.own_shard(rows), tuple(p for p in own if self.has(p))
        if own and not (self.options.resume or self.options.overwrite):
            raise FileExistsError(f"{own[0]} exists: resume or overwrite")
        if self.appends:
            rows = select.not_done(rows, *[self.spark.read.schema(schema).json(p) for p in own])
        return self.first(rows, "source_id")

    def added(self, stage: str, todo: DataFrame, make: Callable[[DataFrame], dict[str, DataFrame]]) -> None:
        """An incremental stage, committed part by part, so an interrupted run loses one part at most and a resumed one does only what is missing.

        make gives the rows of each table for a part of todo; the stage's own table is the last.
        """
        start, total = time.time(), todo.count()
        size, every = self.cfg["run"]["commit_rows"], self.cfg["run"]["log_every"]
        parts = max(1, -(-total // size))
        counts: dict[str, int] = {}
        logged = 0
        for part in range(parts):
            some = todo if parts == 1 else todo.filter(F.pmod(F.xxhash64("source_id"), F.lit(parts)) == part)
            for path, rows in make(some).items():
                seen = Observation()
                sinks.write_jsonl(rows.observe(seen, F.count("*").alias("rows")), path, append=part > 0 or self.appends)
                counts[path] = counts.get(path, 0) + seen.get["rows"]
            done = total * (part + 1) // parts
            if done - logged >= every or part == parts - 1:
                self.log.info("%s: about %d of %d sources", stage, done, total)
                logged = done
        made, again = list(counts.values()), self.retries.value
        self.retries = self.spark.sparkContext.accumulator(0)
        self.stats(stage, {"processed": total, "retries": again, "rows": made[-1], **({"rejected": made[0]} if len(made) > 1 else {}), "parts": parts, **_pace(total, start)})

    def work(self, name: str, rows: DataFrame) -> DataFrame:
        """rows written and read back: what a model says is asked for once, whatever reads it and whoever is lost."""
        path = f"{self.folder}/work/{name}.shard{self.options.shard_id:02d}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def latest(self, name: str, schema: str) -> DataFrame:
        """A table with the last row of each source: by the time of the file, then by its place."""
        rows = self.read(name, schema)
        at = F.struct("_metadata.file_modification_time", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
        return select.latest(rows.select("*", at.alias("__at")), "source_id", "__at").drop("__at")

    def cache(self) -> DataFrame:
        place = self.cfg["metricx"]["cache_db"]
        known = self.spark.read.schema(schemas.CACHE).parquet(place) if corpus._exists(self.spark, f"{place}/_SUCCESS") else self.spark.createDataFrame([], schemas.CACHE)
        return known.dropDuplicates(["scorer_id", "key"])  # shards may have scored the same

    def scores(self, pairs: DataFrame) -> DataFrame:
        """pairs (source, hypothesis, ...) with score; what the table of scores lacks is scored and added to it first."""
        scorer, name = score.scorer(self.cfg), score.scorer_id(self.cfg)
        if self.cfg["metricx"]["backend"] == "dummy":
            return pairs.withColumn("score", scorer(F.col("source"), F.col("hypothesis")))
        _, missing = score.split_known(pairs, self.cache(), name)
        new = missing.select(F.lit(name).alias("scorer_id"), "key", scorer(F.col("source"), F.col("hypothesis")).alias("score"))
        new.write.mode("append").parquet(self.cfg["metricx"]["cache_db"])
        known = self.cache().filter(F.col("scorer_id") == name).select("key", "score")
        return score.with_key(pairs).join(known, "key").drop("key")


def _pace(rows: int, start: float) -> dict:
    seconds = time.time() - start
    return {"duration_s": round(seconds, 3), "rows_per_s": round(rows / max(seconds, 1e-3), 1)}


def logger(level: str = "INFO", file_path: str | None = None) -> logging.Logger:
    """The engine's logger; the first call's handlers stay."""
    log = logging.getLogger("loomline")
    if not log.handlers:
        log.setLevel(level)
        for handler in [logging.StreamHandler(), *([logging.FileHandler(file_path, encoding="utf-8")] if file_path else [])]:
            handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
            log.addHandler(handler)
    return log


def sample_sources(run: Run) -> str:
    path = run.path("sampled_sources")
    if run.ready(path):
        return path
    _, lang = config.languages(run.cfg)
    data = run.cfg["data"]
    docs = corpus.corpus_documents(corpus.read_corpus(run.spark, data["path"] or data["madlad_dataset"], lang, data["madlad_split"], data["reader_options"]))
    segs = segment.segments(docs, run.cfg, run.cfg["final_generation"]["blob"]["enabled"])
    if run.options.limit:  # the sampler reads them twice, and they are found by a pass over the corpus
        segs = run.work("limited_segments", segment.limited(segs, run.options.limit))
    blob = run.cfg["final_generation"]["blob"]
    seen = Observation("seen")
    sampled = sample.sampled_sources(segs, run.cfg, lang, seen)  # arrivals are counted here
    targets = sample.targets(data["sample_pool_size"], blob["blob_ratio"], blob["enabled"])
    return run.keep("sample_sources", path, sampled, {"seen": seen.get["segments"], **{f"{kind}_target": n for kind, n in targets.items()}})


def prefiltered(sources: DataFrame, cfg: dict, texts: DataFrame, scores: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """sources with both scores and the improvement. texts: (source_id, greedy_text, sample_text); scores adds score to (source, hypothesis, ...)."""
    both = sources.join(texts, "source_id")
    said = "inline(array(named_struct('greedy', true, 'hypothesis', greedy_text), named_struct('greedy', false, 'hypothesis', sample_text)))"
    scored = scores(both.select("source_id", F.col("source_text").alias("source"), F.expr(said)))
    by_kind = scored.groupBy("source_id").agg(F.max(F.when(F.col("greedy"), F.col("score"))).alias("score_greedy"), F.max(F.when(~F.col("greedy"), F.col("score"))).alias("score_sample"))
    stored = ["greedy_text", "sample_text"] if cfg["prefilter"]["store_translations"] else []
    columns = ["source_id", "source_text", "length_bucket_id", "segment_type", "madlad", "score_greedy", "score_sample", (F.col("score_greedy") - F.col("score_sample")).alias("improvement"), *stored]
    return both.join(by_kind, "source_id").select(*columns)


def prefilter_score(run: Run) -> str:
    path = run.path("prefilter_candidates", True)

    def make(todo: DataFrame) -> dict[str, DataFrame]:
        if run.stub:
            texts = todo.select("source_id", F.expr(teacher.stub_greedy("source_text")).alias("greedy_text"), F.expr(teacher.stub_sample("source_text", "source_id")).alias("sample_text"))
        else:
            texts = run.work("translations", teacher.two_translations(todo, run.cfg, run.client(), run.retries))
        return {path: prefiltered(todo, run.cfg, texts, run.scores)}

    run.added("prefilter_score", run.todo(run.read("sampled_sources", schemas.SAMPLED), schemas.PREFILTERED, path), make)
    return path


def select_sources(run: Run) -> str:
    path = run.path("selected_sources")
    if run.ready(path):
        return path
    rows = run.first(run.read("prefilter_candidates", schemas.PREFILTERED), "source_id")
    buckets = len(run.cfg["bucketing"]["boundaries"]) - 1
    return run.keep("select_sources", path, select.top_sources(rows, run.cfg["data"]["target_examples_total"], run.cfg["selection"]["per_bucket"], buckets))


def generate_candidates(run: Run) -> str:
    path, n = run.path("candidates_128", True), run.cfg["final_generation"]["num_candidates"]

    def make(todo: DataFrame) -> dict[str, DataFrame]:
        if run.stub:
            return {path: todo.select("source_id", F.expr(teacher.stub_candidates("source_text", n)).alias("translations"))}
        return {path: teacher.many_candidates(todo, run.cfg, run.client(), run.retries)}

    run.added("generate_128", run.todo(run.read("selected_sources", schemas.PREFILTERED), schemas.CANDIDATES, path), make)
    return path


def _best_columns(best: DataFrame) -> DataFrame:
    return best.select("source_id", "source_text", "target_text", "metricx_qe_score_best", "madlad", "length_bucket_id", "segment_type", *(["top_k"] if "top_k" in best.columns else []))


def score_select_best(run: Run) -> str:
    path, sources = run.path("selected_best", True), run.latest("selected_sources", schemas.PREFILTERED)
    top_k = run.cfg["final_generation"]["store_top_k"]

    def make(todo: DataFrame) -> dict[str, DataFrame]:
        if run.cfg["metricx"]["backend"] == "dummy":
            return {path: _best_columns(select.best_candidates(sources, todo, X.dummy_score("source_text", "t"), top_k))}
        pairs = todo.join(sources.select("source_id", F.col("source_text").alias("source")), "source_id").select("source_id", "source", F.posexplode("translations").alias("i", "hypothesis"))
        scored = run.scores(pairs).select("source_id", "i", F.col("hypothesis").alias("translation"), "score")
        return {path: _best_columns(select.best_scored(sources, scored, top_k))}

    run.added("score_select_best", run.todo(run.latest("candidates_128", schemas.CANDIDATES), schemas.BEST, path), make)
    return path


def format_filter(run: Run) -> str:
    kept, out = run.path("filtered", True), run.path("rejected", True)
    judge = run.cfg["filters"]["llm_judge"]

    def make(pairs: DataFrame) -> dict[str, DataFrame]:
        passed, rejected = filters.split_rejected(filters.with_rule_reason(pairs, run.cfg))
        if judge["enabled"]:  # only pairs that the rules pass reach the model
            replies = passed.select("source_id", F.expr(teacher.stub_reply("source_id")).alias("reply")) if run.stub else run.work("judge_replies", teacher.judge_replies(passed, run.cfg, run.client(judge["model"]), run.retries))
            passed, also = filters.split_rejected(filters.with_judgement(passed, replies, judge["fail_policy"]))
            rejected = rejected.unionByName(also)
        return {out: rejected, kept: passed}

    run.added("format_filter", run.todo(run.read("selected_best", schemas.BEST), schemas.BEST, kept, out), make)
    return kept


def export_final(run: Run) -> str:
    fmt = run.cfg["export"]["format"]
    path = f"{run.folder}/final.parquet" if fmt == "parquet" else run.path("final")
    if run.ready(path):
        return path
    rows = export.final_rows(run.first(run.read("filtered", schemas.BEST), "source_id"), run.latest("selected_sources", schemas.PREFILTERED), run.cfg)
    return run.keep("export", path, rows, {"format": fmt}, lambda df, p: sinks.write(df, p, fmt, run.cfg["export"]["parquet_compression"]))


STAGES: dict[str, Callable[[Run], str]] = {
    "sample_sources": sample_sources,
    "prefilter_score": prefilter_score,
    "select_sources": select_sources,
    "generate_128": generate_candidates,
    "score_select_best": score_select_best,
    "format_filter": format_filter,
    "export": export_final,
}


#: Stages by what they need, so that a run can be split over two clusters.
GROUPS = {
    "all": tuple(STAGES),
    "cpu": ("sample_sources", "select_sources", "format_filter", "export"),
    "gpu": ("prefilter_score", "generate_128", "score_select_best"),
}


def run_stage(spark: SparkSession, cfg: dict, stage: str, options: Options | None = None) -> str | list[str]:
    """One stage, several split by commas, or a group of GROUPS."""
    run = Run(spark, cfg, options)
    names = [s for name in stage.split(",") for s in GROUPS.get(name, (name,))]
    unknown = [n for n in names if n not in STAGES]
    if unknown:
        raise ValueError(f"unknown stage: {', '.join(unknown)}; stages: {', '.join([*STAGES, *GROUPS])}")
    made = [STAGES[n](run) for n in names]
    return made[0] if len(made) == 1 else made
