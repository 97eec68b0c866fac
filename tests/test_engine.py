"""Operators, stages and the command line."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from loomline import cli, config, schemas
from loomline.operators import filters, sample, score, segment, select, teacher
from loomline.plans.stages import Options, run_stage
from loomline.queries import EchoClient
from loomline.sources import corpus, sinks
from loomline.streaming import segments as streaming

SEG = {"mode": "auto", "min_chars": 2, "max_chars": 100, "merge_short": False, "allow_html": True}


def cfg_of(**seg) -> dict:
    return config.merged(config.DEFAULTS, {"segmentation": {**SEG, **seg}})


def test_list_and_string_fields(spark):
    lists = spark.createDataFrame([(1, "1", [" hello ", "", None, "world"])], "doc_ord long, doc_id string, text array<string>")
    found = segment.segments(lists, cfg_of(), include_blobs=False)
    assert [r["source_text"] for r in found.collect()] == ["hello", "world"]
    strings = spark.createDataFrame([(1, "1", "Hello\nworld"), (2, "2", None), (3, "3", "")], "doc_ord long, doc_id string, text string")
    found = segment.segments(strings, cfg_of(min_chars=6, merge_short=True))
    assert {(r["segment_type"], r["source_text"]) for r in found.collect()} == {("sentence", "Hello world"), ("blob", "Hello world")}


def test_blob_bounds(spark):
    cfg = config.merged(cfg_of(min_chars=1), {"final_generation": {"blob": {"blob_max_tokens": 4}}})
    docs = spark.createDataFrame([(1, "1", "a b\nc d\ne\nf g h i j\nk")], "doc_ord long, doc_id string, text string")
    blobs = segment.segments(docs, cfg).filter("segment_type = 'blob'").orderBy("segment_index").collect()
    assert [(r["source_text"], list(r["segment_span"])) for r in blobs] == [("a b c d", [0, 1]), ("e", [2, 2]), ("f g h i j", [3, 3]), ("k", [4, 4])]


def test_quota_and_spill(spark):
    segs = spark.range(10).select(F.col("id").alias("doc_ord"), F.lit("sentence").alias("segment_type"), F.lit(0).alias("segment_index"), F.expr("if(id < 5, 0, 1)").alias("length_bucket_id"))
    take = lambda **k: [r["doc_ord"] for r in sample.stratified(segs, {"sentence": k.pop("total")}, [0, 5, 10], **k).orderBy("sample_rank").collect()]
    assert take(total=4, quota=2) == [0, 1, 5, 6]
    assert take(total=6, quota=2) == [0, 1, 5, 6, 2, 3]
    assert take(total=3, quota=2) == [0, 1, 5]
    assert take(total=20, quota=2) == [0, 1, 5, 6, 2, 3, 4, 7, 8, 9]
    assert take(total=2, quota=0) == [0, 1]
    spilled = take(total=6, quota=2, reservoir=3)
    assert spilled[:4] == [0, 1, 5, 6] and len(set(spilled)) == 6


@pytest.mark.parametrize("reservoir", [100_000, 50])
def test_late_documents_are_dropped_unseen(spark, reservoir):
    """A corpus much larger than the sample: the quantiles prune, and the rows are those of a plain sort."""
    segs = spark.range(40_000).select(
        ((F.col("id") * 7919) % 40_000).alias("doc_ord"), F.expr("if(id % 3 = 0, 'blob', 'sentence')").alias("segment_type"), F.lit(0).alias("segment_index"), F.expr("cast(id % 5 = 0 as int)").alias("length_bucket_id")
    )
    got = sample.stratified(segs, {"sentence": 300, "blob": 100}, [0, 5, 10], 60, reservoir).toPandas()
    rows = segs.toPandas().sort_values("doc_ord")
    for kind, total in (("sentence", 300), ("blob", 100)):
        own = rows[rows.segment_type == kind]
        heads = [d for b in (0, 1) for d in own[own.length_bucket_id == b].doc_ord.head(60)]
        found = got[got.segment_type == kind].sort_values("sample_rank").doc_ord.tolist()
        if reservoir == 50:
            assert found[: len(heads)] == heads[:total] and len(found) == min(total, len(heads) + 50) and len(set(found)) == len(found)
        else:
            rest = [d for d in own.doc_ord if d not in set(heads)]
            assert found == (heads + rest)[:total]


@pytest.mark.parametrize("nulls", [20, 150, 39_000])
def test_null_ids_are_sampled_alike(spark, monkeypatch, nulls):
    """Rows without a doc_ord come first, each once, pruned or not."""
    segs = spark.range(40_000).select(
        F.expr(f"if(id < {nulls}, null, (id * 7919) % 40000)").alias("doc_ord"), F.lit("sentence").alias("segment_type"), F.expr("int(id % 2)").alias("segment_index"), F.expr("cast(id % 5 = 0 as int)").alias("length_bucket_id"), F.col("id").alias("n")
    )
    take = lambda: [r["n"] for r in sample.stratified(segs, {"sentence": 300}, [0, 5, 10], 60).orderBy("sample_rank").collect()]
    pruned = take()
    monkeypatch.setattr(sample, "_up_to", lambda segs, *a: segs)
    assert take() == pruned and len(set(pruned)) == 300
    assert sum(n < nulls for n in pruned) == min(nulls, 300) or nulls == 39_000 and sum(n < nulls for n in pruned[:120]) == 120


def _kinds(spark):
    return spark.range(40_000).select(
        ((F.col("id") * 7919) % 40_000).alias("doc_ord"), F.expr("if(id % 4 = 0, 'blob', 'sentence')").alias("segment_type"), F.lit(0).alias("segment_index"), F.expr("case when id % 5 = 0 then 1 when id < 40 then 2 else 0 end").alias("length_bucket_id")
    )


def test_documents_behind_the_last_place_are_not_cut_again(spark):
    """With a rare bucket, whose few rows are all heads or nearly: the second pass reads documents up to the last that has a place."""
    rows = spark.range(40_000).select(F.col("id").alias("doc_ord"), F.lit("sentence").alias("segment_type"), F.lit(0).alias("segment_index"), F.expr("cast(id % 400 = 0 as int)").alias("length_bucket_id"))
    got = sample.stratified(rows, {"sentence": 40}, [0, 5, 10], 20)
    assert [r["doc_ord"] for r in got.orderBy("sample_rank").collect()] == [x for x in range(21) if x][:20] + [400 * i for i in range(20)]
    lacks, counts = {"sentence": 0}, {("sentence", 0): 39_900, ("sentence", 1): 100}
    spots = {at: [(i + 1) * 200 for i in range(sample.QUANTILES)] for at in counts}
    ends = sample._ends({"sentence": 40}, {"sentence": 20}, lacks, (counts, spots, dict.fromkeys(counts, 0)))
    assert ends["sentence", 0] <= 1000 and ends["sentence", 1] <= 200 * 45
    assert sample._ends({"sentence": 20}, {"sentence": 20}, lacks, (counts, spots, dict.fromkeys(counts, 0)))["sentence", 1] == sample.NONE


@pytest.mark.parametrize("reservoir, blobs", [(None, 150), (10_000, 150), (100, 100)])
def test_overflow_comes_by_arrival_up_to_the_reservoir(spark, reservoir, blobs):
    """Each type has a reservoir of its own; without one, or where heads fill the total, overflow is never drawn by hash."""
    got, rows = sample.stratified(_kinds(spark), {"sentence": 300, "blob": blobs}, [0, 5, 10, 15], 60, reservoir).toPandas(), _kinds(spark).toPandas().sort_values("doc_ord")
    for kind, total in (("sentence", 300), ("blob", blobs)):
        own = rows[rows.segment_type == kind]
        heads = [d for b in (0, 1, 2) for d in own[own.length_bucket_id == b].doc_ord.head(60)]
        rest = [d for d in own.doc_ord if d not in set(heads)]
        found = got[got.segment_type == kind].sort_values("sample_rank").doc_ord.tolist()
        if kind == "blob" or reservoir is None:
            assert found == (heads + rest)[:total]
        else:
            assert found[: len(heads)] == heads and found != (heads + rest)[:total] and len(set(found)) == min(total, len(heads) + reservoir)


def test_top_sources_ties(spark):
    rows = [(f"s{i}", float(i % 3), i % 2) for i in range(9)]
    scored = spark.createDataFrame(rows, "source_id string, improvement double, length_bucket_id int")
    assert [r["source_id"] for r in select.top_sources(scored, 4).collect()] == ["s2", "s5", "s8", "s1"]
    assert [r["source_id"] for r in select.top_sources(scored, 4, True, 2).collect()] == ["s2", "s5", "s8", "s1"]


def test_best_candidates(spark):
    sources = spark.createDataFrame([("s1", "hello", 0, "sentence", "m"), ("s2", "x", 0, "sentence", "m")], "source_id string, source_text string, length_bucket_id int, segment_type string, madlad string")
    candidates = spark.createDataFrame([("s1", ["hi", "hello world", "ho"]), ("s2", []), ("s3", ["y"])], "source_id string, translations array<string>")
    got = select.best_candidates(sources, candidates, "abs(length(source_text) - length(t))", 2).collect()
    assert len(got) == 1 and got[0]["target_text"] == "hi" and [k["translation"] for k in got[0]["top_k"]] == ["hi", "ho"]


def test_export_cuts_documents_once(spark, tmp_path):
    """export_final reads its sources from a table, ranks translations in one place, and has a row a source though an id comes twice."""
    from loomline.queries import QUERIES

    docs = spark.createDataFrame([(1, "A line that is long enough to be a segment."), (1, "A line that is long enough to be a segment."), (2, "Another line, which is as long as the first.")], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    made = QUERIES["export_final"](spark, str(tmp_path))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "documents.parquet" not in " ".join(made.inputFiles()) and plan.count("array_sort") == 1
    assert len({r["source_id"] for r in made.collect()}) == made.count() == 2


def test_dummy_scores_and_cache(spark):
    pairs = spark.createDataFrame([("aaa", "aa"), ("bbbb", "bbbbbb"), ("aaa", "aa")], "source string, hypothesis string")
    none = spark.createDataFrame([], schemas.CACHE)
    scored, new = score.scored_with_cache(pairs, none, score.dummy, "d")
    assert sorted(r["score"] for r in scored.collect()) == [1.0, 1.0, 2.0] and new.count() == 2
    known = new.withColumn("score", F.col("score") + 100)
    again, more = score.scored_with_cache(pairs, known, score.dummy, "d")
    assert sorted(r["score"] for r in again.collect()) == [101.0, 101.0, 102.0] and more.count() == 0
    assert score.upserted(known, new.limit(1)).count() == 2
    with pytest.raises(ValueError):
        score.scorer(config.merged(config.DEFAULTS, {"metricx": {"backend": "other"}}))
    by_model = score.by_model(lambda: lambda s, h: [float(len(x) + len(y)) for x, y in zip(s, h)])
    assert sorted(r[0] for r in pairs.select(by_model(F.col("source"), F.col("hypothesis"))).collect()) == [5.0, 5.0, 10.0]


def answer(*texts: str) -> dict:
    return {"choices": [{"message": {"content": t}} for t in texts]}


def test_client_retries():
    calls, slept = [], []

    def send(payload, headers):
        calls.append(headers["Idempotency-Key"])
        if len(calls) == 1:
            raise OSError("down")
        return answer("Traceback (most recent call last)" if len(calls) == 2 else "ok")

    client = teacher.HttpClient("http://x", "m", max_attempts=4, backoff_s=[1, 2], send=send, sleep=slept.append)
    assert client.generate([{"role": "user", "content": "hi"}], teacher.Generation(0.0), "r") == ["ok"]
    assert slept == [1, 2] and len(set(calls)) == 1
    assert teacher.backoff_schedule([1, 2], 5) == [1, 2, 2, 2] and teacher.backoff_schedule([1], 1) == []

    def no_template(payload, headers):
        raise RuntimeError("no Chat Template here")

    with pytest.raises(teacher.TemplateMissing):
        teacher.HttpClient("http://x", "m", send=no_template, sleep=slept.append).generate([], teacher.Generation(0.0))


def test_candidate_strategies():
    class Few:
        def __init__(self, fails: bool):
            self.fails, self.asked = fails, []

        def generate(self, messages, params, request_id=None):
            self.asked.append((params.n, params.seed))
            if params.n > 1 and self.fails:
                raise RuntimeError
            return ["t"]

    params = teacher.Generation(1.0, seed=5)
    for strategy, fails, want in (("auto", True, [(3, 5), (1, 5), (1, 6), (1, 7)]), ("n_parameter", False, [(3, 5), (1, 5), (1, 6), (1, 7)]), ("per_call", True, [(1, 5), (1, 6), (1, 7)])):
        few = Few(fails)
        assert teacher.candidates_of(few, [], 3, params, strategy, "r", 1) == ["t"] * 3 and few.asked == want
    with pytest.raises(RuntimeError):
        teacher.candidates_of(Few(True), [], 3, params, "n_parameter", "r")


def test_judge_failure_policy(spark):
    pairs = spark.createDataFrame([("a",), ("b",), ("c",)], "source_id string")
    replies = spark.createDataFrame([("a", '{"pass": true}'), ("b", None)], "source_id string, reply string")
    reasons = lambda policy: {r["source_id"]: r["reject_reason"] for r in filters.with_judgement(pairs, replies, policy).collect()}
    assert reasons("conservative") == {"a": None, "b": "judge_failed", "c": "judge_failed"}
    assert reasons("permissive") == {"a": None, "b": None, "c": None}


def test_sources(spark, tmp_path):
    folder = str(tmp_path)
    (tmp_path / "t.shard01.jsonl").write_text('{"source_id": "b"}\n\n')
    (tmp_path / "t.shard00.jsonl").write_text('{"source_id": "a"}\n')
    assert sorted(r[0] for r in corpus.read_jsonl(spark, f"{folder}/t.jsonl", "source_id string").collect()) == ["a", "b"]
    (tmp_path / "t.jsonl").write_text('{"source_id": "whole"}\n')
    assert [r[0] for r in corpus.read_jsonl(spark, f"{folder}/t.jsonl", "source_id string").collect()] == ["whole"]
    (tmp_path / "bad.jsonl").write_text('{"source_id": \n')
    with pytest.raises(Exception):
        corpus.read_jsonl(spark, f"{folder}/bad.jsonl", "source_id string").collect()
    with pytest.raises(FileNotFoundError):
        corpus.read_jsonl(spark, f"{folder}/none.jsonl", "source_id string")
    df = spark.createDataFrame([("a", None)], "source_id string, x string")
    sinks.write_jsonl(df, f"{folder}/out")
    assert '"x":null' in "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    sinks.write_parquet(df, f"{folder}/p.parquet")
    assert corpus.read_parquet(spark, f"{folder}/p.parquet").count() == 1
    sinks.write_sharded(spark.range(50).selectExpr("cast(id as string) source_id"), f"{folder}/s", 4)
    assert spark.read.json(f"{folder}/s").count() == 50
    sinks.write_text(spark.createDataFrame([("line",)], "value string"), f"{folder}/txt")
    assert corpus.read_text(spark, f"{folder}/txt").first()[0] == "line"
    assert sinks.shard_path("a/x.jsonl", 3, 8) == "a/x.shard03.jsonl" and sinks.shard_path("x.jsonl", 0, 1) == "x.jsonl"
    bare = spark.createDataFrame([("one", None), (None, "c"), ("two", "d")], "text string, content string")
    assert [(r["doc_id"], r["text"]) for r in corpus.corpus_documents(bare).collect()] == [("doc_0", "one"), ("doc_2", "two")]
    with pytest.raises(FileNotFoundError, match="no corpus"):
        corpus.read_corpus(spark, [f"{folder}/no1.parquet", f"{folder}/no2.parquet"])


def test_config(tmp_path):
    file = tmp_path / "c.yaml"
    file.write_text("run:\n  out_dir: runs/x\nsegmentation:\n  min_chars: 3\n")
    cfg = config.load(str(file))
    assert cfg["run"]["out_dir"] == str(tmp_path / "runs/x") and cfg["segmentation"]["min_chars"] == 3 and cfg["segmentation"]["max_chars"] == 5000
    assert config.dry_run(cfg)["final_generation"]["num_candidates"] == 8
    assert config.languages(cfg) == ("kor", "ko")
    for bad in ({"bucketing": {"boundaries": [5, 1]}}, {"final_generation": {"num_candidates": 0}}, {"data": {"sample_pool_size": 0}}, {"final_generation": {"blob": {"blob_ratio": 2}}}):
        with pytest.raises(ValueError):
            config.check(config.merged(config.DEFAULTS, bad))


@pytest.fixture
def run_cfg(spark, tmp_path):
    rows = [(i, "\n".join(f"Sentence number {j} of document {i} says {'more ' * (j % 5)}than enough." for j in range(6)), "en") for i in range(12)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "docs.parquet"))
    over = {
        "run": {"out_dir": str(tmp_path / "run")}, "data": {"path": str(tmp_path / "docs.parquet"), "src_lang": "en", "tgt_lang": "fr", "sample_pool_size": 40, "target_examples_total": 12},
        "final_generation": {"num_candidates": 3}, "metricx": {"backend": "dummy", "cache_db": str(tmp_path / "cache")},
    }
    return config.merged(config.DEFAULTS, over)


@pytest.mark.parametrize("client", ["stub", EchoClient])
def test_whole_run(spark, run_cfg, tmp_path, client):
    paths = run_stage(spark, run_cfg, "all", Options(client=client))
    final = spark.read.json(paths[-1]).collect()
    filtered = spark.read.schema(schemas.BEST).json(f"{run_cfg['run']['out_dir']}/filtered.jsonl").count()
    rejected = spark.read.schema(schemas.REJECTED).json(f"{run_cfg['run']['out_dir']}/rejected.jsonl").count()
    assert len(final) == filtered and filtered + rejected == 12
    assert final[0]["pair_id"] == "en->fr" and final[0]["selection"]["improvement"] is not None and final[0]["metricx"]["versions"]["pyspark"]
    with pytest.raises(FileExistsError):
        run_stage(spark, run_cfg, "prefilter_score", Options(client=client))
    before = spark.read.schema(schemas.PREFILTERED).json(f"{run_cfg['run']['out_dir']}/prefilter_candidates.jsonl").count()
    run_stage(spark, run_cfg, "all", Options(resume=True, client=client))
    after = spark.read.schema(schemas.PREFILTERED).json(f"{run_cfg['run']['out_dir']}/prefilter_candidates.jsonl").count()
    assert before == after == 32  # 20 sentences, and all 12 blobs
    stats = spark.read.text(f"{run_cfg['run']['out_dir']}/stats/sample_sources.shard00").first()[0]
    told = json.loads(stats)["sample_sources"]
    assert told["rows"] == 32 and told["seen"] == 84 and told["sentence_target"] == told["blob_target"] == 20


def test_shards_limits_and_formats(spark, run_cfg):
    run_stage(spark, run_cfg, "sample_sources")
    for k in range(2):
        run_stage(spark, run_cfg, "prefilter_score", Options(shard_id=k, num_shards=2, client="stub"))
    run_stage(spark, run_cfg, "select_sources")
    assert run_stage(spark, run_cfg, "select_sources", Options(resume=True)).endswith("selected_sources.jsonl")
    run_stage(spark, run_cfg, "generate_128,score_select_best,format_filter", Options(limit=5, client="stub"))
    cfg = config.merged(run_cfg, {"export": {"format": "parquet"}})
    assert spark.read.parquet(run_stage(spark, cfg, "export")).count() <= 5
    with pytest.raises(ValueError):
        run_stage(spark, cfg, "no_such_stage")
    assert [p.rsplit("/", 1)[1] for p in run_stage(spark, cfg, "gpu,export", Options(overwrite=True, client="stub"))] == ["prefilter_candidates.jsonl", "candidates_128.jsonl", "selected_best.jsonl", "final.parquet"]


def test_cli_arguments():
    a = cli.parser().parse_args(["run", "--config", "c", "--stage", "all", "--num-shards", "4", "--resume"])
    assert a.num_shards == 4 and a.resume and not a.overwrite


def test_streamed_segments_equal_batch(spark, tmp_path, run_cfg):
    schema, out, mark = "doc_id long, text string, lang string", str(tmp_path / "segs"), str(tmp_path / "mark")
    (tmp_path / "in").mkdir()
    docs = spark.read.parquet(run_cfg["data"]["path"])
    for part in (docs.filter("doc_id < 5"), docs.filter("doc_id >= 5")):
        part.write.mode("append").parquet(str(tmp_path / "in"))
        streaming.append_segments(spark, str(tmp_path / "in"), schema, out, mark, run_cfg).awaitTermination()
    batch = sample.with_source_id(sample.with_length(segment.segments(corpus.corpus_documents(docs), run_cfg), run_cfg))
    assert sorted(r[0] for r in spark.read.parquet(out).select("source_id").collect()) == sorted(r[0] for r in batch.select("source_id").collect())
    assert streaming.bucket_counts(spark.read.parquet(out)).agg(F.sum("segments")).first()[0] == batch.count()


def test_long_documents_in_linear_time(spark):
    """Many lines in one document: runs over several blocks of marks equal a plain fold, in seconds."""
    import time

    lines = [f"{'w ' * (i % 7)}line {i}" for i in range(100_000)]
    docs = spark.createDataFrame([(1, "1", "\n".join(lines))], "doc_ord long, doc_id string, text string")
    cfg = config.merged(config.DEFAULTS, {"segmentation": {"min_chars": 15}, "final_generation": {"blob": {"blob_max_tokens": 40}}})
    begun = time.time()
    found = segment.segments(docs, cfg).orderBy("segment_type", "segment_index").collect()
    assert time.time() - begun < 60
    merged, held = [], ""
    for x in (x.strip() for x in lines):
        if held and len(held) < 15:
            held += " " + x
        else:
            if held:
                merged.append(held)
            held = x
    merged = [x for x in [*merged, held] if len(x) >= 15]
    assert [r["source_text"] for r in found if r["segment_type"] == "sentence"] == merged
    blobs, size = [], 0
    for i, x in enumerate(merged):
        n = len(x.split())
        if blobs and size + n <= 40:
            blobs[-1][1], size = i, size + n
        else:
            blobs.append([i, i])
            size = n
    assert [list(r["segment_span"]) for r in found if r["segment_type"] == "blob"] == blobs


class Recorded:
    """A client that notes each request in a folder, and fails from a number of them on."""

    def __init__(self, folder: str, fails_from: int):
        self.folder, self.fails_from = folder, fails_from

    def generate(self, messages, params, request_id=None):
        import os
        import uuid

        if len(os.listdir(self.folder)) >= self.fails_from:
            raise RuntimeError("the server is gone")
        with open(f"{self.folder}/{uuid.uuid4().hex}", "w") as f:
            f.write(request_id)
        return EchoClient().generate(messages, params, request_id)


def test_a_killed_stage_goes_on(spark, run_cfg, tmp_path):
    """Parts that were committed stay, and their sources aren't asked again."""
    folder = tmp_path / "asked"
    folder.mkdir()
    cfg = config.merged(run_cfg, {"run": {"commit_rows": 8}})
    run_stage(spark, cfg, "sample_sources")
    out = f"{cfg['run']['out_dir']}/prefilter_candidates.jsonl"
    with pytest.raises(Exception):
        run_stage(spark, cfg, "prefilter_score", Options(client=lambda: Recorded(str(folder), 40)))
    kept = {r["source_id"] for r in spark.read.schema(schemas.PREFILTERED).json(out).collect()}
    assert 0 < len(kept) < 32
    before = set(folder.iterdir())
    run_stage(spark, cfg, "prefilter_score", Options(resume=True, client=lambda: Recorded(str(folder), 10_000)))
    rows = [r["source_id"] for r in spark.read.schema(schemas.PREFILTERED).json(out).collect()]
    assert len(rows) == len(set(rows)) == 32
    later = [p.read_text().split(":")[0] for p in set(folder.iterdir()) - before]
    assert len(later) == 2 * (32 - len(kept)) and not kept & set(later)


def test_limited_runs_go_on(spark, run_cfg):
    run_stage(spark, run_cfg, "sample_sources,prefilter_score,select_sources", Options(client="stub"))
    for name, stage in (("candidates_128", "generate_128"), ("selected_best", "score_select_best"), ("filtered", "format_filter")):
        counts = []
        for _ in range(2):
            run_stage(spark, run_cfg, stage, Options(limit=5, resume=True, client="stub"))
            found = spark.read.json(f"{run_cfg['run']['out_dir']}/{name}.jsonl").select("source_id")
            if name == "filtered":
                found = found.unionByName(spark.read.schema(schemas.REJECTED).json(f"{run_cfg['run']['out_dir']}/rejected.jsonl").select("source_id"))
            counts.append((found.count(), found.distinct().count()))
        assert counts == [(5, 5), (10, 10)], stage
    stats = json.loads(spark.read.text(f"{run_cfg['run']['out_dir']}/stats/format_filter.shard00").first()[0])["format_filter"]
    assert stats["processed"] == 5 and stats["rows"] + stats["rejected"] == 5 and stats["rows_per_s"] > 0


def test_scores_are_remembered(spark, run_cfg, tmp_path, monkeypatch):
    """The prefilter and the selection ask the scorer for each distinct pair once, over runs."""
    calls = tmp_path / "scored"
    calls.mkdir()

    def load():
        def many(sources, hypotheses):
            import uuid

            (calls / uuid.uuid4().hex).write_text("\n".join(f"{len(s)} {len(h)}" for s, h in zip(sources, hypotheses)) + "\n")
            return [float(abs(len(s) - len(h))) for s, h in zip(sources, hypotheses)]

        return many

    monkeypatch.setattr(score, "scorer", lambda cfg: score.by_model(load))
    cfg = config.merged(run_cfg, {"metricx": {"backend": "hf"}})
    run_stage(spark, cfg, "sample_sources,prefilter_score", Options(client="stub"))
    scored = sum(len(p.read_text().splitlines()) for p in calls.iterdir())
    assert 0 < scored <= 64
    run_stage(spark, cfg, "prefilter_score", Options(overwrite=True, client="stub"))
    assert sum(len(p.read_text().splitlines()) for p in calls.iterdir()) == scored
    run_stage(spark, cfg, "select_sources,generate_128,score_select_best", Options(client="stub"))
    assert spark.read.schema(schemas.BEST).json(f"{cfg['run']['out_dir']}/selected_best.jsonl").count() == 12


def test_requests_at_a_time(spark, tmp_path):
    """max_concurrency bounds the run, not each task."""
    folder = str(tmp_path)

    class Slow:
        def generate(self, messages, params, request_id=None):
            import os
            import time
            import uuid

            name = f"{folder}/{uuid.uuid4().hex}"
            open(name + ".open", "w").close()
            with open(name + ".seen", "w") as f:
                f.write(str(sum(x.endswith(".open") for x in os.listdir(folder))))
            time.sleep(0.05)
            os.remove(name + ".open")
            return ["x"]

    cfg = config.merged(config.DEFAULTS, {"teacher": {"max_concurrency": 3}})
    sources = spark.range(60).selectExpr("cast(id as string) source_id", "'t' source_text").repartition(16)
    assert teacher.two_translations(sources, cfg, Slow).count() == 60
    assert max(int(p.read_text()) for p in tmp_path.glob("*.seen")) <= 3


def test_last_row_of_a_source_counts(spark, tmp_path):
    from loomline.plans.stages import Run

    cfg = config.merged(config.DEFAULTS, {"run": {"out_dir": str(tmp_path)}})
    (tmp_path / "t.jsonl").write_text('{"source_id": "a", "n": 1}\n{"source_id": "b", "n": 2}\n{"source_id": "a", "n": 3}\n')
    assert {(r["source_id"], r["n"]) for r in Run(spark, cfg).latest("t", "source_id string, n int").collect()} == {("a", 3), ("b", 2)}


def test_tokenizer_measure(spark, tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    made = Tokenizer(models.WordLevel({"a": 0, "b": 1, "?": 2}, unk_token="?"))
    made.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    made.save(str(tmp_path / "tokenizer.json"))
    cfg = config.merged(config.DEFAULTS, {"bucketing": {"measure": "tokenizer", "tokenizer_name": str(tmp_path / "tokenizer.json"), "boundaries": [0, 2, 5]}})
    segs = spark.createDataFrame([("a b c",), ("",), ("a",)], "source_text string")
    assert sorted((r["length"], r["length_bucket_id"]) for r in sample.with_length(segs, cfg).collect()) == [(0, 0), (1, 0), (3, 1)]


def test_reader_options_and_all_violations(spark, run_cfg, tmp_path):
    (tmp_path / "docs.jsonl").write_text('{"doc_id": 1, "text": "A line that is long enough."} \n{"doc_id": 2, "text": broken\n')
    cfg = config.merged(run_cfg, {"data": {"path": str(tmp_path / "docs.jsonl"), "reader_options": {"mode": "DROPMALFORMED"}}})
    run_stage(spark, cfg, "sample_sources")
    assert spark.read.schema(schemas.SAMPLED).json(f"{cfg['run']['out_dir']}/sampled_sources.jsonl").filter("segment_type = 'sentence'").count() == 1
    with pytest.raises(ValueError, match="boundaries.*num_candidates.*sample_pool_size"):
        config.check(config.merged(config.DEFAULTS, {"bucketing": {"boundaries": [5, 1]}, "final_generation": {"num_candidates": 0}, "data": {"sample_pool_size": 0}}))


def test_ordinals_over_partitions(spark):
    rows = spark.createDataFrame([(f"t{i}",) for i in range(100)], "text string").repartition(7)
    got = corpus.with_ordinal(rows).collect()
    assert sorted(r["ordinal"] for r in got) == list(range(100)) and [r["text"] for r in sorted(got, key=lambda r: r["ordinal"])] == [r["text"] for r in rows.collect()]


def test_retries_are_counted(spark, run_cfg):
    from loomline.queries import Flaky

    run_stage(spark, run_cfg, "sample_sources", Options(limit=16))
    make = lambda: teacher.HttpClient("http://none", "m", max_attempts=4, backoff_s=[0.0], send=Flaky(), sleep=lambda s: None, error_substrings=("internal server error",))
    cfg = config.merged(run_cfg, {"teacher": {"max_concurrency": 1}})
    run_stage(spark, cfg, "prefilter_score", Options(client=make))
    out = cfg["run"]["out_dir"]
    texts = [r["source_text"] for r in spark.read.schema(schemas.SAMPLED).json(f"{out}/sampled_sources.jsonl").collect()]
    told = json.loads(spark.read.text(f"{out}/stats/prefilter_score.shard00").first()[0])["prefilter_score"]
    assert told["processed"] == len(texts) and told["retries"] == 2 * sum(len(t) % 4 for t in texts) > 0


def test_retried_requests_are_dealt_over_all_tasks(spark):
    """client_retries has a client a task, and tasks hand on tables of many answers, each row once."""
    from loomline.queries import QUERIES

    made = QUERIES["client_retries"](spark, "/root/testdata/sf0.001")
    assert made.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism > 1
    rows = spark.range(1000).select(F.col("id").cast("string").alias("source_id"), F.expr("array(named_struct('role', 'user', 'content', 'x'))").alias("messages"))
    for concurrency in (1, 3, 9):
        asks = [lambda c, ms, i: {"a": f"{ms[0]['content']}{i}"}, lambda c, ms, i: {"b": i}]
        got = teacher.call_model(rows, lambda: None, asks, "source_id string, a string, b string", concurrency).collect()
        assert sorted((r["source_id"], r["a"], r["b"]) for r in got) == sorted((str(i), f"x{i}", str(i)) for i in range(1000))


def test_limited_segments_are_found_once(spark, run_cfg):
    """The sampler reads the first segments from a table, and the stage still tells how many it saw."""
    told = lambda: json.loads(spark.read.text(f"{run_cfg['run']['out_dir']}/stats/sample_sources.shard00").first()[0])["sample_sources"]
    run_stage(spark, run_cfg, "sample_sources", Options(limit=3))
    assert spark.read.parquet(f"{run_cfg['run']['out_dir']}/work/limited_segments.shard00").count() == told()["seen"] == 3
    run_stage(spark, run_cfg, "sample_sources", Options(overwrite=True))
    docs = corpus.corpus_documents(corpus.read_corpus(spark, run_cfg["data"]["path"], config.languages(run_cfg)[1]))
    assert told()["seen"] == segment.segments(docs, run_cfg).count() > 3
