"""Model calls: chat completions with retries, from tasks of Spark.

A client lives as long as its partition. Rows are dealt over no more tasks than requests may
run at a time, and each task has its share of those in threads, so concurrency bounds the
whole run. Calls aren't repeatable, so stages write what they get before anything else reads it.
"""

from __future__ import annotations

import hashlib
import json
import os
import time
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial
from typing import Any, Protocol

import pandas as pd
from pyspark import Accumulator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.functions import prompts
from loomline.functions import text as X


@dataclass(frozen=True)
class Generation:
    temperature: float
    top_p: float = 1.0
    max_tokens: int = 512
    n: int = 1
    seed: int | None = None


class Client(Protocol):
    def generate(self, messages: list[dict], params: Generation, request_id: str | None = None) -> list[str]: ...


ClientFactory = Callable[[], Client]


def backoff_schedule(delays: list[float], max_attempts: int) -> list[float]:
    """A delay before each attempt but the first; the last one repeats as needed."""
    need = max(0, max_attempts - 1)
    if not need or not delays:
        return [0.0] * need
    return [float(delays[min(i, len(delays) - 1)]) for i in range(need)]


def idempotency_key(payload: dict[str, Any], request_id: str | None) -> str:
    raw = json.dumps(payload, sort_keys=True, ensure_ascii=False)
    return hashlib.sha1((f"{raw}||{request_id}" if request_id else raw).encode()).hexdigest()[:24]


class TemplateMissing(RuntimeError):
    """The server has no chat template; trying again doesn't help."""


@dataclass
class HttpClient:
    """A chat-completions server. send can be replaced, as tests do."""

    base_url: str
    model: str
    api_key_env: str = "VLLM_API_KEY"
    timeout_s: float = 120
    max_attempts: int = 6
    backoff_s: list[float] = field(default_factory=lambda: [1, 2, 4, 8, 16, 32])
    min_chars: int = 1
    error_substrings: tuple[str, ...] = X.ERROR_SUBSTRINGS
    use_proxies: bool = False
    send: Callable[[dict, dict], dict] | None = None
    sleep: Callable[[float], None] = time.sleep
    #: Requests that were made again.
    retries: int = 0

    def valid(self, text: str | None) -> bool:
        if text is None or len(text.strip()) < self.min_chars:
            return False
        low = text.lower()
        return not any(e and e.lower() in low for e in self.error_substrings)

    def _post(self, payload: dict, headers: dict) -> dict:
        head = {"Content-Type": "application/json", "Authorization": f"Bearer {os.environ.get(self.api_key_env, '')}", **headers}
        request = urllib.request.Request(f"{self.base_url}/chat/completions", json.dumps(payload).encode(), head)
        opener = urllib.request.build_opener() if self.use_proxies else urllib.request.build_opener(urllib.request.ProxyHandler({}))
        with opener.open(request, timeout=self.timeout_s) as answer:
            return json.load(answer)

    def generate(self, messages: list[dict], params: Generation, request_id: str | None = None) -> list[str]:
        payload = {"model": self.model, "messages": messages, "temperature": params.temperature, "top_p": params.top_p, "max_tokens": params.max_tokens, "n": params.n}
        if params.seed is not None:
            payload["seed"] = params.seed
        delays = backoff_schedule(self.backoff_s, self.max_attempts)
        headers = {"Idempotency-Key": idempotency_key(payload, request_id)}  # of all attempts
        for attempt in range(len(delays) + 1):
            try:
                answer = (self.send or self._post)(payload, dict(headers))
                texts = [c["message"]["content"] for c in answer["choices"]]
                if not texts or not all(map(self.valid, texts)):
                    raise RuntimeError("the model's answer is empty or invalid")
                return texts
            except Exception as e:
                if "chat template" in str(e).lower():
                    raise TemplateMissing("the model server has no chat template; start it with one") from e
                if attempt == len(delays):
                    raise
                self.retries += 1
                self.sleep(delays[attempt])
        raise AssertionError


def http_client(cfg: dict, model: str | None = None) -> ClientFactory:
    t = cfg["teacher"]

    def make() -> Client:
        return HttpClient(
            t["base_url"], model or t["model"], t["api_key_env"], t["request_timeout_s"], t["retry"]["max_attempts"], list(t["retry"]["backoff_s"]),
            t["validation"]["min_chars"], tuple(t["validation"]["error_substrings"]), not t["unset_proxies_before_request"],
        )

    return make


def candidates_of(client: Client, messages: list[dict], n: int, params: Generation, strategy: str, request_id: str, seed_step: int = 0) -> list[str]:
    """n translations: all in one request, one request each, or the former with the latter behind it."""
    if strategy in ("auto", "n_parameter"):
        try:
            texts = client.generate(messages, Generation(params.temperature, params.top_p, params.max_tokens, n, params.seed), request_id)
            if len(texts) == n:
                return texts
        except Exception:
            if strategy == "n_parameter":
                raise
    seeds = [None if params.seed is None else params.seed + i * seed_step for i in range(n)]
    return [client.generate(messages, Generation(params.temperature, params.top_p, params.max_tokens, 1, s), f"{request_id}:{i}")[0] for i, s in enumerate(seeds)]


#: A model's answer to a row, as some of its values.
Ask = Callable[[Client, list[dict], str], dict]
#: Rows that a thread has at a time, and answered rows that a task holds at least before it hands them on: a table of few rows costs more than most answers.
ROWS_A_THREAD, ROWS_A_TABLE = 4, 128


def call_model(rows: DataFrame, make: ClientFactory, asks: list[Ask], schema: str, concurrency: int, retries: Accumulator | None = None) -> DataFrame:
    """What all asks say to each row (source_id, messages), as rows of schema with source_id first.

    A row's asks run beside each other. retries gets the number of requests that clients made again.
    """
    tasks = max(1, min(concurrency, rows.sparkSession.sparkContext.defaultParallelism))
    threads = max(1, concurrency // tasks)
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make()
        counted = 0
        with ThreadPoolExecutor(threads) as pool:
            said_by = (lambda *x: pool.submit(*x).result) if threads > 1 else (lambda ask, *x: partial(ask, *x))  # one thread is the task's own
            for batch in batches:
                ids, asked, got = batch["source_id"].tolist(), batch["messages"].tolist(), []
                for at in range(0, len(ids), threads * ROWS_A_THREAD):
                    part = slice(at, at + threads * ROWS_A_THREAD)
                    said = [[said_by(ask, client, [{"role": m["role"], "content": m["content"]} for m in ms], i) for ask in asks] for i, ms in zip(ids[part], asked[part])]
                    got += [{"source_id": i, **{k: v for one in own for k, v in one().items()}} for i, own in zip(ids[part], said)]
                    if retries is not None and (again := getattr(client, "retries", 0)) > counted:
                        retries.add(again - counted)
                        counted = again
                    if len(got) >= ROWS_A_TABLE or part.stop >= len(ids):
                        yield pd.DataFrame(got, columns=names)
                        got = []

    return rows.select("source_id", "messages").repartition(tasks).mapInPandas(run, schema)


def two_translations(sources: DataFrame, cfg: dict, make: ClientFactory, retries: Accumulator | None = None) -> DataFrame:
    """(source_id, greedy_text, sample_text)."""
    g, (src, tgt) = cfg["teacher"]["generation"], (cfg["data"]["src_lang"], cfg["data"]["tgt_lang"])

    def one(temperature: float, name: str) -> Ask:
        return lambda client, messages, source_id: {f"{name}_text": client.generate(messages, Generation(temperature, g["top_p"], g["max_tokens"], 1, g["seed"]), f"{source_id}:{name}")[0]}

    rows = sources.select("source_id", F.expr(prompts.translation_messages("source_text", src, tgt)).alias("messages"))
    asks = [one(g["greedy_temperature"], "greedy"), one(g["sample_temperature"], "sample")]
    return call_model(rows, make, asks, "source_id string, greedy_text string, sample_text string", cfg["teacher"]["max_concurrency"], retries)


def many_candidates(sources: DataFrame, cfg: dict, make: ClientFactory, retries: Accumulator | None = None) -> DataFrame:
    """(source_id, translations)."""
    g, final, (src, tgt) = cfg["teacher"]["generation"], cfg["final_generation"], (cfg["data"]["src_lang"], cfg["data"]["tgt_lang"])
    params = Generation(g["final_temperature"], g["top_p"], g["max_tokens"], 1, g["seed"])

    def ask(client: Client, messages: list[dict], source_id: str) -> dict:
        return {"translations": candidates_of(client, messages, final["num_candidates"], params, final["strategy"], source_id, g.get("seed_step", 0))}

    rows = sources.select("source_id", F.expr(prompts.translation_messages("source_text", src, tgt)).alias("messages"))
    return call_model(rows, make, [ask], "source_id string, translations array<string>", max(1, cfg["teacher"]["max_concurrency"] // 4), retries)


def judge_replies(pairs: DataFrame, cfg: dict, make: ClientFactory, retries: Accumulator | None = None) -> DataFrame:
    """(source_id, reply); a call that fails for good gives a null reply."""
    j, (src, tgt) = cfg["filters"]["llm_judge"], (cfg["data"]["src_lang"], cfg["data"]["tgt_lang"])

    def ask(client: Client, messages: list[dict], source_id: str) -> dict:
        try:
            return {"reply": client.generate(messages, Generation(j["temperature"], 1.0, j["max_tokens"]), f"{source_id}:judge")[0]}
        except Exception:
            return {"reply": None}

    rows = pairs.select("source_id", F.expr(prompts.judge_messages("source_text", "target_text", src, tgt)).alias("messages"))
    return call_model(rows, make, [ask], "source_id string, reply string", cfg["teacher"]["max_concurrency"], retries)


# The stub is a stand-in without a model: its translations are expressions, so a whole run is one plan.


def stub_greedy(text: str) -> str:
    return f"substr({text}, 1, greatest(1, length({text}) div 2))"


def stub_sample(text: str, source_id: str) -> str:
    return f"substr({text}, 1, greatest(1, length({text}) * (1 + {X.shard_of(source_id, 7)}) div 8))"


def stub_candidate(text: str, i: str, n: int) -> str:
    return f"substr(reverse({text}), 1, greatest(1, length({text}) * ({i} + 1) div {n}))"


def stub_candidates(text: str, n: int) -> str:
    return f"transform(sequence(0, {n - 1}), i -> {stub_candidate(text, 'i', n)})"


def stub_reply(source_id: str) -> str:
    return f"""if({X.shard_of(source_id, 5)} = 0, 'Verdict: {{"pass": false, "reason_code": "meaning"}}', '{{"pass": true, "reason_code": "ok"}}')"""
