"""Unit vectors of the text rules, by a plain version in Python."""

from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from loomline.functions import prompts
from loomline.functions import text as X

TEXTS = [
    "", " \t", "one", "Hello\nworld", "a. b! c?  d", "x" * 30, "多字 текст, ok.", "é \U0001f600 _a1", "a\r\nb\rc\x0bd\x1ce\x85f g h", "Dr. No. Yes", "　 pad  ",
    "<b>x</b>", "a < b > c", "no < tag", "Here IS the translation", "ASSISTANT: hi", "번역: x", "x<think>",
]


def evaluated(spark, sql: str, texts=TEXTS) -> list:
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r[0] for r in df.orderBy("i").select(F.expr(sql)).collect()]


def merged(parts, least):
    out, held = [], ""
    for p in parts:
        if not held:
            held = p
        elif len(held) < least:
            held += " " + p
        else:
            out.append(held)
            held = p
    return out + [held] if held else out


@pytest.mark.parametrize(
    ("sql", "plain"),
    [
        (X.token_len("t"), lambda t: max(1, len(re.findall(r"\w+|[^\w\s]", t)))),
        (X.strip("t"), str.strip),
        (X.split_lines("t"), lambda t: [x.strip() for x in t.splitlines() if x.strip()]),
        (X.split_sentences("t"), lambda t: [x.strip() for x in re.split(r"(?<=[.!?])\s+", t) if x.strip()]),
        (X.merge_short(X.split_lines("t"), 3), lambda t: merged([x.strip() for x in t.splitlines() if x.strip()], 3)),
        (X.has_html("t"), lambda t: bool(re.search(r"<[^>]+>", t))),
        (X.forbidden_marker("t"), lambda t: any(m in t.lower() for m in X.FORBIDDEN_MARKERS)),
        (X.stable_hash("t"), lambda t: hashlib.sha1(t.encode()).hexdigest()[:16]),
        (X.shard_of("t", 7), lambda t: int(hashlib.sha1(t.encode()).hexdigest()[:8], 16) % 7),
        (X.valid_response("t", 2), lambda t: len(t.strip()) >= 2 and not any(e in t.lower() for e in X.ERROR_SUBSTRINGS)),
    ],
)
def test_rule(spark, sql, plain):
    # A combining mark is no word character in Python's sense of one rule only; it is left out there.
    texts = [t for t in TEXTS if "́" not in t]
    assert evaluated(spark, sql, texts) == [plain(t) for t in texts]


def test_buckets(spark):
    df = spark.range(-1, 12).select(F.expr(X.bucket_of("id", [0, 5, 10])).alias("b"))
    assert [r["b"] for r in df.collect()] == [1, *[0] * 5, *[1] * 5, 1, 1]


def test_record_hash_skips_null(spark):
    got = spark.range(1).select(F.expr(X.record_hash("'a'", "null", "3"))).first()[0]
    assert got == hashlib.sha1(b"a||3").hexdigest()[:16]


def test_rule_bounds(spark):
    rows = [("abcd", "a", "pass"), ("abcde", "a", "length_ratio_small"), ("a", "abcd", "pass"), ("a", "abcde", "length_ratio_large"), ("", "x", "pass"), ("x", "", "too_short")]
    rows += [("a b c d e f g h i j", "a b c d e f g h i z", "pass"), ("a b", "a b", "high_overlap"), ("x" * 9000, "y" * 20001, "too_long"), ("!!!!", "....", "pass")]
    df = spark.createDataFrame(rows, "s string, t string, want string")
    got = df.select("want", F.expr(X.rule_reason("s", "t", 1, 20000, 0.25, 4.0, 0.9)).alias("got")).collect()
    assert [r["got"] for r in got] == [r["want"] for r in got]


def test_score_parsing(spark):
    assert evaluated(spark, X.parsed_score("t"), ["score -1.25 of 5", "7", "a.5"]) == [-1.25, 7.0, 5.0]
    with pytest.raises(Exception, match="no score in"):
        evaluated(spark, X.parsed_score("t"), ["none"])


def test_judge_truth(spark):
    cases = {
        '{"pass": true}': (True, "unknown"), 'x {"pass": "false", "reason_code": "r"} y': (True, "r"), '{"pass": ""}': (False, "unknown"), '{"pass": 0, "reason_code": null}': (False, "None"),
        '{"pass": [1]}': (True, "unknown"), '{"pass": {}}': (False, "unknown"), '{"pass": null}': (False, "unknown"), "{}": (False, "unknown"), "none": (False, "judge_failed"), "{bad": (False, "judge_failed"), "{bad}": (False, "judge_failed"),
    }
    assert list(zip(evaluated(spark, X.judge_pass("t"), list(cases)), evaluated(spark, X.judge_reason("t"), list(cases)))) == list(cases.values())
    assert evaluated(spark, X.judge_pass("t", True), ["none"]) == [True]
    assert evaluated(spark, X.judge_reason("t", True), ["none"]) == ["judge_failed_permissive"]


def test_prompts(spark):
    text = "It's {text} \\ <x>\n"
    got = evaluated(spark, prompts.translation_messages("t", "kor", "eng"), [text])[0]
    want = prompts.TRANSLATOR_USER.replace("{text}", "\0").format(source_lang="kor", src_lang_code="kor", target_lang="eng", tgt_lang_code="eng").replace("\0", text)
    assert [m["role"] for m in got] == ["system", "user"] and got[1]["content"] == want
    assert evaluated(spark, prompts.scorer_prompt("t", "'h'"), ["s"])[0] == "source: s\nhypothesis: h\nreference: \nscore:"
