"""The same queries in DuckDB's SQL, written from the rules and not from the expressions."""

from __future__ import annotations

import json

from loomline.functions import prompts
from loomline.functions.text import ERROR_SUBSTRINGS, FORBIDDEN_MARKERS
from loomline.queries import EDGES

WS = r"[\p{Z}\x09-\x0D\x1C-\x1F\x85]"
WORD = r"[\p{L}\p{N}_]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def tokens(x: str) -> str:
    return rf"greatest(1, len(regexp_extract_all({x}, '{WORD}+|[^\p{{L}}\p{{N}}_\p{{Z}}\x09-\x0D\x1C-\x1F\x85]')))"


def nonempty(parts: str) -> str:
    return f"list_filter(list_transform({parts}, lambda x: {strip('x')}), lambda x: x <> '')"


def lines(x: str) -> str:
    return nonempty(rf"string_split_regex({x}, '\r\n|[\x0A-\x0D\x1C-\x1E\x85\x{{2028}}\x{{2029}}]')")


def sentences(x: str) -> str:
    return nonempty(rf"string_split(regexp_replace({x}, '([.!?]){WS}+', '\1' || chr(1), 'g'), chr(1))")


def joined_short(parts: str, least: int) -> str:
    step = (
        "CASE WHEN a.b = '' THEN {'m': a.m, 'b': x} "
        f"WHEN length(a.b) < {least} THEN {{'m': a.m, 'b': a.b || ' ' || x}} ELSE {{'m': list_append(a.m, a.b), 'b': x}} END"
    )
    folded = f"list_reduce(list_transform({parts}, lambda x: x), lambda a, x: {step}, {{'m': []::VARCHAR[], 'b': ''}})"
    return f"(SELECT CASE WHEN f.b = '' THEN f.m ELSE list_append(f.m, f.b) END FROM (SELECT {folded} AS f))"


def hashed(x: str) -> str:
    return f"substr(sha1({x}), 1, 16)"


def shard(key: str, n: int) -> str:
    return f"(('0x' || substr(sha1({key}), 1, 8))::BIGINT % {n})"


def bucket(x: str) -> str:
    arms = " ".join(f"WHEN {x} >= {a} AND {x} < {b} THEN {i}" for i, (a, b) in enumerate(zip(EDGES, EDGES[1:])))
    return f"CASE {arms} ELSE {len(EDGES) - 2} END"


def segments(most: int = 5000, blob_tokens: int = 512, least: int = 20) -> str:
    """CTEs up to seg (doc_id, kind, idx, last, txt)."""
    step = (
        f"CASE WHEN len(c.b) > 0 AND c.n + x.k > {blob_tokens} THEN "
        "{'o': list_append(c.o, {'t': array_to_string(c.b, ' '), 'a': c.st, 'z': (x.i - 1)::INT}), 'b': [x.s], 'n': x.k::INT, 'st': x.i::INT, 'i': x.i::INT} "
        "ELSE {'o': c.o, 'b': list_append(c.b, x.s), 'n': (c.n + x.k)::INT, 'st': c.st, 'i': x.i::INT} END"
    )
    start = "{'o': []::STRUCT(t VARCHAR, a INT, z INT)[], 'b': []::VARCHAR[], 'n': 0::INT, 'st': 0::INT, 'i': (-1)::INT}"
    fits = lambda x: f"length({x}) BETWEEN {least} AND {most} AND NOT regexp_matches({x}, '<[^>]+>')"
    return f"""
l AS (SELECT doc_id, {lines("text")} AS p FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, flatten(list_transform(p, lambda x: CASE WHEN length(x) > {most} THEN {sentences("x")} ELSE [x] END)) AS p FROM l),
m AS (SELECT doc_id, {joined_short("p", least)} AS p FROM s),
f AS (SELECT doc_id, list_filter(p, lambda x: {fits("x")}) AS p FROM m),
k AS (SELECT doc_id, list_transform(p, lambda x, i: {{'s': x, 'i': (i - 1)::INT, 'k': {tokens("x")}::INT}}) AS q FROM f WHERE len(p) > 0),
b AS (SELECT doc_id, list_reduce(q, lambda c, x: {step}, {start}) AS c FROM k),
bl AS (SELECT doc_id, unnest(list_append(c.o, {{'t': array_to_string(c.b, ' '), 'a': c.st, 'z': c.i}})) AS b FROM b),
seg AS (
  SELECT doc_id, 'sentence' AS kind, (i - 1)::INT AS idx, NULL::INT AS last, p[i] AS txt FROM f, unnest(generate_series(1, len(p))) AS u(i) WHERE len(p) > 0
  UNION ALL SELECT doc_id, 'blob', b.a, b.z, b.t FROM bl WHERE {fits("b.t")}),
ided AS (SELECT *, {hashed("concat_ws('||', doc_id::VARCHAR, idx::VARCHAR, kind, txt)")} AS source_id, {tokens("txt")} AS n FROM seg),
bucketed AS (SELECT *, {bucket("n")} AS bucket FROM ided),
src AS (SELECT source_id, txt, bucket FROM bucketed WHERE kind = 'sentence')"""


GREEDY = "substr(txt, 1, greatest(1, length(txt) // 2))"
SAMPLE = f"substr(txt, 1, greatest(1, length(txt) * (1 + {shard('source_id', 7)}) // 8))"


def candidate(i: str, n: int) -> str:
    return f"substr(reverse(txt), 1, greatest(1, length(txt) * ({i} + 1) // {n}))"


def gap(a: str, b: str) -> str:
    return f"abs(length({a}) - length({b}))::DOUBLE"


def sampled(total: int, quota: int) -> str:
    half = total // 2
    return f"""WITH {segments()},
a AS (SELECT *, row_number() OVER (PARTITION BY kind, bucket ORDER BY doc_id, idx) > CASE kind WHEN 'sentence' THEN {quota} ELSE {quota} END AS spill FROM bucketed),
r AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY spill, CASE WHEN spill THEN 0 ELSE bucket END, doc_id, idx) AS rn FROM a)
SELECT source_id, kind AS segment_type, bucket::BIGINT AS length_bucket_id, rn::BIGINT AS sample_rank FROM r WHERE rn <= {half}"""


PAIRS = """pairs AS (
  SELECT 'c' || t.conv_id || '-' || t.turn AS pair, t.text AS s, n.text AS t FROM conversations t JOIN conversations n ON n.conv_id = t.conv_id AND n.turn = t.turn + 1
  WHERE t.role = 'user' AND n.role = 'assistant'
  UNION ALL SELECT 'd' || doc_id, text, CASE doc_id % 7 WHEN 0 THEN 'Assistant: ' || text WHEN 1 THEN '' WHEN 2 THEN repeat(text, 9) WHEN 3 THEN substr(text, 1, length(text) // 10)
    WHEN 4 THEN text WHEN 5 THEN reverse(text) ELSE repeat(text, 5) END FROM documents)"""


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


MARKED = "(" + " OR ".join(f"contains(lower(t), {quoted(m)})" for m in FORBIDDEN_MARKERS) + ")"
RATIO = "length(t) / greatest(1, length(s))"


def words(x: str) -> str:
    return f"list_distinct(regexp_extract_all(lower({x}), '{WORD}+'))"


OVERLAP = f"CASE WHEN len({words('s')}) = 0 THEN 0 ELSE len(list_intersect({words('s')}, {words('t')})) / len({words('s')}) END"
REASON = (
    f"CASE WHEN {MARKED} THEN 'forbidden_marker' WHEN length(t) < 1 THEN 'too_short' WHEN length(t) > 20000 THEN 'too_long' WHEN {RATIO} < 0.25 THEN 'length_ratio_small' "
    f"WHEN {RATIO} > 4.0 THEN 'length_ratio_large' WHEN {OVERLAP} > 0.9 THEN 'high_overlap' ELSE 'pass' END"
)


def split(sql: str) -> str:
    return f"SELECT doc_id, (i - 1)::BIGINT AS at, p[i] AS part FROM (SELECT doc_id, {sql} AS p FROM documents), unnest(generate_series(1, len(p))) AS u(i) WHERE len(p) > 0"


def sentence_rows(most: int) -> str:
    return f"WITH {segments(most)} SELECT doc_id, idx::BIGINT AS segment_index, txt AS source_text FROM seg WHERE kind = 'sentence'"


PRE = f"pre AS (SELECT *, {gap('txt', GREEDY)} AS sg, {gap('txt', SAMPLE)} AS ss, {gap('txt', GREEDY)} - {gap('txt', SAMPLE)} AS imp FROM src)"


def best(n: int, score: str, top: int) -> str:
    return f"""cand AS (SELECT DISTINCT source_id, txt, i, {candidate("i", n)} AS t FROM src, unnest(generate_series(0, {n - 1})) AS u(i)),
ranked AS (SELECT *, {score} AS score, row_number() OVER (PARTITION BY source_id ORDER BY {score}, i) AS rk FROM cand QUALIFY rk <= {top})"""


NEAR25 = f"abs({gap('txt', 't')} - 25)"
CACHE_PAIRS = f"""p AS (SELECT source_id, txt, {GREEDY} AS h FROM src), keyed AS (SELECT *, {hashed("txt || '||' || h")} AS key, {gap("txt", "h")} AS sc FROM p),
old AS (SELECT DISTINCT key, sc + 1000 AS score FROM keyed WHERE {shard("key", 3)} = 1)"""


def prompt(template: str, **values: str) -> str:
    out = quoted(template)
    for k, v in values.items():
        out = out.replace("{" + k + "}", f"' || {v} || '")
    return out


JUDGED = """CASE conv_id % 9 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true WHEN 3 THEN false WHEN 4 THEN true WHEN 5 THEN false WHEN 6 THEN {0} WHEN 7 THEN {0} ELSE false END"""

def ending(size: str) -> str:
    """The last characters of a text, one at least."""
    return f"right(txt, greatest(1, {size})::BIGINT)"


JUDGE_BODY = prompt(prompts.JUDGE_USER, source_lang=quoted("en"), target_lang=quoted("fr"), source_text="txt", candidate_text=GREEDY)

SAMPLED = f"""WITH {segments()},
a AS (SELECT *, row_number() OVER (PARTITION BY kind, bucket ORDER BY doc_id, idx) > 112 AS spill FROM bucketed),
r AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY spill, CASE WHEN spill THEN 0 ELSE bucket END, doc_id, idx) AS rn FROM a QUALIFY rn <= 1000),
pre AS (SELECT *, {gap('txt', GREEDY)} - {gap('txt', SAMPLE)} AS imp FROM r)"""

E2E = f"""WITH {segments()},
a AS (SELECT *, row_number() OVER (PARTITION BY kind, bucket ORDER BY doc_id, idx) > 112 AS spill FROM bucketed),
r AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY spill, CASE WHEN spill THEN 0 ELSE bucket END, doc_id, idx) AS rn FROM a QUALIFY rn <= 1000),
pre AS (SELECT *, {gap('txt', GREEDY)} - {gap('txt', SAMPLE)} AS imp FROM r),
sel AS (SELECT * FROM pre ORDER BY imp DESC, source_id LIMIT 200),
cand AS (SELECT sel.*, i, {candidate('i', 8)} AS t FROM sel, unnest(generate_series(0, 7)) AS u(i)),
top AS (SELECT *, {gap('txt', 't')} AS score, row_number() OVER (PARTITION BY source_id ORDER BY {gap('txt', 't')}, i) AS rk FROM cand QUALIFY rk = 1),
ruled AS (SELECT *, {REASON} AS reason FROM (SELECT *, txt AS s FROM top))
SELECT source_id, txt AS source_text, t AS target_text, score AS metricx_qe_score_best, imp AS improvement, kind AS segment_type, bucket::BIGINT AS length_bucket_id,
  CASE WHEN reason <> 'pass' THEN reason WHEN {shard('source_id', 5)} = 0 THEN 'meaning' ELSE 'pass' END AS reason FROM ruled"""

ORACLES: dict[str, str] = {
    "token_length": f"SELECT doc_id, {tokens('text')}::BIGINT AS tokens FROM documents WHERE text IS NOT NULL",
    "split_lines": split(lines("text")),
    "split_sentences": split(sentences("text")),
    "merge_short": split(joined_short(lines("text"), 60)),
    "segment_list_field": f"WITH l AS (SELECT doc_id, list_filter({nonempty('string_split(text, chr(10))')}, lambda x: length(x) BETWEEN 20 AND 5000 AND NOT regexp_matches(x, '<[^>]+>')) AS p FROM documents) "
    "SELECT doc_id, (i - 1)::BIGINT AS segment_index, p[i] AS source_text FROM l, unnest(generate_series(1, len(p))) AS u(i) WHERE len(p) > 0",
    "segment_documents": sentence_rows(5000),
    "segment_documents_tight": sentence_rows(300),
    "html_filter": "SELECT page_id, regexp_matches(html, '<[^>]+>') AS has_html, length(html) BETWEEN 1 AND 4000 AND NOT regexp_matches(html, '<[^>]+>') AS kept, length(html) BETWEEN 1 AND 4000 AS kept_with_html FROM pages",
    "build_blobs": f"WITH {segments(300, 64)} SELECT doc_id, idx::BIGINT AS segment_index, last::BIGINT AS last_index, txt AS source_text FROM seg WHERE kind = 'blob'",
    "source_ids": f"WITH {segments(300, 64)} SELECT source_id, kind AS segment_type, idx::BIGINT AS segment_index FROM ided",
    "shard_assignment": f"WITH {segments()} SELECT {shard('source_id', 8)} AS shard, count(*) AS n FROM ided GROUP BY 1",
    "bucket_histogram": f"WITH {segments()} SELECT kind AS segment_type, bucket::BIGINT AS length_bucket_id, count(*) AS n, sum(n)::BIGINT AS tokens FROM bucketed GROUP BY 1, 2",
    "stratified_sample": sampled(2000, 112),
    "stratified_sample_truncated": sampled(300, 60),
    "stratified_sample_quota": sampled(1000, 7),
    "reservoir_sample": f"WITH {segments()}, a AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY doc_id, idx) > 20 AS spill FROM bucketed WHERE kind = 'sentence') "
    "SELECT 'sentence' AS segment_type, least(500, count(*) FILTER (NOT spill) + least(400, count(*) FILTER (spill))) AS n, least(500, count(*) FILTER (NOT spill) + least(400, count(*) FILTER (spill))) AS distinct_segments FROM a",
    "lang_map": "SELECT CASE lang WHEN 'en' THEN 'eng' WHEN 'fr' THEN 'fra' WHEN 'de' THEN 'deu' ELSE lang END AS lang, count(*) AS n FROM documents GROUP BY 1",
    "doc_id_choice": "SELECT CASE WHEN doc_id % 3 <> 0 THEN doc_id::VARCHAR WHEN doc_id % 2 <> 0 THEN 'k' || doc_id ELSE doc_id::VARCHAR END AS doc_id, doc_id AS record_id FROM documents",
    "lang_scan": "SELECT doc_id, lang, length(text)::BIGINT AS chars FROM documents WHERE lang = 'fr'",
    "dummy_score": f"WITH {segments()} SELECT source_id, {gap('txt', GREEDY)} AS score FROM src",
    "improvement": f"WITH {segments()}, {PRE} SELECT source_id, sg AS score_greedy, ss AS score_sample, imp AS improvement FROM pre",
    "select_topn_global": f"WITH {segments()}, {PRE} SELECT source_id, imp AS improvement, bucket::BIGINT AS length_bucket_id FROM pre ORDER BY imp DESC, source_id LIMIT 500",
    "select_topn_per_bucket": f"WITH {segments()}, {PRE}, q AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY imp DESC, source_id) AS rn FROM pre) "
    "SELECT source_id, imp AS improvement, bucket::BIGINT AS length_bucket_id FROM q WHERE rn <= 55 ORDER BY imp DESC, source_id LIMIT 500",
    "candidate_expansion": f"WITH {segments()} SELECT source_id, i::BIGINT AS i, {candidate('i', 4)} AS translation FROM src, unnest(generate_series(0, 3)) AS u(i)",
    "best_candidate": f"WITH {segments()}, {best(8, NEAR25, 1)} SELECT source_id, t AS target_text, score AS metricx_qe_score_best FROM ranked",
    "topk_candidates": f"WITH {segments()}, {best(8, NEAR25, 3)} SELECT source_id, (rk - 1)::BIGINT AS rank, score, t AS translation FROM ranked",
    "last_wins_dedup": "SELECT conv_id, max(turn) AS turn, arg_max(text, turn) AS text FROM conversations GROUP BY conv_id",
    "forbidden_markers": f"WITH {PAIRS} SELECT pair, {MARKED} AS marked FROM pairs",
    "word_overlap": f"WITH {PAIRS} SELECT pair, round({OVERLAP}, 9)::DOUBLE AS overlap FROM pairs",
    "length_ratio": f"WITH {PAIRS} SELECT pair, round({RATIO}, 9)::DOUBLE AS ratio FROM pairs",
    "rule_filter": f"WITH {PAIRS} SELECT pair, {REASON} AS reason FROM pairs",
    "rejected_by_reason": f"WITH {PAIRS} SELECT {REASON} AS reason, count(*) AS n FROM pairs GROUP BY 1",
    "response_validity": f"WITH q AS (SELECT conv_id, turn, CASE conv_id % 4 WHEN 0 THEN text || ' RuntimeError: x' WHEN 1 THEN repeat(' ', length(text)) ELSE text END AS t FROM conversations) "
    f"SELECT conv_id, turn, coalesce(length({strip('t')}) >= 5 AND NOT ({' OR '.join(f'contains(lower(t), {quoted(e)})' for e in ERROR_SUBSTRINGS)}), false) AS valid FROM q",
    "score_parsing": "SELECT doc_id, (CASE WHEN doc_id % 2 = 0 THEN -1 ELSE 1 END * (doc_id + CASE WHEN doc_id % 3 = 0 THEN 0.25 ELSE 0 END))::DOUBLE AS score FROM documents",
    "judge_parse": f"SELECT DISTINCT conv_id, {JUDGED.format('false')} AS passed, CASE conv_id % 9 WHEN 0 THEN 'ok' WHEN 1 THEN 'meaning' WHEN 3 THEN 'None' WHEN 4 THEN 'x' "
    f"WHEN 6 THEN 'judge_failed' WHEN 7 THEN 'judge_failed' WHEN 8 THEN 'none' ELSE 'unknown' END AS reason, {JUDGED.format('true')} AS passed_permissive FROM conversations",
    "prompt_render": f"WITH {segments()} SELECT source_id, "
    f"md5({prompt(prompts.TRANSLATOR_USER, source_lang=quoted('en'), src_lang_code=quoted('en'), target_lang=quoted('fr'), tgt_lang_code=quoted('fr'), text='txt')}) AS translate_md5, "
    f"md5({prompt(prompts.JUDGE_USER, source_lang=quoted('en'), target_lang=quoted('fr'), source_text='txt', candidate_text=GREEDY)}) AS judge_md5, "
    f"md5({prompt(prompts.SCORER, source='txt', hypothesis=GREEDY, reference=quoted(''))}) AS scorer_md5 FROM src",
    "resume_antijoin": f"WITH {segments()} SELECT source_id, bucket::BIGINT AS length_bucket_id FROM src WHERE {shard('source_id', 3)} <> 0",
    "resume_counts": "SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id",
    "score_cache_join": f"WITH {segments()}, {CACHE_PAIRS} SELECT source_id, coalesce(old.score, sc) AS score FROM keyed LEFT JOIN old USING (key)",
    "cache_upsert": f"WITH {segments()}, {CACHE_PAIRS}, new AS (SELECT DISTINCT key, sc AS score FROM keyed WHERE {shard('key', 2)} = 0) "
    "SELECT 'dummy' AS scorer_id, key, score FROM new UNION ALL SELECT 'dummy', key, score FROM old ANTI JOIN new USING (key)",
    "export_final": f"""WITH {segments()}, {PRE}, cand AS (SELECT pre.*, i, {candidate("i", 4)} AS t FROM pre, unnest(generate_series(0, 3)) AS u(i)),
top AS (SELECT *, {gap("txt", "t")} AS score, row_number() OVER (PARTITION BY source_id ORDER BY {gap("txt", "t")}, i) AS rk FROM cand QUALIFY rk = 1),
ruled AS (SELECT * FROM (SELECT *, txt AS s FROM top) WHERE {REASON} = 'pass')
SELECT 'en->fr' AS pair_id, 'en' AS source_lang_code, 'fr' AS target_lang_code, t AS target_text, score AS metricx_qe_score_best, source_id,
  CASE WHEN {shard("source_id", 4)} <> 0 THEN imp END AS improvement, CASE WHEN {shard("source_id", 4)} <> 0 THEN sg END AS score_greedy,
  bucket::BIGINT AS length_bucket_id, 'Qwen/Qwen3-235B-A22B-Instruct-2507' AS model, true AS rule_based FROM ruled""",
    "pipeline_end_to_end": E2E,
    "teacher_translations": f"WITH {segments()} SELECT source_id, {ending('length(txt) // 2')} AS greedy_text, {ending('length(txt) // 3')} AS sample_text FROM src",
    "teacher_candidates": f"WITH {segments()} SELECT source_id, 8::BIGINT AS n, md5(array_to_string([{', '.join(ending(f'length(txt) // 3 - {i}') for i in range(8))}], '|')) AS translations_md5 FROM src",
    "judge_filter": f"WITH {segments()} SELECT source_id, CASE WHEN length({JUDGE_BODY}) % 3 <> 0 THEN 'pass' ELSE 'length' END AS reason FROM src",
    "idempotency_key": f"""WITH {segments()}, said AS (SELECT source_id, {prompt(prompts.TRANSLATOR_USER, source_lang=quoted('en'), src_lang_code=quoted('en'), target_lang=quoted('fr'), tgt_lang_code=quoted('fr'), text='txt')} AS content FROM src)
SELECT source_id, substr(sha1('{{"messages": [{{"content": {json.dumps(prompts.TRANSLATOR_SYSTEM)}, "role": "system"}}, {{"content": ' || to_json(content)::VARCHAR || ', "role": "user"}}], "n": 1}}||' || source_id), 1, 24) AS key FROM said""",
    "length_distribution": f"""WITH {PAIRS}, wanted AS (SELECT unnest([0.05, 0.25, 0.5, 0.75, 0.95])::DOUBLE AS quantile),
sizes AS (SELECT 'source' AS side, length(s) AS n FROM pairs UNION ALL SELECT 'target', length(t) FROM pairs),
placed AS (SELECT side, n, row_number() OVER (PARTITION BY side ORDER BY n) - 1 AS rn, count(*) OVER (PARTITION BY side) - 1 AS top FROM sizes WHERE n IS NOT NULL),
near AS (SELECT side, quantile, quantile * max(top) AS spot, max(n) FILTER (rn = floor(quantile * top)) AS low, max(n) FILTER (rn = ceil(quantile * top)) AS high FROM placed, wanted GROUP BY side, quantile)
SELECT side, quantile, round(low + (spot - floor(spot)) * (high - low), 6)::DOUBLE AS chars FROM near""",
    "jsonl_sink": "SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN lang END AS lang, md5(text) AS text_md5 FROM documents",
    "parquet_sink": "SELECT doc_id, lang, md5(text) AS text_md5 FROM documents",
    "text_sink": f"SELECT md5(part) AS line_md5, count(*) AS n FROM ({split(lines('text'))}) GROUP BY 1",
    "sharded_sink": f"SELECT doc_id, {shard("'s' || doc_id", 4)} AS shard, md5(text) AS text_md5 FROM documents",
    "shard_files": "SELECT doc_id, lang, md5(text) AS text_md5 FROM documents",
    "text_field_choice": "SELECT doc_id::VARCHAR AS doc_id, md5(text) AS text_md5 FROM documents WHERE doc_id % 7 <> 0 AND text IS NOT NULL",
    "settings": "SELECT count(*) AS documents, 3::BIGINT AS min_chars, 8::BIGINT AS candidates, 2::BIGINT AS buckets, 1::BIGINT AS refused FROM documents WHERE lang = 'en' AND length(text) BETWEEN 3 AND 5000",
    "stage_run": f"SELECT 'en->fr' AS pair_id, source_id, source_text, target_text, metricx_qe_score_best, improvement, segment_type, length_bucket_id FROM ({E2E}) WHERE reason = 'pass'",
    "stage_rejects": f"SELECT source_id, reason FROM ({E2E}) WHERE reason <> 'pass'",
    "stage_resume": f"{SAMPLED} SELECT source_id, imp AS improvement, bucket::BIGINT AS length_bucket_id FROM pre ORDER BY source_id LIMIT 600",
    "stage_overwrite": f"{SAMPLED} SELECT 1::BIGINT AS refused, least(100, (SELECT count(*) FROM seg))::BIGINT AS kept, count(*) AS anew, count(*) AS told FROM pre",
    "client_retries": f"WITH {segments()} SELECT source_id, CASE WHEN length(txt) % 4 < 3 THEN length(txt) ELSE -1 END::BIGINT AS chars FROM src",
}
