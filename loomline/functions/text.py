"""Text expressions as Spark SQL: each function takes and returns SQL for a column.

Character classes are spelled out so that they mean the same in every engine; the
short classes of the regular-expression dialects differ on Unicode. Bounds count
code points. Names follow what is computed, not how.
"""

from __future__ import annotations

WS = r"[\p{Z}\x09-\x0D\x1C-\x1F\x85]"
#: The same characters as a list: trimming by it stays in generated code.
WS_CHARS = "".join(rf"\u{c:04X}" for c in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
WORD = r"[\p{L}\p{N}_]"
TOKEN = rf"{WORD}+|[^\p{{L}}\p{{N}}_\p{{Z}}\x09-\x0D\x1C-\x1F\x85]"
LINE_END = r"\r\n|[\x0A-\x0D\x1C-\x1E\x85\x{2028}\x{2029}]"
HTML = r"<[^>]+>"

# Markers of answers that aren't translations, and of failed requests.
FORBIDDEN_MARKERS = ("assistant:", "user:", "system:", "here is the translation", "번역:", "i will translate", "<think>", "</think>")
ERROR_SUBSTRINGS = ("traceback", "internal server error", "runtimeerror", "exception", "chat template")


def text_lit(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def strip(x: str) -> str:
    return f"btrim({x}, '{WS_CHARS}')"


def token_len(x: str) -> str:
    """Words and single other characters, one at least."""
    return f"greatest(1, regexp_count({x}, r'{TOKEN}'))"


def _stripped(parts: str) -> str:
    return f"filter(transform({parts}, x -> {strip('x')}), x -> x <> '')"


def split_lines(x: str) -> str:
    return _stripped(f"split({x}, r'{LINE_END}', -1)")


def split_sentences(x: str) -> str:
    return _stripped(rf"split({x}, r'(?<=[.!?]){WS}+', -1)")


def let(name: str, value: str, body: str) -> str:
    """body with name standing for value, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


#: Elements that a fold marks before it puts the marks away.
PART = 1000


def runs(sizes: str, goes_on: str, more: str) -> str:
    """SQL for array<struct<first, last>>: where runs of elements begin and end, by their sizes from 1 on.

    An element of size k joins a run of size h if goes_on holds, and makes it more. A
    fold copies its state at each step, so it marks no more than PART elements at a
    time, a letter each, and arrays of any length cost little over their length.
    """
    on = f"a.h > 0 and {goes_on.format(h='a.h', k='k')}"
    inner = f"aggregate(slice(z, b * {PART} + 1, {PART}), named_struct('m', '', 'h', o.h), (a, k) -> if({on}, named_struct('m', concat(a.m, '0'), 'h', {more.format(h='a.h', k='k')}), named_struct('m', concat(a.m, '1'), 'h', k)), a -> named_struct('m', concat(o.m, a.m), 'h', a.h))"
    marks = f"aggregate(sequence(0, (size(z) - 1) div {PART}), named_struct('m', '', 'h', 0), (o, b) -> {inner}, o -> split(o.m, ''))"
    firsts = f"filter(sequence(0, size(z) - 1), i -> get(m, i) = '1')"
    found = let("m", marks, let("f", firsts, "transform(f, (x, j) -> named_struct('first', x, 'last', coalesce(get(f, j + 1), size(z)) - 1))"))
    return let("z", sizes, f"if(size(z) = 0, cast(array() as array<struct<first: int, last: int>>), {found})")


def run_text(parts: str, run: str) -> str:
    return f"array_join(slice({parts}, {run}.first + 1, {run}.last - {run}.first + 1), ' ')"


def merge_short(parts: str, min_chars: int) -> str:
    """Join a part under min_chars with those behind it, by one space, until it is long enough."""
    found = runs("transform(p, x -> length(x))", f"{{h}} < {min_chars}", "{h} + 1 + {k}")
    return let("p", parts, f"transform({found}, r -> {run_text('p', 'r')})")


def has_html(x: str) -> str:
    return f"({x} rlike r'{HTML}')"


def segment_ok(x: str, min_chars: int, max_chars: int, allow_html: bool) -> str:
    sized = f"length({x}) between {min_chars} and {max_chars}"
    return f"({sized})" if allow_html else f"({sized} and not {has_html(x)})"


def forbidden_marker(x: str) -> str:
    return "(" + " or ".join(f"contains(lower({x}), {text_lit(m)})" for m in FORBIDDEN_MARKERS) + ")"


def word_set(x: str) -> str:
    return f"array_distinct(regexp_extract_all(lower({x}), r'{WORD}+', 0))"


def word_overlap(source: str, target: str) -> str:
    """Part of the source's distinct words that the target has; 0 without words."""
    return f"coalesce(try_divide(cast(size(array_intersect({word_set(source)}, {word_set(target)})) as double), size({word_set(source)})), 0D)"


def stable_hash(x: str, length: int = 16) -> str:
    return f"substr(sha1({x}), 1, {length})"


def record_hash(*parts: str, length: int = 16) -> str:
    """Hash of the parts that aren't null."""
    return stable_hash(f"concat_ws('||', {', '.join(f'cast({p} as string)' for p in parts)})", length)


def shard_of(key: str, shards: int) -> str:
    if shards <= 1:
        return "0"
    return f"cast(pmod(cast(conv(substr(sha1({key}), 1, 8), 16, 10) as bigint), {shards}) as int)"


def bucket_of(length: str, boundaries: list[int]) -> str:
    """Index of the half-open range that holds a length; what is outside all goes to the last."""
    last = len(boundaries) - 2
    arms = " ".join(f"when {length} >= {a} and {length} < {b} then {i}" for i, (a, b) in enumerate(zip(boundaries, boundaries[1:])))
    return f"case {arms} else {last} end"


def dummy_score(source: str, hypothesis: str) -> str:
    return f"cast(abs(length({source}) - length({hypothesis})) as double)"


def parsed_score(x: str) -> str:
    """The first signed decimal in a scorer's answer; without one the query fails."""
    found = rf"regexp_extract({x}, r'-?\d+(?:\.\d+)?', 0)"
    return f"if({found} = '', cast(raise_error(concat('no score in: ', {x})) as double), cast({found} as double))"


def valid_response(x: str, min_chars: int = 1, errors: tuple[str, ...] = ERROR_SUBSTRINGS) -> str:
    bad = " or ".join(f"contains(lower({x}), {text_lit(e.lower())})" for e in errors if e) or "false"
    return f"coalesce(length({strip(x)}) >= {min_chars} and not ({bad}), false)"


def length_ratio(source: str, target: str) -> str:
    return f"(length({target}) / greatest(1, length({source})))"


def rule_reason(source: str, target: str, min_chars: int, max_chars: int, min_ratio: float, max_ratio: float, overlap: float) -> str:
    """The first rule that a pair fails, or pass; values on a bound pass."""
    return (
        f"case when {forbidden_marker(target)} then 'forbidden_marker' when length({target}) < {min_chars} then 'too_short' "
        f"when length({target}) > {max_chars} then 'too_long' when {length_ratio(source, target)} < {min_ratio}D then 'length_ratio_small' "
        f"when {length_ratio(source, target)} > {max_ratio}D then 'length_ratio_large' when {word_overlap(source, target)} > {overlap}D then 'high_overlap' else 'pass' end"
    )


def judge_json(reply: str) -> str:
    """The outermost braces of a reply as a variant; null where there are none or they don't parse."""
    return rf"try_parse_json(regexp_extract({reply}, r'(?s)\{{.*\}}', 0))"


def truthy(variant: str) -> str:
    """Whether a variant counts as true: false, 0, '', null and empty collections don't."""
    kind = f"schema_of_variant({variant})"
    return (
        f"case when {variant} is null or {kind} = 'VOID' then false when {kind} = 'BOOLEAN' then try_variant_get({variant}, '$', 'boolean') "
        f"when {kind} = 'STRING' then try_variant_get({variant}, '$', 'string') <> '' "
        f"when {kind} like 'ARRAY%' or {kind} like 'OBJECT%' then to_json({variant}) not in ('[]', '{{}}') else try_variant_get({variant}, '$', 'double') <> 0 end"
    )


def judge_pass(reply: str, permissive: bool = False) -> str:
    parsed = judge_json(reply)
    field = f"try_variant_get({parsed}, '$.pass', 'variant')"
    return f"case when {parsed} is null then {str(permissive).lower()} else coalesce({truthy(field)}, false) end"


def judge_reason(reply: str, permissive: bool = False) -> str:
    """reason_code as text; a missing one is unknown, an explicit null None, a failed reply judge_failed."""
    parsed = judge_json(reply)
    field = f"try_variant_get({parsed}, '$.reason_code', 'variant')"
    failed = "judge_failed_permissive" if permissive else "judge_failed"
    return (
        f"case when {parsed} is null then '{failed}' when {field} is null then 'unknown' when schema_of_variant({field}) = 'VOID' then 'None' "
        f"else try_variant_get({field}, '$', 'string') end"
    )
