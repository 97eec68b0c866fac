"""Documents to segments: sentences of lines, and token-bounded blobs of sentences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.functions import text as X


def segments_of(column: str, is_list: bool, seg: dict) -> str:
    """SQL for the array of a document's segments; lists are only stripped, never split or merged."""
    if is_list:
        parts = f"filter(transform({column}, x -> {X.strip('x')}), x -> x is not null and x <> '')"
    else:
        parts = X.split_lines(column)
        if seg["mode"] in ("auto", "newline"):
            parts = f"flatten(transform({parts}, l -> if(length(l) > {seg['max_chars']}, {X.split_sentences('l')}, array(l))))"
        if seg.get("merge_short", True):
            parts = X.merge_short(parts, seg["min_chars"])
    ok = X.segment_ok("x", seg["min_chars"], seg["max_chars"], seg.get("allow_html", False))
    return f"filter({parts}, x -> {ok})"


def blobs_of(segments: str, max_tokens: int) -> str:
    """SQL for array<struct<text, first, last>>: runs of segments of at most max_tokens, a longer segment alone."""
    found = X.runs(f"transform(s, x -> {X.token_len('x')})", f"{{h}} + {{k}} <= {max_tokens}", "{h} + {k}")
    return X.let("s", segments, f"transform({found}, r -> named_struct('text', {X.run_text('s', 'r')}, 'first', r.first, 'last', r.last))")


def segment_arrays(docs: DataFrame, cfg: dict) -> DataFrame:
    """(doc_ord, doc_id, segments) of (doc_ord, doc_id, text)."""
    is_list = isinstance(docs.schema["text"].dataType, T.ArrayType)
    return docs.filter("text is not null").select("doc_ord", "doc_id", F.expr(segments_of("text", is_list, cfg["segmentation"])).alias("segments"))


def segments(docs: DataFrame, cfg: dict, include_blobs: bool = True) -> DataFrame:
    """One row a segment: (doc_ord, doc_id, segment_type, segment_index, segment_span, source_text).

    Each document is folded once; sentences and blobs leave it in one generator, so the
    scan isn't repeated for a union.
    """
    seg = cfg["segmentation"]
    whole = "named_struct('segment_type', 'sentence', 'segment_index', i, 'segment_span', cast(null as array<int>), 'source_text', x)"
    rows = f"transform(segments, (x, i) -> {whole})"
    if include_blobs:
        ok = X.segment_ok("b.text", seg["min_chars"], seg["max_chars"], seg.get("allow_html", False))
        blob = "named_struct('segment_type', 'blob', 'segment_index', b.first, 'segment_span', array(b.first, b.last), 'source_text', b.text)"
        made = blobs_of("segments", cfg["final_generation"]["blob"]["blob_max_tokens"])
        rows = f"concat({rows}, transform(filter({made}, b -> {ok}), b -> {blob}))"
    found = segment_arrays(docs, cfg).select("doc_ord", "doc_id", F.expr(f"inline({rows})"))
    return found


def limited(segs: DataFrame, limit: int | None) -> DataFrame:
    """The first segments by arrival; 0 and None take all."""
    arrival = ["doc_ord", F.expr("segment_type = 'blob'"), "segment_index"]
    return segs.orderBy(*arrival).limit(limit) if limit else segs
