"""The registered queries against their SQL, and the pipeline against plain code."""

from __future__ import annotations

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "labels", "conversations")


def rows(df) -> list[str]:
    df = df[sorted(df.columns)]
    return sorted("|".join(map(str, r)) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", ["op2_chat_formatting", "op3_quality_rules", "op4_decontamination", "op9_line_dedup", "op10_substring_dedup"])
def test_query_equals_sql(spark, name):
    from loomline.llm.oracle import ORACLES
    from loomline.llm.queries import QUERIES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(con.execute(ORACLES[name]).df())


def test_suffix_query(spark):
    import hashlib

    from loomline.llm.queries import QUERIES
    from tests.llm.test_operators import plain_suffix

    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = plain_suffix(docs, 100)
    for r in QUERIES["op6_suffix_array_dedup"](spark, SF).collect():
        n, removed, spans, kept = want[r["doc_id"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (n, removed, spans, hashlib.sha256(kept).hexdigest())


def test_near_query(spark):
    from loomline.llm.queries import QUERIES
    from tests.llm.test_operators import plain_components

    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = plain_components(docs, 2, 80)
    for r in QUERIES["op5_minhash_dedup"](spark, SF).collect():
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (*want[r["doc_id"]], want[r["doc_id"]][1] == r["doc_id"])


def test_page_query(spark):
    import html
    import re

    from loomline.llm.queries import QUERIES

    source = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in QUERIES["op1_html_extraction"](spark, SF).collect():
        inside = re.search(r"<article>(.*?)(</article>|\Z)", source[r["page_id"]], re.S)
        body = re.sub(r"<[^>]*\Z", "", inside[1]).replace("<br>", " ") if inside else ""
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_pipeline(spark, tmp_path):
    """Every stage equals a plain version of it on its own input."""
    import corpus_pipeline as cp
    from loomline.llm import pieces
    from tests.llm.test_operators import plain_components, plain_decontam

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for number, (name, stage) in enumerate(cp.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        after = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
        if name != "sentencepiece":
            assert docs.columns == columns
        if name == "toxicity":
            assert len(after) > 0.8 * len(before) and after.items() <= before.items()
        elif name == "line_dedup":
            assert after.keys() == before.keys()
        elif name == "minhash_dedup":
            groups = plain_components(list(before.items()), 5, 80)
            assert after.keys() == {i for i, (_, c) in groups.items() if c == i}
        elif name == "decontamination":
            judged = {i: plain_decontam(t, bench, 8) for i, t in before.items()}
            assert after.keys() == {i for i, j in judged.items() if len(j[2]) < 2}
            assert all((after[i] == before[i]) == (judged[i][1] == 0) for i in after)
        else:
            v = pieces.Vocabulary(pieces.model_bytes(pieces.MODEL))
            for r in docs.collect():
                assert v.decode(r["piece_ids"]).decode() == r["text"] and r["decoded_same"]
        before = after
    assert cp.run(spark, SF).count() == len(before)
