"""Each operator against a plain version, over the cases that its docstring defines."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomline.llm import chat_format, decontam, html_extract, line_dedup, minhash, quality, substring_dedup, suffix_dedup

DOCS = "doc_id long, text string, source string, n_words long, score string"


def words(rng: random.Random, n: int, vocabulary: int = 60) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def corpus(seed: int = 1, n: int = 40) -> list[tuple]:
    """Copies, near copies, shared passages, repeats within a text, nulls, empty and long texts; two columns that clash with results."""
    rng = random.Random(seed)
    passage, line = words(rng, 60), "A common line."
    rows = []
    for i in range(n):
        kind = i % 8
        text = words(rng, rng.randrange(5, 90))
        if kind == 1 and i > 8:
            text = rows[i - 8 + 7][1] if rows[i - 1][1] is None else rows[i - 1][1]
        elif kind == 2:
            text = f"{words(rng, 20)} {passage} {words(rng, 20)}"
        elif kind == 3:
            text = f"{words(rng, 4)}\n{line}\n {line.upper()} \n\n{words(rng, 3)}"
        elif kind == 4:
            text = " ".join(["spam ham"] * rng.randrange(1, 90))
        elif kind == 5 and i > 8:
            near = rows[i - 4][1].split(" ") if rows[i - 4][1] else ["x"]
            near[len(near) // 2] = "changed"
            text = " ".join(near)
        elif kind == 6:
            text = [None, "", " \t\n", "é漢\U0001f600 " * 30, "one"][(i // 8) % 5]
        rows.append((i, text, "hot" if i % 3 == 0 else "cold", -1, "clash"))
    rows.append((n, words(rng, 4000), "cold", -1, "clash"))
    return rows


def by_id(df) -> dict:
    return {r["doc_id"]: r for r in df.collect()}


def test_html_pages():
    page = (
        "<html><head><title>T</title><script>var a='<p>no</p>'</script></head><body><header>Top</header><nav><ul><li><a>menu</a></ul></nav>"
        '<div class="cookie-notice">cookies</div><article class="post-12"><h1>A &amp; B</h1><p>One <b>two</b>\n three<p>Four &lt;x&gt;<form>f</form>'
        '<div class="comments"><p>nice</p></div></article><aside>side</aside><div class="ad">buy</div><footer>end</footer>'
    )
    made = html_extract.Page(page)
    assert made.extract([]) == "A & B\nOne two three\nFour <x>"
    assert made.paths[made.best()] == "/body./article.post-#"
    assert html_extract.Page("").extract([]) == ""
    assert html_extract.Page("plain &amp; simple").extract([]) == "plain & simple"
    assert html_extract.Page("<p cla").extract([]) == ""


def test_html_hosts_vote(spark):
    good = '<body><div class="menu">m</div><div class="main-7"><p>{}</p></div><div class="box"><p>{}</p></div></body>'
    rows = [(i, "http://h.example/a", good.format("long text " * 20, "x")) for i in range(9)]
    rows += [(9, "http://h.example/b", good.format("short", "a very long box " * 30)), (10, None, None), (11, "http://h.example/c", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    for limit in (50_000, 0):  # broadcast, then joined
        out = {r["page_id"]: r for r in html_extract.extract(pages, broadcast_paths=limit - 10 if limit == 0 else limit).collect()}
        assert out[9]["text"] == "short" and out[9]["n_chars"] == 5
        assert out[10]["text"] == "" and out[11]["text"] == "" and len(out) == 12
    assert html_extract.extract(pages.limit(0)).count() == 0


def test_html_split_articles(spark):
    split = '<main><section class="intro"><p>{}</p></section><section class="story"><p>{}</p></section></main>'
    rows = [(i, "http://a.example/", split.format("intro " * 50, "story " * 120)) for i in range(9)] + [(9, "http://a.example/", split.format("intro", ""))]
    titled = '<body><div class="top"><h1>{}</h1></div><div class="text"><p>{}</p></div><div class="close">x</div></body>'
    rows += [(20 + i, "http://b.example/", titled.format("A", "body " * 90)) for i in range(9)]
    mixed = '<body><div class="lead">{}</div><div class="text"><p>{}</p></div></body>'  # two pages of eight have a lead
    rows += [(40 + i, "http://c.example/", mixed.format("lead " * 9 if i < 2 else "", "body " * 90)) for i in range(8)]
    out = {r["page_id"]: r["text"] for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(out[i] == f"{('intro ' * 50).strip()}\n{('story ' * 120).strip()}" for i in range(9)) and out[9] == "intro"
    assert all(out[20 + i].startswith("A\nbody body") for i in range(9))
    assert all(out[40 + i].startswith("lead lead" if i < 2 else "body body") and out[40 + i].endswith("body") for i in range(8))


def test_html_link_lists():
    sources = '<ul><li><a href="#">First source</a></li><li><a href="#">Second source</a></li></ul><dl><dt><a href="#">Term</a></dt><dd><a href="#">Entry</a></dd></dl>'
    menu = '<div class="top"><ul><li><a href="#">Home</a></li><li><a href="#">News</a></li></ul></div>'
    listed = "First source\nSecond source\nTerm\nEntry"
    for inner in (f"<article><p>Text.</p>{sources}</article>", f'<main><div class="story"><p>Text.</p></div><div class="refs">{sources}</div></main>', f'<div class="story"><p>Text.</p>{sources}</div>'):
        made = html_extract.Page(f"<body>{menu}{inner}</body>")
        assert made.extract([]) == f"Text.\n{listed}" and "top" not in made.paths[made.best()]


def test_html_keeps_article_text(spark):
    parse = lambda body: html_extract.Page(f"<html><body>{body}</body></html>").extract([])
    assert parse("<article><p>See <a href=x title=don't>link</a> world. It's fine.</p></article>") == "See link world. It's fine."
    assert parse('<article><p>A <a href="x>y" title=\'a"b\'>b</a> c</p></article>') == "A b c"
    assert parse("<article><p>One</p><ul><li><a>First linked resource</a></li><li><a>Second linked resource</a></li></ul></article>") == "One\nFirst linked resource\nSecond linked resource"
    assert parse('<article><div class="share-price">12 Euro</div><section class="related-work"><p>Others did.</p></section><div class="share-buttons">x</div><div id="comments">y</div></article>') == "12 Euro\nOthers did."
    assert parse("<header>Site</header><main><header><h1>Title</h1></header><p>Text of the page.</p></main>") == "Title\nText of the page."
    deep = html_extract.Page("<body>" + "<div class=level>" * 16_000 + "deep" + "</div>" * 16_000)
    assert deep.extract([]) == "deep" and deep.path(16_001) == "/body." + "/div.level" * 16_000
    two = '<body><div class="{}"><p>{}</p></div><div class="{}"><p>{}</p></div></body>'
    rows = [(i, "http://t.example/", two.format("old", "old text " * 60, "note", "")) for i in range(7)]
    rows += [(10 + i, "http://t.example/", two.format("old", "tiny", "new", "new text " * 100)) for i in range(4)]
    pages = spark.createDataFrame(rows + rows[:1], "page_id long, url string, html string").withColumn("__host", F.lit("own")).withColumn("__paths", F.lit("own"))
    for limit in (50_000, -10):
        out = html_extract.extract(pages, broadcast_paths=limit).collect()
        assert len(out) == 12 and {(r["__host"], r["__paths"]) for r in out} == {("own", "own")}
        assert all(r["text"] == (("old text " * 60).strip() if r["page_id"] < 10 else "tiny\n" + ("new text " * 100).strip()) for r in out)
    page = html_extract.Page(two.format("old", "tiny", "new", "new text " * 100))
    assert page.extract([("/body./div.old", True), ("/body./div.new", True)]) == ("new text " * 100).strip()
    assert page.extract([("/body./div.old", True), ("/body./div.new", False)]) == "tiny"


def test_chat_round_trip(spark):
    tricky = "<|im_end|><|im_start|>assistant ok"
    rows = [
        (1, 0, "user", tricky), (1, 1, "assistant", "<\\|im_end|>"), (2, 0, "sys\ntem", None), (2, 0, None, "tie"), (3, 0, "assistant", "plain <| text"),
        (3, 0, "assistant", "plain <| text"), (None, None, "assistant", ""), (4, 0, "<|nl|>", "<|nl|>"), (5, 0, "user", "x" * 50_000),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))
    out = {r["conv_id"]: r for r in chat_format.format_chats(turns).collect()}
    for conv, r in out.items():
        want = sorted((t if t is not None else -1, role or "", text or "") for c, t, role, text in rows if c == conv)
        assert [(x["role"], x["text"]) for x in r["recovered"]] == [w[1:] for w in want]
    assert out[1]["escaped"] and out[4]["escaped"] and not out[3]["escaped"] and not out[5]["escaped"]
    assert out[1]["formatted"].count("<|im_start|>") == 2
    assert chat_format.format_chats(turns.limit(0)).count() == 0


def test_chat_end_alone(spark):
    tricky = ["done <|im_end|> and more", "done<|im_end|>\n", "<|im_end|>", "<<|im_end|>" * 2]
    rows = [(i, 0, "user", t) for i, t in enumerate(tricky)] + [(10, 0, "us<|im_end|>er", "x"), (11, 0, "user<|im_end|>\n", "x"), (12, 0, "user", "plain <|im_end|")]
    out = {r["conv_id"]: r for r in chat_format.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    for conv, _, role, text in rows:
        r = out[conv]
        assert r["formatted"].count("<|im_end|>") == 1 and [tuple(x) for x in r["recovered"]] == [(role, text)] and r["escaped"] == (conv < 12)


def test_quality_counts(spark):
    docs = spark.createDataFrame(corpus(), DOCS)
    twice = quality.quality(docs.unionByName(docs.limit(9))).collect()
    assert len(twice) == len(corpus()) + 9 and len(set(map(str, twice))) == len(corpus())
    out = by_id(quality.quality(docs))
    for i, text, *_ in corpus():
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        count = Counter(grams)
        repeated = {k + j for k, g in enumerate(grams) if count[g] > 1 for j in range(3)}
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        r = out[i]
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"], r["n_dup_lines"]) == (len(w), sum(map(len, w)), len(repeated), len(lines) - len(set(lines)))
        assert r["base_failed"] == (len(w) < 50 or 100 * len(repeated) > 50 * len(w))
    assert quality.quality(docs.limit(0)).count() == 0


def test_quality_lines(spark):
    prose = "This line of prose has more than a dozen words in it and it ends properly. " * 8
    rows = [(1, prose), (2, f"Home | News | Sport | More\n{prose}\nAll rights reserved"), (3, "\n".join(["Home | News | Sport | Weather | Travel | Maps"] * 12)), (4, "These### words%%% are&&& all*** strewn$$$ with### symbols.%%% " * 9)]
    out = by_id(quality.quality(spark.createDataFrame(rows, "doc_id long, text string"), max_repeat=101))
    assert out[1]["kept"] and out[1]["clean_text"].strip() == prose.strip()
    assert out[2]["kept"] and out[2]["n_lines_failed"] == 2 and "rights" not in out[2]["clean_text"]
    assert not out[3]["kept"] and not out[4]["kept"]


def test_quality_long_lines(spark):
    """Lines of very many labels, words and ends, and a menu's edges, as the rules' patterns read them."""
    edges = ["a|b|c|d", "a|b|c", "|a|b|c", " |a|b|c", f"{'x' * 30}|b|c|d", f"{'x' * 31}|b|c|d", f"  {'x' * 30}|b|c|{' ' * 40}{'y' * 30}", f"a|b|c|{'y' * 29}  ", "a|||", "a › b » c · d • e", "a > b > c > d\r"]
    rows = [(i, text) for i, text in enumerate(["a|" * 100_000, "word " * 1_000_000, "." * 300_000 + "x", "x | " * 50_000 + "end.", *edges, edges[0]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = by_id(quality.quality(docs))
    assert out[0]["n_lines_failed"] == 1 and out[1]["n_words"] == 1_000_000 and out[2]["n_words"] == 1
    pattern = re.compile(r"[\x20\x09-\x0D]*[^|»›>•·]{1,30}([|»›>•·][\x20\x09-\x0D]*[^|»›>•·]{0,30}){3,}")
    for i, text in rows[4:]:
        assert (out[i]["n_lines_failed"] == 1) == bool(pattern.fullmatch(text)), text


def plain_decontam(text, items, window):
    clean = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    w = clean(text)
    hit, found = set(), set()
    for item, t in items:
        iw = clean(t)
        n = min(window, len(iw))
        wins = {tuple(iw[k : k + n]) for k in range(len(iw) - n + 1)} if n and item is not None else set()
        for k in range(len(w) - n + 1):
            if tuple(w[k : k + n]) in wins:
                hit |= set(range(k, k + n))
                found.add(item)
    return len(w), len(hit), sorted(map(str, found))


def test_decontamination(spark):
    rng = random.Random(5)
    items = [(k, words(rng, n, 40)) for k, n in enumerate([30, 12, 8, 3, 1, 9, 9])] + [(7, None), (8, ""), (None, words(rng, 9)), (9, words(rng, 12, 40))]
    items.append((10, items[0][1]))
    rows = [(i, words(rng, 80, 40)) for i in range(20)]
    rows += [(20 + i, f"{words(rng, 9)} {t.upper() if i % 2 else t}, {words(rng, 9)}") for i, (_, t) in enumerate(items) if t] + [(50, None), (51, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_hit", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = docs.unionByName(docs.filter("doc_id = 21")).withColumn("__key", F.lit("own"))
    for how in ({}, {"broadcast_bytes": 10}, {"broadcast_bytes": 10, "block_bytes": 60}):
        rows_out = decontam.decontaminate(docs, bench, **how).collect()
        out = {r["doc_id"]: r for r in rows_out}
        assert len(rows_out) == len(rows) + 1 and {r["__key"] for r in rows_out} == {"own"}
        for i, text in rows:
            n, hit, found = plain_decontam(text, items, 8)
            r = out[i]
            assert (r["n_words"], r["n_hit"], r["n_items"]) == (n, hit, len(found)), i
            assert r["items_sha256"] == hashlib.sha256(",".join(found).encode()).hexdigest()
            assert r["contaminated"] == (len(found) >= 2)
            assert plain_decontam(r["clean_text"], [], 8)[0] == n - hit
        assert decontam.decontaminate(docs.limit(0), bench, **how).count() == 0
    assert by_id(decontam.decontaminate(docs, bench.limit(0)))[20]["n_hit"] == 0


def plain_components(rows, k, similarity):
    sets = {}
    for i, t, *_ in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and sets[b] and 100 * both >= similarity * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("shingle", [2, 5])
def test_near_duplicates(spark, shingle):
    rng = random.Random(9)
    rows = [(i, t) for i, t, *_ in corpus(3, 32)]
    base = words(rng, 50, 500).split()
    for i in range(100, 130):  # a chain of near copies whose ends aren't alike
        base[rng.randrange(50)] = f"c{i}"
        rows.append((i, " ".join(base)))
    rows += [(200, "a b"), (201, "A  B"), (202, "a"), (203, "a"), (204, words(rng, 3)), (205, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("clash"))
    out = by_id(minhash.near_duplicates(docs, shingle=shingle))
    for i, (n, component) in plain_components(rows, shingle, 80).items():
        assert (out[i]["n_shingles"], out[i]["component_id"], out[i]["kept"]) == (n, component, component == i), i
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_a_hot_band_costs_its_size(spark, monkeypatch):
    """Very many unlike texts that share a shingle and so bands: the rows that blocks get stay in proportion, and links among them are found."""
    made = []
    blocks = minhash._blocks
    monkeypatch.setattr(minhash, "_blocks", lambda *a: made.append(blocks(*a)) or made[-1])
    monkeypatch.setattr(minhash, "BLOCK", 100)
    monkeypatch.setattr(minhash, "SPLIT", 50)
    common, n = " ".join(f"k{i}" for i in range(8)), 5_000
    rows = [(i, f"{common} c{i} d{i} e{i}") for i in range(n)]
    rows += [(30_000 + k * 10_000 + i, f"{common} d{i} e{i} f{i} g{i} h{i}" + (" x" if i % 2 == k else "")) for i in range(40) for k in (0, 1)]
    out = by_id(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2))
    assert all(out[40_000 + i]["component_id"] == 30_000 + i for i in range(40)) and all(out[i]["kept"] for i in range(n))
    assert made[-1].count() < 8 * n  # blocks of 100 without the split would get each of some thousand nodes dozens of times


def test_a_group_of_near_copies_costs_its_size(spark, monkeypatch):
    """Copies that differ too much from their group meet it once, not in each band nor by each of their rare shingles."""
    made = []
    blocks = minhash._blocks
    monkeypatch.setattr(minhash, "_blocks", lambda *a: made.append(blocks(*a)) or made[-1])
    monkeypatch.setattr(minhash, "BLOCK", 50)
    monkeypatch.setattr(minhash, "SPLIT", 10)
    rng = random.Random(17)
    base, rows = [f"b{i}" for i in range(120)], []
    for i in range(300):
        text = list(base)
        for at in rng.sample(range(120), rng.randrange(1, 5) if i % 3 else rng.randrange(11, 16)):
            text[at] = f"v{rng.randrange(40)}"
        rows.append((i, " ".join(text)))
    out = by_id(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2))
    for i, (n, component) in plain_components(rows, 2, 80).items():
        assert (out[i]["n_shingles"], out[i]["component_id"]) == (n, component), i
    assert made[-1].count() < 10 * len(rows)


def test_shared_counts(monkeypatch):
    rng = np.random.default_rng(8)
    for at_once in (1 << 22, 3):
        monkeypatch.setattr(minhash, "AT_ONCE", at_once)
        for most in (0, 30):  # items that most sets have
            sets = [np.unique(np.concatenate([rng.choice(most, most * 9 // 10, replace=False), rng.integers(most, 90, rng.integers(1, 20))])).astype(np.uint64) for _ in range(25)]
            rows = [0, 3, 24]
            for i, counts in zip(rows, minhash.shared_counts(sets, rows), strict=True):
                assert counts.tolist() == [len(np.intersect1d(sets[i], x)) for x in sets]


def test_blocks_of_a_band(monkeypatch, spark):
    """Small blocks and an early split give the same components."""
    monkeypatch.setattr(minhash, "BLOCK", 3)
    for split in (500, 1):
        monkeypatch.setattr(minhash, "SPLIT", split)
        rng = random.Random(12)
        rows = []
        for i in range(120):
            near = rng.choice(rows)[1].split() if rows and i % 3 else [f"v{rng.randrange(6)}" for _ in range(rng.randrange(2, 9))]
            near[rng.randrange(len(near))] = f"v{rng.randrange(6)}"
            rows.append((i, " ".join(near)))
        out = by_id(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2))
        for i, (n, component) in plain_components(rows, 2, 80).items():
            assert (out[i]["n_shingles"], out[i]["component_id"]) == (n, component), i


def test_estimate_is_close():
    rng = np.random.default_rng(4)
    for n in (3, 40, 900, 30_000):
        errors = []
        for _ in range(30):
            shared, own = minhash.mix(rng.integers(1, 2**62, n, dtype=np.uint64)), minhash.mix(rng.integers(1, 2**62, n // 3 + 1, dtype=np.uint64))
            a, b = np.unique(shared), np.unique(np.concatenate([shared, own]))
            found = minhash.estimate(minhash.sketch(a)[None], minhash.sketch(b)[None], np.array([len(a)]), np.array([len(b)]))[0]
            errors.append(found - len(a) / len(b))
        assert abs(np.mean(errors)) < 0.06


def test_line_index_is_reversible(spark):
    docs = spark.createDataFrame(corpus(), DOCS).select("doc_id", "text").withColumn("n_lines", F.lit("clash"))
    one, two = docs.filter("doc_id < 30"), docs.filter("doc_id >= 30")
    index = line_dedup.insert(line_dedup.insert(line_dedup.empty_index(spark), one), two)
    rows = lambda df: {(r["shard"], bytes(r["key"])): r["n"] for r in df.collect()}
    assert rows(index) == rows(line_dedup.line_counts(docs))
    before = line_dedup.line_counts(one)
    assert rows(line_dedup.delete(index, two)) == rows(before)
    old, new = (line_dedup.build_filters(x.filter("n >= 4")) for x in (before, index))
    for start, a, b in ((old, before, index), (new, index, before)):
        filters = {r["shard"]: line_dedup.CuckooFilter.of(bytes(r["payload"])) for r in line_dedup.update_filters(start, a, b, 4).collect()}
        assert all(bytes(r["key"]) in filters[r["shard"]] for r in b.filter("n >= 4").collect())
    for limit in (200_000, 0):
        out = by_id(line_dedup.clean(docs, index, min_docs=4, broadcast_keys=limit))
        key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
        count = Counter(k for _, t, *_ in corpus() for k in {key(x) for x in (t or "").split("\n")} if k)
        for i, t, *_ in corpus():
            lines = (t or "").split("\n")
            kept = [x for x in lines if not key(x) or count[key(x)] < 4]
            assert (out[i]["clean_text"], out[i]["n_lines"], out[i]["n_dropped"]) == ("\n".join(kept), len(lines), len(lines) - len(kept))
    assert line_dedup.line_dedup(docs.limit(0)).count() == 0


def test_cuckoo_filter():
    keys = [line_dedup.key_hash(str(i).encode()) for i in range(3000)]
    made = line_dedup.CuckooFilter.build(keys[:2000])
    assert all(k in made for k in keys[:2000])
    assert sum(k in made for k in keys[2000:]) < 20
    for k in keys[:1000]:
        assert made.delete(k)
    assert all(k in made for k in keys[1000:2000]) and sum(k in made for k in keys[:1000]) < 20
    assert line_dedup.CuckooFilter.of(made.payload()).table.tolist() == made.table.tolist()


def plain_substring(rows, window):
    first, out = {}, {}
    toks = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t, *_ in rows}
    for i, w in sorted(toks.items()):
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k : k + window]), i)
    for i, w in toks.items():
        gone = {k + j for k in range(len(w) - window + 1) if first[tuple(w[k : k + window])] < i for j in range(window)}
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


@pytest.mark.parametrize("reference_words", [60_000, 40])
def test_substring_dedup(spark, reference_words):
    rows = corpus(7, 64)
    docs = spark.createDataFrame(rows, DOCS)
    out = by_id(substring_dedup.substring_dedup(docs, reference_words=reference_words))
    for i, want in plain_substring(rows, 13).items():
        assert (out[i]["n_words"], out[i]["n_removed"], out[i]["clean_text"]) == want, i
    assert out[0]["source"] == "hot"
    assert substring_dedup.substring_dedup(docs.limit(0)).count() == 0


def test_substring_words_and_white_space(spark):
    w = [f"{'long' * (i % 6)}é{i}" for i in range(30)]
    docs = spark.createDataFrame([(1, " ".join(w)), (2, "\n\t".join(w)), (3, "x " + "\r\n".join(w[:13]) + " \x0b"), (4, " ".join(w[1:13]))], "doc_id long, text string")
    out = by_id(substring_dedup.substring_dedup(docs))
    assert [(out[i]["n_words"], out[i]["n_removed"], out[i]["clean_text"]) for i in (1, 2, 3, 4)] == [(30, 0, " ".join(w)), (30, 30, ""), (14, 13, "x"), (12, 0, " ".join(w[1:13]))]


def plain_suffix(rows, window):
    seen, out = set(), {}
    for i, t, *_ in sorted(rows):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - window + 1):
            if b[k : k + window] in seen:
                gone[k : k + window] = True
            seen.add(b[k : k + window])
        spans = int((np.diff(np.concatenate(([0], gone.view(np.int8)))) == 1).sum())
        out[i] = (len(b), int(gone.sum()), spans, np.frombuffer(b, np.uint8)[~gone].tobytes())
    return out


@pytest.mark.parametrize("held", [64_000_000, 0])
def test_suffix_dedup(spark, held):
    rows = [r for r in corpus(11, 48)] + [(300, "ab" * 400, "x", 0, ""), (301, "z" * 700, "x", 0, "")]
    docs = spark.createDataFrame(rows, DOCS)
    out = by_id(suffix_dedup.suffix_dedup(docs, held_bytes=held))
    for i, want in plain_suffix(rows, 100).items():
        assert (out[i]["n_bytes"], out[i]["n_removed"], out[i]["n_spans"], bytes(out[i]["kept"])) == want, i
    assert suffix_dedup.suffix_dedup(docs.limit(0)).count() == 0


def test_groups_by_the_size_of_the_input(spark, monkeypatch):
    """More buckets and shards than shuffle partitions; a column named like an inner one stays."""
    from loomline.llm import windows

    monkeypatch.setattr(windows, "GROUP_BYTES", 700)
    rows = corpus(7, 40)
    docs = spark.createDataFrame(rows, DOCS).withColumn("bucket", F.lit("own"))
    out = by_id(substring_dedup.substring_dedup(docs))
    assert all((out[i]["n_words"], out[i]["n_removed"], out[i]["clean_text"], out[i]["bucket"]) == (*want, "own") for i, want in plain_substring(rows, 13).items())
    out = by_id(suffix_dedup.suffix_dedup(docs))
    assert all((out[i]["n_bytes"], out[i]["n_removed"], bytes(out[i]["kept"]), out[i]["bucket"]) == (*want[:2], want[3], "own") for i, want in plain_suffix(rows, 100).items())


def test_repeated_rows_and_null_ids(spark):
    text = " ".join(f"u{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text), (1, text), (None, text), (2, text)], "doc_id long, text string")
    words_left = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_removed"]) for r in substring_dedup.substring_dedup(docs).collect())
    assert words_left == [(False, 1, 40), (False, 1, 40), (False, 2, 40), (True, 0, 0)]
    bytes_left = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_removed"]) for r in suffix_dedup.suffix_dedup(docs).collect())
    assert bytes_left == [(False, 1, len(text)), (False, 1, len(text)), (False, 2, len(text)), (True, 0, 0)]
    near = minhash.near_duplicates(docs).collect()
    assert {r["component_id"] for r in near} == {1} and len(near) == 4
