"""Similarity join, decontamination, top-k, pages and archives against brute force and on odd input."""

import io
import random
import re
import zipfile
from math import log

import numpy as np
import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

from netvigil.llm import archive, decontaminate, jaccard, pages, queries, topk
from netvigil.llm.files import Ranges, publish
from netvigil.session import new_path


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_as_sql(spark, sf_dir, name):
    assert compare(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLES[name]) is None


# --- similarity join ---------------------------------------------------------------------------------------------


def shingle_set(text):
    words = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode()) if w]
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def brute_components(rows):
    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in parent}


def test_components_are_those_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SIDE", 4)
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    rows = []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(1, 70))]
        if rng.random() < 0.5:
            base += passage
        for _ in range(rng.randint(1, 9)):
            words = list(base)
            for _ in range(rng.randint(0, 4)):
                if rng.random() < 0.5:
                    words[rng.randrange(len(words))] = rng.choice(vocabulary)
                else:
                    words.append(rng.choice(vocabulary))
            rows.append((len(rows) * 7 % 1009, rng.choice([" ", "\n", " \t "]).join(words)))
    rows += [(2001, "one two"), (2002, "ONE  two"), (2003, ""), (2004, ""), (2005, None), (None, rows[0][1]), (2006, "é É"), (2007, "É É")]
    rows += [(3000, rows[0][1]), (3000, "another text of the same number here"), (3001, "another text of the same number here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component_id", F.lit("x")).withColumn("size", F.lit(1))
    found = jaccard.jaccard_components(docs).collect()
    assert len(found) == len(rows)
    expected = brute_components(rows)
    assert {(r.doc_id, r.component_id) for r in found if r.doc_id is not None} == set(expected.items())
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles) for r in found) == sorted((i if i is not None else -1, len(shingle_set(t))) for i, t in rows)
    assert [r.component_id for r in found if r.doc_id is None] == [None]
    kept = jaccard.keep_one(docs).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted({c for c in expected.values()})
    assert sum(r.doc_id is None for r in kept) == 1 and jaccard.keep_one(docs).columns == docs.columns


def test_no_documents_no_components(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.jaccard_components(empty).collect() == [] and jaccard.keep_one(empty).collect() == []


def test_a_long_text_and_its_copy(spark):
    text = " ".join(f"t{i}" for i in range(150_000)) + "x" * 1_200_000
    rows = [(1, text), (2, text), (3, text + " end")]
    found = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in found} == {1} and {r.n_shingles for r in found} == {149_996, 149_997}


# --- decontamination ---------------------------------------------------------------------------------------------


def test_search_finds_what_full_scoring_finds(monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK", 2)
    rng = random.Random(1)
    items = [(i, " ".join(rng.choice("abcdefghijklmnopqrst") * rng.randint(1, 2) for _ in range(rng.randint(3, 25)))) for i in range(60)]
    words = decontaminate._hashes([t for _, t in items])
    frequency = {}
    for own in words:
        for term in np.unique(own).tolist():
            frequency[term] = frequency.get(term, 0) + 1
    mean = sum(map(len, words)) / len(words)
    index = decontaminate.build_index(items, frequency, len(items), mean)

    def weights(own):
        out = {}
        for term in set(own):
            n, df = own.count(term), frequency[term]
            out[term] = log(1 + (len(items) - df + 0.5) / (df + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(own) / mean))
        total = sum(out.values())
        return {t: w / total for t, w in out.items()}

    table = [weights(own.tolist()) for own in words]
    for _ in range(200):
        query = rng.sample(range(len(index.terms)), rng.randint(1, len(index.terms)))
        held = set(index.terms[query].tolist())
        scores = {i: sum(w for t, w in row.items() if t in held) for i, row in enumerate(table)}
        least = rng.choice([0.2, 0.5, 0.8])
        found = dict(decontaminate.search(index, query, least, 0, len(items)))
        assert set(found) == {i for i, s in scores.items() if s >= least - 1e-9}
        assert all(abs(found[i] - scores[i]) < 1e-9 for i in found)


def test_items_are_found_wherever_they_stand(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    texts = [r.text for r in items.orderBy("item_id").collect()]
    filler = " ".join(f"filler{i % 97}" for i in range(1000))
    rows = [(i, f"{filler[: 37 * i]} {t.upper()} {filler}") for i, t in enumerate(texts)]
    rows += [(1000 + i, " ".join(t.split()[:4]) + filler) for i, t in enumerate(texts)] + [(5000, None), (5001, ""), (5002, "!?"), (None, texts[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit("mine")).withColumn("plain_text", F.lit(1))
    found = decontaminate.contaminations(docs, items.withColumn("doc_id", F.lit(1))).collect()
    assert {(r.doc_id, r.item_id) for r in found} >= {(i, i) for i in range(len(texts))}
    assert max(r.doc_id for r in found) < 1000
    left = decontaminate.decontaminate(docs, items)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {1000 + i for i in range(len(texts))} | {5000, 5001, 5002}


def test_items_in_several_shards(spark, sf_dir, monkeypatch):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = set(decontaminate.contaminations(docs, items).select("doc_id", "item_id").collect())
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 700)
    assert whole and set(decontaminate.contaminations(docs, items).select("doc_id", "item_id").collect()) == whole


def test_nothing_to_decontaminate(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, None), (None, "a b c"), (2, "?")], "item_id long, text string")
    assert decontaminate.contaminations(docs, items).collect() == []
    assert decontaminate.decontaminate(docs, items).count() == 1
    assert decontaminate.contaminations(docs.limit(0), items.limit(0)).collect() == []


# --- top-k -------------------------------------------------------------------------------------------------------


def test_top_products_with_ties_and_holes(spark, monkeypatch):
    monkeypatch.setattr(topk, "BUCKET", 16)
    monkeypatch.setattr(topk, "SPAN", 40)
    rng = np.random.default_rng(2)
    vectors = [(i, (rng.normal(size=6) * rng.choice([0.05, 0.3, 3])).tolist()) for i in range(220)]
    vectors += [(300 + i, [0.5] * 6) for i in range(90)] + [(400, [0.0] * 6), (401, None), (402, [None] * 6), (403, [float("nan")] * 6), (420, [float("inf")] * 6)]
    vectors += [(440 + i, [1.0, 2.0]) for i in range(3)] + [(None, [1.0] * 6), (500, []), (20, vectors[20][1])]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("score", F.lit(1)).withColumn("dim", F.lit("d"))
    got = {}
    for r in topk.top_products(frame, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    whole = {i: np.floor(64 * np.array(v, np.float32).astype(float)).astype(int) for i, v in vectors if i is not None and v is not None and not any(
        x is None or not np.isfinite(x) for x in v)}
    for q in (i for i in whole if i % 20 == 0):
        scores = sorted((-int(whole[q] @ w), i) for i, w in whole.items() if i != q and len(w) == len(whole[q]))[:20]
        assert got.pop(q, {}) == {k + 1: (i, -s) for k, (s, i) in enumerate(scores)}
    assert not got
    assert topk.top_products(frame.limit(0), F.col("vec_id") % 20 == 0).collect() == []


# --- pages -------------------------------------------------------------------------------------------------------


def test_alignment_is_longest():
    def longest(a, b):
        rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
        return rows[-1][-1]

    rng = random.Random(4)
    for k in range(2000):
        pages.CELLS = 4 if k % 2 else 1 << 28
        a, b = ([rng.randint(0, 6) for _ in range(rng.randint(0, 12))] for _ in range(2))
        rest = iter(b)
        found = pages.common(a, b)
        assert found == sorted(set(found)) and len(found) == longest(a, b) and all(a[i] in rest for i in found)


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script></head><body class="no-sidebar">
<header>Site</header><nav><ul><li><a href=x>Home</a></ul></nav><div class="cookie-notice">We use<div>cookies</div></div>
<main><article class="post"><header><h1>A &amp; B</h1><p>by me</p></header><p>One <b>bo</b>ld  line.<p class="ad">Buy<p>Two<br>three&#33;
<aside>Beside</aside><form>Name<input></form><section id="comments"><p>First!</section><a href=y>Read more</a></article></main>
<div style="display: none">unseen</div><footer>&copy; us</footer></body></html>"""


def test_lines_of_a_page():
    assert [t for t, inside, _ in pages.lines(PAGE) if inside] == ["A & B", "One bold line.", "Two", "three!", "Read more"]
    assert pages.lines("") == [] and pages.lines("<p>cut <b>off<")[0][0] == "cut off<"
    assert [t for t, _, _ in pages.lines("<p>a<p" + "<b>" * 30_000 + "z" + "</i>" * 30_000)] == ["a", "z"]


@pytest.mark.parametrize("tag", [
    'p title="the hidden cost"', 'p data-x="/lakes/hidden-lake.html"', "p data-role=search", 'div class="overflow-hidden"',
    'div class="content ad-free"', 'section id="related-work"', 'h2 id="comments"', 'div id="related"', "p title='a class=\"ad\" b'",
])
def test_text_that_only_sounds_like_furniture_stays(tag):
    name = tag.split()[0]
    page = f"<body><p>Some text.</p><{tag}>This is much of the page's text.</{name}></body>"
    assert [t for t, _, _ in pages.lines(page)] == ["Some text.", "This is much of the page's text."]


@pytest.mark.parametrize("tag", [
    "p hidden", 'p role="search"', 'p class="x ad"', 'div class="site-footer"', 'div class="cookie-notice"', 'p id="comments"',
    'p CLASS=ad-slot', "p class='a' style='display:none'", 'p class="ad', 'div id="footer"',
])
def test_furniture_goes(tag):
    page = f"<body><p>Some text.</p><{tag}>Furniture that is longer than the text.</{tag.split()[0]}></body>"
    assert [t for t, _, _ in pages.lines(page)] == ["Some text."]


def test_shared_lines_go_and_copies_stay(spark):
    frame = "<body><p>Top menu</p><p>{0} is one long story about {0} that nobody else tells.</p><p>All rights reserved</p></body>"
    rows = [(i, f"http://h.example/a/{i}", frame.format(f"thing{i}")) for i in range(6)]
    rows += [(50, "http://other.example/x?a=1", frame.format("copy")), (51, "http://other.example/x?a=2", frame.format("copy"))]
    rows += [(60, None, None), (61, None, ""), (62, "http://h.example/a/1", PAGE), (None, None, "<p>lone</p>"), (70, "http://x.example/", PAGE), (70, "http://x.example/", PAGE)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS place", "3 AS gone")
    found = pages.main_text(table).collect()
    text = {r.page_id: r.text for r in found}
    assert len(found) == len(rows) and all(r.n_chars == len(r.text) for r in found)
    assert text[2] == "thing2 is one long story about thing2 that nobody else tells."
    assert text[50].startswith("Top menu copy is one") and text[60] == text[61] == "" and text[None] == "lone"
    assert text[70] == "A & B One bold line. Two three! Read more"
    assert pages.main_text(table.limit(0)).collect() == []


def test_text_outside_an_article_is_judged_by_the_neighbour(spark):
    page = "<body><p>Shop of the town</p><p>Lead of {0}.</p><a href=x>More {0}</a><article><p>Story of {0}, told at length.</p></article></body>"
    rows = [(i, f"http://h.example/a/{i}", page.format(f"thing{i}")) for i in range(4)] + [(9, "http://lone.example/", page.format("lone"))]
    text = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(text[i] == f"Lead of thing{i}. Story of thing{i}, told at length." for i in range(4))
    assert text[9] == "Shop of the town Lead of lone. Story of lone, told at length."


def test_copies_are_told_by_what_is_not_frequent(spark):
    frame = "<body><p>" + "Long menu of the site. " * 40 + "</p>{0}<p>All rights reserved</p></body>"
    story = lambda i: f"<p>Story {i}.</p>"
    long = lambda i: "".join(f"<p>Part {k} of tale {i}, which is long enough to weigh more than its stamp.</p>" for k in range(20))
    rows = [(i, f"http://short.example/a/{i}", frame.format(story(i))) for i in range(4)]
    rows += [(10 + i, f"http://copies.example/a/{i}", frame.format(story("same" if 1 <= i <= 4 else i))) for i in range(6)]
    rows += [(20 + i, f"http://stamps.example/a/{i}", frame.format(long(min(i, 4)) + f"<p>Printed {i}</p>")) for i in range(6)]
    notice = "<article><p>Tale {0} in full.</p><p>{1}</p><p>Support our paper.</p></article>"
    rows += [(30 + i, f"http://notice.example/a/{i}", notice.format(i, "A passage twice." if i < 2 else f"Passage {i}.")) for i in range(5)]
    text = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [text[i] for i in range(4)] == [f"Story {i}." for i in range(4)]
    assert [text[10 + i] for i in range(6)] == ["Story 0.", *["Story same."] * 4, "Story 5."]
    assert all("menu" not in text[20 + i] and f"Part 19 of tale {min(i, 4)}," in text[20 + i] and f"Printed {i}" in text[20 + i] for i in range(6))
    assert text[30] == "Tale 0 in full. A passage twice." and text[34] == "Tale 4 in full. Passage 4."


# --- archives ----------------------------------------------------------------------------------------------------


def test_revisits_and_odd_pages(spark):
    long = "é" * 600
    rows = [(1, "u", long), (5, "u v", long), (3, None, long), (None, "n", long), (7, "s", "short"), (8, "s", "short"), (9, "x", None), (5, "u v", long)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS kind", "2 AS size", "3 AS digest", "4 AS path")
    found = archive.round_trip(table).collect()
    kinds = sorted(((r.page_id or -1, r.record_type, r.refers_to) for r in found), key=str)
    kinds.sort(key=lambda k: k[0])
    assert kinds == [(-1, "revisit", 5), (1, "revisit", 5), (3, "revisit", 5), (5, "response", None), (5, "response", None)] + [
        (i, "response", None) for i in (7, 8, 9)
    ]
    assert {r.payload_bytes for r in found if r.page_id in (1, 5)} == {1200} and [r.payload_bytes for r in found if r.page_id == 9] == [0]
    assert archive.round_trip(table.limit(0)).collect() == []


def test_directories_with_and_without_zip64(spark):
    folder = new_path(spark, "zips")
    records = [archive._record("response", i, None, "u", "d", 3, b"abc") for i in range(5)]
    import gzip

    data = b"".join(gzip.compress(r) for r in records)
    for wide in (False, True):
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w") as package:
            with package.open(archive.WARC, "w", force_zip64=wide) as member:
                member.write(data)
            package.comment = b"PK\x05\x06 in a comment"
        raw = held.getvalue()
        if wide:
            # The same package as a writer beyond the limits makes it: full 32-bit fields and the ZIP64 records.
            end = raw.rfind(b"PK\x05\x06", 0, raw.rfind(b"PK\x05\x06"))
            count, size, start = (int.from_bytes(raw[end + a : end + b], "little") for a, b in ((10, 12), (12, 16), (16, 20)))
            entry = bytearray(raw[start : start + size])
            place, packed = int.from_bytes(entry[42:46], "little"), int.from_bytes(entry[20:24], "little")
            extra = b"\x01\x00\x18\x00" + b"".join(v.to_bytes(8, "little") for v in (packed, packed, place))
            entry[20:28], entry[42:46], entry[30:32] = b"\xff" * 8, b"\xff" * 4, len(extra).to_bytes(2, "little")
            name = 46 + int.from_bytes(entry[28:30], "little")
            directory = bytes(entry[:name]) + extra
            record = b"PK\x06\x06" + (44).to_bytes(8, "little") + bytes(12) + b"".join(v.to_bytes(8, "little") for v in (count, count, len(directory), start))
            locator = b"PK\x06\x07" + bytes(4) + (start + len(directory)).to_bytes(8, "little") + (1).to_bytes(4, "little")
            raw = raw[:start] + directory + record + locator + b"PK\x05\x06" + bytes(4) + b"\xff" * 12 + bytes(2)
        from netvigil.llm.files import make_folder

        make_folder(folder)
        path = f"{folder}/{wide}.wacz"
        publish(path, lambda out, raw=raw: out.write(raw))
        with Ranges(path) as file:
            ranges = list(archive.record_ranges(file))
            assert [archive.parse_record(file.read(*r))[0]["warc-record-id"] for r in ranges] == [f"<urn:page:{i}>" for i in range(5)]
    publish(f"{folder}/bad", lambda out: out.write(b"no package at all"))
    with Ranges(f"{folder}/bad") as file, pytest.raises(ValueError):
        archive.members(file)


# --- pipeline ----------------------------------------------------------------------------------------------------


def test_pipeline_is_its_stages_by_brute_force(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    items = [" ".join(re.findall(r"\w+", r.text.lower())) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows = {r.doc_id: r for r in docs if r.text and any(c.isalpha() for c in r.text)}
    hosts, counts = {}, {}
    for r in rows.values():
        hosts[r.source] = hosts.get(r.source, 0) + 1
        for line in {x.strip(" ") for x in r.text.split("\n")} - {""}:
            counts[r.source, line] = counts.get((r.source, line), 0) + 1
    gone = {k for k, n in counts.items() if n >= 5 and n > 0.1 * hosts[k[0]]}
    texts = {i: "\n".join(x for x in r.text.split("\n") if (r.source, x.strip(" ")) not in gone) for i, r in rows.items()}
    sets = {i: shingle_set(t) for i, t in texts.items()}
    by_gram, parent = {}, {i: i for i in texts}
    for i, s in sets.items():
        for g in s:
            by_gram.setdefault(g, []).append(i)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in {(i, j) for same in by_gram.values() for i in same for j in same if i < j}:
        if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            x, y = root(i), root(j)
            parent[max(x, y)] = min(x, y)
    plain = {i: " ".join(re.findall(r"\w+", texts[i].lower())) for i in texts if root(i) == i}
    left = {i for i, t in plain.items() if not any(f" {x} " in f" {t} " for x in items)}
    found = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in found} == left and all(r.exact for r in found)


@pytest.mark.parametrize("name", ["language_id", "line_dedup", "near_duplicates", "decontamination", "unigram_encoding"])
def test_stages_take_odd_rows(spark, sf_dir, name):
    """Nulls in every column, empty and long texts, repeated rows, clashing columns, empty tables."""
    import corpus_pipeline

    rows = [
        (1, None, "en", "a", None), (2, "", None, None, 0), (None, "Is this text null?", None, "a", 18),
        (3, "word " * 60_000 + "x" * 300_000, "en", "a", 2), (4, "the same text", "en", "b", 3),
        (4, "the same text", "en", "b", 3), (None, None, None, None, None), (5, "\n\n \n", "de", "", 4),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr(
        "*", "1 AS wanted", "2 AS kept", "3 AS score", "4 AS key", "5 AS ids", "6 AS plain_text", "7 AS n_tokens")
    stage = dict(corpus_pipeline.STAGES)[name]
    made = stage(spark, docs, sf_dir)
    found = [(r["doc_id"], r["text"] if "text" in made.columns else None) for r in made.collect()]
    assert stage(spark, docs.limit(0), sf_dir).count() == 0
    if name != "unigram_encoding":
        assert made.columns == docs.columns and made.schema == docs.schema
    if name == "language_id":
        assert sorted(str(i) for i, _ in found) == ["3", "4", "4", "None"]
        assert made.where("lang is null").count() == 0
    else:
        # Repeated rows are copies: one of them stays.
        assert len(found) == (7 if name == "near_duplicates" else 8)


def test_a_block_needs_what_its_queries_need():
    lengths, least = np.array([10.0, 4.0, 0.0]), np.array([50, 12, 1])
    assert topk.needed(lengths, least) == pytest.approx(3.0, abs=1e-6) and topk.needed(lengths, least) < 3
    assert topk.needed(lengths, np.array([50, -(1 << 62), 1])) < 0 and topk.needed(lengths, np.array([50, 12, 0])) == -np.inf
    assert topk.needed(np.array([0.0]), np.array([1])) == np.inf


def test_far_buckets_get_no_block(spark, monkeypatch):
    """Long vectors first: once a block's thresholds are known, buckets of short vectors aren't sent to it."""
    monkeypatch.setattr(topk, "BUCKET", 16)
    monkeypatch.setattr(topk, "SPAN", 64)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=6) * 0.9 ** (i // 16)]) for i in range(640)]
    seen, real = spark.sparkContext.accumulator(0), topk._round

    def counted(k):
        inner = real(k)

        def rows_of(batches):
            def each():
                for batch in batches:
                    seen.add(len(batch))
                    yield batch

            return inner(each())

        return rows_of

    monkeypatch.setattr(topk, "_round", counted)
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.top_products(vectors, F.col("vec_id") % 20 == 0, 5).collect()
    whole = {i: [int(np.floor(64 * x)) for x in v] for i, v in rows}
    for q in range(0, 640, 20):
        scores = sorted(((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q))[:5]
        assert [(r["vec_id"], r["score"]) for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q] == [(i, -s) for s, i in scores]
    # 40 buckets and 10 blocks: all pairs are 400.
    assert 40 <= seen.value < 200
