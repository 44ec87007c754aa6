"""Personal data, language, tokens, line dedup and training order against brute force and on odd input."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import ROOT

from netvigil.llm import decontaminate, language, lines, materialise, pii, unigram
from netvigil.session import new_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns that clash with those of operators."""
    long = "word " * 60_000 + "x" * 300_000
    rows = [
        (1, None, "en", "a", None), (2, "", None, None, 0), (None, "Is this text null?", "en", "a", 1), (3, long, "en", "a", 2),
        (4, "same text", "en", "b", 3), (4, "same text", "en", "b", 3), (None, None, None, None, None), (5, "\n\n \n", "de", "", 4),
    ]
    return spark.createDataFrame(rows, DOCS).selectExpr(
        "*", "1 AS lines", "2 AS kept", "'z' AS spans", "3 AS score", "4 AS key", "5 AS ids", "6 AS Lines_of_page", "7 AS slot"
    )


# --- personal data -----------------------------------------------------------------------------------------------

PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def brute_spans(text):
    out = []
    for kind, (name, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True, "ip": name != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[name]
            if ok:
                out.append((m.start(), kind, f"{name}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(3)
    parts = ["a@b.c", "@", ".", "x.y@z-1.com.", "+1 (243) 555-0192", "4111 1111 1111 1111", "255.1.2.3", "256.1.1.1", " ", "é", "1", "+", "-", "0", "a"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        spans, _ = pii.base_spans(text)
        assert [f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans] == brute_spans(text), text


def test_contexts_find_what_the_checks_refuse(spark):
    good = ["4111111111111111", "4012888888881881", "5555555555554444", "378282246310005", "6011111111111117"]
    rows = [(i, f"please bill card {n} now") for i, n in enumerate(good)] + [(9, "please bill card 4111111111111112 now"), (10, "in 12345 days")]
    found = {r.doc_id: r for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[9].spans == "context:17:33" and found[9].n_context == 1
    assert found[9].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert found[0].spans == "card:17:33" and found[0].n_card == 1 and found[10].spans == ""


def test_contexts_find_other_forms_than_the_seeds(spark):
    texts = [f"tel: +1 ({200 + i}) 555-0{i}92 w{i}" for i in range(5)] + [f"please mail j{i}@mail{i}.example.com today" for i in range(5)]
    more = ["tel: 974 555 3436 ok", "call tel: (974) 555 3436", "tel:9745553", "please mail jane_doe[at]example today", "please mail jd@intern today"]
    plain = ["in 12 days", "chapter: 5 ends", "a well-known word", "please read j_5 today"]
    rows = list(enumerate(texts + more + plain))
    found = {r.doc_id: r.spans for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [found[10 + i] for i in range(5)] == ["context:5:17", "context:10:24", "context:4:11", "context:12:31", "context:12:21"]
    assert all(found[15 + i] == "" for i in range(4)) and all(found[i].count(":") == 2 and "context" not in found[i] for i in range(10))


def test_personal_data_of_odd_rows(spark):
    rows = pii.personal_data(odd_docs(spark)).collect()
    assert len(rows) == 8 and {r.spans for r in rows} == {""}
    assert pii.personal_data(odd_docs(spark).limit(0)).collect() == []


# --- language ----------------------------------------------------------------------------------------------------


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(found) > 150 and sum(r.lang_pred == r.lang for r in found) / len(found) > 0.95
    assert all(0 <= r.score <= 1 for r in found)


def test_prediction_sees_the_text_only(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(300)
    model = language.fit(docs)
    texts = [r.text for r in docs.limit(40).collect()]
    one = [model.predict(*next(language.features([t], model.width)))[0][0] for t in texts]
    many = [n for rows, letter in language.features(texts, model.width) for n in model.predict(rows, letter)[0]]
    assert one == many


def test_language_of_odd_rows(spark):
    found = language.identify(odd_docs(spark)).collect()
    assert len(found) == 8
    assert {r.lang_pred for r in found if r.doc_id in (1, 2, 5)} == {"und"}
    kept = language.keep_identified(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 3, 4, 4]
    assert language.identify(odd_docs(spark).limit(0)).collect() == []


def test_slices_of_a_long_text_count_every_triple(monkeypatch):
    text = "the quick brown fox " * 50
    whole = next(language.features([text], 512))[0]
    monkeypatch.setattr(language, "PIECE", 333)
    assert np.allclose(whole, next(language.features([text], 512))[0], atol=0.02)


# --- tokens ------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def pieces():
    return unigram.load_pieces()


def brute_path(pieces, words, text):
    """All ways to split, by plain dynamic programming over a dict of pieces."""
    best = [(0.0, [])] + [(-float("inf"), [])] * len(text)
    for i in range(len(text)):
        single = False
        for j in range(i + 1, min(len(text), i + pieces.depth) + 1):
            part = text[i:j].replace(unigram.MARK, "\0").replace(" ", unigram.MARK)
            if part in words:
                single |= j == i + 1
                if best[i][0] + pieces.score[words[part]] > best[j][0]:
                    best[j] = best[i][0] + pieces.score[words[part]], best[i][1] + [words[part]]
        if not single and best[i][0] + pieces.unknown > best[i + 1][0]:
            best[i + 1] = best[i][0] + pieces.unknown, best[i][1] + [pieces.bytes_first[b] for b in text[i].encode()]
    return best[-1][1]


def test_paths_are_the_best_ones(spark, sf_dir, pieces):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=unigram.VOCABULARY)
    words = {model.id_to_piece(i): i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
    texts = [r.text[:400] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()]
    texts += ["", " ", "a  b\n\nc\té", "日本語 ☃ ﬁ 😀", f"x{unigram.MARK}y {unigram.MARK}", "q" * 200, "   the"]
    for text, ids in zip(texts, unigram.encode(pieces, texts)):
        assert ids.tolist() == (brute_path(pieces, words, " " + text) if text else [])
        assert unigram.decode(pieces, ids) == text
    assert unigram.decode(pieces, np.array([pieces.bytes_first[0xFF]])) == "�"


def test_vocabulary_that_crosses_words_is_taken_whole():
    vocabulary = [(f"<0x{b:02X}>", 0.0, "byte") for b in range(256)]
    vocabulary += [("a▁b", -1.0, "normal"), ("▁", -1.0, "normal"), ("a", -1.0, "normal"), ("b", -1.0, "normal"), ("<s>", 0.0, "other")]
    small = unigram.pieces_of(vocabulary)
    assert not small.by_word
    assert unigram.encode(small, ["a b"])[0].tolist() == [257, 256] and unigram.decode(small, np.array([257, 256])) == "a b"


def test_tokens_of_odd_rows(spark):
    rows = unigram.encode_documents(odd_docs(spark)).collect()
    assert len(rows) == 8 and all(r.exact and r.n_tokens == len(r.ids) for r in rows)
    assert unigram.encode_documents(odd_docs(spark).limit(0)).collect() == []


# --- line dedup --------------------------------------------------------------------------------------------------


def test_lines_of_odd_rows(spark):
    made = lines.drop_boilerplate(odd_docs(spark), least_pages=5)
    assert made.columns == odd_docs(spark).columns
    assert sorted(map(str, made.select("doc_id", "text", "lang", "slot").collect())) == sorted(
        map(str, odd_docs(spark).select("doc_id", "text", "lang", "slot").collect())
    )
    assert lines.line_counts(odd_docs(spark).limit(0)).collect() == []


def test_ratio_is_relative_to_the_host(spark):
    rows = [(i, f"menu\nbody {i}\n menu \n\nend {i}", "hot") for i in range(20)] + [(100 + i, "menu" if i < 6 else f"own {i}", "large") for i in range(90)]
    rows += [(300 + i, "menu", None) for i in range(6)] + [(400 + i, "menu", "few") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in lines.line_counts(docs).collect()}
    assert got[3] == ("body 3\n\nend 3", 5, 2)
    assert got[100] == ("menu", 1, 0) and got[300] == ("", 1, 1) and got[400] == ("", 1, 1)


# --- training order ----------------------------------------------------------------------------------------------


def test_permutation_is_one():
    for total in (1, 2, 3, 5, 17, 1000, 65_537):
        slots = materialise.permute(np.arange(total), total, 11)
        assert sorted(slots.tolist()) == list(range(total))
        assert (materialise.permute(slots, total, 11, back=True) == np.arange(total)).all()
    assert (materialise.permute(np.arange(1000), 1000, 1) != materialise.permute(np.arange(1000), 1000, 2)).any()


def test_shards_hold_every_sequence_once(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(materialise, "SHARD", 300)
    source = new_path(spark, "documents")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(200).select("doc_id", "text").union(
        spark.createDataFrame([(None, "nobody's"), (1_000_000, None), (1_000_001, ""), (1_000_002, "x" * 511), (1_000_003, "x" * 512)], "doc_id long, text string")
    )
    docs.repartition(3).write.parquet(source)
    docs = spark.read.parquet(source)
    folder = new_path(spark, "shards")
    places = materialise.materialise(docs, folder, key=5).collect()
    records = list(materialise.read_slots(folder, 0, 1 << 40))
    assert sorted(p.slot for p in places) == list(range(len(records)))
    assert records[290:310] == list(materialise.read_slots(folder, 290, 20))
    assert all(p.byte_offset == p.slot % 300 * materialise.LENGTH and p.shard == p.slot // 300 for p in places)
    texts = {}
    for p in sorted(places, key=lambda p: p.part_no):
        texts[p.doc_id] = texts.get(p.doc_id, b"") + records[p.slot][: p.n_ids]
    assert texts == {r.doc_id: materialise.byte_ids(r.text) for r in docs.collect() if r.text}


def test_no_sequences_no_shards(spark):
    assert materialise.training_order(odd_docs(spark).limit(0)).collect() == []
    assert {r.doc_id for r in materialise.training_order(odd_docs(spark)).collect()} == {None, 3, 4, 5}
    assert odd_docs(spark).where(F.length("text") > 0).count() == 5


def test_lines_go_by_the_ratio_alone(spark):
    """Also on hosts of few pages; a host of one page keeps its lines."""
    rows = [(i, f"menu\nown {i}" if i < 4 else f"own {i}", "all" if i < 4 else "half") for i in range(8)]
    rows += [(8 + i, "menu\nhalf" if i < 4 else f"other {i}", "half") for i in range(4)] + [(20, "only\npage", "one")]
    made = lines.drop_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    found = {r["doc_id"]: r["text"] for r in made.collect()}
    assert [found[i] for i in range(4)] == [f"own {i}" for i in range(4)]
    assert [found[8 + i] for i in range(4)] == [""] * 4 and found[20] == "only\npage"


def test_tasks_need_no_package(spark, sf_dir, tmp_path):
    """The corpus operators run where Python workers can't import this package."""
    import subprocess
    import sys

    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
import os
os.environ.pop("PYTHONPATH", None)
from netvigil.session import local_session
spark = local_session(2, **{{"spark.executorEnv.PYTHONPATH": "", "spark.driver.memory": "2g"}})
from netvigil.llm.queries import QUERIES
for name in ("op3_language", "op4_unigram", "op5_decontaminate", "op11_resampling", "op12_divergence", "op13_packing"):
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() >= 0
    print("ran", name)
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=600)
    assert done.stdout.count("ran") == 6, done.stderr[-3000:]


def test_an_item_is_found_whatever_the_others_are(spark):
    """What is looked at for an item follows from its own length, not from the longest item of the table."""
    item = "where did the old river turn to the east of town. it turned at the mill of the miller"
    apart = item.replace("town. it", "town " + "filler words that say nothing " * 800 + " it")
    docs = spark.createDataFrame([(1, apart), (2, "lead in " + item + " and out")], "doc_id long, text string")
    long = " ".join(f"unrelated{i}" for i in range(4000))
    few, many = (
        spark.createDataFrame(rows, "item_id long, text string") for rows in ([(7, item)], [(7, item), (8, long)])
    )
    found = [sorted(r[:2] for r in decontaminate.contaminations(docs, items).collect()) for items in (few, many)]
    assert found[0] == found[1] == [(2, 7)]
