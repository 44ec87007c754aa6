"""Importance resampling against a plain rebuild, on odd rows and over cut texts."""

import hashlib
import math
import re
import zlib

import pytest

from netvigil.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_words string, rank int"


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def runs_of(text):
    words = words_of(text)
    return [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def bucket(run):
    return zlib.crc32(run.encode()) % 10000


def plain(docs, target, percent=5, least_words=20):
    s, t = [0] * 10000, [0] * 10000
    for _, text in docs:
        for run in runs_of(text):
            s[bucket(run)] += 1
    for text in target:
        for run in runs_of(text):
            t[bucket(run)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + 10000) / ((a + 1) * (sum(t) + 10000)))) for a, b in zip(s, t)]
    rows = []
    for doc_id, text in docs:
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(run)] for run in runs_of(text))
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(runs_of(text)), weight, score, None])
    able = [r for r, (_, text) in zip(rows, docs) if len(words_of(text)) >= least_words]
    able.sort(key=lambda r: (-r[3], math.inf if r[0] is None else r[0]))
    for rank, row in enumerate(able[:percent * len(able) // 100], 1):
        row[4] = rank
    return sorted(map(tuple, rows), key=repr)


def run(spark, docs, target, **options):
    given = spark.createDataFrame([(d, t, "en", "s", "clash", 7) for d, t in docs], SCHEMA)
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    out = resampling.resampled(given.repartition(3), bench, **options)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted(map(tuple, out.collect()), key=repr)


def texts(n):
    pool = "the Cat sat 42 mats über café of Night-time x.y.z 漢字 and dogs run".split()
    return [" ".join(pool[(i * 7 + j * j) % len(pool)] + str(i * j % 5) for j in range(i % 60)) for i in range(n)]


def test_same_as_plain(spark):
    docs = list(enumerate(texts(130)))
    target = ["the cat sat on mats", "dogs run at night", None]
    assert run(spark, docs, target, percent=20) == plain(docs, target, percent=20)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "... \n\t !"), (None, " ".join(["null id"] * 15)), (-5, " ".join(["word"] * 25))]
    docs += [(7, " ".join(texts(130)[59:62]))] * 3 + [(8, "same text for ties " * 9), (9, "same text for ties " * 9)]
    assert run(spark, docs, ["word"], percent=60) == plain(docs, ["word"], percent=60)
    assert run(spark, docs, [], percent=100, least_words=0) == plain(docs, [], percent=100, least_words=0)


def test_empty_tables(spark):
    assert run(spark, [], ["a b"]) == []
    assert run(spark, [(1, "one two")], []) == plain([(1, "one two")], [])


def test_ties_at_the_cutoff(spark, monkeypatch):
    monkeypatch.setattr(resampling, "luck", lambda doc_id, seed: resampling.F.lit(0).cast("long"))
    docs = [(i, "one text that all of the documents have " * 3) for i in (9, 4, 7, -2, 11, 5, 4)]
    ranks = {}
    for doc_id, *_, rank in run(spark, docs, ["text"], percent=50):
        ranks.setdefault(doc_id, []).append(rank)
    assert ranks[-2] == [1] and sorted(ranks[4]) == [2, 3] and ranks[5] == ranks[9] == ranks[11] == ranks[7] == [None]


@pytest.mark.parametrize("part", [30, 200])
def test_cut_texts_have_the_same_features(monkeypatch, part):
    monkeypatch.setattr(resampling, "PART", part)
    given = texts(80) + ["x" * 100 + " " + "y" * 1000 + " z " + "Q" * 33 + " " + "w" * 32 + " " + "v" * 34, "", None]
    got, counts = [[] for _ in given], [0] * len(given)
    for rows, buckets, new in resampling.features([t.encode() if t is not None else None for t in given]):
        counts = [a + b for a, b in zip(counts, new)]
        for row, b in zip(rows, buckets):
            got[row].append(int(b))
    assert [sorted(g) for g in got] == [sorted(map(bucket, runs_of(t))) for t in given]
    assert counts == [len(words_of(t)) for t in given]
