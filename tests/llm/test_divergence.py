"""Source divergence against a plain rebuild in whole numbers, on odd rows, small bounds and merged stripes."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from netvigil.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, term string, value string, kept int, sizes int"


def terms_of(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain(docs, least_docs=10, top=10):
    df, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        df[lang].update(set(terms_of(text)))
        counts[lang, source].update(terms_of(text))
    rows = []
    for lang, sources in groups.items():
        kept = sorted((t for t, n in df[lang].items() if n >= least_docs), key=str.encode)
        whole = Counter()
        for source in sources:
            whole.update({t: counts[lang, source][t] for t in kept})

        def shares(of):
            total = sum(of[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (of[t] + 2) // total for t in kept}

        p, q = {s: shares(counts[lang, s]) for s in sources}, shares(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in ("pair", pairs), ("term", terms):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                for rank, (value, item) in enumerate(found, 1):
                    if part == "pair" or rank <= top:
                        rows.append((lang, s, part, item, value, rank))
    return sorted(rows)


def run(spark, docs, **options):
    given = [(i, t, lang, source, "clash", "clash", 1, 2) for i, (t, lang, source) in enumerate(docs)]
    out = divergence.divergences(spark.createDataFrame(given, SCHEMA).repartition(4), **options)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, out.collect()))


def corpus(n):
    pool = "The the Ödön naïve 漢字 word_word a1b2c3 dog's x'y zebra UPPER".split()
    langs, sources = ["en", "de", None, ""], ["s1", "s2", "", None, "ß", "zz"]
    return [
        (" ".join(pool[(i * i + j * (i % 5 + 1)) % len(pool)] for j in range(i % 13)), langs[i % 4 // (1 + i % 2)], sources[i * 7 % 6])
        for i in range(n)
    ]


def test_same_as_plain(spark):
    docs = corpus(150) + [(None, "en", "null-text"), ("", "fr", "only"), ("few words", "fr", "only"), ("few", "it", "a"), ("few", "it", "b")]
    assert run(spark, docs) == plain(docs)
    assert run(spark, docs * 2, least_docs=1, top=2) == plain(docs * 2, least_docs=1, top=2)


def test_empty_table(spark):
    assert run(spark, []) == []


def _stripes(tables):
    rows = defaultdict(lambda: [0, Counter()])
    for table in tables:
        for row in table.to_pylist():
            stripe = rows[row["lang"], row["term"]]
            stripe[0] += row["df"]
            stripe[1].update(dict(zip(row["sources"], row["counts"])))
    return dict(rows)


def _batch(docs):
    return pa.RecordBatch.from_arrays(
        [pa.array([d[i] or "" for d in docs], pa.string()) for i in (1, 2, 0)], ["lang", "source", "text"]
    )


@pytest.mark.parametrize("cells", [1, 10, 1 << 19])
def test_stripes_handed_over_early_and_cut_texts_merge_to_the_same(monkeypatch, cells):
    docs = corpus(60)
    expected = _stripes(divergence._fold(iter([_batch(docs)])))
    monkeypatch.setattr(divergence, "CELLS", cells)
    monkeypatch.setattr(divergence, "PIECE", 7)
    parts = pa.Table.from_batches(list(divergence._fold(iter([_batch(docs[:30]), _batch(docs[30:])]))))
    assert _stripes([parts]) == expected
    parts = parts.sort_by([("lang", "ascending"), ("term", "ascending")])
    folded = divergence._folded(parts)
    assert folded.num_rows == len(expected) and _stripes([folded]) == expected
    monkeypatch.setattr(divergence, "BLOCK", 3)
    terms = defaultdict(Counter)
    for block in divergence._merger(1)(iter(parts.to_batches(max_chunksize=4))):
        for row in block.to_pylist():
            for k, term in enumerate(row["terms"]):
                for cell in range(row["starts"][k], row["starts"][k + 1]):
                    terms[row["lang"], term][row["names"][row["cell_names"][cell]]] += row["cell_counts"][cell]
    assert terms == {key: stripe[1] for key, stripe in expected.items() if key[1]}


def test_shares_are_exact_for_large_counts():
    counts = np.array([0, 1, 10**6, 3 * 10**13, 7 * 10**17], dtype=np.int64)
    for whole in (10**3, 2 * 10**13 + 7, 10**14 + 3, 9 * 10**17 + 11):
        able = counts[counts + 2 <= whole]
        assert divergence.shares(able, whole).tolist() == [1 + 10**9 * (int(c) + 2) // whole for c in able]


def test_small_matrices_give_the_same(monkeypatch):
    row = {
        "lang": "en", "terms": ["a", "b", "c"], "starts": [0, 2, 3, 5], "names": ["y", "x", "z"], "cell_names": [0, 1, 2, 0, 2],
        "cell_counts": [5, 1, 7, 2, 2], "kept": 9, "sources": ["w", "x", "y", "z"], "sizes": [0, 30, 20, 9],
    }
    results = []
    for size in (1, 1 << 20):
        monkeypatch.setattr(divergence, "MATRIX", size)
        pairs = divergence._Pairs()
        terms = list(divergence._measured(row, 10, pairs))
        sums = Counter()
        for _, _, a, b, v in pairs.handed_over():
            sums[a, b] += v
        results.append((terms, sums))
    assert results[0] == results[1]
