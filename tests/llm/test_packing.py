"""Packing: every id once, full sequences, the target mixture in each, on odd rows and with weights that run dry."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from netvigil.llm import packing

PATH = public_tokenizers.path(packing.VOCABULARY)
SCHEMA = "doc_id long, text string, source string, queue string, part int, place long, ids string"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")


def run(spark, docs, parts=3, **options):
    given = spark.createDataFrame([(d, t, s, "clash", 1, 2, "clash") for d, t, s in docs], SCHEMA)
    return [r.asDict() for r in packing.packed(given.repartition(parts), PATH, **options).collect()]


def check(tokenizer, docs, pieces, length=4096):
    """Every id lies in one piece, sequences are gapless and full, or as short as powers of two."""
    expected, got = defaultdict(list), defaultdict(list)
    for doc_id, text, source in docs:
        expected[doc_id, source or ""].append(ids_of(tokenizer, text))
    for p in pieces:
        got[p["doc_id"], p["queue"]].append(p)
    assert got.keys() == expected.keys()
    for key, texts in expected.items():
        covered = defaultdict(int)
        for p in got[key]:
            same = [i for i in texts if len(i) == p["doc_tokens"]
                    and zlib.crc32(i[p["start"]:p["start"] + p["length"]].tobytes()) == p["ids_crc32"]]
            assert same
            for at in range(p["start"], p["start"] + p["length"]):
                covered[p["doc_tokens"], at] += 1
        for n in {len(i) for i in texts}:
            count = sum(len(i) == n for i in texts)
            assert [covered[n, at] for at in range(n)] == [count] * n
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    total = sum(len(i) for texts in expected.values() for i in texts)
    sizes = []
    for sequence in range(len(sequences)):
        place = 0
        for offset, n in sorted(sequences[sequence]):
            assert offset == place
            place += n
        sizes.append(place)
    full = total // length
    assert sizes == [length] * full + [1 << b for b in range(13, -1, -1) if (total - full * length) >> b & 1]


def sample(n, sources=("a", "a", "a", "b", "c", None)):
    pool = "It's the Ünïcode word, 42 don't-stop naïve 漢字 ... end! of_line\n".split(" ")
    return [(i, " ".join(pool[(i + j * j) % len(pool)] for j in range(i * 37 % 300)), sources[i * i % len(sources)]) for i in range(n)]


def test_every_id_once(spark, tokenizer):
    docs = sample(150)
    check(tokenizer, docs, run(spark, docs))


def test_odd_rows(spark, tokenizer):
    docs = [(1, None, "a"), (2, "", None), (None, "no id", "a"), (-4, "long text " * 9000, "b"), (5, " \n\t", "a")]
    docs += [(7, "three times the same", "a")] * 3 + [(8, "<|endoftext|> as text", "a"), (9, "<|EndOfText|> x", "b")]
    check(tokenizer, docs, run(spark, docs))
    assert run(spark, []) == []


def test_short_sequences(spark, tokenizer):
    docs = sample(40)
    check(tokenizer, docs, run(spark, docs, length=256), length=256)


def mixture(pieces, queue, sequences):
    out = [0] * sequences
    for p in pieces:
        if p["queue"] == queue and p["sequence_id"] < sequences:
            out[p["sequence_id"]] += p["length"]
    return out


def test_sequences_hold_the_shares_of_the_sources(spark):
    docs = [(i, "word " * (40 + i % 50), "hot" if i % 3 else f"s{i % 2}") for i in range(3000)]
    pieces = run(spark, docs, parts=5)
    whole = sum(p["length"] for p in pieces)
    full = whole // packing.LENGTH
    for queue in ("hot", "s0", "s1"):
        share = sum(p["length"] for p in pieces if p["queue"] == queue) / whole
        held = mixture(pieces, queue, full)
        # Deficits are carried: after any number of sequences the sum is off by a packet of each source at most.
        sums = np.cumsum(held) - share * packing.LENGTH * np.arange(1, full + 1)
        assert np.abs(sums).max() <= 3 * packing.PACKET
        assert np.abs(np.array(held) / packing.LENGTH - share).max() < 0.15


def test_weights(spark, tokenizer):
    docs = [(i, "word " * 99, ("a", "b", "other", "more")[i % 4]) for i in range(1200)]
    pieces = run(spark, docs, weights={"a": 2.0, "b": 1.0})
    renamed = [(d, t, s if s in "ab" else "") for d, t, s in docs]
    check(tokenizer, renamed, pieces)
    first = 8  # a has 30,000 ids and gets half of each sequence until it is empty
    assert all(abs(x / packing.LENGTH - 0.5) < 0.15 for x in mixture(pieces, "a", first))
    assert all(abs(x / packing.LENGTH - 0.25) < 0.15 for x in mixture(pieces, "b", first))
    last = max(p["sequence_id"] for p in pieces if p["queue"] == "a")
    assert last * packing.LENGTH < 2.2 * 30_000
    with pytest.raises(ValueError):
        run(spark, docs, weights={"a": 0.0})


def test_stretches_send_all():
    for sizes in ({"a": 10, "b": 100_000, "c": 0}, {"a": 7}, {"a": 5000, "b": 5000}, {}):
        weights = {"a": 3.0, "b": 1.0, "c": 5.0}
        plan = packing.stretches(sizes, weights, 4096)
        for queue, n in sizes.items():
            mine = sorted(x[3:] for x in plan if x[0] == queue)
            assert [a for a, _ in mine] == [0, *[b for _, b in mine[:-1]]][:len(mine)]
            assert (mine[-1][1] if mine else 0) == n


def test_rounds_are_those_of_a_plain_deficit_round_robin():
    """The closed form against counters that are raised and spent round by round."""
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, packing.PACKET + 1, 400)
    quantum, credit, counter, rounds, at = 700.25, 33, 33.0, [], 0
    for number in range(10_000):
        counter += quantum
        while at < len(sizes) and sizes[at] <= counter:
            counter -= sizes[at]
            rounds.append(number)
            at += 1
    ends = np.cumsum(sizes)
    batch = pa.RecordBatch.from_arrays([
        pa.array(range(400)), pa.array(["q"] * 400), pa.array(sizes), pa.array(ends - sizes),
        pa.array([[{"first": 0, "quantum": quantum, "sent": 0.0, "until": float(ends[-1])}]] * 400),
        pa.array([credit] * 400),
    ], ["doc_id", "queue", "n", "place", "plan", "credit"])
    placed = pa.Table.from_batches(list(packing._placed(False, 1, 10_000)(iter([batch]))))
    assert placed["round"].to_pylist() == rounds


ODD = [
    "it's I'll don't 'S", "éa É.", "ΑΣ ΣΑΣ.", "a b c\x85d\x1cx", "x<|end", "  ", "", "İstanbul ǅ ß",
    "日本語。テスト", "a.b,c!!d--e_f", "12.5% 3rd", "🙂🙂a'sb 's", "́a b́. ́", "a\x00b", "A`b^c~d", "KK åÅ.",
    "<|ENDOFTEXT|> B", "a\x01b \x01 c", "\x02 \x00", "\x0ba\x0c", "<|startoftext|>",
]


@pytest.mark.parametrize("together", [1, 40, 1 << 23])
def test_chunks_give_the_ids_of_whole_texts(monkeypatch, tokenizer, together):
    monkeypatch.setattr(packing, "TOGETHER", together)
    monkeypatch.setattr(packing, "KNOWN", 8)
    texts = ODD + [t for _, t, _ in sample(20)]
    got = packing.Encoder(PATH).encode(pa.array(texts))
    assert [x.tolist() for x in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
