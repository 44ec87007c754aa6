"""Divergence of sources within a language: how far the words of one source lie from those of another and of the whole.

In-mapper stripes: every task folds whole documents into hash tables and hands over, for each (language, term) that it
met, one stripe: the documents that hold the term, and the occurrences in each source. A task hands over early when its
tables have grown to a bound and goes on with empty ones; the stripes of one key are merged after the shuffle, in sorted
order, whatever their number. So a frequent term costs one row a task, not one an occurrence, and a merge holds one
stripe at a time. Merged stripes stay together in blocks, and the divergences come out of the blocks directly: a block
adds what its terms contribute to every pair of sources, and names its highest terms of every source.

A smoothed count isn't zero where a term is absent, so every kept term contributes to every pair. Where both counts are
zero the contribution is the same for all terms; it is added once, times the number of kept terms, and the blocks only
correct it where a count isn't zero: work follows the cells that occur, not terms times pairs.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from netvigil.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Documents of a language that a kept term is in, scale and smoothing of shares, terms reported of a group.
LEAST_DOCS, SCALE, SMOOTH, TOP = 10, 1_000_000_000, 2, 10
#: Cells (a term in a source) that a task holds before it hands over; bytes of a text that are split together.
CELLS, PIECE = 1 << 19, 1 << 22
#: Terms of a block; numbers of a matrix that is worked on at once.
BLOCK, MATRIX = 4096, 1 << 20

_STRIPE = pa.schema([
    ("lang", pa.string()), ("term", pa.string()), ("df", pa.int64()),
    ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())),
])
STRIPE = "lang string, term string, df long, sources array<string>, counts array<long>"
BLOCKS = (
    "lang string, terms array<string>, starts array<int>, names array<string>, cell_names array<int>, "
    "cell_counts array<long>, totals array<long>"
)
MEASURED = "part string, lang string, source string, item string, value long"


def _only_terms() -> bytes:
    """A table for bytes.translate: A-Z in lower case, letters and bytes of longer code points as they are, else space."""
    return bytes(
        b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
    )


def _word_lists(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in pieces of bounded size that end between terms."""
    start = 0
    while start < len(text):
        end = text.find(b" ", start + PIECE)
        end = len(text) if end < 0 else end
        yield text[start:end].split()
        start = end


def _handed_over(docs: dict, counts: dict, held: dict) -> Iterator[pa.RecordBatch]:
    """Stripes of what a task has folded; an empty term has the documents of each source."""
    langs: dict[str, dict[bytes, tuple[list, list]]] = {}
    for (lang, source), n in docs.items():
        stripes = langs.setdefault(lang, {})
        whole = stripes.setdefault(b"", ([], []))
        whole[0].append(source)
        whole[1].append(n)
        for term, k in counts[lang, source].items():
            stripe = stripes.get(term)
            if stripe is None:
                stripes[term] = ([source], [k])
            else:
                stripe[0].append(source)
                stripe[1].append(k)
    for lang, stripes in langs.items():
        terms = list(stripes)
        for at in range(0, len(terms), 20_000):
            some = terms[at:at + 20_000]
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(some), pa.string()),
                pa.array(some, pa.binary()).cast(pa.string()),
                pa.array([held[lang][t] for t in some], pa.int64()),
                pa.array([stripes[t][0] for t in some], pa.list_(pa.string())),
                pa.array([stripes[t][1] for t in some], pa.list_(pa.int64())),
            ], schema=_STRIPE)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table, docs, counts, held, cells = _only_terms(), Counter(), {}, {}, 0
    for batch in batches:
        texts = batch.column(2).cast(pa.binary())
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
            docs[lang, source] += 1
            own = counts.setdefault((lang, source), Counter())
            before, seen = len(own), set()
            for words in _word_lists(text.as_py().translate(table)):
                own.update(words)
                seen.update(words)
            held.setdefault(lang, Counter()).update(seen)
            cells += len(own) - before
            if cells >= CELLS:
                yield from _handed_over(docs, counts, held)
                docs, counts, held, cells = Counter(), {}, {}, 0
    yield from _handed_over(docs, counts, held)


def _runs(batch: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(first rows, run of each row) of rows with equal lang and term that follow each other."""
    n = batch.num_rows
    differ = np.ones(n, dtype=bool)
    if n > 1:
        same = pc.and_(
            pc.equal(batch["lang"].slice(1), batch["lang"].slice(0, n - 1)),
            pc.equal(batch["term"].slice(1), batch["term"].slice(0, n - 1)),
        )
        differ[1:] = ~same.to_numpy(zero_copy_only=False)
    return np.flatnonzero(differ), np.cumsum(differ) - 1


def _folded(rows: pa.Table) -> pa.Table:
    """Rows sorted by key with the stripes of each key merged into one."""
    rows = rows.combine_chunks()
    first, run = _runs(rows)
    if len(first) == rows.num_rows:
        return rows
    sources, counts = rows["sources"].combine_chunks(), rows["counts"].combine_chunks()
    names = sources.flatten().dictionary_encode()
    cell = run[sources.value_parent_indices().to_numpy()]
    key = cell * max(1, len(names.dictionary)) + names.indices.to_numpy().astype(np.int64)
    order = np.argsort(key, kind="stable")
    key = key[order]
    begins = np.flatnonzero(np.diff(key, prepend=-1))
    sums = np.add.reduceat(counts.flatten().to_numpy()[order], begins) if len(begins) else np.empty(0, np.int64)
    key = key[begins]
    ends = np.searchsorted(key // max(1, len(names.dictionary)), np.arange(len(first) + 1), "left").astype(np.int32)
    kept_names = names.dictionary.take(pa.array(key % max(1, len(names.dictionary))))
    return pa.table([
        rows["lang"].take(pa.array(first)), rows["term"].take(pa.array(first)),
        pa.array(np.add.reduceat(rows["df"].to_numpy(), first)),
        pa.ListArray.from_arrays(pa.array(ends), kept_names), pa.ListArray.from_arrays(pa.array(ends), pa.array(sums)),
    ], schema=_STRIPE)


def _block(lang: str, terms: list[str], sources: list[list[str]], counts: list[list[int]]) -> dict:
    """One row of merged stripes; ``names`` has every source that occurs, ``totals`` its occurrences in the block."""
    names: dict[str, int] = {}
    cell_names = [names.setdefault(s, len(names)) for row in sources for s in row]
    cell_counts = [n for row in counts for n in row]
    totals = [0] * len(names)
    for i, n in zip(cell_names, cell_counts):
        totals[i] += n
    starts = np.cumsum([0, *map(len, sources)]).tolist()
    return {
        "lang": lang, "terms": terms, "starts": starts, "names": list(names), "cell_names": cell_names,
        "cell_counts": cell_counts, "totals": totals,
    }


def _merger(least_docs: int):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by lang and term; only the last key of a batch may go on in the next."""
        schema = pa.schema([
            ("lang", pa.string()), ("terms", pa.list_(pa.string())), ("starts", pa.list_(pa.int32())),
            ("names", pa.list_(pa.string())), ("cell_names", pa.list_(pa.int32())),
            ("cell_counts", pa.list_(pa.int64())), ("totals", pa.list_(pa.int64())),
        ])
        rest, open_lang, waiting = _STRIPE.empty_table(), None, ([], [], [])

        def block(row: dict) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([row], schema=schema)

        def finished(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            nonlocal open_lang, waiting
            keep = pc.or_(pc.equal(rows["term"], ""), pc.greater_equal(rows["df"], least_docs))
            for row in rows.filter(keep).to_pylist():
                if row["lang"] != open_lang or len(waiting[0]) >= BLOCK:
                    if waiting[0]:
                        yield block(_block(open_lang, *waiting))
                    open_lang, waiting = row["lang"], ([], [], [])
                if row["term"] == "":
                    named = _block(row["lang"], [], [row["sources"]], [[0] * len(row["sources"])])
                    yield block(named | {"starts": [0], "cell_names": [], "cell_counts": []})
                else:
                    for column, value in zip(waiting, (row["term"], row["sources"], row["counts"])):
                        column.append(value)

        for batch in batches:
            rows = _folded(pa.concat_tables([rest, pa.Table.from_batches([batch]).cast(_STRIPE)]))
            if rows.num_rows:
                rest = rows.slice(rows.num_rows - 1)
                yield from finished(rows.slice(0, rows.num_rows - 1))
        yield from finished(rest)
        if waiting[0]:
            yield block(_block(open_lang, *waiting))

    return merge


def shares(counts: np.ndarray, whole: np.ndarray | int) -> np.ndarray:
    """1 + floor(SCALE * (count + SMOOTH) / whole), exact; ``whole`` is the smoothed total, at least count + SMOOTH."""
    a, whole = counts + SMOOTH, np.asarray(whole)
    if whole.size and int(whole.max()) >= 1 << 47:
        return np.asarray(1 + a.astype(object) * SCALE // whole.astype(object)).astype(np.int64)
    # In two steps, so that products stay below 2**63: SCALE is 31,250 times 32,000.
    high, rest = np.divmod(a * 31_250, whole)
    return 1 + high * 32_000 + rest * 32_000 // whole


def distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


class _Pairs:
    """Sums for ordered pairs of the sources of a language, handed over when they hold too many numbers."""

    def __init__(self) -> None:
        self.sums: dict[tuple[str, int], np.ndarray] = {}
        self.names: dict[str, list[str]] = {}
        self.size = 0

    def add(self, lang: str, names: list[str], i: int, row: np.ndarray) -> None:
        if (lang, i) in self.sums:
            self.sums[lang, i] += row
        else:
            self.sums[lang, i], self.names[lang] = row, names
            self.size += len(row)

    def handed_over(self) -> Iterator[tuple]:
        for (lang, i), row in self.sums.items():
            names = self.names[lang]
            for j in np.flatnonzero(row).tolist():
                yield "pair", lang, names[min(i, j)], names[max(i, j)], int(row[j])
        self.sums, self.size = {}, 0


def _measured(row: dict, top: int, pairs: _Pairs) -> Iterator[tuple]:
    """Adds a block's corrections to ``pairs`` and yields its ``top`` terms of every source."""
    lang, names, kept = row["lang"], row["sources"], row["kept"]
    index = {name: i for i, name in enumerate(names)}
    whole = np.array(row["sizes"], dtype=np.int64) + SMOOTH * kept
    lang_whole = int(sum(row["sizes"])) + SMOOTH * kept
    absent = shares(np.zeros(len(names), dtype=np.int64), whole)
    starts = np.array(row["starts"], dtype=np.int64)
    place = np.array([index[x] for x in row["names"]], dtype=np.int64)[np.array(row["cell_names"], dtype=np.int64)]
    counts = np.array(row["cell_counts"], dtype=np.int64)
    term = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    p = shares(counts, whole[place])
    q = shares(np.add.reduceat(counts, starts[:-1]), lang_whole)[term]
    over = np.flatnonzero((counts > 0) & (p > q))
    value = distances(p[over], q[over])
    order = np.lexsort((term[over], -value, place[over]))
    sorted_place = place[over][order]
    best = order[np.arange(len(order)) - np.searchsorted(sorted_place, sorted_place, "left") < top]
    for cell, v in zip(over[best].tolist(), value[best].tolist()):
        yield "term", lang, names[place[cell]], row["terms"][term[cell]], v
    step = max(1, MATRIX // max(1, len(names)))
    for low in range(0, len(starts) - 1, step):
        high = min(low + step, len(starts) - 1)
        cells = slice(starts[low], starts[high])
        matrix = np.tile(absent, (high - low, 1))
        held = np.zeros((high - low, len(names)), dtype=bool)
        matrix[term[cells] - low, place[cells]] = p[cells]
        held[term[cells] - low, place[cells]] = True
        for i in np.unique(place[cells]).tolist():
            mine = held[:, i]
            # A pair of two that occur counts once, from the source that comes first.
            once = ~held[mine] | (np.arange(len(names)) > i)
            more = distances(matrix[mine, i][:, None], matrix[mine]) - distances(absent[i], absent)
            pairs.add(lang, names, i, np.where(once, more, 0).sum(axis=0))


def _measurer(top: int):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, out = _Pairs(), []
        names = ["part", "lang", "source", "item", "value"]

        def full() -> pa.RecordBatch:
            columns = list(zip(*out)) or [[]] * 5
            kinds = [pa.string()] * 4 + [pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            for at in range(batch.num_rows):
                for row in batch.slice(at, 1).to_pylist():
                    out.extend(_measured(row, top, pairs))
                if pairs.size >= MATRIX:
                    out.extend(pairs.handed_over())
                if len(out) >= 10_000:
                    yield full()
                    out = []
        out.extend(pairs.handed_over())
        yield full()

    return measure


def stripes(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Blocks of merged stripes of the terms that are in ``least_docs`` documents of their language, and a block
    without terms that names the sources of each language."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    given = docs.select(empty("lang").alias("lang"), empty("source").alias("source"), empty("text").alias("text"))
    folded = given.mapInArrow(_fold, STRIPE).repartition("lang", "term").sortWithinPartitions("lang", "term")
    return folded.mapInArrow(_merger(least_docs), BLOCKS)


def divergences(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) for each source of each language of ``docs`` (text, lang, source; further
    columns are ignored).

    Part ``pair``: the other sources of the language by distance. Part ``term``: at most ``top`` terms that are more
    frequent in the source than in the language, by their share of the distance. Nulls are read as the empty text, also
    as a language or source of its own. A source without terms is compared like any other; a language without kept terms has
    distances of zero and no terms; one with a single source has no pairs. Very long texts are split in pieces, repeated rows
    count as often as they are there, ties go by the item's UTF-8 bytes, and an empty table gives no rows.
    """
    blocks = stored(stripes(docs, least_docs), "stripes")
    sizes = blocks.select("lang", F.explode(F.arrays_zip("names", "totals")).alias("x")).groupBy(
        "lang", F.col("x.names").alias("source")
    ).agg(F.sum("x.totals").alias("n"))
    kept = blocks.groupBy("lang").agg(F.sum(F.size("terms")).cast("long").alias("kept"))
    groups = sizes.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("g"))
    langs = stored(groups.join(kept, "lang").select(
        "lang", "kept", F.col("g.source").alias("sources"), F.col("g.n").alias("sizes")
    ), "languages")
    measured = stored(
        blocks.where(F.size("terms") > 0).join(langs, "lang").select(*blocks.columns, "kept", "sources", "sizes")
        .mapInArrow(_measurer(top), MEASURED), "measured",
    )
    first = langs.select("lang", "kept", F.posexplode(F.arrays_zip("sources", "sizes")).alias("i", "a"), "sources", "sizes")
    both = first.repartition("lang", "i").select(
        "lang", "kept", "a",
        F.explode(F.expr("slice(arrays_zip(sources, sizes), i + 2, greatest(size(sources) - i - 1, 0))")).alias("b"),
    )
    # What two absent terms contribute; nothing is divided where no term is kept.
    share = lambda x: F.expr(f"1 + ({SCALE * SMOOTH}L div nullif({x}.sizes + {SMOOTH} * kept, 0))")
    base = both.withColumn("p", share("a")).withColumn("q", share("b")).select(
        "lang", F.col("a.sources").alias("source"), F.col("b.sources").alias("item"),
        F.expr("if(kept = 0, 0L, kept * (((p - q) * (p - q)) div (p + q)))").alias("value"),
    )
    half = base.union(measured.where("part = 'pair'").select("lang", "source", "item", "value")).groupBy(
        "lang", "source", "item"
    ).agg(F.sum("value").alias("value"))
    pair = half.select("lang", "value", F.explode(F.array(
        F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))
    )).alias("x")).select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")
    term = measured.where("part = 'term'").select("lang", "source", "part", "item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(order))
    return ranked(pair).union(ranked(term).where(F.col("rank") <= top))


DIVERGENCE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= {LEAST_DOCS}),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
gn AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL), ln AS (SELECT lang, sum(n) AS n FROM c GROUP BY ALL),
q AS (SELECT lang, term, 1 + {SCALE}::HUGEINT * (sum(c.n) + {SMOOTH}) // (any_value(ln.n) + {SMOOTH} * any_value(v)) AS q
  FROM c JOIN ln USING (lang) JOIN v USING (lang) GROUP BY lang, term),
cell AS (SELECT lang, source, term, coalesce(c.n, 0) AS n,
    1 + {SCALE}::HUGEINT * (coalesce(c.n, 0) + {SMOOTH}) // (coalesce(gn.n, 0) + {SMOOTH} * v) AS p
  FROM grp JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term) LEFT JOIN gn USING (lang, source)),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM cell a JOIN cell b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
term AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
  FROM cell JOIN q USING (lang, term) WHERE n > 0 AND p > q),
parts AS (SELECT 'pair' AS part, * FROM pair UNION ALL SELECT 'term', * FROM term),
ranked AS (SELECT *, row_number() OVER (PARTITION BY part, lang, source ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
