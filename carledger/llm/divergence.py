"""Operator 13, source divergence audit: how far the vocabulary of each source lies from the others of its language.

Every Arrow batch is a shard. Pointers to the starts of its words are sorted by the words' bytes with a multikey quicksort:
eight bytes at a time, each slice is split into less, equal and greater around one of its own keys, all slices at once; equal
slices go on with the next eight bytes until the word ends. A slice whose words have ended is a run of equal words. Texts are
laid by language and source before, and the splits keep the order, so a run yields its counts by source and document in
passing. Spark adds up the shards; a document is in one shard, so its documents add up too.

The divergence of two sources is a sum over all kept terms of the language. It is taken over slices of the terms, in blocks of
sources, as a table of terms by sources in a task; what a term contributes to two sources that both lack it is the same for all
such terms and is added as a product. All arithmetic is exact, on integers.

Cases: null text, language or source count as empty text; documents without terms still give their source; repeated rows count
each; a word of any length is one term; a document of any length is sorted in slices, its terms counting one document;
a language without kept terms has values of 0 and no terms; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carledger.llm.bytewords import gather, text_buffer, tidied
from carledger.llm.tables import stored

LEAST_DOCS = 10  # documents of a language that hold a term, for it to be kept
TOP = 10  # terms reported for each source
SLICE_WORDS = 300_000  # pointers sorted together
SLICE_ROWS = 1 << 17  # counts of kept terms that one task sums over
SOURCES = 128  # sources that one task holds side by side
CELLS = 1 << 20  # of the table of terms by sources that are looked at together
_UNIT = 1_000_000_000


def letter_table() -> np.ndarray:
    """Words are runs of letters and of anything beyond ASCII; only A-Z are lower-cased."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    keep = np.zeros(256, bool)
    keep[65:91] = keep[97:123] = keep[128:] = True
    table[~keep] = 0
    return table


def word_pointers(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the runs of bytes that aren't 0."""
    edge = np.diff(np.r_[False, data != 0, False].astype(np.int8))
    start = np.flatnonzero(edge == 1)
    return start, np.flatnonzero(edge == -1) - start


def multikey_sort(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the words data[start : start + size] by their bytes, and the first place of each run of equal words.
    Equal words keep their order."""
    padded = np.r_[data, np.zeros(8, np.uint8)]
    keys = np.lib.stride_tricks.sliding_window_view(padded, 8)
    mask = np.array([0] + [(1 << 64) - (1 << 64 - 8 * n) for n in range(1, 9)], np.uint64)

    def key(which: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The next eight bytes of each word, 0 beyond its end. No byte of a word is 0."""
        left = np.clip(size[which] - depth, 0, 8)
        at = np.minimum(start[which] + depth, len(data))
        return keys[at].view(">u8").ravel().astype(np.uint64) & mask[left]

    n = len(start)
    order, runs = np.arange(n), []
    if n == 0:
        return order, order
    # Slices that are not in order yet: their first place, size and depth, and their words with the keys at that depth.
    first, count, depth = np.zeros(1, np.int64), np.array([n], np.int64), np.zeros(1, np.int64)
    which, own = order.copy(), key(order, np.int64(0))
    while len(first):
        base = np.cumsum(count) - count
        # The pivot is the middle one of three keys of the slice.
        three = np.sort(np.stack([own[base + count // 4], own[base + count // 2], own[base + count * 3 // 4]]), axis=0)[1]
        pivot, at, todo = np.repeat(three, count), first, []
        for side, ours in enumerate((own < pivot, own == pivot, own > pivot)):
            chosen = np.flatnonzero(ours)  # by slice, in the order they had
            sizes = np.diff(np.searchsorted(chosen, np.r_[base, len(own)]))
            # Equal slices go eight bytes deeper; those whose pivot ends in them are runs.
            ended = (sizes == 1) | (three & np.uint64(255) == 0) if side == 1 else sizes == 1
            live = ~ended & (sizes > 0)
            ended &= sizes > 0
            moved, stays = which[chosen], np.repeat(live, sizes)
            places = np.arange(len(chosen)) + np.repeat(at - (np.cumsum(sizes) - sizes), sizes)
            order[places[~stays]] = moved[~stays]
            runs.append(at[ended])
            left, down = moved[stays], depth[live] + (8 if side == 1 else 0)
            ahead = key(left, np.repeat(down, sizes[live])) if side == 1 else own[chosen[stays]]
            todo.append((at[live], sizes[live], down, left, ahead))
            at = at + sizes
        first, count, depth, which, own = (np.concatenate(c) for c in zip(*todo, strict=True))
    return order, np.sort(np.concatenate(runs))


def _slices(words: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about SLICE_WORDS words together, at least one document each."""
    ends = np.cumsum(words)
    i = 0
    while i < len(words):
        done = ends[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(ends, done + SLICE_WORDS, "right")))
        yield i, j
        i = j


def _counted(data: np.ndarray, start: np.ndarray, size: np.ndarray, doc: np.ndarray, group: np.ndarray):
    """(start, size, group, n, n_docs) of each term of each group, from words in order of their groups and documents."""
    order, runs = multikey_sort(data, start, size)
    new_term = np.zeros(len(order), bool)
    new_term[runs] = True
    new = new_term | np.r_[True, group[order][1:] != group[order][:-1]]
    first = np.flatnonzero(new)
    new_doc = new | np.r_[True, doc[order][1:] != doc[order][:-1]]
    n = np.diff(np.r_[first, len(order)])
    n_docs = np.add.reduceat(new_doc.astype(np.int64), first) if len(first) else n
    at = order[first]
    return start[at], size[at], group[at], n, n_docs


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = letter_table()
    for batch in batches:
        (langs, lang), (origins, origin) = _ranked(batch.column(0)), _ranked(batch.column(1))
        codes, of = np.unique(lang * len(origins) + origin, return_inverse=True)
        names = langs.take(pa.array(codes // max(1, len(origins)))), origins.take(pa.array(codes % max(1, len(origins))))
        raw, offsets = text_buffer(batch.column(2))
        none = np.zeros(len(codes), np.int64)
        yield _rows(names, np.arange(len(codes)), np.zeros(0, np.uint8), none, none, none, none)  # every source, also without terms
        by = np.argsort(of, kind="stable")
        text_size = np.diff(offsets)[by]
        ends = np.cumsum(text_size)
        # The texts by group, a 0 between any two of them.
        at = 0
        while at < len(by):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 8 * SLICE_WORDS, "right")))
            chosen = by[at:stop]
            data = np.concatenate([np.r_[table[raw[offsets[d] : offsets[d + 1]]], np.uint8(0)] for d in chosen.tolist()])
            borders = np.cumsum(np.diff(offsets)[chosen] + 1)
            start, size = word_pointers(data)
            doc = np.searchsorted(borders, start, "right")
            if len(start) <= 2 * SLICE_WORDS or stop - at > 1:
                for i, j in _slices(np.bincount(doc, minlength=len(chosen))):
                    lo, hi = np.searchsorted(doc, [i, j])
                    found = _counted(data, start[lo:hi], size[lo:hi], doc[lo:hi], of[chosen][doc[lo:hi]])
                    yield _rows(names, found[2], data, found[0], found[1], found[3], found[4])
            else:  # one long document, slice by slice; a term of it that was seen before adds no document
                seen: set[bytes] = set()
                for lo in range(0, len(start), SLICE_WORDS):
                    part = slice(lo, lo + SLICE_WORDS)
                    s, z, g, n, _ = _counted(data, start[part], size[part], doc[part], of[chosen][doc[part]])
                    terms = [data[i : i + m].tobytes() for i, m in zip(s.tolist(), z.tolist(), strict=True)]
                    fresh = np.array([t not in seen for t in terms], np.int64)
                    seen.update(terms)
                    yield _rows(names, g, data, s, z, n, fresh)
            at = stop


def _rows(names: tuple, group: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray, n: np.ndarray, n_docs: np.ndarray):
    terms = np.ascontiguousarray(gather(data, start, size, np.arange(len(start))))
    offsets = np.r_[0, np.cumsum(size)].astype(np.int32)
    term = pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(terms))
    columns = [*(name.take(pa.array(group)) for name in names), term, pa.array(n, pa.int64()), pa.array(n_docs, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "n_docs"])


_COUNTS = "lang string, source string, term string, n long, n_docs long"


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), n_docs: the terms of each source, and one row with an empty term for each source."""
    texts = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))
    shards = texts.mapInArrow(tidied(_shards), _COUNTS)
    return shards.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def _share(n, total, terms):
    """1 + floor(10^9 (n + 2) / (total + 2 terms)), exact also where the product exceeds 64 bits."""
    wide = lambda c: c.cast("decimal(20,0)")
    ratio = F.call_function("div", F.lit(_UNIT).cast("decimal(10,0)") * wide(n + 2), wide(total + 2 * terms))
    return 1 + F.when(terms > 0, ratio).otherwise(0)


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    gap, both = p - q, p + q
    return gap * gap // both


_SUMS = "lang string, left_source string, right_source string, value long"


def _pair_sums(key: tuple, table: pa.Table) -> pa.Table:
    """What the terms of a slice add to each two sources of a block, or of two blocks."""
    lang, _, left, right = (k.as_py() for k in key)
    names, source = _ranked(table["source"])
    term, p, block = table["term"], table["p"].to_numpy(), table["block"].to_numpy()
    anchor = table["anchor"].to_numpy(zero_copy_only=False)
    plain, blocks = np.ones(len(names), np.int64), np.zeros(len(names), np.int64)
    plain[source[anchor]], blocks[source[anchor]] = p[anchor], block[anchor]
    rows = np.flatnonzero(~anchor)
    number, of = _ranked(term.take(pa.array(rows)))
    by = np.argsort(of, kind="stable")
    rows, of = rows[by], of[by]
    ours = np.flatnonzero(blocks == left)
    theirs = np.flatnonzero(blocks == right)
    sums = np.zeros((len(names), len(names)), np.int64)
    step = max(1, CELLS // max(1, len(names)))
    for lo in range(0, len(number), step):
        i, j = np.searchsorted(of, [lo, lo + step])
        cells = np.repeat(plain[:, None], min(step, len(number) - lo), axis=1)
        cells[source[rows[i:j]], of[i:j] - lo] = p[rows[i:j]]
        for s in ours.tolist():
            others = theirs[theirs > s] if left == right else theirs
            if len(others):
                sums[s, others] += _distance(cells[s], cells[others]).sum(axis=1) - len(cells[0]) * _distance(plain[s], plain[others])
    pairs = [(s, t) for s in ours.tolist() for t in theirs.tolist() if left != right or t > s]
    one, two = np.array(pairs, np.int64).reshape(-1, 2).T
    return pa.table(
        [pa.array([lang] * len(pairs), pa.string()), names.take(pa.array(one)), names.take(pa.array(two)), pa.array(sums[one, two], pa.int64())],
        names=["lang", "left_source", "right_source", "value"],
    )


def _ranked(column) -> tuple[pa.Array, np.ndarray]:
    """Distinct values and the number of each."""
    coded = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank. Part `pair`: each other source of the language by divergence. Part `term`: the
    `top` terms that the source has more of than its language, by their share of the divergence."""
    counts = stored(term_counts(docs))
    of_lang = counts.filter("term != ''").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("n_docs").alias("lang_docs"))
    kept = stored(counts.filter("term != ''").join(of_lang.filter(F.col("lang_docs") >= least_docs).drop("lang_docs"), ["lang", "term"]).drop("n_docs"))
    vocabulary = kept.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n")).groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("n_rows"))
    ranking = Window.partitionBy("lang").orderBy("source")
    sources = stored(
        counts.filter("term = ''")
        .select("lang", "source")
        .join(vocabulary, "lang", "left")
        .join(totals, ["lang", "source"], "left")
        .na.fill(0, ["v", "lang_total", "total", "n_rows"])
        .withColumn("slices", (F.sum("n_rows").over(Window.partitionBy("lang")) / SLICE_ROWS).cast("long") + 1)
        .withColumn("block", F.floor((F.row_number().over(ranking) - 1) / SOURCES))
        .withColumn("blocks", F.max("block").over(Window.partitionBy("lang")))
        .withColumn("p0", _share(F.lit(0), F.col("total"), F.col("v")))
    )
    shares = kept.join(sources, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("total"), F.col("v")))
    return _pairs(shares, sources).unionByName(_terms(shares, top)).select("lang", "source", "part", "item", "value", "rank")


def _pairs(shares: DataFrame, sources: DataFrame) -> DataFrame:
    """Each block of sources meets itself and every other; each source's share of a term that it lacks goes along."""
    slice_ = F.pmod(F.xxhash64("term"), "slices")
    columns = ["lang", "source", "block", "blocks"]
    terms = shares.select(*columns, slice_.alias("slice"), "term", "p", F.lit(False).alias("anchor"))
    anchors = sources.select(*columns, F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), F.lit("").alias("term"), F.col("p0").alias("p"), F.lit(True).alias("anchor"))
    other = F.explode(F.sequence(F.lit(0), "blocks"))
    units = terms.unionByName(anchors).withColumn("other", other).withColumn("left", F.least("block", "other")).withColumn("right", F.greatest("block", "other"))
    sums = units.select("lang", "slice", "left", "right", "source", "block", "term", "p", "anchor").groupBy("lang", "slice", "left", "right").applyInArrow(_pair_sums, _SUMS)
    ends = F.least("left_source", "right_source").alias("left_source"), F.greatest("left_source", "right_source").alias("right_source")
    sums = sums.groupBy("lang", *ends).agg(F.sum("value").alias("value"))
    plain = sources.select("lang", "source", "p0", "v")
    side = lambda name: plain.select("lang", F.col("source").alias(f"{name}_source"), F.col("p0").alias(f"{name}_p"), "v")
    sums = sums.join(side("left"), ["lang", "left_source"]).join(side("right").drop("v"), ["lang", "right_source"])
    both = F.expr("value + v * ((left_p - right_p) * (left_p - right_p) div (left_p + right_p))")
    found = sums.select("lang", "left_source", "right_source", both.alias("value"))
    ways = found.select(
        "lang",
        F.explode(F.array(*(F.struct(F.col(a).alias("source"), F.col(b).alias("item")) for a, b in (("left_source", "right_source"), ("right_source", "left_source"))))).alias("way"),
        "value",
    ).select("lang", "way.*", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return ways.withColumn("part", F.lit("pair")).withColumn("rank", F.row_number().over(order))


def _terms(shares: DataFrame, top: int) -> DataFrame:
    q = _share(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    above = shares.withColumn("q", q).filter("p > q").withColumn("value", F.expr("(p - q) * (p - q) div (p + q)"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    found = above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


#: The same in SQL, for an engine with 128-bit integers.
ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
words AS (
  SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
vocabulary AS (
  SELECT lang, term, count(*) AS lang_n FROM words GROUP BY ALL HAVING count(DISTINCT d) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM vocabulary GROUP BY lang),
counts AS (
  SELECT lang, source, term, count(*) AS n FROM words JOIN vocabulary USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL),
sources AS (
  SELECT DISTINCT d.lang, d.source, coalesce(v, 0) AS v, coalesce(lang_total, 0) AS lang_total, coalesce(total, 0) AS total
  FROM docs d LEFT JOIN langs USING (lang) LEFT JOIN totals USING (lang, source)),
shares AS (
  SELECT s.lang, s.source, t.term, coalesce(n, 0) AS n,
    1 + 1000000000::HUGEINT * (coalesce(n, 0) + 2) // (total + 2 * v) AS p,
    1 + 1000000000::HUGEINT * (lang_n + 2) // (lang_total + 2 * v) AS q
  FROM sources s JOIN vocabulary t USING (lang) LEFT JOIN counts USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source != b.source GROUP BY ALL),
rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source != b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, part, item, value::BIGINT AS value,
    row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM rows)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""
