"""Operator 2, near-duplicates by bottom-k MinHash sketches from one hash function.

1. A text is the set of its distinct word shingles, as 64-bit hashes. Texts with equal sets form one class, found by a
   128-bit fingerprint; from here on a class counts once.
2. The sketch of a set is its `K` smallest hashes. At a similarity of 0.8, fewer than `LEAST` common values among the K
   smallest of a union have a probability below 1e-9; sets of up to 4/5 K shingles have an exact bound. So only a prefix of
   the sketch, its rarest values, enters the inverted lists: two sketches with LEAST common values share one of them.
3. Lists of up to `SHORT` classes give their pairs, and overlaps are added up. Longer lists are compared in blocks (see 5)
   and give a spanning forest. Either way the union sketch of two classes estimates their similarity, and below LEAST
   common values they are not joined. What is joined makes clusters.
4. Clusters are compared in blocks with whole sets, by exact intersections. Components of these links are groups.
5. `_spanning` compares the members of a group, such as a long list or a cluster. Blocks of about `BLOCK` members are
   compared with themselves and with the group's first block. Members then outside the group's largest component are
   compared with all its blocks. So no pair is left out that could join two components, while n near copies need few of
   their n * n pairs, and a task holds two blocks at most.

Cases: null, empty or wordless texts have the empty set and are linked with nothing; texts with fewer words than a shingle
are one shingle; equal texts and repeated rows are linked; a null doc_id is linked too and never the smallest; ties go to
the smallest doc_id, and to the first row where all ids are null; rows are dropped by their number, so that rows of equal
or null doc_id don't share a fate; rows that share the smallest doc_id of a group all stay; only doc_id and text are read,
so other columns can have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carledger.llm.bytewords import Hasher, Words, batch_words, gather, list_array, mix, run_hash, shingles, space_table, text_buffer, tidied
from carledger.llm.graph import components
from carledger.llm.tables import free_name, may_hold, membership, narrow, numbered, stored

K = 32  # values of a sketch
LEAST = 10  # the sum of binomial(32, 0.8) below 10 is under 1e-9
SHORT = 16  # classes of a list whose pairs are listed
BLOCK = 256  # classes of a block
PERCENT = 80  # least similarity of a link


def _sets(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets by document) of the distinct shingles of each document, ascending."""
    at, key = shingles(words, width)
    n = np.diff(words.offsets)
    few = np.flatnonzero((n > 0) & (n < width))
    doc = [words.doc[at]]
    keys = [key]
    for size in np.unique(n[few]):
        own = few[n[few] == size]
        doc.append(own)
        keys.append(run_hash(words.hashes, words.offsets[own], int(size)))
    doc, key = np.concatenate(doc), np.concatenate(keys)
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    return key[new], np.searchsorted(doc[new], np.arange(words.docs + 1))


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _prints(key: np.ndarray, offsets: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two fingerprints of each set, and one of the set with its document's id."""
    low, high = _sums(mix(key ^ np.uint64(0xA5A5A5A5A5A5A5A5)), offsets), _sums(mix(key + np.uint64(0x1234567)), offsets)
    return low, high, mix(low ^ ids)


def _scan(docs: DataFrame, width: int, emit, schema: str, *more: Column) -> DataFrame:
    """Runs `emit(ids column, sets, offsets, prints)` over all documents; ids come as text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, table = Hasher(), space_table()
        for batch in batches:
            data, ends = text_buffer(batch.column(0))
            ids = hasher.segments(data[ends[0] : ends[-1]], ends[:-1] - ends[0], ends[1:] - ends[0])
            for part in batch_words(batch.column(1), table, hasher):
                key, offsets = _sets(part, width)
                own = slice(part.first, part.first + part.docs)
                yield emit(batch.slice(part.first, part.docs), key, offsets, _prints(key, offsets, ids[own]))

    return docs.select(F.col("doc_id").cast("string").alias("_id"), "text", "doc_id", *more).mapInArrow(tidied(run), schema)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _sketches(docs: DataFrame, width: int, row: Column) -> DataFrame:
    """doc_id, n, low, high, key, sketch, _row for each row; sketch values are ordered as signed numbers."""

    def emit(batch, key, offsets, prints):
        n = np.diff(offsets)
        kept = np.arange(len(key)) - np.repeat(offsets[:-1], n) < K
        sketch = (key[kept] ^ np.uint64(1 << 63)).view(np.int64)
        columns = [batch.column(2), pa.array(n), *map(_signed, prints), list_array(sketch, np.minimum(n, K), pa.int64()), batch.column(3)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "low", "high", "key", "sketch", "_row"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n long, low long, high long, key long, sketch array<long>, _row long"
    return _scan(docs, width, emit, schema, row.alias("_row"))


def _whole_sets(docs: DataFrame, width: int, wanted: DataFrame) -> DataFrame:
    """low, high, key, size, data (the set) of the rows whose key passes a filter with the keys of `wanted`."""
    packed = docs.sparkSession.sparkContext.broadcast(membership(wanted, "key"))

    def emit(batch, key, offsets, prints):
        n = np.diff(offsets)
        held = np.flatnonzero(may_hold(packed.value, prints[2]) & (n > 0))
        values = gather(key, offsets[:-1], n, held).view(np.int64)
        columns = [*(_signed(x[held]) for x in prints), pa.array(n[held]), list_array(values, n[held], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["low", "high", "key", "size", "data"])

    return _scan(docs, width, emit, "low long, high long, key long, size long, data array<long>")


def _least_common(n: Column) -> Column:
    """How many sketch values a set of n shingles and any set similar to it have in common at least."""
    share = F.floor((n * PERCENT + 99) / 100)
    return F.when(n * 100 <= K * PERCENT, share).otherwise(F.least(F.lit(LEAST), share))


def _prefixes(nodes: DataFrame) -> DataFrame:
    """value, node, n: for each class the rarest values of its sketch, as many as a similar class can't all lack."""
    postings = nodes.select("node", "n", F.explode("sketch").alias("value"))
    df = postings.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    shared = postings.join(df, "value").groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("all"))
    length = F.greatest(F.lit(0), F.size("all") - _least_common(F.col("n")) + 1).cast("int")
    return shared.select("node", "n", F.explode(F.slice("all", 1, length)).alias("x")).select("x.value", "node", "n")


def _candidates(nodes: DataFrame) -> DataFrame:
    """a, b: pairs of classes that join clusters."""
    prefix = stored(_prefixes(nodes))
    lists = prefix.groupBy("value").agg(F.count("*").alias("size")).where("size > 1")
    entries = stored(narrow(prefix.join(lists, "value")))
    left, right = (entries.where(f"size <= {SHORT}").select("value", F.col("node").alias(x), F.col("n").alias(f"n{x}")) for x in "ab")
    near = f"least(na, nb) * 100 >= greatest(na, nb) * {PERCENT}"
    pairs = left.join(right, "value").where(f"a < b and {near}").groupBy("a", "b").agg(F.count("*").alias("overlap"))
    for x in "ba":
        own = nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))
        pairs = pairs.join(own, x)
    whole = f"na <= {K} and nb <= {K}"
    union = F.array_sort(F.array_union("sa", "sb"))
    union = F.when(F.expr(whole), union).otherwise(F.slice(union, 1, K))
    common = F.size(F.array_intersect(F.array_intersect("sa", "sb"), union))
    enough = F.when(F.expr(whole), common * 100 >= F.size(union) * PERCENT).otherwise(common >= LEAST)
    long = entries.where(f"size > {SHORT}").select(F.col("value").alias("group"), "node")
    sketches = nodes.select("node", F.col("n").alias("size"), F.col("sketch").alias("data"))
    return pairs.where(enough).select("a", "b").union(_spanning(long, lambda placed: placed.join(sketches, "node"), _alike))


def _alike(data: np.ndarray, start: np.ndarray, n: np.ndarray, i: int, common: np.ndarray):
    """The rows whose union sketch with row i has enough common values, one after the other."""
    own = data[start[i] : start[i + 1]]
    within = np.minimum(n[i], n) * 100 >= PERCENT * np.maximum(n[i], n)
    for j in np.flatnonzero(within & ((common >= LEAST) | (np.maximum(n[i], n) <= K))):
        other = data[start[j] : start[j + 1]]
        union, whole = np.union1d(own, other), max(n[i], n[j]) <= K
        last = union[-1] if whole or len(union) <= K else union[K - 1]
        both = np.intersect1d(own, other, assume_unique=True)
        count = int((both <= last).sum())
        if count * 100 >= len(union) * PERCENT if whole else count >= LEAST:
            yield j


def _linked(data: np.ndarray, start: np.ndarray, n: np.ndarray, i: int, common: np.ndarray):
    """The rows whose sets are similar to that of row i."""
    yield from np.flatnonzero(common * 100 >= PERCENT * (n[i] + n - common))


def _forest(table: pa.Table, test, left: np.ndarray, right: np.ndarray, root: np.ndarray) -> tuple[pa.Table, np.ndarray]:
    """A spanning forest of the links between rows where `left` holds and rows where `right` holds, and the root of each
    row in it. `root` says what is joined before."""
    ids, n = table["node"].to_numpy(), table["size"].to_numpy()
    lists = table["data"].combine_chunks()
    start = np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy())].astype(np.int64)
    data = lists.flatten().to_numpy()
    _, value = np.unique(data, return_inverse=True)
    order = np.argsort(value, kind="stable")
    holder = np.repeat(np.arange(len(ids)), np.diff(start))[order]
    first = np.searchsorted(value[order], np.arange(value.max() + 2 if len(value) else 1))
    root, a, b = root.copy(), [], []
    for i in np.flatnonzero(left):
        own = value[start[i] : start[i + 1]]
        count = first[own + 1] - first[own]
        at = np.repeat(first[own] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        common = np.bincount(holder[at], minlength=len(ids))
        common[~right | (root == root[i])] = -K  # joined already, or not to be compared
        for j in test(data, start, n, i, common):
            if common[j] >= 0 and root[j] != root[i]:
                a.append(ids[i])
                b.append(ids[j])
                root[root == root[j]] = root[i]
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())}), root


def _spanning(members: DataFrame, with_data, test) -> DataFrame:
    """a, b: links that hold together what links inside each group connect. members: group, node; `with_data` adds size
    (shingles of the whole set) and data (array of its hashes, or of some) to them; `test` finds the links of a row."""
    columns, none = ["group", "node", "size", "data"], F.lit(None).cast("long")

    def rows(key, a, b, root=None):
        found = {"group": np.full(len(a), key), "a": a, "b": b} | ({} if root is None else {"root": root})
        return pa.table({k: pa.array(v, pa.int64()) for k, v in found.items()})

    def alone(key, table):
        """The first block with itself: links. In a group of several blocks also (node, whether it is in the largest
        component, its root) of each row."""
        every = np.ones(table.num_rows, bool)
        links, root = _forest(table, test, every, every, np.arange(table.num_rows))
        found = rows(key[0].as_py(), links["a"], links["b"], pa.nulls(links.num_rows, pa.int64()))
        if table["blocks"][0].as_py() > 1:
            ids, main = table["node"].to_numpy(), np.bincount(root).argmax()
            found = pa.concat_tables([found, rows(key[0].as_py(), ids, (root == main).astype(np.int64), ids[root])])
        return found

    def beside(key, table):
        """Another block with itself and with the first: links, and (node, null) of its rows that are then not joined to
        the first block's largest component."""
        ids, own = table["node"].to_numpy(), pc.is_null(table["root"]).to_numpy(zero_copy_only=False)
        known, main = (pc.fill_null(table[c], -1).to_numpy() for c in ("root", "main"))
        place = {int(i): k for k, i in enumerate(ids)}
        start = np.array([k if own[k] else place[int(known[k])] for k in range(len(ids))])
        links, root = _forest(table, test, own, np.ones(len(ids), bool), start)
        apart = ids[own & ~np.isin(root, root[main == 1])]
        group = key[0].as_py()
        return pa.concat_tables([rows(group, links["a"], links["b"]), rows(group, apart, pa.nulls(len(apart), pa.int64()))])

    def across(key, table):
        """Rows that aren't in the largest component with a block: links."""
        own = table["own"].to_numpy(zero_copy_only=False)
        links, _ = _forest(table, test, own, ~own, np.arange(len(own)))
        return rows(key[0].as_py(), links["a"], links["b"])

    sizes = members.groupBy("group").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = with_data(members.join(sizes, "group").withColumn("block", block))
    placed = stored(placed.select(*columns, "blocks", "block"))
    schema = "group long, a long, b long"
    first = placed.where("block = 0").select(*columns, "blocks").groupBy("group").applyInArrow(alone, f"{schema}, root long")
    first = stored(first)
    marks = first.where("root is not null").select("group", F.col("a").alias("node"), F.col("b").alias("main"), "root")
    wide = placed.where("blocks > 1")
    head = wide.where("block = 0").join(marks, ["group", "node"]).withColumn("unit", F.explode(F.sequence(F.lit(1), F.col("blocks") - 1)))
    others = wide.where("block > 0").select(*columns, none.alias("main"), none.alias("root"), F.col("block").alias("unit"))
    units = others.union(head.select(*columns, "main", "root", "unit"))
    second = stored(units.groupBy("group", "unit").applyInArrow(beside, schema))
    apart = second.where("b is null").select("group", F.col("a").alias("node")).union(marks.where("main = 0").select("group", "node"))
    parts = apart.groupBy("group").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")).cast("int")
    outside = wide.join(apart, ["group", "node"]).join(parts, "group").withColumn("part", part)
    outside = outside.withColumn("unit", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    inside = wide.join(parts, "group").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    inside = inside.withColumn("unit", F.col("block"))
    outside, inside = (x.select("part", *columns, "unit", F.lit(own).alias("own")) for x, own in ((outside, True), (inside, False)))
    # Units are small but long to compare: as many partitions as there are, not as few as their size asks for.
    partitions = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    third = outside.union(inside).repartition(partitions, "group", "part", "unit")
    third = third.groupBy("group", "part", "unit").applyInArrow(across, schema)
    links = first.where("root is null").select("a", "b").union(second.where("b is not null").select("a", "b"))
    return stored(links.union(third.select("a", "b")))


def groups(docs: DataFrame, width: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of `docs`, by shingles of `width` words.

    component_id is the smallest doc_id that links lead to, kept tells whether it is the row's own. Of a group without any
    doc_id one row is kept.
    """
    return _judged(docs, width, F.monotonically_increasing_id()).drop("_row")


def _judged(docs: DataFrame, width: int, row: Column) -> DataFrame:
    """The columns of `groups` and _row, the row's number."""
    rows = stored(_sketches(docs, width, row))
    classes = (
        rows.where("n > 0")
        .groupBy("low", "high", "n")
        .agg(F.min(F.struct("doc_id", "_row", "key")).alias("first"), F.min("doc_id").alias("least_id"))
        .select("low", "high", "n", F.col("first._row").alias("node"), F.col("first.key").alias("key"), "least_id")
    )
    classes = stored(narrow(classes))
    nodes = stored(classes.join(rows.select(F.col("_row").alias("node"), "sketch"), "node"))
    clusters = stored(narrow(components(_candidates(nodes)).select(F.col("label").alias("group"), "node")))
    wanted = clusters.join(nodes.select("node", "low", "high", "key"), "node").select("node", "low", "high", "key")
    wanted = stored(narrow(wanted))
    sets = _whole_sets(docs, width, wanted)
    same = ["low", "high", "key"]
    found = components(_spanning(clusters, lambda placed: placed.join(wanted, "node").join(sets, same), _linked))
    found = stored(narrow(found))
    named = classes.join(found, "node", "left").withColumn("label", F.coalesce("label", "node"))
    # A class is named by its first row, null ids before others: in a group of null ids alone by the first of all.
    least = named.groupBy("label").agg(F.min("least_id").alias("component_id"), F.min("node").alias("_first"))
    named = named.join(least, "label").select("low", "high", "n", "component_id", "_first")
    own = F.when(F.col("component_id").isNull(), F.col("_row") == F.col("_first")).otherwise(F.col("doc_id").eqNullSafe(F.col("component_id")))
    return rows.join(named, ["low", "high", "n"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n") > 0, own).otherwise(True).alias("kept"),
        "_row",
    )


def deduplicate(docs: DataFrame, width: int = 5) -> DataFrame:
    """The rows of `docs` whose doc_id is the smallest of its group, and the first row of each group without any doc_id."""
    at = free_name("_at", docs)
    rows = stored(numbered(docs, at))
    gone = stored(_judged(rows, width, F.col(at)).where("not kept").select(F.col("_row").alias("_gone")))
    return rows.join(gone, rows[at] == gone["_gone"], "left_anti").drop(at)


ORACLE = r"""
WITH RECURSIVE word AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents
), doc AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN ws
    ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS shingles FROM word
), posting AS (
  SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM doc
), link AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM posting a JOIN posting b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), edge AS (
  SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN edge e ON e.a = r.b
)
SELECT d.doc_id, len(d.shingles)::BIGINT AS n_shingles, min(r.b) AS component_id, min(r.b) = d.doc_id AS kept
FROM doc d JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id, d.shingles
"""
