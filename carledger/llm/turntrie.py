"""Operator 12, conversation prefix trie in double arrays.

Each conversation is a path: 16 bytes of SHA-256 for the role and text of each turn. Paths are range-partitioned and sorted by
their bytes, then by conversation, so that all conversations with a common prefix lie together, and a prefix or a path that
very many share is cut into even parts. Each task packs its paths into shards. A shard numbers its distinct turns densely and
lays its trie out in two arrays: the child of state s by turn c is the state BASE[s] + c, and CHECK[BASE[s] + c] = s. Walking
all paths through the arrays gives the members of every node; going back over CHECK adds up its subtree.

Only the prefixes of the first and of the last path of a shard can also lie in other shards. These upper nodes are merged over
all shards by the hash of their prefix; then each shard adds up what it owns below them, and the shards' sums are added. All
other nodes are complete in their shard. The digest of the ends of an upper node is fed with the shards' ids in order, one
piece after the other.

Cases: rows without conv_id take no part; null role or text counts as empty; turns of equal number are ordered by role, then by
the hash of their text; repeated rows are turns of their own; texts and conversations of any length are taken whole (a path is one value,
16 bytes and a number a turn); only conv_id, turn, role and text are read; an empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carledger.llm.bytewords import slices, tidied
from carledger.llm.tables import stored

STEP, SHARED = 5, 9  # conversation c begins with the first crc32(c) % SHARED turns of conversation c - c % STEP
SHARD_TURNS = 200_000  # turns that share a double array
DIGEST = 16  # bytes that stand for a turn
NO_ENDS = hashlib.sha256(b"").hexdigest()


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, path (binary) and sizes (bytes of text of each turn) of every conversation, with the turns that it shares."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * DIGEST)
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn", role.alias("role"), digest.alias("digest"), F.octet_length(text).alias("size"))
    own = conversations.filter("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    own = own.withColumn("turns", F.transform("turns", lambda x: F.struct(x.digest.alias("digest"), x["size"].cast("long").alias("size"))))
    first = own.filter(F.col("conv_id") % STEP == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, SHARED - 1).alias("before"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(SHARED)).cast("int")
    after = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return (
        own.withColumns({"base": F.col("conv_id") - F.col("conv_id") % STEP, "h": h})
        .join(first, "base", "left")
        .select("conv_id", F.concat(F.slice(F.coalesce("before", F.expr("slice(turns, 1, 0)")), F.lit(1), F.col("h")), after).alias("turns"))
        .select("conv_id", F.unhex(F.array_join("turns.digest", "")).alias("path"), F.col("turns.size").alias("sizes"))
    )


class DoubleArray:
    """The trie of sorted paths, `lengths` turns each, of turns numbered from 0. State 0 is the root."""

    def __init__(self, turns: np.ndarray, lengths: np.ndarray):
        self.base, self.check = np.zeros(1, np.int64), np.full(1, -1, np.int64)
        self.turns, self.lengths, self.begin = turns, lengths, np.cumsum(lengths) - lengths
        self._low = 1  # no state below is free
        state, paths, depth = np.zeros(len(lengths), np.int64), np.arange(len(lengths)), 0
        while True:
            on = lengths[paths] > depth
            paths, state = paths[on], state[on]
            if not len(paths):
                break
            code = turns[self.begin[paths] + depth]
            new = np.r_[True, (state[1:] != state[:-1]) | (code[1:] != code[:-1])]
            self._enter(state[new], code[new])
            state, depth = self.base[state] + code, depth + 1

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.r_[self.base, np.zeros(more, np.int64)]
            self.check = np.r_[self.check, np.full(more, -1, np.int64)]

    def _free(self, count: int) -> np.ndarray:
        """The lowest free states."""
        self._grow(self._low + count)
        while True:
            found = self._low + np.flatnonzero(self.check[self._low :] < 0)
            if len(found) >= count:
                return found[:count]
            self._grow(len(self.check) + count - len(found))

    def _enter(self, parent: np.ndarray, code: np.ndarray) -> None:
        """Enters the children of some states; children of one state follow each other."""
        first = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])
        count = np.diff(np.r_[first, len(parent)])
        for i in np.flatnonzero(count > 1).tolist():
            codes = code[first[i] : first[i] + count[i]]
            gaps = codes - codes.min()
            room = self._free(1)[0]
            while True:
                self._grow(room + int(gaps.max()) + 1)
                taken = self.check[room + gaps] >= 0
                if not taken.any():
                    break
                room += 1
                while room < len(self.check) and self.check[room] >= 0:
                    room += 1
            state = parent[first[i]]
            self.base[state] = room - codes.min()
            self.check[room + gaps] = state
        alone = first[count == 1]
        if len(alone):
            slots = self._free(len(alone))
            self.base[parent[alone]] = slots - code[alone]
            self.check[slots] = parent[alone]
            self._low = int(slots[-1]) + 1

    def walk(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(depth, paths, states): the state of every path that has so many turns, from the root on."""
        paths = np.arange(len(self.lengths))
        state, depth = np.zeros(len(paths), np.int64), 0
        while len(paths):
            yield depth, paths, state
            on = self.lengths[paths] > depth
            paths, state = paths[on], state[on]
            to = self.base[state] + self.turns[self.begin[paths] + depth]
            if (self.check[to] != state).any():
                raise AssertionError("a path leaves the trie")
            state, depth = to, depth + 1


_SHARDS = (
    "shard string, side int, key binary, parent_key binary, depth long, conv_id long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, size long, ends string"
)
FIRST, LAST = 1, 2  # sides: on the first path of the shard, on the last one, on both (3); 0 is in this shard alone


def _numbered(digests: np.ndarray) -> np.ndarray:
    """Dense numbers of rows of two 64-bit halves."""
    order = np.lexsort((digests[:, 1], digests[:, 0]))
    ranked = digests[order]
    new = np.r_[False, (ranked[1:] != ranked[:-1]).any(axis=1)]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new)
    return number


def _prefix_keys(path: bytes) -> list[bytes]:
    """A hash of each prefix of a path, the empty one first."""
    running = hashlib.sha256()
    keys = [running.digest()[:DIGEST]]
    for at in range(0, len(path), DIGEST):
        running.update(path[at : at + DIGEST])
        keys.append(running.copy().digest()[:DIGEST])
    return keys


def _shard(batch: pa.RecordBatch, name: str) -> Iterator[pa.RecordBatch]:
    """The nodes of consecutive paths."""
    conv = batch.column("conv_id").to_numpy()
    lengths = pa.compute.binary_length(batch.column("path")).to_numpy().astype(np.int64) // DIGEST
    paths = batch.column("path").cast(pa.large_binary())
    offsets = np.frombuffer(paths.buffers()[1], np.int64)[paths.offset : paths.offset + len(paths) + 1]
    raw = paths.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    digests = np.ascontiguousarray(data).view(np.uint64).reshape(-1, 2)
    trie = DoubleArray(_numbered(digests), lengths)
    size_of = batch.column("sizes").flatten().to_numpy()

    states = len(trie.check)
    count, least = np.zeros(states, np.int64), np.full(states, np.iinfo(np.int64).max)
    depth_of, size, side, ends = np.zeros(states, np.int64), np.zeros(states, np.int64), np.zeros(states, np.int64), {}
    levels, last = [], len(conv) - 1
    keys = {FIRST: _prefix_keys(paths[0].as_py()), LAST: _prefix_keys(paths[last].as_py())}
    key_of: dict[int, bytes] = {}
    for depth, which, state in trie.walk():
        new = np.r_[True, state[1:] != state[:-1]]
        begin = np.flatnonzero(new)
        here = state[begin]
        levels.append(here)
        count[here] = np.diff(np.r_[begin, len(state)])
        least[here] = np.minimum.reduceat(conv[which], begin)
        depth_of[here] = depth
        if depth:
            size[here] = size_of[trie.begin[which[begin]] + depth - 1]
        for bit, row, at in ((FIRST, 0, 0), (LAST, last, -1)):
            if which[at] == row:
                side[state[at]] |= bit
                key_of[int(state[at])] = keys[bit][depth]
        done = np.flatnonzero(lengths[which] == depth)  # paths that end here, in runs of equal ones
        if len(done):
            cuts = np.flatnonzero(np.r_[True, state[done][1:] != state[done][:-1]])
            ids = conv[which[done]]
            for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(done)], strict=True):
                ends[int(state[done[lo]])] = ",".join(map(str, np.sort(ids[lo:hi]).tolist()))

    children, leaves, saved = np.zeros(states, np.int64), np.zeros(states, np.int64), np.zeros(states, np.int64)
    for here in reversed(levels):
        own = here[side[here] == 0]
        leaves[own] += children[own] == 0
        saved[own] += (count[own] - 1) * size[own]
        for total, value in ((children, 1), (leaves, leaves[own]), (saved, saved[own])):
            np.add.at(total, trie.check[own], value)

    nodes = np.concatenate(levels)
    up = trie.check[nodes]
    whole, above = side[nodes] == 0, np.where(up >= 0, side[up] != 0, False)
    text = [
        hashlib.sha256(ends[s].encode()).hexdigest() if s in ends and w else ends.get(s, NO_ENDS if w else None)
        for s, w in zip(nodes.tolist(), whole.tolist(), strict=True)
    ]
    column = lambda x: pa.array(x, pa.int64())
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([name] * len(nodes), pa.string()),
            pa.array(side[nodes], pa.int32()),
            pa.array([key_of.get(s) for s in nodes.tolist()], pa.binary()),
            pa.array([key_of.get(s) if u else None for s, u in zip(up.tolist(), above.tolist(), strict=True)], pa.binary()),
            column(depth_of[nodes]),
            column(least[nodes]),
            pa.array(least[up], pa.int64(), mask=above | (up < 0)),
            *map(column, (count[nodes], children[nodes], leaves[nodes], saved[nodes], size[nodes])),
            pa.array(text, pa.string()),
        ],
        names=[c.split()[0] for c in _SHARDS.split(", ")],
    )


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packs the paths of a partition, which are in order, into shards."""
    partition, number = TaskContext.get().partitionId(), 0
    held, turns = [], 0

    def packed() -> Iterator[pa.RecordBatch]:
        nonlocal number, held, turns
        number += 1
        one = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        held, turns = [], 0
        return _shard(one, f"{partition}.{number}")

    for batch in batches:
        sizes = pa.compute.add(pa.compute.list_value_length(batch.column("sizes")), 1)
        for part in slices(batch, sizes, SHARD_TURNS):
            held.append(part)
            turns += len(part.column("sizes").flatten()) + part.num_rows
            if turns >= SHARD_TURNS:
                yield from packed()
    if held:
        yield from packed()


_OWNED = "key binary, n_leaves long, saved_tokens long"


def _below(table: pa.Table) -> pa.Table:
    """What a shard owns in the subtree of each node on its first and last path."""
    depth, side = table["depth"].to_numpy(), table["side"].to_numpy()
    out = []
    for name in ("n_leaves", "saved_tokens"):
        value, total = table[name].to_numpy(), np.zeros(len(depth), np.int64)
        forked = 0
        for bits in (FIRST, LAST, FIRST | LAST):
            rows = np.flatnonzero(side == bits)
            rows = rows[np.argsort(-depth[rows], kind="stable")]
            total[rows] = np.cumsum(value[rows]) + (forked if bits == FIRST | LAST else 0)
            forked += int(value[rows].sum())
        out.append(pa.array(total, pa.int64()))
    return pa.table([table["key"], *out], names=["key", "n_leaves", "saved_tokens"])


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of the ends of each node, whose pieces follow each other in order."""
    key, running = None, None
    row = lambda: pa.RecordBatch.from_pydict({"key": [key], "ends_sha256": [running.hexdigest()]})
    for batch in batches:
        for k, piece in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            if k == key:
                running.update(b",")
            else:
                if key is not None:
                    yield row()
                key, running = k, hashlib.sha256()
            running.update(piece.encode())
    if key is not None:
        yield row()


def nodes(paths: DataFrame) -> DataFrame:
    """The nodes of the trie of `paths` (conv_id, path, sizes): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    partitions = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = paths.repartitionByRange(partitions, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    shards = stored(ordered.select("conv_id", "path", "sizes").mapInArrow(tidied(_shards), _SHARDS))
    upper = shards.filter("side != 0")
    merged = upper.groupBy("key").agg(
        *(F.min(c).alias(c) for c in ("depth", "parent_key", "conv_id", "size")),
        F.min("shard").alias("owner"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children")),
    )
    merged = stored(merged)
    inner = merged.filter("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("n_upper"))
    merged = merged.join(inner, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("n_upper", F.lit(0)))
    mine = F.when(F.col("shard") == F.col("owner"), 1).otherwise(0)
    known = merged.select("key", "owner", F.col("n_children").alias("children"), F.col("n_convs").alias("members"))
    held = upper.join(known, "key").select(
        "shard",
        "side",
        "depth",
        "key",
        (F.col("n_leaves") + mine * (F.col("children") == 0).cast("long")).alias("n_leaves"),
        (F.col("saved_tokens") + mine * (F.col("members") - 1) * F.col("size")).alias("saved_tokens"),
    )
    below = held.groupBy("shard").applyInArrow(_below, _OWNED).groupBy("key").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    pieces = upper.filter("ends IS NOT NULL").select("key", F.expr("cast(split_part(ends, ',', 1) as bigint)").alias("first"), "ends")
    digests = pieces.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_end_digests, "key binary, ends_sha256 string")
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("upper_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    top = (
        merged.join(below, "key")
        .join(digests, "key", "left")
        .join(parents, "parent_key", "left")
        .withColumns({"parent_conv_id": F.col("upper_conv_id"), "ends_sha256": F.coalesce("ends_sha256", F.lit(NO_ENDS))})
    )
    rest = (
        shards.filter("side = 0")
        .withColumnRenamed("ends", "ends_sha256")
        .join(parents, "parent_key", "left")
        .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "upper_conv_id"))
    )
    return top.select(columns).unionByName(rest.select(columns))


def trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the prefix trie of all rebuilt conversations."""
    return nodes(rebuilt(conversations))


#: The same in SQL. The inner lists compute crc32 byte by byte, bit by bit.
ORACLE = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, text) AS turns FROM turns GROUP BY conv_id),
shared AS (
  SELECT conv_id, turns, conv_id - conv_id % 5 AS base,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
      lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) % 9 AS h FROM own),
rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(list_slice(b.turns, 1, h), []), list_slice(a.turns, h + 1, len(a.turns))) AS path
  FROM shared a LEFT JOIN own b ON b.conv_id = a.base),
members AS (
  SELECT conv_id, len(path) AS n, unnest(range(len(path) + 1)) AS depth, path FROM rebuilt),
prefixes AS (SELECT conv_id, n, depth, list_slice(path, 1, depth) AS prefix FROM members),
nodes AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
  FROM prefixes GROUP BY depth, prefix),
linked AS (
  SELECT a.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.depth = a.depth + 1 AND list_slice(c.prefix, 1, a.depth) = a.prefix) AS n_children
  FROM nodes a LEFT JOIN nodes p ON p.depth = a.depth - 1 AND p.prefix = list_slice(a.prefix, 1, a.depth - 1)),
above AS (
  SELECT unnest(range(depth + 1)) AS top, prefix, (n_children = 0)::BIGINT AS leaf,
    CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(prefix[depth].text) END AS saved FROM linked),
sums AS (
  SELECT top AS depth, list_slice(prefix, 1, top) AS prefix, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM above GROUP BY ALL)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM linked JOIN sums USING (depth, prefix)
"""
