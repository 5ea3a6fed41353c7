"""The prefix trie of conversations, against a plain version and SQL."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np

from carledger.llm import turntrie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = abs(c) // 5 * 5 * (1 if c >= 0 else -1)
        paths[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in sorted(paths):
        ends[paths[c]].append(c)
        for d in range(len(paths[c]) + 1):
            members[paths[c][:d]].append(c)
            if d:
                children[paths[c][: d - 1]].add(paths[c][:d])
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
    sha = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    return sorted(
        (m[0], len(k), members[k[:-1]][0] if k else -1, len(m), len(children[k]), leaves[k], saved[k], sha(ends[k])) for k, m in members.items()
    )


def talks(n, seed=2, longest=12):
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(-n, 3 * n), n):
        for turn in range(draw.choice([1, 2, 4, longest])):
            rows.append((c, turn, draw.choice(["user", "user", None]), draw.choice(["a", "a", "a", "é", None, "", "long " * 30])))
    rows += [(c, t, "user", "the same") for c in range(4 * n, 5 * n) for t in range(3)]  # one conversation in a third of all
    rows += [(None, 1, "user", "lost"), (7 * n, None, None, None), (7 * n, 2, "x", "y"), (7 * n, 2, "x", "y")]
    rows += [(9 * n, t, "user", f"step {t % 7}") for t in range(900)]
    return rows


def found(spark, rows):
    conversations = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", depth int")
    return sorted(tuple(-1 if x is None else x for x in r) for r in turntrie.trie(conversations).collect())


def test_equals_plain_version(spark, monkeypatch):
    rows = talks(150)
    want = plain(rows)
    assert found(spark, rows) == want
    for turns in (1, 7, 100):  # shards of one path, and of few
        monkeypatch.setattr(turntrie, "SHARD_TURNS", turns)
        assert found(spark, rows) == want


def test_only_turnless_conversations(spark):
    rows = [(c, 0, "u", "x") for c in range(1, 300) if c % 5 and zlib.crc32(str(c).encode()) % 9]
    (root,) = found(spark, rows)
    assert root[:7] == (rows[0][0], 0, -1, len(rows), 0, 1, 0)
    assert root[7] == hashlib.sha256(",".join(str(r[0]) for r in rows).encode()).hexdigest()


def test_empty_table(spark):
    assert found(spark, []) == [] and found(spark, [(None, 1, "u", "x")]) == []


def test_double_array_leads_each_path_to_its_own_state():
    draw = random.Random(4)
    paths = sorted({tuple(draw.randint(0, 30) for _ in range(draw.randint(0, 6))) for _ in range(500)})
    lengths = np.array([len(p) for p in paths])
    array = turntrie.DoubleArray(np.array([c for p in paths for c in p]), lengths)
    prefixes = {}
    for depth, which, state in array.walk():
        for i, s in zip(which.tolist(), state.tolist(), strict=True):
            assert prefixes.setdefault(s, paths[i][:depth]) == paths[i][:depth]
    assert len(prefixes) == len({p[:d] for p in paths for d in range(len(p) + 1)})


def test_equals_sql(spark, duck, sf_dir):
    rows = turntrie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet")).collect()
    want = duck.execute(turntrie.ORACLE).fetchall()
    key = lambda r: (r[1], r[0])
    assert sorted(map(tuple, rows), key=key) == sorted(want, key=key)
