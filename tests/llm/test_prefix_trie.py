import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lmplake.llm import common, listrank, prefix_trie as T
from lmplake.llm import queries as Q

SCHEMA = "conv_id long, turn long, role string, text string, conv string, pos long, n long, s1 long, depth long"


def rebuilt(rows):
    convs = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            sha = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs.setdefault(c, []).append((turn is not None, turn or 0, sha, role, text))
    convs = {c: [x[3:] for x in sorted(t)] for c, t in convs.items()}
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def brute(convs):
    """Nodes of the trie by plain recursion over prefixes."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    rows = {}
    for node in sorted(members, key=len, reverse=True):
        kids = [k for k in rows if k[:-1] == node and len(k) == len(node) + 1]
        ends = sorted(c for c in members[node] if len(convs[c]) == len(node))
        saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        rows[node] = [min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(kids),
                      sum(rows[k][5] for k in kids) or 1, saved + sum(rows[k][6] for k in kids),
                      hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()]
    return sorted(map(tuple, rows.values()), key=lambda r: (r[0], r[1]))


def conversations(n=60, seed=3):
    rng = random.Random(seed)
    heads = [[(("user", "assistant")[i % 2], f"turn {h} {i} é") for i in range(9)] for h in range(3)]
    rows = []
    for c in range(n):
        turns = rng.choice(heads)[:rng.randrange(0, 9)] + [(rng.choice(["user", None]), rng.choice(["a", "b", None, ""])) for _ in range(rng.randrange(0, 4))]
        rows += [(c, None if i == 0 and rng.random() < 0.1 else i, r, t, "x", 1, 2, 3, 4) for i, (r, t) in enumerate(turns)]
    rows += [(500, i, "user", "one very long conversation", "x", 1, 2, 3, 4) for i in range(len(rows) // 2)]
    rows += [(501, 1, "user", "t" * 300_000, "", 0, 0, 0, 0), (501, 1, "user", "same turn", "", 0, 0, 0, 0), (501, 1, "user", "same turn", "", 0, 0, 0, 0),
             (None, 1, "user", "no conversation", "", 0, 0, 0, 0)]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_trie_equals_brute_force(frame, monkeypatch, small):
    if small:  # many ranges, bins, blocks and levels
        monkeypatch.setattr(common, "RANGE_ROWS", 40)
        monkeypatch.setattr(T, "BIN", 8)
        monkeypatch.setattr(listrank.rank, "__defaults__", (64,))
    rows = conversations()
    got = Q.prefix_trie_of(frame(rows, SCHEMA)).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: (r[0], r[1])) == brute(rebuilt(rows))


def test_empty_table_and_turnless_conversations(frame):
    assert Q.prefix_trie_of(frame([], SCHEMA)).collect() == []
    # conversation 6 loses its only turn and has no conversation to borrow from
    assert zlib.crc32(b"6") % 9 > 0
    got = [tuple(r) for r in Q.prefix_trie_of(frame([(6, 0, "user", "x", "", 0, 0, 0, 0)], SCHEMA)).collect()]
    assert got == [(6, 0, None, 1, 0, 1, 0, hashlib.sha256(b"6").hexdigest())]


@pytest.mark.parametrize("order", ["sorted", "random"])
def test_list_rank(spark, order):
    n = 3000
    perm = np.arange(n) if order == "sorted" else np.random.default_rng(1).permutation(n)
    rows = [(int(perm[i]), int(perm[i + 1]) if i + 1 < n else -1) for i in range(n)]
    got = {r["id"]: r["pos"] for r in listrank.rank(spark.createDataFrame(rows, "id long, succ long").repartition(3), block=128).collect()}
    assert got == {int(p): i for i, p in enumerate(perm)}


def test_modular_arithmetic():
    rng = np.random.default_rng(5)
    a, b = (rng.integers(0, T.P61, 500, dtype=np.uint64) for _ in range(2))
    a[:2], b[:2] = T.P61 - 1, T.P61 - 1
    assert T.mulmod(a, b).tolist() == [int(x) * int(y) % T.P61 for x, y in zip(a, b)]
    assert T.powmod(T.BASES[0], np.arange(40)).tolist() == [pow(T.BASES[0], i, T.P61) for i in range(40)]
    assert T.running(a).tolist() == [sum(map(int, a[:i + 1])) % T.P61 for i in range(len(a))]


def test_equal_names_of_different_turns_fail(spark):
    rows = [(1, 1, "aa", 1, True, 5, 5, 0, 0), (2, 1, "bb", 1, True, 5, 5, 0, 0)]
    named = spark.createDataFrame(rows, "conv long, depth long, turn_sha string, n_bytes long, is_end boolean, s1 long, s2 long, p1 long, p2 long")
    convs = spark.createDataFrame([(1, 1), (2, 1)], "conv long, n long")
    with pytest.raises(Exception, match="one name"):
        T._nodes(named, convs).agg(F.sum("depth")).collect()
