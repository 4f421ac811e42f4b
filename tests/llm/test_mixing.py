import random
from fractions import Fraction

import numpy as np
import pytest

from lmplake.llm import mixing as X
from lmplake.llm.feistel import permute


def shares(sizes, weights, most):
    """Targets by the contract's words, in fractions: 100% by weight; whoever is above its limit stops there, the
    excess is shared again by weight until nobody is above."""
    target, free, left = [Fraction(0)] * len(sizes), set(range(len(sizes))), Fraction(sum(sizes))
    while free:
        weight = sum(weights[i] for i in free)
        for i in free:
            target[i] = left * weights[i] / weight
        over = {i for i in free if target[i] > most * sizes[i]}
        if not over:
            break
        for i in over:
            target[i] = Fraction(most * sizes[i])
            left -= target[i]
        free -= over
    return target


def test_targets_follow_the_words_of_the_contract():
    rng = random.Random(8)
    for _ in range(300):
        sizes = [rng.choice([0, 1, 2, rng.randrange(10), rng.randrange(10 ** 6)]) for _ in range(rng.randrange(1, 9))]
        weights = [1 + i % 3 for i in range(len(sizes))]
        want = shares(sizes, weights, 3)
        assert X.water_fill(sizes, weights, 3) == pytest.approx([float(t) for t in want], rel=1e-9, abs=1e-9), sizes


def test_water_fill():
    assert X.water_fill([10, 10], [1, 1], 3) == [10, 10]
    t = X.water_fill([100, 2, 50], [1, 2, 3], 3)
    assert t[1] == 6 and sum(t) == pytest.approx(152) and t[2] == pytest.approx(109.5)
    assert X.water_fill([0, 5], [1, 1], 3) == [0, 5]
    assert X.water_fill([], [], 3) == []


def test_tree_keeps_quotas():
    q = np.array([7, 0, 1000, 33])
    out = X.split_tree(q, 8, 3)
    assert (out.sum(axis=0) == q).all() and out.sum(axis=1).max() - out.sum(axis=1).min() <= 3
    assert (out >= 0).all() and (out == X.split_tree(q, 8, 3)).all()


def test_feistel_is_a_permutation():
    for n in (1, 2, 3, 17, 1024, 1025):
        assert sorted(permute(np.arange(n), n, 5).tolist()) == list(range(n))
    many = permute(np.tile(np.arange(6), 2), np.full(12, 6), np.repeat([1, 2], 6))
    assert sorted(many[:6]) == sorted(many[6:]) == list(range(6))


def rows(seed=2):
    rng = random.Random(seed)
    out = []
    for i in range(300):
        s = rng.choices(["é", "a", "z", None, "b"], [100, 5, 30, 10, 60])[0]
        text = rng.choices([None, "", " ".join("w" * rng.randrange(1, 5) for _ in range(rng.randrange(1, 60)))], [1, 1, 30])[0]
        out.append((i, text, s, "x"))
    return out + [(5, "same row", "a", "x")] * 3 + [(None, "no key", None, "x"), (700, "w " * 30_000, "b", "x")]


def test_targets_and_takes(frame):
    data = rows()
    df = frame(data, "doc_id long, text string, source string, draw string")
    mixed = X.mix_sources(df, ["doc_id", "source", "text", "draw"], block_words=40)
    out = mixed.collect()
    assert len(out) == len(data)
    again = X.mix_sources(df.repartition(7), ["doc_id", "source", "text"], block_words=40, keep_sizes=False).collect()
    key = lambda r: (str(r["doc_id"]), r["text"] or "", str(sorted(map(tuple, r["draws"]))))
    assert sorted(map(key, out)) == sorted(map(key, again))
    size = {}
    for _, t, s, _ in data:
        size[s] = size.get(s, 0) + len((t or "").split())
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    target = dict(zip(order, map(float, shares([size[s] for s in order], [1 + i % 3 for i in range(len(order))], 3))))
    taken = dict.fromkeys(order, 0)
    draws = {}
    for r in out:
        assert r["size"] == len((r["text"] or "").split()) and r["source_size"] == size[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        words = sum(d["words"] for d in r["draws"])
        assert words <= 3 * r["size"]
        taken[r["source"]] += words
        for d in r["draws"]:
            assert 0 <= d["shard"] < X.N_SHARDS
            draws.setdefault((r["source"], d["draw"]), set()).add(d["shard"])
    for s in order:
        assert abs(taken[s] - target[s]) <= 0.5 + 1e-6
    assert all(len(v) == 1 for v in draws.values())  # a block goes to one shard
    texts = X.mixed_texts(mixed).collect()
    assert sum(len(r["text"].split()) for r in texts) == sum(taken.values())


def test_empty(frame):
    assert X.mix_sources(frame([], "doc_id long, text string, source string"), ["doc_id"]).collect() == []
    with pytest.raises(ValueError):
        X.mix_sources(frame([(1, "a", "b", 1)], "doc_id long, text string, source string, size long"), ["size"])
