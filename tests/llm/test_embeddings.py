import math

import numpy as np

from lmplake.llm import embeddings as E
from tests.llm.brute import union_find

SCHEMA = "vec_id long, embedding array<float>, n_links int"


def vectors(seed=3, n=400, d=16):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, d))
    rows = [*base]
    for i in range(25):
        for _ in range(rng.integers(1, 6)):
            rows.append(base[i] + rng.normal(size=d) * rng.choice([0.01, 0.1, 0.2, 0.3]))
    rows += [base[0], base[0], 3 * base[1]]
    return [np.asarray(r, np.float32).tolist() for r in rows]


def brute(rows, threshold=0.95):
    good = [(k, np.array(v, np.float64)) for k, v, _ in rows if v is not None and len(v) == 16
            and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    x = np.array([v / np.linalg.norm(v) for _, v in good])
    c = x @ x.T >= threshold
    np.fill_diagonal(c, False)
    keys = [k for k, _ in good]
    group = union_find([(keys[i], keys[j]) for i, j in zip(*np.nonzero(c))], {k for k, _, _ in rows})
    return dict(zip(keys, c.sum(axis=1).tolist())), group


def table():
    rows = [(i * 2, v, 0) for i, v in enumerate(vectors())]
    k = rows[0][1]
    return rows + [(9001, None, 0), (9002, [0.0] * 16, 0), (9003, [float("nan"), *k[1:]], 0), (9004, [None, *k[1:]], 0),
                   (9005, k[:8], 0), (9006, [], 0), (9007, [float("inf"), *k[1:]], 0), (9008, [None, *k[1:]], 0)]


def check(rows, out):
    links, group = brute(rows)
    assert len(out) == len(rows)
    for r in out:
        assert (r["n_links"], r["component_id"]) == (links.get(r["vec_id"], 0), group[r["vec_id"]]), r
        assert r["kept"] == (r["vec_id"] == r["component_id"])


def test_equals_brute_force(frame):
    rows = table()
    out = E.near_duplicates(frame(rows, SCHEMA), recall=0.9999).collect()
    check(rows, out)


def test_recall_at_production_parameters(frame):
    rows = table()
    links, _ = brute(rows)
    out = E.near_duplicates(frame(rows, SCHEMA)).collect()
    found = sum(r["n_links"] for r in out)
    assert 0.9 * sum(links.values()) <= found <= sum(links.values())
    assert all(r["n_links"] <= links.get(r["vec_id"], 0) for r in out)


def test_blocks_change_nothing(frame, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", 3)
    monkeypatch.setattr(E, "SMALL", 2)
    rows = table()
    check(rows, E.near_duplicates(frame(rows, SCHEMA), recall=0.9999).collect())


def test_null_and_repeated_ids_and_empty(frame):
    v = [1.0] * 16
    w = [1.0] * 15 + [-9.0]
    rows = [(1, v, 0), (1, v, 0), (None, v, 0), (5, w, 0)]
    out = {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in E.near_duplicates(frame(rows, SCHEMA)).collect()}
    assert out == {(1, 2, 1, True), (None, 2, None, False), (5, 0, 5, True)}
    zero = [(1, [0.0, 1.0], 0), (2, [-0.0, 1.0], 0)]
    assert {(r["n_links"], r["component_id"]) for r in E.near_duplicates(frame(zero, SCHEMA)).collect()} == {(1, 1)}
    assert E.near_duplicates(frame([], SCHEMA)).collect() == []
    assert [r["kept"] for r in E.near_duplicates(frame([(4, None, 0)], SCHEMA)).collect()] == [True]


def test_each_length_links_its_own(frame):
    rng = np.random.default_rng(6)
    base = [rng.normal(size=16) for _ in range(60)] + [rng.normal(size=24) for _ in range(40)]
    rows = [(i, np.asarray(v, np.float32).tolist(), 0) for i, v in enumerate(base)]
    rows += [(1000 + i, np.asarray(v + rng.normal(size=len(v)) * 0.01, np.float32).tolist(), 0) for i, v in enumerate(base) if i % 2]
    rows += [(2000, rows[70][1], 0), (2001, [1.0, 2.0], 0), (2002, [1.0, 2.0], 0), (2003, [3.0], 0)]
    out = {r["vec_id"]: r for r in E.near_duplicates(frame(rows, SCHEMA), recall=0.9999).collect()}
    assert len(out) == len(rows)
    for i in range(100):
        assert out[i]["n_links"] == (i % 2) + (i == 70), i
        if i % 2:
            assert out[1000 + i]["component_id"] == i and out[1000 + i]["n_links"] == 1
    assert out[2000]["component_id"] == 70 and out[2002]["component_id"] == 2001 and out[2003]["n_links"] == 0
