import random

import numpy as np

from lmplake.llm import common
from lmplake.llm import minhash as M
from lmplake.llm.common import mix
from tests.llm.brute import near_classes, shingle_bag, weighted_jaccard

SCHEMA = "doc_id long, text string, class_id string"  # a column that clashes with an output


def corpus(seed=1):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(40):
        words = [rng.choice(vocab) for _ in range(rng.randrange(3, 120))]
        rows.append(" ".join(words))
        for _ in range(rng.randrange(0, 4)):
            w = words[:]
            for _ in range(rng.randrange(0, max(1, len(w) // 14))):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((" ".join(w)).upper() if rng.random() < 0.2 else " ".join(w))
    rows += ["", None, "  \n", "", "one two", "one two", "x " * 300, "x " * 310, "word " * 20_000]
    rng.shuffle(rows)
    return [(i, t, "x") for i, t in enumerate(rows)]


def got(df):
    return sorted((r["doc_id"] is None, r["doc_id"], r["class_id"], r["kept"]) for r in df.collect())


def test_equals_brute_force(frame):
    rows = corpus()
    want = near_classes([(a, b) for a, b, _ in rows])
    out = got(M.near_duplicates(frame(rows, SCHEMA)))
    assert out == sorted((False, k, c, k == c) for k, c in want.items())


def test_blocks_change_nothing(frame, monkeypatch):
    rows = corpus(2)
    want = near_classes([(a, b) for a, b, _ in rows])
    monkeypatch.setattr(M, "BLOCK_ROWS", 2)
    monkeypatch.setattr(M, "BLOCK_BYTES", 900)
    out = got(M.near_duplicates(frame(rows, SCHEMA)))
    assert out == sorted((False, k, c, k == c) for k, c in want.items())


def test_repeated_rows_null_keys_and_empty(frame):
    rows = [(1, "a b c d e f", ""), (1, "a b c d e f", ""), (None, "a b c d e f", ""), (0, "a b c d e f", ""), (7, None, "")]
    out = got(M.near_duplicates(frame(rows, SCHEMA)))
    assert out == sorted([(False, 1, 0, False), (False, 1, 0, False), (True, None, None, True), (False, 0, 0, True), (False, 7, 7, True)],
                         key=lambda r: (r[0], r[1] or 0))
    assert M.near_duplicates(frame([], SCHEMA)).collect() == []


def test_coordinates_agree_as_often_as_sets_overlap():
    rng = np.random.default_rng(5)
    a = {int(i): int(c) for i, c in zip(rng.choice(10_000, 300, replace=False), rng.integers(1, 9, 300))}
    b = dict(a)
    for i in list(a)[:60]:
        b[i] = int(rng.integers(1, 9))
    for i in range(40):
        b[20_000 + i] = int(rng.integers(1, 5))
    true = sum(min(a[i], b.get(i, 0)) for i in a) / sum(max(a.get(i, 0), b.get(i, 0)) for i in a | b)
    rows = [(0, i, c) for i, c in a.items()] + [(1, i, c) for i, c in b.items()]
    agree = []
    for seed in range(20):
        item = mix(np.array([i for _, i, _ in rows], np.uint64) + np.uint64(seed << 32))
        s = M.dart_minhash(np.array([r for r, _, _ in rows]), item, np.array([c for _, _, c in rows], float), 2, 256)
        agree.append((s[0] == s[1]).mean())
    assert abs(np.mean(agree) - true) < 0.02


def test_exact_similarity():
    texts = ["a b c d e f g h a b c d e", "a b c d e f g h i j", "A b c d e"]
    from lmplake.llm.common import utf8
    import pyarrow as pa
    r, g, c = M.shingles(*utf8(pa.array([t.lower() for t in texts])))
    bags = [shingle_bag(t) for t in texts]
    for threshold in (0.05, 0.1, 0.2, 0.4, 0.9):
        m = M.similar(r, g, c, 3, threshold)
        for i in range(3):
            for j in range(i):
                assert m[i, j] == (weighted_jaccard(bags[i], bags[j]) >= threshold)


def thue_morse(n=1024):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_texts_whose_polynomial_hashes_are_equal(frame):
    """The pattern and its complement collide in every polynomial modulo 2^64."""
    one = thue_morse()
    two = one.translate(str.maketrans("ab", "ba"))
    raw = np.frombuffer((one + two).encode(), np.uint8)
    assert len(set(common.span_hash(common.prefix_hash(raw), np.array([0, 1024]), np.array([1024, 2048])).tolist())) == 1
    assert len(set(common.word_hash(raw, np.array([0, 1024]), np.array([1024, 2048])).tolist())) == 2
    rows = [(1, one), (2, two), (3, one)]
    got = {r["doc_id"]: r["class_id"] for r in M.near_duplicates(frame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 1}
