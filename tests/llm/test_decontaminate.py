import random

import pytest

from lmplake.llm import decontaminate as D
from tests.llm.brute import edit_distance_inside


def words(rng, n):
    return [rng.choice(["the", "of", "and", "to"]) if rng.random() < 0.3 else
            "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9))) for _ in range(n)]


def setup(seed=1, edits=0):
    rng = random.Random(seed)
    items = [(i, " ".join(words(rng, rng.randrange(14, 50)))) for i in range(12)] + [(20, "Short item here ok"), (21, None), (22, " "), (23, "a")]
    rows, planted = [], set()
    for i in range(80):
        w = words(rng, rng.randrange(0, 120))
        if i % 4 == 0:
            k = rng.randrange(12)
            p = items[k][1].split()
            for _ in range(edits):
                p[rng.randrange(len(p))] = rng.choice(["xx", "replaced"])
            at = rng.randrange(len(w) + 1)
            w[at:at] = ["\n".join(p).upper() if i % 8 else " ".join(p)]
        rows.append((i, " ".join(w), "z"))
    return items, rows + [(100, None, "z"), (101, "", "z"), (None, items[2][1], "z"), (102, items[4][1], "z"), (102, items[4][1], "z"),
                          (103, items[5][1] + " pad " * 30_000 + items[6][1] + " " + items[5][1], "z")]


def truth(items, rows, max_edit=0.1):
    out = set()
    for n, (_, t, _) in enumerate(rows):
        flat = " ".join((t or "").lower().split())
        flat = flat if len(flat) < 50_000 else flat[:2_000] + flat[-2_000:]
        for i, x in items:
            item = " ".join((x or "").lower().split())
            if item and len(item) > 1 and edit_distance_inside(item, flat) <= max_edit * len(item):
                out.add((n, i))
    return out


def found(frame, items, rows):
    df = frame([(n, *r) for n, r in enumerate(rows)], "n int, doc_id long, text string, item_id string")
    out = D.scan(df, frame(items, "item_id long, text string")).collect()
    assert len(out) == len(rows)
    return {(r["n"], x["item_id"]) for r in out for x in r["leaks"] if x["item_id"] != 23}, out


def test_verbatim_passages_are_all_found(frame):
    items, rows = setup()
    got, out = found(frame, items, rows)
    assert got == truth(items, rows)
    for r in out:
        for x in r["leaks"]:
            assert x["distance"] == 0
            w = (r["text"] or "").lower().split()
            assert " ".join(w[x["word_start"]:x["word_end"]]) == " ".join(dict(items)[x["item_id"]].lower().split())


def test_edited_passages_recall(frame):
    hit = total = 0
    for seed in (2, 3):
        items, rows = setup(seed, edits=1)
        got, _ = found(frame, items, rows)
        want = truth(items, rows)
        assert got <= want
        hit, total = hit + len(got), total + len(want)
    assert hit >= 0.9 * total > 0


def test_exact_distance():
    rng = random.Random(5)
    for _ in range(200):
        a, b = ("".join(rng.choice("abé ") for _ in range(rng.randrange(1, n))) for n in (9, 25))
        d, x, y = D.edit_within(a, b)
        assert d == edit_distance_inside(a, b)
        assert d == min(edit_distance_inside(a, b[x:y]), len(a))


def test_empty_and_clash(frame):
    items, rows = setup()
    schema = "doc_id long, text string, leaks string"
    with pytest.raises(ValueError):
        D.scan(frame(rows, schema), frame(items, "item_id long, text string"))
    assert D.scan(frame([], "doc_id long, text string"), frame(items, "item_id long, text string")).collect() == []
    assert {tuple(r["leaks"]) for r in D.scan(frame([(1, "a b")], "doc_id long, text string"),
                                              frame([], "item_id long, text string")).collect()} == {()}


def near(items, rows):
    flat = [" ".join(t.split()) for _, t, _ in rows]
    return {(n, i) for n, f in enumerate(flat) for i, x in items if D.edit_within(x, f)[0] <= 0.1 * len(x)}


def test_edits_of_the_first_words_lose_nothing(frame):
    rng = random.Random(7)
    items = [(i, " ".join(words(rng, n))) for i, n in enumerate([20, 30, 60, 120])]
    rows = []
    for i, (_, t) in enumerate(items):
        for head in ([], ["xx", "replaced"], ["q"], ["a", "b", "c"]):
            rows.append((i, " ".join([*words(rng, 30), *head, *t.split()[2:], *words(rng, 30)]), "z"))
    got, _ = found(frame, items, rows)
    want = near(items, rows)
    assert got == want and len(want) >= 12


def test_character_edits_up_to_the_limit_lose_nothing(frame):
    rng = random.Random(9)
    items = [(i, " ".join(words(rng, n))) for i, n in enumerate([2, 3, 5, 8, 11, 12, 20, 50, 90])]
    rows = []
    for i, (_, t) in enumerate(items):
        for kind in ("spread", "spread", "mixed", "mixed"):
            left, k = list(t), int(0.1 * len(t))
            for at in sorted(rng.sample(range(len(left)), k), reverse=True):
                how = "sub" if kind == "spread" else rng.choice(["sub", "ins", "del"])
                left[at:at + 1] = {"sub": "z", "ins": left[at] + "é", "del": ""}[how]
            rows.append((i, " ".join([*words(rng, 20), "".join(left), *words(rng, 20)]), "z"))
    got, _ = found(frame, items, rows)
    want = near(items, rows)
    assert got == want and len(want) >= 4 * len(items)
