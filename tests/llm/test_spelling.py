import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lmplake.llm import queries as Q
from lmplake.llm import spelling as S

SCHEMA = "doc_id long, text string, word string, n long, id long, run string, root string"


def brute_words(rows):
    c = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            c[w] += 1
    return {w: n for w, n in c.items() if len(w) >= 7 and n >= 2}


def brute_groups(counts):
    words = sorted(counts)
    near = {w: [v for v in words if S.one_edit(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, counts[w], len(near[w]), form[w], counts[form[w]] if form[w] else None, root(w)) for w in words)


def edited(rng, w, letters):
    i = rng.randrange(len(w))
    return rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1:]])


def vocabulary(seed, n=250, letters="abé", long=True):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(6, 13))) for _ in range(n)}
    words |= {edited(rng, w, letters) for w in list(words)} | {edited(rng, edited(rng, w, letters), letters) for w in list(words)[:60]}
    words |= {"a" * k for k in range(7, 14)}
    if long:
        words |= {"ab" * 32, "ab" * 32 + "a", "ab" * 31 + "a" + "bb", "ba" * 400, "ba" * 399 + "b", "ba" * 200 + "é" + "ba" * 200}
    return sorted(words)


def test_one_edit():
    def table(a, b):
        cost = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(cost[j] + 1, new[-1] + 1, cost[j - 1] + (x != y)))
            cost = new
        return cost[-1]

    words = vocabulary(1, 40, "ab", long=False)
    for a in words:
        for b in words:
            assert S.one_edit(a, b) == (table(a, b) == 1)
    long = words + ["ab" * 32, "ab" * 32 + "a", "ba" * 100, "ba" * 100 + "b", "aaaaaaü", "aaaaaaž"]
    i, j = (x.ravel() for x in np.indices((len(long), len(long))))
    assert S.near_pairs(long, i, j).tolist() == [S.one_edit(long[x], long[y]) for x, y in zip(i, j)]


@pytest.mark.parametrize("tau", [0, 3, 20, 10_000])
def test_an_edit_takes_no_more_grams_than_the_bound(tau):
    """Also that the first affected + 1 lists of two near words meet, for every edit of every word."""
    rng = random.Random(tau)
    letters = "abc"
    words = vocabulary(tau, 150, letters, long=False)
    near = {edited(rng, w, letters) for w in words for _ in range(6)}
    everything = sorted(set(words) | near)
    counts = Counter(f"{S.START}{w}{S.END}"[p:p + q] for w in everything for q in range(3, 9) for p in range(len(w) + 3 - q))
    frequent = {g for g, n in counts.items() if n > tau}
    grams = {w: Counter(f"{S.START}{w}{S.END}"[p:e] for p, e in S.decompose(f"{S.START}{w}{S.END}", frequent)) for w in everything}
    bound = {w: S.affected(s := f"{S.START}{w}{S.END}", S.decompose(s, frequent), frequent) for w in everything}
    lists = {w: set(S.tokens(w, frequent)) for w in everything}
    pairs = [(a, b) for i, a in enumerate(everything) for b in everything[:i] if S.one_edit(a, b)]
    assert len(pairs) > 500
    for a, b in pairs:
        common = sum((grams[a] & grams[b]).values())
        assert common >= max(sum(grams[a].values()) - bound[a], sum(grams[b].values()) - bound[b])
        assert lists[a] & lists[b]


@pytest.mark.parametrize("tau,most,list_rows", [(64, 1 << 17, 2048), (2, 1 << 17, 16), (0, 1 << 17, 2048), (2, 40, 7)])
def test_groups_equal_brute_force(frame, monkeypatch, tau, most, list_rows):
    monkeypatch.setattr(S, "PAIRS", 500)
    rng = random.Random(tau + most)
    counts = {w: rng.choice([2, 2, 3, 20, 30, 300, 4000]) for w in vocabulary(tau + 7)}
    counts["ž" * 9], counts["ž" * 8 + "š"] = 2, 30
    got = S.group(frame([(w, n, "x") for w, n in counts.items()], "word string, n long, form string"), tau=tau, most=most, list_rows=list_rows)
    assert sorted(map(tuple, got.collect())) == brute_groups(counts)


def test_query_over_texts(frame):
    rng = random.Random(9)
    words = vocabulary(11, 60, "abÀé") + ["short", "Xyzzyxx", "ABCDEFG", "abcdefg"]
    rows = [(i, " ".join(rng.choice(words[:1 + i % len(words)]) for _ in range(60)) + "-ABCDEFG_ÀÉabcde1", "", 1, 1, "", "") for i in range(80)]
    rows += [(None, " ".join(words), "", 1, 1, "", ""), (900, None, "", 1, 1, "", ""), (901, "", "", 1, 1, "", ""), (5, rows[5][1], "", 1, 1, "", "")]
    rows.append((902, "abcdefgh " * 20_000 + "x" * 3000, "", 1, 1, "", ""))
    counts = brute_words(rows)
    got = sorted(map(tuple, Q.spelling_groups_of(frame(rows, SCHEMA)).collect()))
    assert got == brute_groups(counts)
    assert any(r[3] for r in got)


def test_chains_of_forms_and_empty_tables(frame):
    counts = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2000, "zzzzzzz": 5}
    got = sorted(map(tuple, S.group(frame(list(counts.items()), "word string, n long")).collect()))
    assert got == brute_groups(counts) and got[0][-1] == "aaaabbb"
    assert S.group(frame([], "word string, n long")).collect() == []
    assert Q.spelling_groups_of(frame([], SCHEMA)).collect() == []
