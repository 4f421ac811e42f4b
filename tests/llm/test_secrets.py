import hashlib
import re

import pytest

from lmplake.llm import secrets as S

CASES = [
    ('PREFIX = "abcd1234"\npart = "Zx9!efgh"\ndb_password = PREFIX + part', {"abcd1234", "Zx9!efgh"}),
    ("<password>hunter2hunter2!</password>", {"hunter2hunter2!"}),
    ('{"api-key": "Ab3dEf6hIj"}', {"Ab3dEf6hIj"}),
    ("export DB_PASS=s3cr3tpassw0rd", {"s3cr3tpassw0rd"}),
    ('<add key="ApiKey" value="qwe987RTY654"/>', {"qwe987RTY654"}),
    ('a = "k9X2mQ7z"\nb = a\nc = b\nprivateKey = c', {"k9X2mQ7z"}),
    ('signing_key := "Qw3rTy9uIo"', {"Qw3rTy9uIo"}),
    ('title = "a long quiet evening"', set()),
    ('password = "changeme"', set()),
    ('key_file = "/etc/keys/server01"', set()),
    ("the token is here: nothing follows", set()),
    ("", set()),
]


def plain(text):
    out = []
    for m in re.finditer(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[1]) >= 8:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


@pytest.mark.parametrize("text,found", CASES)
def test_lexer(text, found):
    base, spans = S.spans_of(text)
    assert {text[a:b] for a, k, b in spans if k == 3} >= found
    if not found:
        assert not [x for x in spans if x[1] == 3]
    assert set(base) <= set(spans)


def test_base_spans_are_those_of_the_patterns():
    texts = ["token=api_key:longvalue12", "TOKEN = 'abcdefgh'", "tokenſecret: abcdefgh1", "AKIA" + "A1" * 6, "AKIAAKIA" + "Z" * 7,
             "é" * 9 + 'passwd":  "xY12345678"', "f" * 31, "0" * 32 + "g" + "a" * 40, "secret:secret:secret=aaaaaaaa", "api_key=1234567",
             "ſecret=abcdefgh", "toKen=abcdefgh"]
    for t in texts:
        assert S.base_spans(t) == plain(t)


def test_scan(frame):
    rows = [(1, "x token = abcdefghij", "q"), (2, None, "q"), (3, "", "q"), (None, "AKIA" + "B" * 16, None), (1, "x token = abcdefghij", "q"),
            (4, "lorem ipsum " * 30_000 + 'db_password = "Aa1!Bb2@Cc3#"', "q")]
    df = frame(rows, "doc_id long, text string, q string")
    out = S.scan(df).collect()
    assert len(out) == len(rows)
    for r in out:
        base = plain(r["text"] or "")
        listing = ",".join(f"{S.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert r["base_sha256"] == hashlib.sha256(listing.encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == i for _, k, _ in base) for i in range(3))
        if r["doc_id"] == 4:
            assert r["n_literal"] == 1 and r["spans"].startswith("literal:360")
    assert S.scan(frame([], "doc_id long, text string")).collect() == []
    with pytest.raises(ValueError):
        S.scan(frame([(1, "a", "b")], "doc_id long, text string, spans string"))


def test_lexing_is_linear_in_hostile_text():
    import time
    for t in ("a." * 60_000, "x=" * 60_000, 'k="' * 40_000, "<a>" * 40_000, "a = a + a\n" * 5_000,
              'a0 = "Ab3"\n' + "".join(f'a{i} = a{i - 1} + "x{i % 7}"\n' for i in range(1, 45_000)),
              'password = "Ab3"\n' + 'password = password + "x1Y"\n' * 35_000,
              'y = "Zq8!"\ntoken0 = "Ab3"\n' + "".join(f"token{i} = y + token{i - 1} + y\n" for i in range(1, 30_000)),
              "".join(f'secret{i} = "value{i}Ab"\n' for i in range(40_000))):
        began = time.process_time()
        S.spans_of(t)
        assert time.process_time() - began < 5


def test_values_are_scored_as_they_are_joined():
    """The figures made from parts are those of the joined text, and all literals behind a value are reported."""
    rng = __import__("random").Random(3)
    text = "".join(rng.choice("abXY01 !é") for _ in range(400))
    values, full = [], []
    for _ in range(200):
        pieces, plain = [], ""
        for _ in range(rng.randrange(1, 4)):
            if values and rng.random() < 0.5:
                i = rng.randrange(len(values))
                if len(full[i]) > 5000:
                    continue
                pieces.append(values[i])
                plain += full[i]
            else:
                a = rng.randrange(390)
                pieces.append((a, a + rng.randrange(1, 9)))
                plain += text[pieces[-1][0]:pieces[-1][1]]
        if not pieces:
            continue
        v = S.Value(text, pieces)
        n = {c: plain.count(c) for c in set(plain)}
        assert v.size == len(plain) and dict(v.counts) == n and v.text == (plain if len(plain) <= S.TOLD else None)
        assert v.kinds == sum(b for p, b in (("[a-z]", 1), ("[A-Z]", 2), ("[0-9]", 4), ("[^A-Za-z0-9]", 8)) if re.search(p, plain))
        values.append(v)
        full.append(plain)
    chain = 'a0 = "Ab3!"\n' + "".join(f'a{i} = a{i - 1} + "x{i}"\n' for i in range(1, 50)) + "password = a49\n"
    assert {chain[a:b] for a, b in S.literals(chain)} >= {"Ab3!", "x1", "x49"}
