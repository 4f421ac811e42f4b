"""Benchmark decontamination by exact pieces, bit-parallel block distances and exact edit distance.

A document leaks a benchmark item when some passage of it is within ``max_edit``
(a fraction of the item's length, 0.1 unless given) of the item, in characters of
the lower-cased text with single blanks between words (Levenshtein distance). An item
too short for any edit (below 10 characters at 0.1) matches whole words only.

Search, complete at every distance up to the limit: k edits can't touch all of k + 1
pieces of an item, so one piece stands in the passage as it is. Pieces next to each
other form blocks of at most ``WORD`` characters; some block of l pieces has at most
l - 1 of the edits, by the same count. Every place of a text that shows the first
``SEED`` characters of a piece is a candidate; the piece's block is compared with the
text around it, bit-parallel (Myers), for many candidates at once; what stays within
l - 1 is verified exactly, on the passage with k characters around it. Symbols are
folded to 8 and 5 bits on the way, which can only add candidates. No walk, sample or
random choice is involved: this replaces the CGK walks with bit sampling, which lose
passages by chance at any number of repetitions.

All characters of all texts are starts of windows; windows never cross documents. Items
are the stated query set: they are sent to the tasks in blocks of ``ITEM_BLOCK``,
with one pass over the documents for each block.

Defined cases: null or wordless texts leak nothing; null or wordless items match
nothing; equal items are all reported; a document that holds an item twice reports
its closest (then first) passage. Empty tables give empty results. Columns besides
key and text pass through; ``scan`` refuses an input that already has its output.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lmplake.llm.common import U64, chunks, map_arrow, utf8, words

MAX_EDIT = 0.1
RECALL = 1.0  # the search is complete
ITEM_BLOCK = 4096
SEED, WORD = 8, 64
PART, BATCH = 1 << 18, 1 << 14
BLANK, END = 32, 0xFFFFFFFF
_M = U64(0x9FB21C651E98DF25)
LEAK = "array<struct<item_id:bigint,distance:int,word_start:int,word_end:int>>"


def characters(raw: np.ndarray, offsets: np.ndarray):
    """One number per character of the texts with single blanks between words, each text
    that has words followed by ``END``; the texts' starts; the words' starts and each
    text's first word."""
    s, e, row = words(raw, offsets)
    first = np.searchsorted(row, np.arange(len(offsets)))
    solid = np.zeros(len(raw) + 1, np.int8)
    solid[s] = 1
    np.add.at(solid, e, -1)  # a word can end where the next text's first begins
    lead = (np.cumsum(solid[:-1], dtype=np.int8) > 0) & ((raw & 0xC0) != 0x80)
    at = np.flatnonzero(lead)
    value = raw[at].astype(np.uint32)
    for m, least in ((1, 0xC0), (2, 0xE0), (3, 0xF0)):
        long = np.flatnonzero(raw[at] >= least)
        value[long] |= raw[np.minimum(at[long] + m, len(raw) - 1)].astype(np.uint32) << np.uint32(8 * m)
    upto = np.append(0, np.cumsum(lead))
    after = np.cumsum(upto[e] - upto[s] + 1)
    out = np.zeros(len(at) + len(s), np.uint32)
    out[np.arange(len(at)) + np.repeat(np.arange(len(s)), upto[e] - upto[s])] = value
    out[after - 1] = np.where(np.append(row[1:] != row[:-1], True)[:len(row)], END, BLANK)
    word_at = np.append(0, after)
    return out, word_at[first], word_at[:-1], first


def folded(chars: np.ndarray) -> np.ndarray:
    return (chars ^ (chars >> np.uint32(8)) ^ (chars >> np.uint32(16))).astype(np.uint8)


def grams(sym: np.ndarray) -> np.ndarray:
    """The ``SEED`` symbols from each place on, as one number; the last SEED - 1 places have none."""
    g = sym.astype(U64)
    for n in (1, 2, 4):
        g = g[:-n] | (g[n:] << U64(8 * n))
    return g


class Search:
    """Pieces and blocks of the items, and the places where they show."""

    def __init__(self, texts: list[str], max_edit: float):
        self.chars, self.starts, _, _ = characters(*utf8(pa.array(texts, pa.string())))
        sizes = np.diff(self.starts) - 1
        self.edits = [int(max_edit * n) if n > 0 else 0 for n in sizes.tolist()]
        sym = folded(self.chars)
        pieces, blocks = [], []
        for i, (n, k) in enumerate(zip(sizes.tolist(), self.edits)):
            if n <= 0:
                continue
            at = [j * n // (k + 1) for j in range(k + 2)]
            most = max(1, WORD // -(-n // (k + 1)))
            parts = -(-(k + 1) // most)
            for b in range(parts):
                lo, hi = b * (k + 1) // parts, (b + 1) * (k + 1) // parts
                for j in range(lo, hi):
                    size = min(SEED, at[j + 1] - at[j])
                    s = self.starts[i] + at[j]
                    pieces.append((size, int.from_bytes(sym[s:s + size].tobytes(), "little"), i, at[j], at[j] - at[lo], len(blocks)))
                blocks.append((self.starts[i] + at[lo], min(at[hi] - at[lo], WORD), hi - lo - 1))
        size, key, self.item, self.offset, self.inside, self.block = (
            np.array([x[c] for x in pieces], U64 if c == 1 else np.int64) for c in range(6))
        start, self.length, self.within = (np.array([x[c] for x in blocks], np.int64) for c in range(3))
        # the characters of each block as bit masks, by 5 bits of the symbol
        self.masks = np.zeros((len(blocks), 32), U64)
        for j in range(WORD):
            b = np.flatnonzero(self.length > j)
            self.masks[b, sym[start[b] + j] & 31] |= U64(1 << j)
        self.seeds = []
        for n in np.unique(size).tolist():
            which = np.flatnonzero(size == n)
            which = which[np.argsort(key[which], kind="stable")]
            keys, heads = np.unique(key[which], return_index=True)
            seen = np.zeros(1 << 20, bool)
            seen[(keys * _M) >> U64(44)] = True
            self.seeds.append((U64((1 << 8 * n) - 1), seen, keys, np.append(heads, len(which)), which))

    def near(self, sym: np.ndarray, place: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether the piece's block is near enough to the text about the place; ``sym``
        has ``pad`` symbols more on both sides."""
        block = self.block[piece]
        length, within = self.length[block], self.within[block]
        at = place - self.inside[piece] - within
        top = U64(1) << (length - 1).astype(U64)
        pv, mv = np.full(len(at), ~U64(0)), np.zeros(len(at), U64)
        score = length.astype(np.int16)
        best = score.copy()
        row = block * 32
        masks = self.masks.ravel()
        for j in range(int((length + 2 * within).max())):
            eq = masks[row + (sym[at + j] & 31)]
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph = mv | ~(xh | pv)
            mh = pv & xh
            score += (ph & top) != 0
            score -= (mh & top) != 0
            ph <<= U64(1)
            mh <<= U64(1)
            pv = mh | ~(xv | ph)
            mv = ph & xv
            np.minimum(best, score, out=best)
        return best <= within

    def places(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, piece) of the candidates whose block is near enough."""
        pad = 4 * WORD
        sym = np.pad(folded(chars), pad)
        places, pieces = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a in range(0, len(chars), PART):
            g = grams(sym[pad + a:pad + min(a + PART, len(chars)) + SEED - 1])
            for mask, seen, keys, heads, which in self.seeds:
                key = g & mask
                p = np.flatnonzero(seen[(key * _M) >> U64(44)])
                k = np.minimum(np.searchsorted(keys, key[p]), len(keys) - 1)
                ok = keys[k] == key[p]
                p, k = p[ok] + a, k[ok]
                count = heads[k + 1] - heads[k]
                upto = np.append(0, np.cumsum(count))
                for x in range(0, int(upto[-1]), BATCH):  # a common piece of many items is cut too
                    n = np.arange(x, min(x + BATCH, int(upto[-1])))
                    h = np.searchsorted(upto, n, side="right") - 1
                    place, piece = p[h], which[heads[k[h]] + n - upto[h]]
                    good = self.near(sym, place + pad, piece)
                    places.append(place[good])
                    pieces.append(piece[good])
        return np.concatenate(places), np.concatenate(pieces)

    def leaks(self, raw: np.ndarray, offs: np.ndarray) -> dict[tuple[int, int], tuple[int, int, int]]:
        """By (row, item): distance and word bounds of the closest, then first passage."""
        chars, starts, word_at, first_word = characters(raw, offs)
        place, piece = self.places(chars)
        if not len(place):
            return {}
        row = np.searchsorted(starts, place, side="right") - 1
        found = np.unique(np.stack([row, self.item[piece], place - self.offset[piece]]), axis=1)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        done = None  # row, item and last start that have been looked at
        for r, i, at in found.T.tolist():
            k, item = self.edits[i], self.chars[self.starts[i]:self.starts[i + 1] - 1]
            if done is not None and done[:2] == (r, i) and at <= done[2] or best.get((r, i), (1,))[0] == 0:
                continue
            done = (r, i, at + k)  # starts that close to each other share a window
            lo, hi = max(int(starts[r]), at - k), min(int(starts[r + 1]) - 1, at + len(item) + 2 * k)
            d, x, y = _distance(item, chars[lo:hi])
            x, y = x + lo, y + lo
            if d > k or k == 0 and not ((x == starts[r] or chars[x - 1] == BLANK) and chars[y] in (BLANK, END)):
                continue
            w = np.searchsorted(word_at, [x, y - 1], side="right") - 1 - first_word[r]
            span = (d, int(w[0]), int(w[1]) + 1)
            if (r, i) not in best or span < best[r, i]:
                best[r, i] = span
        return best


def edit_within(item: str, passage: str) -> tuple[int, int, int]:
    """Least Levenshtein distance between ``item`` and a substring of ``passage``, with
    the substring's bounds."""
    return _distance(*(np.frombuffer(x.encode("utf-32-le"), np.uint32) for x in (item, passage)))


def _distance(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    idx = np.arange(len(b) + 1)
    # costs carry the start of the passage that they come from in their low digits
    base = len(b) + 1
    cost = idx.astype(np.int64)  # distance 0, start = idx
    for ch in a:
        sub = cost[:-1] + np.where(b == ch, 0, base)
        new = cost + base
        new[1:] = np.minimum(new[1:], sub)
        cost = np.minimum.accumulate(new - idx * base) + idx * base
    end = int(np.argmin(cost // base))
    return int(cost[end] // base), int(cost[end] % base), end


def scan(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
         out: str = "leaks", max_edit: float = MAX_EDIT, carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns (default: all) and ``out``: the items that each document leaks,
    with distance and word bounds of the passage, by item_id."""
    if not 0 <= max_edit < 1:
        raise ValueError("max_edit is a fraction of the item's length, from 0 to below 1")
    carry = docs.columns if carry is None else carry
    if out in carry:
        raise ValueError(f"the input already has a column {out}; name another output")
    used = items.select(F.col(item_id).cast("long").alias("i"), F.lower(F.col(item_text)).alias("t")) \
        .where(F.col("t").rlike(r"[^\x20\x09-\x0D]"))
    n_blocks = -(-used.count() // ITEM_BLOCK)
    fields = [docs.schema[c] for c in carry]
    cur = docs.select(*[F.col(c) for c in carry], F.lower(F.col(text)).alias("_text"), F.array().cast(LEAK).alias(out))
    for block in range(n_blocks):
        got = sorted(used.where(F.pmod(F.xxhash64("i", "t"), F.lit(n_blocks)) == block).collect(),
                     key=lambda r: (r["i"] is not None, r["i"], r["t"]))
        cur = _scan_block(cur, fields, out, [r["i"] for r in got], [r["t"] for r in got], max_edit)
    return cur.select(*carry, out)


def _scan_block(cur: DataFrame, fields: list, out: str, ids: list, texts: list[str], max_edit: float) -> DataFrame:
    if not ids:
        return cur

    def leaks_of(search: Search, raw: np.ndarray, offs: np.ndarray) -> dict[int, list[dict]]:
        got: dict[int, list[dict]] = defaultdict(list)
        for (r, i), (d, x, y) in sorted(search.leaks(raw, offs).items()):
            got[r].append({"item_id": ids[i], "distance": d, "word_start": x, "word_end": y})
        return got

    def run(batches):
        search = Search(texts, max_edit)
        for b in batches:
            raw, offs = utf8(b.column(len(fields)))
            have = b.column(len(fields) + 1)
            found: dict[int, list[dict]] = {}
            for i, j in chunks(offs):
                found |= {i + r: v for r, v in leaks_of(search, raw[offs[i]:offs[j]], offs[i:j + 1] - offs[i]).items()}
            if found:
                have = pa.array([x + found.get(r, []) for r, x in enumerate(have.to_pylist())], have.type)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], have], names=b.schema.names)

    schema = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in fields],
                           T.StructField("_text", T.StringType()), T.StructField(out, T._parse_datatype_string(LEAK))])
    return map_arrow(cur, run, schema)
