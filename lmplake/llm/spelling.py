"""Spelling variants: words within one edit of each other, found through variable-length grams.

The corpus' distinct words, with their counts, are decorated with a start and an end mark.

1. Gram dictionary: grams of ``QMIN`` to ``QMAX`` - 1 characters that stand at more than ``tau`` places of
   the words are *frequent*. They are counted level by level, longer grams only from frequent ones; ``tau``
   is ``TAU``, or places / ``DICTIONARY`` where that is more, so a level can't hold more than ``DICTIONARY`` grams
   (it is broadcast).
2. Decomposition: at each place a word has its shortest gram that isn't frequent (or the one that reaches
   ``QMAX`` or the word's end); grams inside an earlier one are left out. So posting lists are short wherever
   the dictionary can make them so.
3. Affected grams: for each word the most grams that a single edit, wherever it falls, can take away. An edit
   at i takes the grams across i; a gram left of it stays, since it doesn't depend on what follows;
   a gram [p, e) right of it is lost only inside a new gram that ends in e as well, which needs the text between
   i and e - 1 to be frequent.
4. List merging: near words share at least (grams - affected) grams, of either word. So of each word only the
   lists of its affected + 1 first grams, in one order of all grams with frequent ones last, have to be merged. Words that an
   edit could strip of all grams (grams <= affected) can only be missed against each other; they also stand in lists of
   themselves less one character.
5. Verification: in each list, all pairs are compared exactly by common prefix and suffix.

A list beyond ``LIST`` words is cut into blocks, a group of rows for each pair of blocks, so no list is capped and
none is one task's work. Pairs of words are rows, lists aren't multiplied out.

Words are runs of A-Z, a-z and U+00C0 to U+00FF. Defined cases: null texts have no words; a null document
id counts as empty in the hash; an empty table gives no word; other columns are ignored. Equal counts: the smallest
word in code-point order is the form.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lmplake.llm.common import join_sized, map_arrow, u32, written

QMIN, QMAX = 3, 9
TAU, DICTIONARY = 64, 1 << 17
LIST = 2048
FACTOR = 10
START, END, AGAIN, LESS = "\x01", "\x02", "\x03", "\x04"
PAIRS = 1 << 18  # pairs compared at once
FEW = 8  # words of a list that are paired in a plain loop
LONG = 64  # words beyond are compared one by one
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "[A-Za-zÀ-ÿ]"


# ---------------------------------------------------------------- words of a corpus

def runs(docs: DataFrame, text: str = "text", shortest: int = 7, carry: list[str] | None = None) -> DataFrame:
    """A row for each maximal run of at least ``shortest`` letters, lower-cased in A-Z only."""
    found = F.regexp_extract_all(F.col(text), F.lit(f"{RUN}{{{shortest},}}"), F.lit(0))
    return docs.select(*(carry or []), F.explode(found).alias("run")).withColumn("run", F.translate("run", UPPER, LOWER))


def counted(words: DataFrame, word: str = "word", at_least: int = 2, shortest: int = 7) -> DataFrame:
    """(word, n) of the words of at least ``shortest`` letters that occur ``at_least`` times."""
    return words.where(F.length(word) >= shortest).groupBy(F.col(word).alias("word")).agg(F.count(F.lit(1)).alias("n")) \
        .where(F.col("n") >= at_least)


# ---------------------------------------------------------------- grams

def _count_level(length: int, shorter: set, first: bool):
    def run(batches):
        for b in batches:
            c: Counter = Counter()
            for w in b.column(0).to_pylist():
                s = f"{START}{w}{END}"
                for p in range(len(s) - length + 1):
                    if first or (s[p:p + length - 1] in shorter and s[p + 1:p + length] in shorter):
                        c[s[p:p + length]] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], names=["gram", "n"])
    return run


def dictionary(words: DataFrame, qmin: int = QMIN, qmax: int = QMAX, tau: int = TAU, most: int = DICTIONARY) -> set[str]:
    """The frequent grams of ``words`` (word): at most ``most`` of each length."""
    places = words.agg(F.sum(F.length("word").cast("long") + 2)).first()[0] or 0
    bound = max(tau, places // most)
    found: set[str] = set()
    level: set[str] = set()
    for q in range(qmin, qmax):
        shared = words.sparkSession.sparkContext.broadcast(level)
        rows = map_arrow(words.select("word"), lambda b, q=q, shared=shared: _count_level(q, shared.value, q == qmin)(b), "gram string, n long")
        level = {r["gram"] for r in rows.groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") > bound).select("gram").collect()}
        if not level:
            break
        found |= level
    return found


def decompose(s: str, frequent: set, qmin: int = QMIN, qmax: int = QMAX) -> list[tuple[int, int]]:
    """Places [p, e) of the grams of a decorated word."""
    n, reach, grams = len(s), 0, []
    for p in range(n - qmin + 1):
        e = p + qmin
        while e < n and e - p < qmax and s[p:e] in frequent:
            e += 1
        if e > reach:
            grams.append((p, e))
            reach = e
    return grams


def affected(s: str, grams: list[tuple[int, int]], frequent: set, qmin: int = QMIN, qmax: int = QMAX) -> int:
    """The most grams of a decorated word that one edit can take away."""
    hit = [0] * (len(s) + 1)
    for p, e in grams:
        for i in range(p, e):  # the edit falls on the gram
            hit[i] += 1
        for g in range(max(1, e + 1 - qmax), p + 1):  # or before g <= p, and a new gram from there ends in e too
            if e - 1 - g < qmin or s[g:e - 1] in frequent:
                hit[g - 1] += 1
    return max(hit[:len(s) - 1])


def tokens(word: str, frequent: set, qmin: int = QMIN, qmax: int = QMAX) -> list[str]:
    """The lists that a word stands in."""
    s = f"{START}{word}{END}"
    grams = decompose(s, frequent, qmin, qmax)
    lost = affected(s, grams, frequent, qmin, qmax)
    seen: Counter = Counter()
    ordered = []
    for p, e in grams:
        gram = s[p:e]
        ordered.append((gram in frequent, zlib.crc32(gram.encode()), gram + AGAIN * seen[gram]))
        seen[gram] += 1
    ordered.sort()
    out = [t for _, _, t in ordered[:lost + 1]]
    if len(grams) <= lost:
        out += {LESS + word, *(LESS + word[:i] + word[i + 1:] for i in range(len(word)))}
    return out


# ---------------------------------------------------------------- verification

def one_edit(a: str, b: str) -> bool:
    """Exactly one inserted, deleted or replaced character."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    short = min(len(a), len(b))
    head = next((i for i in range(short) if a[i] != b[i]), short)
    tail = next((i for i in range(short) if a[-1 - i] != b[-1 - i]), short)
    return head + tail >= max(len(a), len(b)) - 1


def near_pairs(words: list[str], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs of words (by number) are one edit apart."""
    size = np.array([len(w) for w in words], np.int64)
    out = np.abs(size[left] - size[right]) <= 1
    usual = np.minimum(size[left], size[right]) <= LONG
    short = [w if len(w) <= LONG + 1 else "" for w in words]
    width = max(map(len, short), default=0) + 1
    try:
        code, unit = "latin-1", np.uint8
        forth, back = ("".join(w[::step].ljust(width, "\0") for w in short).encode(code) for step in (1, -1))
    except UnicodeEncodeError:
        code, unit = "utf-32-le", np.uint32
        forth, back = ("".join(w[::step].ljust(width, "\0") for w in short).encode(code) for step in (1, -1))
    forth, back = (np.frombuffer(x, unit).reshape(-1, width) for x in (forth, back))
    at = np.flatnonzero(out & usual)
    for a in range(0, len(at), PAIRS):
        i = at[a:a + PAIRS]
        x, y = left[i], right[i]
        longest = np.maximum(size[x], size[y])
        common = lambda m: np.argmax(np.concatenate([m[x] != m[y], np.ones((len(x), 1), bool)], axis=1), axis=1)
        head = common(forth)
        tail = common(back)
        out[i] = (head < longest) & (head + tail >= longest - 1)
    for i in np.flatnonzero(out & ~usual):
        out[i] = one_edit(words[left[i]], words[right[i]])
    return out


def _compare(batches):
    """Near pairs (a, b) of each group's words: rows (token, lo, hi, block, id, word) in the order of the group."""
    group, block, ids, words = None, [], [], []
    ready: list[tuple[np.ndarray, np.ndarray]] = []
    pool_ids: list[int] = []
    pool_words: list[str] = []
    waiting = 0

    def flush():
        nonlocal waiting
        if ready:
            left, right = (np.concatenate(x) for x in zip(*ready))
            near = near_pairs(pool_words, left, right)
            key = np.array(pool_ids, np.int64)
            a, b = key[left[near]], key[right[near]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])
        ready.clear(), pool_ids.clear(), pool_words.clear()
        waiting = 0

    def close():
        """Pairs of the group: of one block within it, of two blocks across; words that differ by more than
        one letter in length don't meet."""
        nonlocal waiting
        base = len(pool_words)
        if len(ids) <= FEW:  # most lists
            pool_ids.extend(ids)
            pool_words.extend(words)
            pairs = [(base + i, base + j) for i in range(len(ids)) for j in range(i) if abs(len(words[i]) - len(words[j])) <= 1]
            if pairs:
                ready.append(tuple(np.array(pairs, np.int64).T))
                waiting += len(pairs)
            if waiting >= PAIRS or len(pool_words) >= PAIRS:
                yield from flush()
            return
        size = np.array([len(w) for w in words])
        order = np.argsort(size, kind="stable")
        size = size[order]
        pool_ids.extend(ids[i] for i in order)
        pool_words.extend(words[i] for i in order)
        side = np.array(block)[order]
        until = np.searchsorted(size, size + 1, side="right")
        for i in range(len(order)):
            j = np.arange(i + 1, until[i])
            if group[1] != group[2]:
                j = j[side[j] != side[i]]
            if len(j):
                ready.append((np.full(len(j), base + i), base + j))
                waiting += len(j)
            if waiting >= PAIRS and i + 1 < len(order):
                keep_ids, keep_words = pool_ids[base:], pool_words[base:]
                yield from flush()
                base = 0
                pool_ids.extend(keep_ids), pool_words.extend(keep_words)
        if waiting >= PAIRS or len(pool_words) >= PAIRS:
            yield from flush()

    for b in batches:
        for token, lo, hi, part, key, word in zip(*[c.to_pylist() for c in b.columns]):
            if (token, lo, hi) != group:
                if len(ids) > 1:
                    yield from close()
                group, block, ids, words = (token, lo, hi), [], [], []
            block.append(part), ids.append(key), words.append(word)
    if len(ids) > 1:
        yield from close()
    yield from flush()


def near_words(words: DataFrame, qmin: int = QMIN, qmax: int = QMAX, tau: int = TAU, most: int = DICTIONARY, list_rows: int = LIST) -> DataFrame:
    """(a, b), a < b, for each pair of ``words`` (id, word) within one edit; ids and words are distinct."""
    frequent = words.sparkSession.sparkContext.broadcast(dictionary(words, qmin, qmax, tau, most))

    def listed(batches):
        for b in batches:
            ids, text = b.column(0).to_pylist(), b.column(1).to_pylist()
            rows = [(t, k, w) for k, w in zip(ids, text) for t in tokens(w, frequent.value, qmin, qmax)]
            t, k, w = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(t, pa.string()), pa.array(k, pa.int64()), pa.array(w, pa.string())], names=["token", "id", "word"])

    lists = written(map_arrow(words.select("id", "word"), listed, "token string, id long, word string"), "lists")
    sizes = lists.groupBy("token").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    # blocks of a list: b of them, each word goes to its block's pairs with all blocks
    cut = join_sized(lists, sizes, ["token"], "rows", lists.count(), "inner") \
        .withColumn("blocks", F.ceil(F.col("rows") / list_rows).cast("int")) \
        .withColumn("block", (u32("id") % F.col("blocks")).cast("int"))
    dealt = cut.select("token", "id", "word", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")) \
        .select("token", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "id", "word")
    ordered = dealt.repartition("token", "lo", "hi").sortWithinPartitions("token", "lo", "hi")
    return written(map_arrow(ordered, _compare, "a long, b long"), "pairs").distinct()


# ---------------------------------------------------------------- forms

def group(words: DataFrame, factor: int = FACTOR, **options) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for distinct ``words`` (word, n)."""
    words = written(words.select("word", F.col("n").cast("long").alias("n")).withColumn("id", F.monotonically_increasing_id()), "words")
    pairs = written(near_words(words, **options), "near")
    both = pairs.select(F.col("a").alias("id"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("id"), F.col("a").alias("other")))
    other = words.select(F.col("id").alias("other"), (-F.col("n")).alias("less"), F.col("word").alias("form"))
    near = both.join(other, "other").groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct("less", "form")).alias("best"))
    common = F.col("n_near").isNotNull() & (-F.col("best.less") >= factor * F.col("n"))
    out = written(words.join(near, "id", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(common, F.col("best.form")).alias("form"), F.when(common, -F.col("best.less")).cast("long").alias("form_n")), "forms")
    roots = follow(out.where("form is not null").select("word", F.col("form").alias("root")))
    return out.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def follow(steps: DataFrame) -> DataFrame:
    """(word, root): the end of each word's chain of steps (word, root). Steps lead to words at least ``FACTOR`` times as
    frequent, so chains are short and end; each round doubles the steps that are taken."""
    cur = written(steps, "steps")
    while True:
        total = cur.count()
        into = cur.groupBy("root").agg(F.count(F.lit(1)).alias("n_into"))
        on = into.join(cur.select(F.col("word").alias("root"), F.col("root").alias("next")), "root")
        if on.isEmpty():
            return cur
        moved = join_sized(cur, on, ["root"], "n_into", total, "left")
        cur = written(moved.select("word", F.coalesce("next", "root").alias("root")), "steps")


def planted_typos(occurrences: DataFrame, key: Column, every: int = 31) -> DataFrame:
    """``occurrences`` (run): a run whose hash with the key divides by ``every`` loses one letter, and becomes ``word``."""
    h = F.crc32(F.concat(key, F.lit(":"), F.col("run")).cast("binary"))
    at = (h % F.length("run")).cast("int")
    less = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return occurrences.withColumn("word", F.when(h % every == 0, less).otherwise(F.col("run")))
