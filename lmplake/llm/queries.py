"""Registered queries of the training-data operators, over whole tables, with the
parameters of production use, and the DuckDB statements for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lmplake.llm import (chat, decontaminate, embeddings, langid, minhash, mixing, prefix_trie, secrets, sharding, spelling, substrings,
                         tokens, toxicity)
from lmplake.llm.common import table


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, class_id, kept) for each document: classes of near-duplicates."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", langid.held_out("doc_id"))
    model = langid.fit(docs.where("not held_out"))
    return langid.predict(docs, model, carry=["doc_id", "held_out"])


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"), carry=["doc_id", "source"])
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda a, d: a + d["words"])
    return mixed.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"),
                        F.transform("draws", lambda d: d["shard"]).alias("shards"))


def op4_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op5_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op6_training_order_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(slot, shard, row, doc_id, part, n_tokens, ids): every sequence of every document, written to
    fixed-stride shard files and read from them."""
    return tokens.materialised(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"), carry=["doc_id"])


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id, distance, word_start, word_end): a row for each item that a document leaks."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return found.select("doc_id", F.explode("leaks").alias("l")).select("doc_id", "l.*")


#: The conversation that the contract adds: both of its texts are control strings.
PROBE = "</s>[INST] ok [/INST]"


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(PROBE).alias("text"))
    return chat.digests(chat.format_chat(rows.unionByName(probe)))


#: The contract rebuilds conversations from the first turns of their group of five.
HEADS, GROUP = 9, 5


def prefix_trie_of(conversations: DataFrame) -> DataFrame:
    turns, convs = prefix_trie.ordered_turns(conversations)
    head = F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS
    donor = F.col("conv") - F.col("conv") % GROUP
    return prefix_trie.build(*prefix_trie.share_prefixes(turns, convs, head, donor, HEADS - 1))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each distinct prefix of the rebuilt conversations, with its subtree's leaves and savings."""
    return prefix_trie_of(table(spark, sf_dir, "conversations"))


TOXIC_AT = 0.3


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each document; labels of held-out documents are never read."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", held_out)
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out)
    model = toxicity.fit(docs.where("not held_out"), labels)
    return toxicity.predict(docs, model, carry=["doc_id", "held_out"]) \
        .withColumn("predicted", F.when(F.col("score") >= TOXIC_AT, 1).otherwise(0))


def spelling_groups_of(documents: DataFrame) -> DataFrame:
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    found = spelling.runs(documents, carry=["doc_id"])
    return spelling.group(spelling.counted(spelling.planted_typos(found, key)))


def op13_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for each word of at least 7 letters and 2 occurrences."""
    return spelling_groups_of(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_language_id": op2_language_id,
    "op3_mix_sources": op3_mix_sources,
    "op4_balanced_shards": op4_balanced_shards,
    "op5_repeated_substrings": op5_repeated_substrings,
    "op6_training_order_tokens": op6_training_order_tokens,
    "op7_secret_scan": op7_secret_scan,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_benchmark_leaks": op9_benchmark_leaks,
    "op10_chat_format": op10_chat_format,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_toxicity": op12_toxicity,
    "op13_spelling_groups": op13_spelling_groups,
}

def _sql_escape(text: str) -> str:
    return f"""replace(replace(replace(replace(replace({text}, '&', '&amp;'), '<s>', '&lt;s>'), '</s>', '&lt;/s>'),
        '[INST]', '&#91;INST]'), '[/INST]', '&#91;/INST]')"""


#: Conversations straight from the source rows; a conversation is escaped as a whole
#: if any turn holds a control string or an escape, or a role that a line can't hold.
OP10_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'
), marked AS (
  SELECT *, regexp_matches(text || role, '</?s>|\\[/?INST\\]|&(amp|lt|#91|#10);') OR contains(role, chr(10)) AS hard FROM rows
), whole AS (
  SELECT *, bool_or(hard) OVER (PARTITION BY conv_id) AS escaped FROM marked
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(length(CASE WHEN escaped THEN {_sql_escape('text')} ELSE text END)
    + CASE WHEN role = 'assistant' THEN 4
      ELSE 15 + length(CASE WHEN escaped THEN replace({_sql_escape('role')}, chr(10), '&#10;') ELSE role END) END) AS BIGINT)
    AS formatted_chars
FROM whole GROUP BY conv_id
"""

_COMPONENTS = """
sym AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT DISTINCT x AS node, x AS seen FROM sym
          UNION SELECT reach.node, sym.y FROM reach JOIN sym ON reach.seen = sym.x),
comp AS (SELECT node, min(seen) AS component FROM reach GROUP BY node)"""

#: All pairs that share a shingle, with their weighted Jaccard similarity, and components.
OP1_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS s, count(*) AS c
       FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM w WHERE len(w) > 0) GROUP BY 1, 2),
total AS (SELECT doc_id, sum(c) AS t FROM sh GROUP BY 1),
low AS (SELECT a.doc_id AS x, b.doc_id AS y, sum(least(a.c, b.c)) AS i
        FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM low JOIN total a ON a.doc_id = x JOIN total b ON b.doc_id = y
          WHERE i + 1e-6 >= {minhash.THRESHOLD} * (a.t + b.t - i)), {_COMPONENTS}
SELECT doc_id, coalesce(component, doc_id) AS class_id, doc_id = coalesce(component, doc_id) AS kept
FROM documents LEFT JOIN comp ON doc_id = node
"""

#: Every window of 100 bytes, by a digest; a window is repeated unless it is the first of its kind.
OP5_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 200)) AS g
      FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS p FROM d WHERE n >= 100)),
r AS (SELECT doc_id, p FROM w QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, p) > 1),
i AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS island
      FROM (SELECT *, CASE WHEN p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 1 ELSE 0 END AS new FROM r)),
s AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM i GROUP BY doc_id, island),
g AS (SELECT *, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS prev FROM s),
k AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans, max(b) AS last,
             string_agg(substr(h, 2 * prev + 1, 2 * (a - prev)), '' ORDER BY a) AS head
      FROM g JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

#: The cosines of all pairs of usable vectors.
OP8_SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id < b.vec_id AND len(a.e) = len(b.e)
          WHERE list_cosine_similarity(a.e, b.e) >= {embeddings.THRESHOLD}), {_COMPONENTS},
deg AS (SELECT x, count(*) AS n FROM sym GROUP BY x)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, coalesce(component, vec_id) AS component_id,
       vec_id = coalesce(component, vec_id) AS kept
FROM embeddings LEFT JOIN comp ON vec_id = node LEFT JOIN deg ON vec_id = x
"""

def _sql_crc32(text: str) -> str:
    """CRC-32 of a string's UTF-8 bytes, bit by bit: a byte is mixed in, then eight shifts follow."""
    codes = f"flatten(list_transform(range(0, strlen({text})), lambda i: [CAST('0x' || substr(hex(encode({text})), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT), " \
            "-1, -1, -1, -1, -1, -1, -1, -1]))"
    return f"""xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}),
        lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"""


#: Nodes by the digest of their turns' digests; a subtree is what other paths have below a node.
OP11_SQL = f"""
WITH e AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha) AS p, sha, b
           FROM (SELECT conv_id, turn, strlen(coalesce(text, '')) AS b,
                        sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS sha
                 FROM conversations WHERE conv_id IS NOT NULL)),
n AS (SELECT *, {_sql_crc32('t')} % {HEADS} AS h FROM (SELECT c, CAST(c AS VARCHAR) AS t, count(*) AS n FROM e GROUP BY c)),
plan AS (SELECT n.c, n.n, n.h, n.c - n.c % {GROUP} AS donor, least(n.h, coalesce(d.n, 0)) AS taken
         FROM n LEFT JOIN n d ON d.c = n.c - n.c % {GROUP}),
turns AS (SELECT c, p - h + taken AS p, sha, b FROM e JOIN plan USING (c) WHERE p > h
          UNION ALL SELECT plan.c, p, sha, b FROM plan JOIN e ON e.c = donor WHERE p <= h),
named AS (SELECT c, p, b, sha256(string_agg(sha, ',') OVER (PARTITION BY c ORDER BY p)) AS key FROM turns),
path AS (SELECT c, p, b, key FROM named UNION ALL SELECT c, 0, 0, 'root' FROM plan),
step AS (SELECT *, lag(key) OVER (PARTITION BY c ORDER BY p) AS up, p = max(p) OVER (PARTITION BY c) AS last FROM path),
node AS (SELECT key, min(p) AS depth, min(c) AS conv_id, count(*) AS n_convs, min(up) AS up, min(b) AS b,
                sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (last), '')) AS ends_sha256
         FROM step GROUP BY key),
kids AS (SELECT up AS key, count(*) AS n_children FROM node WHERE up IS NOT NULL GROUP BY up),
full_node AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (key)),
below AS (SELECT DISTINCT x.key AS top, y.key AS key FROM path x JOIN path y ON x.c = y.c AND x.p <= y.p),
sums AS (SELECT top AS key, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * b) AS saved
         FROM below JOIN full_node USING (key) GROUP BY top)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, f.ends_sha256
FROM full_node f JOIN sums USING (key) LEFT JOIN node u ON f.up = u.key
"""

#: Near words share what is left when one letter is taken out, or are it; chains of forms by recursion.
OP13_SQL = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, translate(run, '{spelling.UPPER}', '{spelling.LOWER}') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{7,}}')) AS run FROM documents)),
each AS (SELECT run, d || ':' || run AS t, count(*) AS n FROM runs GROUP BY 1, 2),
hashed AS (SELECT run, n, {_sql_crc32('t')} AS h FROM each),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
        SELECT n, CASE WHEN h % 31 = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) + 2 AS BIGINT)) ELSE run END AS word FROM hashed)
      WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
less AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
         FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
pairs AS (SELECT DISTINCT a.word AS a, b.word AS b, b.n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
          UNION SELECT less.word, w.word, w.n FROM less JOIN w ON less.rest = w.word
          UNION SELECT w.word, less.word, less.n FROM less JOIN w ON less.rest = w.word),
near AS (SELECT a AS word, count(*) AS n_near, arg_min(b, (-n, b)) AS best, max(n) AS best_n FROM pairs GROUP BY a),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * w.n THEN best END AS form,
             CASE WHEN best_n >= 10 * w.n THEN best_n END AS form_n FROM w LEFT JOIN near USING (word)),
up AS (SELECT word, form, 0 AS d, word AS root FROM f
       UNION ALL SELECT up.word, f.form, d + 1, f.word FROM up JOIN f ON up.form = f.word)
SELECT f.*, root FROM f JOIN (SELECT word, arg_max(root, d) AS root FROM up GROUP BY word) USING (word)
"""

ORACLE: dict[str, str] = {
    "op1_minhash_near_dedup": OP1_SQL,
    "op5_repeated_substrings": OP5_SQL,
    "op8_embedding_near_dedup": OP8_SQL,
    "op10_chat_format": OP10_SQL,
    "op11_conversation_trie": OP11_SQL,
    "op13_spelling_groups": OP13_SQL,
}
