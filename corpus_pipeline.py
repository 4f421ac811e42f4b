"""From raw documents to training sequences: five stages over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
stage's result as a table in the shared folder and reads it again for the next one.
All stages but the last return the columns of documents.

1. language_id: rows that the classifier rejects go (no letter at all, or a mean
   probability of the best language below ``MIN_SCORE``, that is, no language at all).
2. near_dedup: of each group of near-duplicates the smallest doc_id stays, once.
3. decontaminate: documents that leak a benchmark item go.
4. mix_sources: documents are repeated or left out so that sources reach their targets.
5. token_ids: padded token sequences in training order.

Repeated and null doc_ids: rows of one doc_id and text are one document; rows of one
doc_id and different texts are different documents, and so are rows without doc_id; in a
class the one with the smallest doc_id (then text digest; without doc_id last) stays. Columns that documents doesn't have by its
contract pass through stages 1 to 4, whatever their names. Null, empty and wordless texts go in
stage 1. Empty tables give empty results. Ties: see the operators.

Tables that a stage writes on its way are removed when its result stands (``settled``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lmplake.llm import decontaminate, langid, minhash, mixing, tokens
from lmplake.llm.common import settled, table

MIN_SCORE = 0.4


def packed(docs: DataFrame) -> DataFrame:
    """Columns doc_id, source and text, which stages read, and row: all others but text, and those two. So no
    column of the input meets a column of a stage, whatever they are called."""
    return docs.select("doc_id", "source", "text", F.struct(*[F.col(c) for c in docs.columns if c != "text"]).alias("row"))


def unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = langid.predict(packed(docs), langid.fit(docs), carry=["row", "text"])
    return unpacked(scored.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= MIN_SCORE)), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = packed(docs)
    each = rows.select("doc_id", F.xxhash64("text").alias("h")).groupBy("doc_id") \
        .agg(F.count(F.lit(1)).alias("n"))
    if each.where("doc_id is null or n > 1").isEmpty():
        name = F.col("doc_id")
    else:  # rows are told apart by their text too: the smallest doc_id, then digest, of a class stays
        digits = F.lpad((F.col("doc_id").cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("string"), 20, "0")
        name = F.concat(F.coalesce(digits, F.lit("null")), F.lit(":"), F.sha2(F.coalesce("text", F.lit("")), 256),
                        F.when(F.col("text").isNull(), ":null").otherwise(""))
    rows = rows.withColumn("name", name)
    groups = minhash.near_duplicates(rows, key="name")
    kept = rows.join(groups.where("not kept").select("name").distinct(), "name", "left_anti")
    if each.where("n > 1").isEmpty():
        return unpacked(kept, docs.columns)
    return unpacked(kept.dropDuplicates(["name"]), docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(packed(docs), table(spark, sf_dir, "benchmark"), carry=["row", "text"])
    return unpacked(found.where(F.size("leaks") == 0), docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(packed(docs), carry=["row", "text"], keep_sizes=False)
    out = mixing.mixed_texts(mixed)
    if "n_chars" in docs.columns:  # of the text as it is now
        cut = F.col("take.words") < F.col("size")
        out = out.withColumn("row", F.col("row").withField("n_chars", F.when(cut, F.length("text").cast("long"))
                                                           .otherwise(F.col("row.n_chars"))))
    return unpacked(out, docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokens.training_order(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminated),
    ("mix_sources", mix_sources),
    ("token_ids", token_ids),
]

#: A trained classifier, hashed signatures and a vocabulary are not SQL; tests/llm
#: compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(spark, lambda: stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
