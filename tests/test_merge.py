import datetime as dt
import itertools

from pyspark.sql import functions as F

from lmplake.operators.merge import carried_over_nodes, merge_rows
from lmplake.operators.positions import positions_within

T = [dt.datetime(2024, 1, 1, h) for h in (5, 6, 7)]
SCHEMA = "node_id bigint, utcbegin timestamp_ntz, v double, ingest_seq bigint"
EXISTING = [(1, T[0], 10.0, 1), (1, T[1], 11.0, 2), (2, T[0], 20.0, 3)]
NEW = [(1, T[1], 12.0, 4), (1, T[2], 13.0, 5), (1, T[2], 14.0, 6), (3, T[0], 30.0, 7)]
GOLDEN = {(1, T[0], 10.0), (1, T[1], 12.0), (1, T[2], 14.0), (2, T[0], 20.0), (3, T[0], 30.0)}


def _rows(df):
    return {(r.node_id, r.utcbegin, r.v) for r in df.collect()}


def test_merge_golden(spark):
    e, n = spark.createDataFrame(EXISTING, SCHEMA), spark.createDataFrame(NEW, SCHEMA)
    assert _rows(merge_rows(e, n)) == GOLDEN


def test_new_beats_existing_even_with_smaller_seq(spark):
    e = spark.createDataFrame([(1, T[0], 1.0, 100)], SCHEMA)
    n = spark.createDataFrame([(1, T[0], 2.0, 5)], SCHEMA)
    assert _rows(merge_rows(e, n)) == {(1, T[0], 2.0)}
    assert _rows(merge_rows(e, n, policy="sequence")) == {(1, T[0], 1.0)}


def test_merge_is_idempotent_and_order_free(spark):
    e, n = spark.createDataFrame(EXISTING, SCHEMA), spark.createDataFrame(NEW, SCHEMA)
    once = merge_rows(e, n)
    assert _rows(merge_rows(once, n)) == GOLDEN
    a, b = spark.createDataFrame(NEW[:2], SCHEMA), spark.createDataFrame(NEW[2:], SCHEMA)
    for x, y in itertools.permutations([a, b]):
        assert _rows(merge_rows(merge_rows(e, x, policy="sequence"), y, policy="sequence")) == GOLDEN


def test_carried_over_nodes(spark):
    e = spark.createDataFrame(EXISTING, SCHEMA).withColumn("pricedate", F.to_date("utcbegin"))
    n = spark.createDataFrame(NEW, SCHEMA).withColumn("pricedate", F.to_date("utcbegin"))
    assert [r.node_id for r in carried_over_nodes(e, n).collect()] == [2]


def test_positions_match_row_number_on_a_hot_group(spark):
    from pyspark.sql import Window
    rows = [("hot", i * 3 + 1) for i in range(3000)] + [("cold", i * 7) for i in range(50)]
    rows += [("sparse", (i * 7919) << 40) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, seq bigint").repartition(5)
    got = positions_within(df, ["g"], "seq", target_block_rows=16)
    ref = df.withColumn("position", F.row_number().over(Window.partitionBy("g").orderBy("seq")))
    assert sorted(got.collect()) == sorted(ref.collect())


def test_node_lookup_by_frame_equals_by_list(spark):
    from lmplake.operators.merge import node_day_lookup
    rows = [(n, T[h], float(n * 10 + h), n * 10 + h) for n in range(1, 6) for h in range(3)]
    table = spark.createDataFrame(rows, SCHEMA).withColumn("pricedate", F.to_date("utcbegin"))
    by_list = node_day_lookup(table, [2, 4])
    by_frame = node_day_lookup(table, spark.createDataFrame([(2,), (4,), (4,)], "node_id bigint"))
    assert sorted(by_list.collect()) == sorted(by_frame.collect()) and by_list.count() == 6
