"""The message loop: fetch messages land and serve, merge messages merge days."""
import datetime as dt
import json
import os

from lmplake.feeds import DA_FEED
from lmplake.operators.serve import asset_dimension
from lmplake.sources.feed_source import write_page_folder
from lmplake.streaming.streams import start_control_stream


def test_control_stream_fetches_merges_and_quarantines(spark, tmp_path):
    pages_root, root = str(tmp_path / "pages"), str(tmp_path / "lake")
    recs = [{"datetime_beginning_utc": f"2024-01-01T{5 + h:02d}:00:00", "pnode_id": node, "total_lmp_da": h,
             "congestion_price_da": 0, "marginal_loss_price_da": 0} for h in range(3) for node in (2156110049, 7)]
    write_page_folder(
        spark.createDataFrame([("20240101T0500", 1, json.dumps(recs))], "pull string, start_row bigint, page_text string"),
        spark.createDataFrame([("20240101T0500", len(recs)), ("20240102T0500", 0)], "pull string, total_rows bigint"),
        pages_root, DA_FEED)
    msgs = tmp_path / "msgs"
    msgs.mkdir()
    fetch = {"begin_time_iso_str": "2024-01-01T00:00:00-0500", "pjm_end_point": DA_FEED, "queue_next": True}
    empty = {"begin_time_iso_str": "2024-01-02T05:00:00+0000", "pjm_end_point": DA_FEED, "queue_next": True}
    other = {"begin_time_iso_str": "2024-01-01T05:00:00+0000", "pjm_end_point": "rt_fivemin_hrl_lmps",
             "queue_next": True}  # a known feed this worker has no transport for
    (msgs / "1.txt").write_text("\n".join(json.dumps(m) for m in (fetch, empty, other)) + "\nnot a message\n")
    run = lambda ck: start_control_stream(spark, str(msgs), str(tmp_path / ck), root, {DA_FEED: {"root": pages_root}},
                                          asset_dimension(spark), now=dt.datetime(2023, 12, 1),
                                          consume="archive").awaitTermination()
    run("ck")
    assert spark.read.parquet(f"{root}/{DA_FEED}/intake").count() == 6
    assert spark.read.parquet(f"{root}/serving/da").count() == 3
    nxt = {r.next_begin_utc: r.n_rows for r in spark.read.parquet(f"{root}/requests").collect()}
    assert nxt == {dt.datetime(2024, 1, 1, 8): 6, dt.datetime(2024, 1, 2, 5): 0}
    quarantined = lambda: spark.read.schema("value string, batch_id long").text(f"{root}/quarantine/messages").count()
    assert quarantined() == 2
    assert not os.path.exists(f"{root}/{DA_FEED}/day")
    (msgs / "2.txt").write_text(json.dumps({"date": "2024-01-01", "endpoint": DA_FEED}) + "\n")
    run("ck")
    assert spark.read.parquet(f"{root}/{DA_FEED}/day").count() == 6
    assert spark.read.parquet(f"{root}/{DA_FEED}/archive").count() == 6  # merged files left the intake
    # merges that nobody can run are kept, not lost: a day that doesn't exist, a feed without a transport
    (msgs / "3.txt").write_text("\n".join(json.dumps(m) for m in (
        {"date": "2024-13-40", "endpoint": DA_FEED}, {"date": "2024-01-01", "endpoint": "rt_fivemin_hrl_lmps"},
        {"date": None, "endpoint": DA_FEED})) + "\n")
    run("ck")
    assert quarantined() == 5
