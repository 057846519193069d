import os
import tempfile

from roaskit.plans.catalog import order_line_contract
from roaskit.streaming.ingest import run_available

HEADER = "order_id,customer_id,order_datetime,sku,qty,unit_price,discount\n"


def write(path, rows):
    with open(path, "w") as f:
        f.write(HEADER + "".join(",".join(r) + "\n" for r in rows))


def test_stream_restart_exactly_once(spark):
    root = tempfile.mkdtemp(prefix="roaskit-stream-")
    inbox = os.path.join(root, "inbox")
    os.makedirs(inbox)
    write(f"{inbox}/a.csv", [("1", "c1", "2025-07-02 10:00:00", "S1", "2", "10.0", "0.1"),
                             ("2", "c2", "2025-07-02 11:00:00", "S2", "0", "15.0", "0.0")])
    write(f"{inbox}/b.csv", [("3", "", "2025-07-02 12:00:00", "S3", "5", "20.0", "0.2")])
    args = (inbox, order_line_contract(), f"{root}/master", f"{root}/quarantine", f"{root}/ckpt")
    run_available(spark, *args, archive=f"{root}/archive", counts=f"{root}/counts")
    assert spark.read.parquet(f"{root}/master").count() == 1
    per_file = {r.source_file: (r.rows, r.accepted, r.rejected) for r in spark.read.parquet(f"{root}/counts").collect()}
    assert per_file == {"a.csv": (2, 1, 1), "b.csv": (1, 0, 1)}
    assert spark.read.parquet(f"{root}/quarantine").count() == 2
    # restart with one new file: only it is read
    write(f"{inbox}/c.csv", [("4", "c4", "2025-07-02 13:00:00", "S4", "1", "5.0", "0.0")])
    run_available(spark, *args, archive=f"{root}/archive")
    m = spark.read.parquet(f"{root}/master")
    assert sorted(r.order_id for r in m.collect()) == ["1", "4"]
    assert spark.read.parquet(f"{root}/quarantine").count() == 2
    # a third run with nothing new adds nothing
    run_available(spark, *args, archive=f"{root}/archive")
    assert spark.read.parquet(f"{root}/master").count() == 2


def test_inbox_of_mixed_headers_is_mapped_by_name_and_routed(spark):
    from roaskit.operators.quality import web_session_contract
    root = tempfile.mkdtemp(prefix="roaskit-stream-")
    inbox = os.path.join(root, "inbox")
    os.makedirs(inbox)
    files = {
        "a.csv": HEADER + "1,c1,2025-07-02 10:00:00,S1,2,10.0,0.1\n2,c1,2025-07-02 10:00:00,S1,x,9.5,0\n",
        # price before quantity, an alias, and a column of its own
        "b.csv": "﻿sku,unit_price,qty,discount,datetime,customer_id,order_id,note\nS2,9,2,0,2025-07-03 10:00:00,c2,3,hi\n",
        # too many and too few fields
        "c[1].csv": HEADER + "4,c4,2025-07-02 10:00:00,S1,2,10.0,0.1,more\n5,c5,2025-07-02 10:00:00,S1,2\n",
        "d.csv": "user_id,session_id,session_start,source,medium,campaign\nu1,s1,2025-07-02 09:00:00,g,cpc,x\n,s2,2025-07-02 09:00:00,g,cpc,x\n",
        "e.csv": "colour,weight\nred,1\n",
        "f.csv": "",
    }
    for name, text in files.items():
        with open(f"{inbox}/{name}", "w", encoding="utf-8") as f:
            f.write(text)
    contracts = [order_line_contract(), web_session_contract()]
    run_available(spark, inbox, contracts, f"{root}/master", f"{root}/quarantine", f"{root}/ckpt")
    lines = sorted((r.order_id, r.customer_id, r.sku, r.qty, r.unit_price) for r in spark.read.parquet(f"{root}/master/order_lines").collect())
    assert lines == [("1", "c1", "S1", 2, 10.0), ("3", "c2", "S2", 2, 9.0)]
    assert [r.session_id for r in spark.read.parquet(f"{root}/master/web_sessions").collect()] == ["s1"]
    bad = {r.order_id: (r.errors, r.raw) for r in spark.read.parquet(f"{root}/quarantine/order_lines").collect()}
    assert set(bad) == {"2", "4", "5"} and '"qty":"x"' in bad["2"][1] and "more" in bad["4"][1]
    assert "malformed_row" in bad["4"][0] and "malformed_row" in bad["5"][0]
    hidden = spark.read.parquet(f"{root}/quarantine/web_sessions").first()
    assert hidden.session_id == "s2" and hidden.user_id is None and len(hidden.raw) == 64
    odd = spark.read.parquet(f"{root}/quarantine/unrouted").collect()
    assert {r.source_file for r in spark.read.parquet(f"{root}/quarantine/order_lines").collect()} == {"a.csv", "c%5B1%5D.csv"}
    assert [(r.source_file, r.raw, r.errors) for r in odd] == [("e.csv", "red,1", ["unknown_header"])]


def test_repeated_keys_go_to_quarantine_across_batches(spark):
    from roaskit.sources.files import append_to_master
    root = tempfile.mkdtemp(prefix="roaskit-stream-")
    inbox = os.path.join(root, "inbox")
    os.makedirs(inbox)
    row = ("1", "c1", "2025-07-02 10:00:00", "S1", "2", "10.0", "0.1")
    write(f"{inbox}/a.csv", [row, (*row[:4], "3", *row[5:])])
    args = (inbox, order_line_contract(), f"{root}/master", f"{root}/quarantine", f"{root}/ckpt")
    run_available(spark, *args, dedup_key=["order_id"])
    write(f"{inbox}/b.csv", [row])
    run_available(spark, *args, dedup_key=["order_id"])
    assert [r.qty for r in spark.read.parquet(f"{root}/master").collect()] == [2]
    bad = spark.read.parquet(f"{root}/quarantine").collect()
    assert sorted(r.qty for r in bad) == [2, 3] and all(r.errors == ["duplicate_key"] for r in bad)
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k long, v string")
    append_to_master(spark, df, f"{root}/table", ["k"], duplicates=f"{root}/twice")
    append_to_master(spark, df.where("k = 2"), f"{root}/table", ["k"], duplicates=f"{root}/twice")
    assert sorted((r.k, r.v) for r in spark.read.parquet(f"{root}/table").collect()) == [(1, "a"), (2, "c")]
    assert sorted((r.k, r.v) for r in spark.read.parquet(f"{root}/twice").collect()) == [(1, "b"), (2, "c")]


def test_an_ingest_keeps_no_copy_of_its_rows(spark, monkeypatch):
    """A task reads its split of the files, not a wider copy of all rows."""
    root = tempfile.mkdtemp(prefix="roaskit-stream-")
    os.makedirs(f"{root}/inbox")
    write(f"{root}/inbox/a.csv", [("1", "c1", "2025-07-02 10:00:00", "S1", "2", "10.0", "0.1"),
                                  ("2", "c2", "2025-07-02 11:00:00", "S2", "x", "15.0", "0.0")])
    kept, persist = [], type(spark.range(1)).persist
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda self, *a: (kept.append(self.columns), persist(self, *a))[1])
    run_available(spark, f"{root}/inbox", order_line_contract(), f"{root}/master", f"{root}/quarantine", f"{root}/ckpt",
                  counts=f"{root}/counts")
    assert spark.read.parquet(f"{root}/master").first().order_id == "1"
    bad = spark.read.parquet(f"{root}/quarantine").first()
    assert bad.order_id == "2" and bad.errors and '"x"' in bad.raw
    assert kept == []
