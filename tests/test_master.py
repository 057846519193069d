import os
import tempfile

import pytest
from pyspark.sql import functions as F

from roaskit.operators.quality import order_line_contract
from roaskit.sources import files
from roaskit.sources.master import BATCH, BUCKET, CommitLog, KeyedMaster, log_of, read_committed
from roaskit.streaming import ingest

HEADER = "order_id,customer_id,order_datetime,sku,qty,unit_price,discount\n"


def _root():
    return tempfile.mkdtemp(prefix="roaskit-master-")


def _rows(spark, keys, value):
    return spark.createDataFrame([(k, value) for k in keys], "k long, v string")


def test_an_append_reads_only_the_buckets_of_its_keys(spark):
    root = _root()
    for start in (0, 500):
        files.append_to_master(spark, _rows(spark, range(start, start + 500), "old"), f"{root}/t", ["k"])
    table = KeyedMaster(spark, f"{root}/t", ["k"])
    batch = _rows(spark, [7, 7, 10_000_007], "new")
    one = batch.where("k = 7")
    touched = table.touched(one)
    assert len(touched) == 1 and table.buckets == 64
    read = table.keys(touched).inputFiles()
    assert read and {f.split(f"{BUCKET}=")[1].split("/")[0] for f in read} == {str(touched[0])}
    files.append_to_master(spark, batch, f"{root}/t", ["k"], duplicates=f"{root}/again")
    got = files.read_master(spark, f"{root}/t")
    assert got.columns == ["k", "v"] and got.count() == 1001
    assert got.where("k = 7").first().v == "old" and got.where("k = 10000007").first().v == "new"
    assert [tuple(r) for r in files.read_master(spark, f"{root}/again", of=f"{root}/t").collect()] == [(7, "new")] * 2


def test_null_keys_and_odd_names_are_keys_like_any_other(spark):
    root = _root()
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "`the key` string, v long")
    for _ in range(2):
        files.append_to_master(spark, df, f"{root}/t", ["the key"])
    assert sorted((r[0] or "", r[1]) for r in files.read_master(spark, f"{root}/t").collect()) == [("", 1), ("a", 3)]
    with pytest.raises(ValueError):
        KeyedMaster(spark, f"{root}/t", ["v"])


def test_new_rows_are_found_without_the_columns_that_they_do_not_keep(spark):
    root = _root()
    rows = [("a", 0.0, "x"), ("a", -0.0, "w"), ("a", 0.0, "v"), ("b", None, "u"), ("b", None, "t"), (None, 1.0, "s")]
    spark.createDataFrame(rows, "k string, v double, whole_text string").write.parquet(f"{root}/in")
    df, table = spark.read.parquet(f"{root}/in"), KeyedMaster(spark, f"{root}/t", ["k"])
    new, again = table.split(df, ["k", "v", "whole_text"], kept=["k", "v"])
    assert "whole_text" not in new._jdf.queryExecution().executedPlan().toString()
    # 0.0 and -0.0 tie, but what one table takes the other must not hold
    assert sorted(map(repr, map(tuple, new.collect()))) == ["('a', -0.0)", "('b', None)", "(None, 1.0)"]
    assert sorted(map(repr, map(tuple, again.collect()))) == ["('a', 0.0, 'v')", "('a', 0.0, 'x')", "('b', None, 'u')"]
    with pytest.raises(ValueError):
        table.split(df, ["whole_text", "k", "v"], kept=["k", "v"])


def test_compaction_keeps_rows_and_frees_the_old_folders(spark):
    root = _root()
    for k in range(4):
        files.append_to_master(spark, _rows(spark, range(10 * k, 10 * k + 10), f"b{k}"), f"{root}/t", ["k"], buckets=4)
    table = KeyedMaster(spark, f"{root}/t", ["k"])
    before = sorted(map(tuple, table.read().collect()))
    table.compact()
    assert len(table.log.commits()) == 1 and table.buckets == 4
    table.vacuum()
    assert sorted(map(tuple, table.read().collect())) == before
    assert len([n for n in os.listdir(f"{root}/t") if n.startswith(BATCH)]) == 1
    files.append_to_master(spark, _rows(spark, [3, 99], "late"), f"{root}/t", ["k"])
    assert table.read().count() == 41 and table.read().where("k = 3").first().v == "b0"


def test_an_uncommitted_append_is_not_there(spark, monkeypatch):
    root = _root()
    files.append_to_master(spark, _rows(spark, [1], "a"), f"{root}/t", ["k"], duplicates=f"{root}/again")

    def crash(*args, **kwargs):
        raise OSError("lost")
    monkeypatch.setattr("roaskit.sources.master.write_batch", crash)
    with pytest.raises(OSError):
        files.append_to_master(spark, _rows(spark, [1, 2], "b"), f"{root}/t", ["k"], duplicates=f"{root}/again")
    monkeypatch.undo()
    assert files.read_master(spark, f"{root}/t").count() == 1
    files.append_to_master(spark, _rows(spark, [1, 2], "b"), f"{root}/t", ["k"], duplicates=f"{root}/again")
    assert sorted(map(tuple, files.read_master(spark, f"{root}/t").collect())) == [(1, "a"), (2, "b")]


def _drop(inbox, name, text):
    os.makedirs(inbox, exist_ok=True)
    with open(f"{inbox}/{name}", "w", encoding="utf-8", newline="") as f:
        f.write(text)


@pytest.mark.parametrize("crash_at", [0, 1, 2])
def test_a_batch_that_crashes_between_its_writes_shows_nothing(spark, monkeypatch, crash_at):
    """Master, quarantine and counts of a batch are all there or none is, and the next run writes them once."""
    root, calls = _root(), []
    tables = {name: f"{root}/{name}" for name in ("master", "quarantine", "counts")}
    _drop(f"{root}/inbox", "a.csv", HEADER + "1,c1,2025-07-02 10:00:00,S1,2,10.0,0.1\n2,c2,2025-07-02 11:00:00,S2,0,15.0,0.0\n")
    real = ingest.write_batch

    def write(frame, table, batch):
        calls.append(table)
        if len(calls) == crash_at + 1:
            raise OSError("executor and driver lost")
        return real(frame, table, batch)
    args = (spark, f"{root}/inbox", order_line_contract(), tables["master"], tables["quarantine"], f"{root}/ckpt")
    monkeypatch.setattr(ingest, "write_batch", write)
    with pytest.raises(Exception):
        ingest.run_available(*args, counts=tables["counts"])
    assert len(calls) == crash_at + 1
    assert all(read_committed(spark, t, log_of(tables["master"])) is None for t in tables.values())
    monkeypatch.undo()
    ingest.run_available(*args, counts=tables["counts"])
    ingest.run_available(*args, counts=tables["counts"])
    got = {n: read_committed(spark, t, log_of(tables["master"])).count() for n, t in tables.items()}
    assert got == {"master": 1, "quarantine": 1, "counts": 1}


def test_a_batch_replayed_after_its_commit_is_not_run_again(spark):
    root = _root()
    _drop(f"{root}/inbox", "a.csv", HEADER + "1,c1,2025-07-02 10:00:00,S1,2,10.0,0.1\n")
    args = (spark, f"{root}/inbox", order_line_contract(), f"{root}/master", f"{root}/quarantine")
    ingest.run_available(*args, f"{root}/ckpt", dedup_key=["order_id"])
    ingest.run_available(*args, f"{root}/other_ckpt", dedup_key=["order_id"])  # the same batch id once more
    assert read_committed(spark, f"{root}/master").count() == 1
    assert read_committed(spark, f"{root}/quarantine", log_of(f"{root}/master")).count() == 0


def test_quoted_breaks_repeated_headers_and_empty_files(spark):
    root = _root()
    inbox = f"{root}/inbox"
    _drop(inbox, "a.csv", HEADER + '1,"c\n1",2025-07-02 10:00:00,"S,1",2,10.0,0.1\n2,c2,2025-07-02 10:00:00,"S\n\n2",3,1.5,0\n')
    _drop(inbox, "b [1].csv", HEADER + '3,"c\r\n3",2025-07-02 10:00:00,S3,1,2.0,0\n')
    _drop(inbox, "c.csv", HEADER + "4,c4,2025-07-02 10:00:00,S4,2,10.0,0.1\n" + HEADER)
    _drop(inbox, "d.csv", "colour,weight\nred,1\ncolour,weight\n\"open,2\n")
    _drop(inbox, "e.csv", "")
    ingest.run_available(spark, inbox, order_line_contract(), f"{root}/master", f"{root}/quarantine", f"{root}/ckpt")
    good = {r.order_id: (r.customer_id, r.sku) for r in read_committed(spark, f"{root}/master").collect()}
    assert {k: (c.replace("\r", ""), s) for k, (c, s) in good.items()} == {
        "1": ("c\n1", "S,1"), "2": ("c2", "S\n\n2"), "3": ("c\n3", "S3"), "4": ("c4", "S4")}
    bad = read_committed(spark, f"{root}/quarantine", log_of(f"{root}/master")).collect()
    # a line that equals the header is a row like any other, and is told as what it is
    assert sorted((r.source_file, r.raw) for r in bad if r.errors == ["unknown_header"]) == [
        ("d.csv", '"open,2'), ("d.csv", "colour,weight"), ("d.csv", "red,1")]
    assert [(r.source_file, r.order_id) for r in bad if r.errors != ["unknown_header"]] == [("c.csv", "order_id")]
