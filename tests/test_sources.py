import os
import tempfile

from pyspark.sql import functions as F

from roaskit.operators.joins import duplicate_keys, full_align, join_with_suffixes
from roaskit.sources import files


def test_messy_spreadsheet(spark):
    d = tempfile.mkdtemp(prefix="roaskit-src-")
    p = os.path.join(d, "media.csv")
    text = ('\ufeffCHANNEL\tYEAR\tJANUARY\tFEBRUARY\t\t\n'
            'Paid Search Media\t2024\t"$52,392 "\t"1,252"\t\t\n'
            '"Paid Social\nAgency"\t2024\t"($12.00)"\t\t\t\n')
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    df = files.normalize_columns(files.read_messy_csv(spark, p, sep="\t"))
    assert df.columns[:4] == ["channel", "year", "january", "february"]
    assert not any(c.startswith("_c") for c in df.columns)
    rows = df.collect()
    assert rows[1].channel == "Paid Social\nAgency" and rows[0].january == "$52,392 "
    ren = files.rename_columns(df, {"channel": "channel_name"}, first_as="label")
    assert ren.columns[0] == "label"
    q = os.path.join(d, "latin.csv")
    with open(q, "w", encoding="latin-1") as f:
        f.write("Channel,Value\nCaf\u00e9,1\n")
    lat = files.read_messy_csv(spark, q, encoding="ISO-8859-1")
    assert lat.first()[0] == "Caf\u00e9"


def test_scan_drop_folder_and_append_dedup(spark):
    d = tempfile.mkdtemp(prefix="roaskit-src-")
    for name, rows in [("a.csv", ["s1,u1", "s2,u2"]), ("b.csv", ["s2,u2", "s3,u3"]), ("notes.txt", ["x,y"])]:
        with open(os.path.join(d, name), "w") as f:
            f.write("session_id,user_id\n" + "\n".join(rows) + "\n")
    scan = files.scan_drop_folder(spark, d, "*.csv", schema="session_id string, user_id string")
    assert sorted((r.source_file, r.session_id) for r in scan.collect()) == [
        ("a.csv", "s1"), ("a.csv", "s2"), ("b.csv", "s2"), ("b.csv", "s3")]
    master = os.path.join(d, "master")
    for f in ("a.csv", "b.csv", "a.csv"):
        files.append_to_master(spark, scan.where(F.col("source_file") == f).drop("source_file"), master,
                               key=["session_id"])
    assert sorted(r.session_id for r in spark.read.parquet(master).collect()) == ["s1", "s2", "s3"]
    out = os.path.join(d, "out")
    files.write_table(spark.read.parquet(master), out)
    files.write_table(spark.read.parquet(master), out)
    assert spark.read.parquet(out).count() == 3


def test_join_helpers(spark):
    a = spark.createDataFrame([("d1", "k", 1.0), ("d2", "k", 2.0)], "date string, key string, value double")
    b = spark.createDataFrame([("d1", "k", 10.0)], "date string, key string, value double")
    j = join_with_suffixes(a, b, ["date", "key"], suffixes=("_media", "_agency"))
    assert sorted(j.columns) == ["date", "key", "value_agency", "value_media"]
    s1 = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "k string, spend double")
    s2 = spark.createDataFrame([("y", 3.0), ("z", 4.0)], "k string, fees double")
    got = {r.k: (r.spend, r.fees) for r in full_align(s1, s2, ["k"]).collect()}
    assert got == {"x": (1.0, 0.0), "y": (2.0, 3.0), "z": (0.0, 4.0)}
    assert duplicate_keys(a, ["key"]).first().n == 2


def test_appended_files_are_seen(spark):
    import tempfile

    from roaskit.sources.tables import load
    root = tempfile.mkdtemp(prefix="roaskit-append-")
    spark.range(3).write.parquet(f"{root}/t.parquet")
    assert load(spark, root, "t").count() == 3
    spark.range(5).write.mode("append").parquet(f"{root}/t.parquet")
    assert load(spark, root, "t").count() == 8
