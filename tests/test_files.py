from datetime import datetime, timedelta

from tidemill.session import fresh_dir
from tidemill.sources import files

BASE = datetime(2024, 1, 1)


def test_keep_newest_then_shortest_path(spark):
    rows = [
        ("/a/long/path", "path", 10, BASE, "x"),
        ("/a/new", "new", 10, BASE + timedelta(hours=1), "x"),
        ("/a/newer", "newer", 10, BASE + timedelta(hours=1), "x"),
        ("/b", "b", 7, BASE, "y"),
    ]
    df = spark.createDataFrame(rows, "path string, name string, size long, modified timestamp, digest string")
    assert [tuple(r) for r in files.keep_newest(df).collect()] == [("x", "/a/new", 2, 20)]
    assert [tuple(r) for r in files.duplicate_files(df).collect()] == [("x", 3, 30, "/a/long/path")]


def test_listing_digests_and_leaves_out_empty_files(spark):
    path = fresh_dir(spark, "files")
    for name, text in (("one", "same"), ("two", "same"), ("three", "other")):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/{name}")
    spark.createDataFrame([("x",)], "value string").limit(0).coalesce(1).write.text(f"{path}/none")
    assert files.nonempty_files(spark, path).count() == 3
    found = files.duplicate_files(files.file_table(spark, path)).collect()
    assert [(r.n_files, r.bytes) for r in found] == [(2, 10)]


def test_text_files_are_one_file_per_folder_as_spark_names_them(spark):
    import os

    rows = [("a\nb", "x/y=1"), ("ü", "é %"), (None, None), ("", ""), ("one", "k"), ("two", "k")] + [(f"t{i}", f"n{i}") for i in range(20)]
    df = spark.createDataFrame(rows, "value string, key string").coalesce(1)
    ours, sparks = fresh_dir(spark, "ours"), fresh_dir(spark, "sparks")
    files.write_text_files(df, ours, ["key"])
    df.write.partitionBy("key").text(sparks)
    content = lambda root: {d[len(root) :]: open(f"{d}/{f}", "rb").read() for d, _, fs in os.walk(root) for f in fs if f.endswith(".txt")}
    assert content(ours) == content(sparks) and len(content(ours)) == 24
    assert sum(len(fs) for _, _, fs in os.walk(ours)) == 24  # no second file beside each
