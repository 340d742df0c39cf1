import os

import pytest
from pyspark.sql import functions as F

from backdrop import schemas, storage
from backdrop.plans import batch as B
from backdrop.sinks import frames as SK
from backdrop.sources import captures as CAP
from backdrop.sources import images as IM
from tests.conftest import A_RGB, G_GREY, write_png
from tests.test_captures import RECS, session_capture


@pytest.fixture()
def mounted(spark, tmp):
    """A second scheme: ``viewfs://shelf/in`` leads to a folder of this test."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name in ("in", "out"):
        os.makedirs(os.path.join(tmp, name))
        conf.set(f"fs.viewfs.mounttable.shelf.link./{name}", f"file://{tmp}/{name}")
    # Mount tables are read when a file system is opened; the one of an earlier test leads elsewhere.
    spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.closeAll()
    yield "viewfs://shelf"
    for name in ("in", "out"):
        conf.unset(f"fs.viewfs.mounttable.shelf.link./{name}")


def test_resolve_leads_through_a_mount_table(spark, tmp, mounted):
    assert storage.resolve(spark, f"{tmp}/in") == f"file:{tmp}/in"
    assert storage.resolve(spark, f"{mounted}/in") == f"file:{tmp}/in"
    assert storage.resolve(spark, f"{mounted}/in/not/there yet") == f"file:{tmp}/in/not/there yet"


def test_rebase():
    assert storage.rebase("viewfs://s/in/a/b.bin", "viewfs://s/in/", "file:/x/in") == "file:/x/in/a/b.bin"
    assert storage.rebase("file:///x/in/a.bin", "/x/in", "file:/y") == "file:/y/a.bin"


def test_files(tmp):
    folder = f"file:{tmp}/a/b c%20"
    storage.make_dir(folder)
    with storage.create_file(f"{folder}/one") as out:
        out.write(b"12345")
    storage.make_dir(f"{folder}/deep")
    with storage.create_file(f"{folder}/deep/two"):
        pass
    assert storage.list_dir(folder) == [(f"{folder}/deep", 0, True), (f"{folder}/one", 5, False)]
    assert sorted(e.uri for e in storage.walk(f"file:{tmp}")) == [f"{folder}/deep/two", f"{folder}/one"]
    assert storage.size_of(f"{folder}/one") == 5 and storage.size_of(folder) is None and storage.list_dir(f"{folder}/x") == []
    storage.move(f"{folder}/one", f"{folder}/deep/two")
    with storage.open_file(f"{folder}/deep/two") as src:
        src.seek(3)
        assert src.read(9) == b"45"
    storage.delete(folder)
    storage.delete(folder)
    assert storage.list_dir(f"file:{tmp}/a") == []
    with pytest.raises(ValueError, match="cannot open"):
        storage.open_file("viewfs://shelf/in/x")


def test_folder_job_history_and_captures_by_another_scheme(spark, tmp, mounted):
    write_png(f"{tmp}/in/s1/a.png", A_RGB)
    write_png(f"{tmp}/in/s1/g.png", G_GREY)
    open(f"{tmp}/in/s1/empty.png", "wb").close()
    open(f"{tmp}/in/s1/bad.jpg", "wb").write(b"nothing")
    os.makedirs(f"{tmp}/in/s2")
    rows = {r["filename"]: r for r in B.process_folder(spark, f"{mounted}/in", f"{mounted}/out").collect()}
    assert {n: r["status"] for n, r in rows.items()} == {"a.png": "success", "g.png": "success", "empty.png": "unreadable", "bad.jpg": "unreadable"}
    assert [rows[n]["frame_id"] for n in ("a.png", "bad.jpg", "empty.png", "g.png")] == [0, 1, 2, 3]
    assert rows["a.png"]["output_path"] == f"{mounted}/out/s1/a.png" and rows["a.png"]["input_path"] == f"{mounted}/in/s1/a.png"
    assert sorted(os.listdir(f"{tmp}/out/s1")) == ["a.png", "g.png"] and os.listdir(f"{tmp}/out") == ["s1"]
    assert IM.read_image_folder(spark, f"{mounted}/out").where("mode >= 0").count() == 2
    history = B.history(spark, f"{mounted}/in", f"{mounted}/out").collect()
    assert [(r["session_id"], r["input_count"], r["output_count"]) for r in history] == [("s2", 0, 0), ("s1", 4, 2)]

    os.makedirs(f"{tmp}/in/caps")
    with open(f"{tmp}/in/caps/c.bin", "wb") as fh:
        fh.write(session_capture(RECS))
    for records in (CAP.read_captures(spark, f"{mounted}/in/caps"), CAP.read_capture_files(spark, f"{mounted}/in/caps")):
        assert [r["payload"] for r in CAP.frames_of(records).orderBy("seq").collect()] == [p for _, _, p in RECS]


def frames_to_land(spark, n, bad=None):
    rows = spark.range(n).select(F.lit("s").alias("session_id"), F.col("id").alias("seq"), F.concat("id", F.lit(".bin")).alias("filename"),
                                 F.col("id").cast("string").cast("binary").alias("payload"), F.lit("success").alias("status"),
                                 F.lit(None).cast("string").alias("message"))
    if bad is not None:
        rows = rows.withColumn("seq", F.when(F.col("seq") == bad, F.raise_error(F.lit("broken row")).cast("long")).otherwise(F.col("seq")))
    return rows.repartition(4)


def test_a_failed_task_leaves_no_file(spark, tmp):
    with pytest.raises(Exception, match="broken row"):
        SK.land_payloads(frames_to_land(spark, 40, bad=17), f"{tmp}/landing")
    assert [f for _, _, names in os.walk(f"{tmp}/landing") for f in names] == []
    done = SK.land_payloads(frames_to_land(spark, 40), f"{tmp}/landing")
    assert done.count() == 40 and len(os.listdir(f"{tmp}/landing/s")) == 40 and os.listdir(f"{tmp}/landing") == ["s"]
    row = done.where("seq = 7").first()
    assert row["path"] == f"{tmp}/landing/s/7.bin" and open(row["path"], "rb").read() == b"7"


def test_names_that_lead_elsewhere_are_refused(spark, tmp):
    rows = spark.createDataFrame([("s", 0, "..", b"x"), ("../t", 1, "a", b"x"), ("s", 2, "x/../b", b"x"), ("s/t", 3, "c", b"x")],
                                 "session_id string, seq long, filename string, payload binary").withColumn("status", F.lit(schemas.SUCCESS)) \
        .withColumn("message", F.lit(None).cast("string"))
    done = {r["seq"]: r for r in SK.land_payloads(rows, f"{tmp}/landing").collect()}
    assert {k: r["status"] for k, r in done.items()} == {0: "error", 1: "error", 2: "success", 3: "success"}
    assert done[2]["path"] == f"{tmp}/landing/s/b" and os.path.exists(f"{tmp}/landing/s/t/c") and not os.path.exists(f"{tmp}/t")


def test_nothing_to_write(spark, tmp):
    assert SK.land_payloads(frames_to_land(spark, 0), f"{tmp}/landing").count() == 0
