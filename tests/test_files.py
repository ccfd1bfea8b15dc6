import io
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from samplelake.operators import ledger as led
from samplelake.operators import registry, scanning
from samplelake.plans import jobs
from samplelake.plans import steps as st
from samplelake.sources import images, keyed, objects, tables, tarshards
from samplelake.sources.files import Files, split_path
from samplelake import staging
from samplelake import staging
from samplelake.functions.codecs import decode_png, encode_png
from samplelake.streaming import incremental


def picture(h, w, seed=0, channels=3):
    return np.random.default_rng(seed).integers(0, 256, (h, w, channels), dtype=np.uint8)


def put(root, files):
    for name, data in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    return str(root)


def jvm_image(spark, tmp_path, kind, h=6, w=9):
    """Image bytes in a format of the JVM's own encoder."""
    jvm = spark.sparkContext._jvm
    im = jvm.java.awt.image.BufferedImage(w, h, jvm.java.awt.image.BufferedImage.TYPE_3BYTE_BGR)
    for y in range(h):
        for x in range(w):
            im.setRGB(x, y, (20 * y << 16) + (10 * x << 8) + 60)
    path = tmp_path / f"made.{kind}"
    assert jvm.javax.imageio.ImageIO.write(im, kind, jvm.java.io.File(str(path)))
    return path.read_bytes()


def names(df, column="key"):
    return sorted(r[column] for r in df.select(column).collect())


# --- objects ------------------------------------------------------------------------


def test_objects(spark, tmp_path):
    root = put(tmp_path / "o", {f"prefix/f{i}.txt": f"data{i}".encode() for i in range(3)})
    listed = objects.list_objects(spark, root)
    assert sorted((r["key"], r["size_bytes"]) for r in listed.collect()) == [(f"prefix/f{i}.txt", 5) for i in range(3)]
    read = {r["key"]: bytes(r["content"]) for r in objects.read_objects(spark, root).collect()}
    assert read == {f"prefix/f{i}.txt": f"data{i}".encode() for i in range(3)}
    one = objects.read_object(spark, root, "prefix/f1.txt").first()
    assert bytes(one["content"]) == b"data1"
    fetched = objects.fetch_content(objects.spread_by_bytes(listed, "size_bytes", ["key"]))
    assert {r["key"]: bytes(r["content"]) for r in fetched.collect()} == read


def test_listing_spans_folders_and_odd_names(spark, tmp_path):
    files = {f"d{i}/e{j}/{k}.png": b"x" * k for i in range(9) for j in range(9) for k in range(3)}
    files |= {"_hidden/a.png": b"1", ".dot.png": b"2", "k=1/_x=2/b.png": b"3", "top.png": b""}
    root = put(tmp_path / "o", files)
    listed = {r["key"]: r["size_bytes"] for r in objects.list_objects(spark, root).collect()}
    assert listed == {k: len(d) for k, d in files.items()}
    read = {r["key"]: bytes(r["content"]) for r in objects.read_objects(spark, root).collect()}
    assert read == files


def test_write_objects(spark, tmp_path):
    rows = spark.createDataFrame([("foo/bar.txt", b"hello"), ("x y.bin", b"")], "key string, content binary")
    written = objects.write_objects(rows, str(tmp_path / "w"))
    assert sorted(map(tuple, written.collect())) == [("foo/bar.txt", 5), ("x y.bin", 0)]
    assert (tmp_path / "w/foo/bar.txt").read_bytes() == b"hello"
    assert sorted(f.name for f in (tmp_path / "w").rglob("*") if f.is_file()) == ["bar.txt", "x y.bin"]
    assert names(objects.list_objects(spark, str(tmp_path / "w"))) == ["foo/bar.txt", "x y.bin"]


@pytest.mark.parametrize(
    "path, parts",
    [
        ("/a/b", ("file", "", "/a/b")),
        ("file:/a/b", ("file", "", "/a/b")),
        ("file:///a/b", ("file", "", "/a/b")),
        ("hdfs://nn:8020/a", ("hdfs", "nn:8020", "/a")),
        ("s3a://bucket/a b", ("s3a", "bucket", "/a b")),
    ],
)
def test_paths(path, parts):
    assert split_path(path) == parts


# --- decoding and scanning ------------------------------------------------------------


@pytest.mark.parametrize("kind", ["png", "bmp", "gif", "jpg"])
def test_decode_formats(spark, tmp_path, kind):
    root = put(tmp_path / "d", {f"x/a.{kind}": jvm_image(spark, tmp_path, kind)})
    row = images.decode_images(spark, root).first()
    assert (row["key"], row["height"], row["width"]) == (f"x/a.{kind}", 6, 9)
    rgb = st.transform_images(images.decode_images(spark, root), [st.ToRgb(bgr=True)], levels=True).first()["image"]
    pixel = np.array(rgb["px"]).reshape(rgb["h"], rgb["w"], 3)[3, 2]
    assert np.max(np.abs(pixel - [60, 20, 60])) <= (25 if kind in ("jpg", "gif") else 0)


def test_scan(spark, tmp_path):
    good = encode_png(picture(20, 10))
    jpeg = jvm_image(spark, tmp_path, "jpg")
    files = {
        "p/a.png": good,
        "p/b.png": encode_png(picture(5, 5)),
        "p/cut.png": good[:-30],
        "p/bad.png": b"not an image",
        "p/empty.png": b"",
        "p/c.jpg": jpeg,
        "p/cut.jpg": jpeg[: len(jpeg) // 2],
        "p/d.bmp": jvm_image(spark, tmp_path, "bmp"),
        "p/e.gif": jvm_image(spark, tmp_path, "gif"),
        "p/f.png": b"P6\n2 2\n255\n" + bytes(12),
        "p/readme.txt": b"text",
    }
    root, out = put(tmp_path / "s", files), str(tmp_path / "out")
    summary = jobs.scan_dataset(spark, root, out, bucket="lake", prefix="p/").first()
    assert (summary["total"], summary["corrupted"], summary["unexpected_format"]) == (10, 4, 1)
    assert summary["total_size_bytes"] == sum(len(d) for n, d in files.items() if not n.endswith(".txt"))
    found = {r["key"]: r for r in spark.read.json(f"{out}/metadata/p.jsonl").collect()}
    assert (found["p/a.png"]["width"], found["p/a.png"]["height"], found["p/a.png"]["format"]) == (10, 20, "PNG")
    assert (found["p/c.jpg"]["width"], found["p/c.jpg"]["height"]) == (9, 6)
    assert (found["p/e.gif"]["width"], found["p/d.bmp"]["height"]) == (9, 6)
    for broken in ("p/cut.png", "p/bad.png", "p/cut.jpg", "p/empty.png"):
        assert found[broken]["corrupted"] and found[broken]["error"] and found[broken]["width"] is None
    recorded = registry.read_registry(spark, f"{out}/metadata/registry").collect()
    assert [(r["source_prefix"], r["metadata_key"], r["total"]) for r in recorded] == [("p/", "metadata/p.jsonl", 10)]


def test_scan_reads_many_small_files_in_few_tasks(spark, tmp_path, monkeypatch):
    good = encode_png(picture(4, 6))
    root = put(tmp_path / "s", {f"p{i % 7}/{i}.{'PNG' if i % 2 else 'txt'}": good for i in range(3000)})
    assert {name.rsplit(".", 1)[1] for name in images.decode_images(spark, root).inputFiles()} == {"PNG"}
    tasks, settings = [], {name: spark.conf.get(name) for name in images.SMALL_FILES}
    kept = images.stage
    monkeypatch.setattr(images, "stage", lambda df, label: tasks.append(df.rdd.getNumPartitions()) or kept(df, label))
    summary = jobs.scan_dataset(spark, root, str(tmp_path / "out"), bucket="b", prefix="p/").first()
    assert (summary["total"], summary["corrupted"]) == (1500, 0)
    assert tasks[0] <= spark.sparkContext.defaultParallelism + 1
    assert {name: spark.conf.get(name) for name in images.SMALL_FILES} == settings


def test_staged_tables_can_be_dropped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "shared_dir", lambda _: str(tmp_path))
    assert staging.stage(spark.range(3)).count() == 3
    folder = staging.staging_path(spark, "x").rsplit("/", 1)[0]
    assert Files().entries(folder)
    staging.drop_staged(spark)
    staging.drop_staged(spark)
    assert Files().entries(str(tmp_path)) == []


def test_empty_scan_summary(spark):
    empty = spark.createDataFrame([], "key string, size_bytes long, corrupted boolean, unexpected_format boolean")
    row = scanning.scan_summary(empty).first()
    assert (row["total"], row["corrupted"], row["avg_size_mb"]) == (0, 0, 0.0)
    line = scanning.scan_report(scanning.scan_summary(empty)).first()["report"]
    assert line == "Found 0 images, 0 corrupted, 0 unexpected format, avg size 0.0MB"


def test_exif(spark):
    data = [("a.jpg", 1, b"\xff\xd8\xff\xe1\x00\x10Exif\x00\x00rest\xff\xd9"), ("b.jpg", 1, b"\xff\xd8\xff\xe0JFIF\xff\xd9")]
    df = spark.createDataFrame(data, "key string, size_bytes long, content binary")
    assert {r["key"]: r["exif_present"] for r in scanning.validate_bytes(df).collect()} == {"a.jpg": True, "b.jpg": False}


def test_registry(spark, tmp_path):
    path = str(tmp_path / "registry")
    assert registry.read_registry(spark, path).count() == 0
    for i in range(4):
        entry = spark.range(1).select(
            F.lit("b").alias("source_bucket"), F.lit("p").alias("source_prefix"), F.lit(f"m{i}").alias("metadata_key"),
            F.timestamp_seconds(F.lit(i)).alias("at"), F.lit(i).cast("long").alias("total"), F.lit(0).cast("long").alias("corrupted"),
        )
        registry.append_scan(entry, path)
    last = registry.last_scans(registry.read_registry(spark, path), 3).collect()
    assert [r["metadata_key"] for r in last] == ["m3", "m2", "m1"]


def test_url_lists(spark, tmp_path):
    lines = tmp_path / "urls.txt"
    lines.write_text("# c\r\n http://a/1.jpg\t\r\n\n\t\nhttp://a/2.jpg\nhttp://a/3.jpg\n")
    assert [r["url"] for r in tables.read_url_list(spark, str(lines), 2).collect()] == ["http://a/1.jpg", "http://a/2.jpg"]
    table = tmp_path / "urls.csv"
    table.write_text("id,url\n1,http://a/1.jpg\n2,#no\n3,\n4,http://a/4.jpg\n")
    got = tables.read_url_list(spark, str(table)).orderBy("line_no").collect()
    assert [r["url"] for r in got] == ["http://a/1.jpg", "http://a/4.jpg"]


# --- shards -----------------------------------------------------------------------------


def sample_rows(spark, n=10, shard="s_00000.tar"):
    rows = spark.range(n).select(
        F.lit(shard).alias("shard"), F.col("id").alias("sample_idx"),
        F.format_string("img_%02d", "id").alias("key"),
        F.concat(F.unhex(F.lit("FFD8FF")), F.encode(F.col("id").cast("string"), "UTF-8")).alias("content"),
        F.when(F.col("id") != 3, F.col("id").cast("int")).alias("cls"),
    )
    return rows.withColumn("members", tarshards.sample_members(F.col("content"), F.col("cls")))


def test_members_of_a_large_batch_are_read_in_portions(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "tars")
    tarshards.write_shards(sample_rows(spark, 3000), root)
    index = tarshards.index_shards(tarshards.list_shard_files(spark, root))
    batch = index.toArrow().combine_chunks().to_batches()[0]
    monkeypatch.setattr(type(index), "mapInArrow", lambda self, function, schema: function)
    read = list(tarshards.fetch_members(index)(iter([batch])))
    assert max(part.num_rows for part in read) <= 512
    at = {i: dict(m) for part in read for i, m in zip(part["sample_idx"].to_pylist(), part["members"].to_pylist())}
    assert {i: m["jpg"] for i, m in at.items()} == {i: b"\xff\xd8\xff" + str(i).encode() for i in range(3000)}


def test_shard_round_trip(spark, tmp_path):
    root = str(tmp_path / "tars")
    written = tarshards.write_shards(sample_rows(spark), root).collect()
    assert [(r["shard"], r["samples"]) for r in written] == [("s_00000.tar", 10)]
    assert [f.name for f in (tmp_path / "tars").iterdir()] == ["s_00000.tar"]
    assert (tmp_path / "tars/s_00000.tar").stat().st_size == written[0]["size_bytes"]
    with tarfile.open(tmp_path / "tars/s_00000.tar") as tar:
        assert tar.getnames()[:3] == ["img_00.jpg", "img_00.cls", "img_01.jpg"]
        assert "img_03.cls" not in tar.getnames()
        assert tar.extractfile("img_05.cls").read() == (5).to_bytes(4, "little")
    back = tarshards.read_shards(spark, root).orderBy("sample_idx").collect()
    assert [r["key"] for r in back] == [f"img_{i:02d}" for i in range(10)]
    assert [bytes(r["members"]["jpg"]) for r in back] == [b"\xff\xd8\xff" + str(i).encode() for i in range(10)]


def test_written_shards_are_named_in_order(spark, tmp_path):
    files = {f"img_{i}.jpg": b"\xff\xd8\xff" + bytes(50) for i in range(5)}
    root, out = put(tmp_path / "imgs", files), str(tmp_path / "shards")
    manifest = jobs.shard_dataset(objects.list_objects(spark, root), "", out, shard_size=2)
    assert manifest.count() == 5
    listed = tarshards.list_shard_files(spark, out)
    assert names(listed, "shard") == [f"shard_0000{i}.tar" for i in range(3)]
    assert tables.read_manifest(spark, out).count() == 5
    by_count = jobs.shard_dataset(objects.list_objects(spark, root), "", str(tmp_path / "two"), num_shards=2)
    assert sorted(r["n"] for r in by_count.groupBy("shard").agg(F.count("*").alias("n")).collect()) == [2, 3]


def test_every_split_is_sharded(spark, tmp_path):
    files = {f"d/{s}/c{i}/{s}{i}.png": encode_png(picture(4, 4, i)) for s in ("train", "val") for i in range(3)}
    root = put(tmp_path / "in", files)
    out = str(tmp_path / "out")
    manifest = jobs.shard_dataset(objects.list_objects(spark, root), "d/", out, splits=["train", "val"], shard_size=2)
    assert names(manifest.select("shard").distinct(), "shard") == [
        "train_00000.tar", "train_00001.tar", "val_00000.tar", "val_00001.tar",
    ]
    read = tarshards.read_shards(spark, out)
    assert names(read) == sorted(n.rsplit("/", 1)[1][:-4] for n in files)


def test_shard_config(spark, tmp_path):
    files = {f"{s}/c{i}/{s}{i}.png": encode_png(picture(4, 4, i)) for s in ("train", "val") for i in range(3)}
    root = put(tmp_path / "in", files | {"train/c0/x.gif": b"GIF89a"})
    path = tmp_path / "shard.yaml"
    path.write_text(
        f"input_root: {root}\noutput_dir: {tmp_path}/out\nshard_size: 2\nextensions: [png, gif]\n"
        f"splits: [train, val]\nupload_uri: {tmp_path}/copy\n"
    )
    manifest = jobs.shard_from_config(spark, str(path), shard_size=3)
    assert names(manifest.select("shard").distinct(), "shard") == ["train_00000.tar", "train_00001.tar", "val_00000.tar"]
    assert names(tarshards.list_shard_files(spark, f"{tmp_path}/copy"), "shard") == [
        "train_00000.tar", "train_00001.tar", "val_00000.tar",
    ]
    assert tables.read_manifest(spark, f"{tmp_path}/copy").count() == 7
    with pytest.raises(ValueError, match="output_dir"):
        jobs.shard_from_config(spark, {"input_root": root})


def test_dots_and_repeated_names_keep_their_place(spark, tmp_path):
    files = {f"c{i}/{n}.png": encode_png(picture(4, 4, i)) for i in range(3) for n in ("same", "a.b.c")}
    root, source, out = put(tmp_path / "in", files), str(tmp_path / "tars"), str(tmp_path / "out")
    listing = objects.list_objects(spark, root)
    # All samples of one name in a row, as under an order by name.
    manifest = jobs.shard_dataset(listing.filter(F.col("key").endswith("same.png")), "", source, shard_size=10)
    read = tarshards.read_shards(spark, source).join(manifest, ["shard", "sample_idx"]).collect()
    assert {r["source"]: bytes(r["members"]["jpg"]) for r in read} == {n: d for n, d in files.items() if "same" in n}
    manifest = jobs.shard_dataset(listing, "", f"{source}2", shard_size=10)
    read = tarshards.read_shards(spark, f"{source}2").join(manifest, ["shard", "sample_idx"]).collect()
    assert {r["source"]: bytes(r["members"]["jpg"]) for r in read} == files
    assert {(r["key"], r["__key__"]) for r in read} == {("a_b_c", "a.b.c"), ("same", "same")}
    jobs.transform_sharded(spark, f"{source}2", [], out, job="j")
    assert sorted(r["key"] for r in jobs.read_ledger(spark, f"{out}/ledger").collect()) == ["a.b.c"] * 3 + ["same"] * 3


def test_foreign_tars(spark, tmp_path):
    buffer = io.BytesIO()
    with tarfile.open(fileobj=buffer, mode="w") as tar:
        for name, data in [("d/a.jpg", b"1"), ("d/a.cls", b"2"), ("d/b.txt", b"3"), ("e/a.seg.PNG", b"4")]:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    root = put(tmp_path / "t", {"x.tar": buffer.getvalue(), "y.tar": buffer.getvalue(), "other.txt": b""})
    wanted = spark.createDataFrame([("x.tar",)], "shard string")
    got = tarshards.read_shards(spark, root, wanted).orderBy("sample_idx").collect()
    assert [(r["shard"], r["key"], sorted(r["members"])) for r in got] == [
        ("x.tar", "d/a", ["cls", "jpg"]), ("x.tar", "d/b", ["txt"]), ("x.tar", "e/a", ["seg.png"]),
    ]
    assert len([r for r in got if "jpg" in r["members"]]) == 1


def test_large_tar_is_shared_by_tasks(spark, tmp_path):
    rows = sample_rows(spark, 200)
    root = str(tmp_path / "t")
    tarshards.write_shards(rows, root)
    index = tarshards.index_shards(tarshards.list_shard_files(spark, root))
    spread = tarshards.spread_reads(index, task_bytes=10_000)
    held = spread.groupBy(F.spark_partition_id()).count().count()
    assert held > 1
    assert tarshards.fetch_members(spread).count() == 200


# --- transform jobs -----------------------------------------------------------------------


STEPS = [st.Resize((16, 16)), st.Normalize()]


def test_sharded_transform(spark, tmp_path):
    files = {f"train/n0/img{i}.png": encode_png(picture(8, 8, i)) for i in range(2)}
    root, source, out = put(tmp_path / "in", files), str(tmp_path / "tars"), str(tmp_path / "out")
    jobs.shard_dataset(objects.list_objects(spark, root), "", source, splits=["train"], shard_size=10)
    timings = jobs.run_transform(spark, source, STEPS, out, job="job")
    assert {"metadata_load", "index", "process", "ledger"} <= set(timings.seconds)
    got = tarshards.read_shards(spark, out).collect()
    assert {r["key"] for r in got} == {"img0", "img1"} and {r["shard"] for r in got} == {"train_00000.tar"}
    assert decode_png(bytes(got[0]["members"]["png"])).shape == (16, 16, 3)
    assert bytes(got[0]["members"]["cls"]) == bytes(4)
    done = jobs.read_ledger(spark, f"{out}/ledger", "job")
    assert names(done) == ["img0", "img1"]
    expected = tables.read_manifest(spark, source).select(F.col("__key__").alias("key"))
    assert led.reconcile_keys(done, expected, ["key"]).count() == 0


def test_sharded_resume(spark, tmp_path, monkeypatch):
    files = {f"c/img{i}.png": encode_png(picture(8, 8, i)) for i in range(6)}
    root, source, out = put(tmp_path / "in", files), str(tmp_path / "tars"), str(tmp_path / "out")
    jobs.shard_dataset(objects.list_objects(spark, root), "", source, shard_size=2)

    # Stop between writing the second wave's output and its ledger entry.
    real, calls = jobs.append_to_ledger, []

    def stops(*a):
        calls.append(a)
        if len(calls) == 2:
            raise RuntimeError("lost driver")
        real(*a)

    monkeypatch.setattr(jobs, "append_to_ledger", stops)
    with pytest.raises(RuntimeError):
        jobs.transform_sharded(spark, source, STEPS, out, job="job", wave=1)
    monkeypatch.setattr(jobs, "append_to_ledger", real)
    assert jobs.read_ledger(spark, f"{out}/ledger").count() == 2
    kept = (tmp_path / "out/shard_00000.tar").stat().st_mtime_ns
    jobs.transform_sharded(spark, source, STEPS, out, job="job")
    assert jobs.read_ledger(spark, f"{out}/ledger").count() == 6
    assert (tmp_path / "out/shard_00000.tar").stat().st_mtime_ns == kept
    assert names(tarshards.read_shards(spark, out)) == [f"img{i}" for i in range(6)]
    again = jobs.transform_sharded(spark, source, STEPS, out, job="job")
    assert "process" not in again.seconds


@pytest.mark.parametrize("decoder", ["spark", "python"])
def test_flat_transform_and_resume(spark, tmp_path, decoder):
    files = {f"c{i % 2}/same.png" if i < 2 else f"c/{i}.png": encode_png(picture(8, 8, i)) for i in range(5)}
    root, out = put(tmp_path / "in", files | {"c/notes.txt": b"x", "c/bad.png": b"no"}), str(tmp_path / "out")
    job = lambda: jobs.run_transform(spark, root, [st.Augment(flip_h=True)], out, job="j")
    if decoder == "python":
        job = lambda: jobs.transform_flat(
            spark, root, [st.Augment(flip_h=True)], out, job="j", decoder="python", dest_prefix="done/", wave=2
        )
    job()
    got = {r["key"]: r for r in jobs.read_transformed(spark, out).collect()}
    assert sorted(got) == sorted(files)
    for name, data in files.items():
        im = got[name]["image"]
        arr = np.frombuffer(im["px"], np.uint8).reshape(im["h"], im["w"], im["c"])
        assert np.array_equal(arr, decode_png(data)[:, ::-1])
        assert got[name]["dest"] == ("done/" + name if decoder == "python" else name)
    put(tmp_path / "in", {"new/9.png": encode_png(picture(8, 8, 9))})
    job()
    assert names(jobs.read_transformed(spark, out)) == sorted([*files, "new/9.png"])


def test_unfinished_run_does_not_count(spark, tmp_path, monkeypatch):
    root = put(tmp_path / "in", {f"{i}.png": encode_png(picture(4, 4, i)) for i in range(3)})
    out = str(tmp_path / "out")
    real = jobs.append_to_ledger

    def lost(*_):
        raise RuntimeError("lost driver")

    monkeypatch.setattr(jobs, "append_to_ledger", lost)
    with pytest.raises(RuntimeError):
        jobs.transform_flat(spark, root, [], out, job="j", decoder="python")
    monkeypatch.setattr(jobs, "append_to_ledger", real)
    jobs.transform_flat(spark, root, [], out, job="j", decoder="python")
    assert names(jobs.read_transformed(spark, out)) == ["0.png", "1.png", "2.png"]


def test_python_decoder_on_damage(spark):
    df = spark.createDataFrame([(b"no",), (encode_png(picture(3, 4, channels=1)),), (None,)], "d binary")
    got = [r["i"] for r in df.select(images.decoded(F.col("d")).alias("i")).collect()]
    assert got[0] is None and got[2] is None
    assert (got[1]["h"], got[1]["w"], got[1]["c"]) == (3, 4, 3)


# --- keyed datasets ---------------------------------------------------------------------


def test_convert(spark, tmp_path):
    files = {f"root/train/{c}/{i}.png": encode_png(picture(4, 4, i)) for c in ("b", "a") for i in range(3)}
    root, out = put(tmp_path / "in", files), str(tmp_path / "out")
    listing = objects.list_objects(spark, root)
    row = jobs.convert_keyed(listing, "root", out, split="train").first()
    assert (row["count"], row["version"], row["key_width"], row["num_classes"]) == (6, 1, 10, 2)
    assert row["source"] == "root/train" and len(row["version_hash"]) == 12
    data = keyed.read_keyed(spark, out).orderBy("idx").collect()
    assert [r["idx"] for r in data] == list(range(6)) and data[5]["key"] == "0000000005"
    assert [r["label"] for r in data] == [0, 0, 0, 1, 1, 1]
    assert bytes(data[3]["image"]) == files["root/train/b/0.png"]
    assert keyed.dataset_length(spark, out) == 6
    assert {r["label"]: r["idx"] for r in keyed.read_labels(spark, out).collect()} == {"a": 0, "b": 1}
    seen = jobs.read_for_training(spark, out, [st.TrainView(size=2, resize=4, seed=1)])
    assert {(r["image"]["h"], r["image"]["w"]) for r in seen.collect()} == {(2, 2)}


def test_training_batches(spark, tmp_path):
    files = {f"r/c{i % 2}/{i}.png": encode_png(picture(6, 6, i)) for i in range(10)}
    root, out = put(tmp_path / "in", files), str(tmp_path / "out")
    jobs.convert_keyed(objects.list_objects(spark, root), "r", out)
    chain = [st.TrainView(size=4, resize=5, seed=1)]
    rows = jobs.training_batches(spark, out, 4, chain, epoch=1, seed=2, pad_last=True).collect()
    places = sorted((r["batch_id"], r["batch_pos"]) for r in rows)
    assert places == [(b, p) for b in range(3) for p in range(4)]
    assert {r["idx"] for r in rows} == set(range(10))
    assert all((r["image"]["h"], r["image"]["w"]) == (4, 4) for r in rows)
    placed = {}
    for r in rows:
        placed.setdefault(r["batch_id"], []).append(r["batch_pos"])
    assert all(p == sorted(p) for p in placed.values())
    short = jobs.training_batches(spark, out, 4, epoch=1, seed=2, max_steps=2)
    assert short.count() == 8


def test_missing_files_leave_no_gap(spark, tmp_path):
    files = {f"r/c/{i}.png": encode_png(picture(4, 4, i)) for i in range(4)}
    root, out = put(tmp_path / "in", files), str(tmp_path / "out")
    present = objects.list_objects(spark, root)
    gone = present.unionByName(spark.createDataFrame([("x", "r/c/1a.png", 3)], present.schema))
    jobs.convert_keyed(gone, "r", out, present=present)
    assert [r["idx"] for r in keyed.read_keyed(spark, out).orderBy("idx").collect()] == [0, 1, 2, 3]


def test_lookup_reads_few_row_groups(spark, tmp_path):
    data = spark.range(1000).select(F.col("id").alias("idx"))
    data.write.parquet(str(tmp_path / "d"))
    one = spark.read.parquet(str(tmp_path / "d")).filter("idx = 7")
    assert "PushedFilters: [IsNotNull(idx), EqualTo(idx,7)]" in one._jdf.queryExecution().executedPlan().toString()


def test_no_manifest(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        keyed.load_manifest(spark, str(tmp_path / "none"))


# --- streams ------------------------------------------------------------------------------


def test_incremental_scan(spark, tmp_path):
    root = put(tmp_path / "in", {"a.png": encode_png(picture(5, 5)), "t.txt": b"x"})
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    assert names(incremental.incremental_scan(spark, root, out, mark)) == ["a.png"]
    put(tmp_path / "in", {"b.png": b"broken"})
    got = {r["key"]: r["corrupted"] for r in incremental.incremental_scan(spark, root, out, mark, 1).collect()}
    assert got == {"a.png": False, "b.png": True}
