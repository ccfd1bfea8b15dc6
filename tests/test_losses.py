"""No object and no sample goes missing without a row that says why."""

import io
import os
import tarfile
import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_files import jvm_image, names, picture, put
from test_images import filtered_png

from samplelake.functions.codecs import encode_png
from samplelake.operators import joins, scanning, selection
from samplelake.plans import jobs
from samplelake.plans import steps as st
from samplelake.sources import images, keyed, objects, tables, tarshards
from samplelake.streaming import incremental

ODD_NAMES = ["my dog.png", "q%41.png", "x+y.png", "h#1.png", "äß.png", "_metadata/a.png", "x/c.png._COPYING_", "d.png.part"]


def test_odd_names(spark, tmp_path):
    files = {n: encode_png(picture(4, 4, i)) for i, n in enumerate(ODD_NAMES)}
    root = put(tmp_path / "in", files)
    assert names(objects.list_objects(spark, root)) == sorted(files)
    read = objects.read_objects(spark, root).collect()
    assert sorted((r["key"], bytes(r["content"])) for r in read) == sorted(files.items())
    plain = [n for n in ODD_NAMES if n.endswith(".png") and "_metadata" not in n]
    assert set(plain) <= set(names(images.decode_images(spark, root)))
    jobs.transform_flat(spark, root, [], str(tmp_path / "out"), job="j")
    done = names(jobs.read_transformed(spark, str(tmp_path / "out")))
    assert done == sorted(n for n in ODD_NAMES if n.endswith(".png"))


def test_scan_of_odd_names(spark, tmp_path):
    root = put(tmp_path / "in", {"bad img.png": b"\x89PNG\r\n\x1a\n" + b"x" * 40, "good one.png": encode_png(picture(4, 6))})
    jobs.scan_dataset(spark, root, str(tmp_path / "out"), bucket="b", prefix="p/")
    rows = {r["key"]: r for r in spark.read.json(f"{tmp_path}/out/metadata/p.jsonl").collect()}
    assert rows["bad img.png"]["corrupted"] and not rows["good one.png"]["corrupted"]
    assert (rows["good one.png"]["width"], rows["good one.png"]["height"]) == (6, 4)


def test_old_objects_that_arrive_late(spark, tmp_path):
    root, out, mark = put(tmp_path / "in", {"a.png": encode_png(picture(4, 4))}), str(tmp_path / "o"), str(tmp_path / "m")
    incremental.incremental_scan(spark, root, out, mark)
    put(tmp_path / "in", {"late_old.png": encode_png(picture(4, 4)), "late_new.png": encode_png(picture(4, 4))})
    then = time.time() - 30 * 86400
    os.utime(tmp_path / "in/late_old.png", (then, then))
    assert names(incremental.incremental_scan(spark, root, out, mark)) == ["a.png", "late_new.png", "late_old.png"]
    assert names(incremental.incremental_scan(spark, root, out, mark)) == ["a.png", "late_new.png", "late_old.png"]


def test_bytes_behind_the_end_marker(spark, tmp_path):
    jpeg = jvm_image(spark, tmp_path, "jpg")
    root = put(tmp_path / "in", {"motion.jpg": jpeg + b"\0" * 200, "cut.jpg": jpeg[:-2]})
    got = {r["key"]: r["error"] for r in incremental.incremental_scan(spark, root, str(tmp_path / "o"), str(tmp_path / "m")).collect()}
    assert got["motion.jpg"] is None and got["cut.jpg"] == "image data is truncated"


def tar_of(samples):
    buffer = io.BytesIO()
    with tarfile.open(fileobj=buffer, mode="w") as tar:
        for name, data in samples:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    return buffer.getvalue()


def test_sharded_transform_of_mixed_members(spark, tmp_path):
    picture_ = np.random.default_rng(1).integers(0, 256, (6, 9, 3), dtype=np.uint8)
    samples = [
        ("a.jpg", jvm_image(spark, tmp_path, "jpg")), ("b.png", filtered_png(picture_, 4)), ("c.jpg", b"broken"),
        ("d.txt", b"no image"), ("e.png", encode_png(picture_)),
    ]
    root = put(tmp_path / "in", {"s_00000.tar": tar_of(samples), "s_00001.tar": tar_of([("z.jpg", b"broken")])})
    rows = [("s_00000.tar", 0, i, k, "c", f"{k}.x") for i, k in enumerate("abcdef")] + [("s_00001.tar", 1, 0, "z", "c", "z.x")]
    tables.write_manifest(spark.createDataFrame(rows, tables.MANIFEST_SCHEMA), root)
    out = str(tmp_path / "out")
    jobs.transform_sharded(spark, root, [st.Resize((4, 4))], out, job="j")
    read = tarshards.read_shards(spark, out).collect()
    assert sorted((r["shard"], r["key"]) for r in read) == [("s_00000.tar", k) for k in "abe"]
    done = {r["key"]: r["error"] for r in jobs.read_ledger(spark, f"{out}/ledger", "j").collect()}
    assert done == {
        "a": None, "b": None, "e": None,
        "c": "image cannot be decoded: no known format", "z": "image cannot be decoded: no known format",
        "d": "no image member", "f": "no sample at this place of the shard",
    }
    assert names(jobs.read_errors(spark, out)) == ["c", "d", "f", "z"]
    again = jobs.transform_sharded(spark, root, [st.Resize((4, 4))], out, job="j")
    assert "process" not in again.seconds
    assert jobs.read_ledger(spark, f"{out}/ledger").count() == 7
    assert [tuple(r) for r in jobs.audit_shards(spark, root).collect()] == [("s_00000.tar", 5, "missing")]


def test_formats_without_a_decoder_fail_the_job(spark, tmp_path):
    if images.codec_installed(spark):
        pytest.skip("the codec here knows the format")
    webp = b"RIFF\x10\0\0\0WEBPVP8 " + b"\0" * 20
    root = put(tmp_path / "in", {"a.webp": webp, "b.png": encode_png(picture(4, 4)), "c.png": b"no"})
    out = str(tmp_path / "out")
    for _ in range(2):
        with pytest.raises(ValueError, match="WEBP"):
            jobs.transform_flat(spark, root, [], out, job="j")
    assert names(jobs.read_transformed(spark, out)) == ["b.png"]
    assert names(jobs.read_ledger(spark, f"{out}/ledger")) == ["b.png", "c.png"]


def test_training_reads_jpeg_and_fails_on_damage(spark, tmp_path):
    files = {"r/c/0.jpg": jvm_image(spark, tmp_path, "jpg"), "r/c/1.png": encode_png(picture(6, 9))}
    root, out = put(tmp_path / "in", files), str(tmp_path / "out")
    jobs.convert_keyed(objects.list_objects(spark, root), "r", out)
    assert [(r["image"]["h"], r["image"]["w"]) for r in jobs.read_for_training(spark, out).collect()] == [(6, 9)] * 2
    assert all(r["image"]["h"] == 6 for r in jobs.training_batches(spark, out, 2).collect())
    put(tmp_path / "in", {"r/c/2.jpg": b"broken"})
    jobs.convert_keyed(objects.list_objects(spark, root), "r", f"{out}2")
    with pytest.raises(Exception, match="image cannot be decoded"):
        jobs.read_for_training(spark, f"{out}2").collect()


def test_tars_of_one_name_are_refused(spark, tmp_path):
    tar = tar_of([("a.jpg", b"1")])
    root = put(tmp_path / "in", {"a/s_00000.tar": tar, "b/s_00000.tar": tar})
    with pytest.raises(ValueError, match="s_00000.tar"):
        tarshards.read_shards(spark, root)


def test_empty_stem_keeps_its_place(spark, tmp_path):
    files = {"train/c1/.jpg": b"0", "train/c1/k.jpg": b"1"}
    root, out = put(tmp_path / "in", files), str(tmp_path / "out")
    manifest = jobs.shard_dataset(objects.list_objects(spark, root), "", out, splits=["train"])
    read = tarshards.read_shards(spark, out).join(manifest, ["shard", "sample_idx"]).collect()
    assert {r["source"]: bytes(r["members"]["jpg"]) for r in read} == files


def test_null_keys_do_not_meet_the_shuffle(spark):
    left = spark.range(2000).select("id", F.when(F.col("id") % 20 == 0, F.col("id") % 7).alias("k"))
    right = spark.createDataFrame([(i, f"v{i}") for i in range(7)], "k long, v string")
    found = joins.join_split(left, right, ["k"], "left", hot_rows=50).collect()
    assert len(found) == 2000
    assert all((r["v"] is None) == (r["k"] is None) for r in found)
    plan = joins.join_split(left, right, ["k"], "inner", hot_rows=50)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_subset_keeps_files_of_no_class(spark):
    rows = [(i, n) for i, n in enumerate(["d/train/a/1.png", "d/train/b/2.png", "d/val/3.png", "d/readme"])]
    archive = spark.createDataFrame(rows, "pos long, name string")
    assert names(selection.limit_classes(archive, 1), "name") == ["d/readme", "d/train/a/1.png", "d/val/3.png"]


def test_content_hash_of_many_records(spark):
    rows = spark.range(1000).select(F.lit("k").alias("key"), F.lit(1).alias("size"))
    one = int(rows.limit(1).agg(keyed.content_hash(F.col("key"), F.col("size"))).first()[0], 16)
    assert int(rows.agg(keyed.content_hash(F.col("key"), F.col("size"))).first()[0], 16) == 1000 * one


def test_jpeg_size_and_exif_are_read_from_segments(spark, tmp_path):
    jpeg = jvm_image(spark, tmp_path, "jpg", 6, 9)
    exif = b"\xff\xe1\x00\x10Exif\0\0" + b"\0" * 8
    files = {"a.jpg": jpeg, "b.jpg": jpeg[:2] + exif + jpeg[2:], "c.jpg": jpeg[:-2] + b"Exif\0\0" + jpeg[-2:]}
    root = put(tmp_path / "in", files)
    got = incremental.incremental_scan(spark, root, str(tmp_path / "o"), str(tmp_path / "m")).collect()
    assert {r["key"]: (r["width"], r["height"], r["exif_present"]) for r in got} == {
        "a.jpg": (9, 6, False), "b.jpg": (9, 6, True), "c.jpg": (9, 6, False),
    }


def test_jpeg_walk_has_no_end_but_its_own(spark, tmp_path):
    jpeg = jvm_image(spark, tmp_path, "jpg", 6, 9)
    thumbnail = b"\xff\xe1\x00\x12Exif\0\0" + b"\0" * 8 + b"\xff\xd9"
    comment = b"\xff\xfe\x00\x04ab"
    files = {
        "whole": jpeg[:2] + thumbnail + jpeg[2:],
        "cut": jpeg[:2] + thumbnail + jpeg[2:-2],
        "cut_early": jpeg[:2] + thumbnail,
        "cut_in_segment": jpeg[:2] + thumbnail[:-4],
        "filled": jpeg[:2] + b"\xff" * 300 + jpeg[2:],
        "much_filled": jpeg[:2] + b"\xff" * 70_001 + jpeg[2:],
        "many_segments": jpeg[:2] + comment * 300 + jpeg[2:],
        "filled_segments": jpeg[:2] + (b"\xff" + comment) * 300 + jpeg[2:],
        "head_only": jpeg[:3],
    }
    rows = spark.createDataFrame([(k, len(v), v) for k, v in files.items()], "key string, size_bytes long, content binary")
    got = {r["key"]: r for r in scanning.validate_bytes(rows).collect()}
    cut = {"cut", "cut_early", "cut_in_segment", "head_only"}
    assert {k for k, r in got.items() if r["corrupted"]} == cut
    assert {(r["width"], r["height"]) for k, r in got.items() if k not in cut} == {(9, 6)}
    assert {k for k, r in got.items() if r["exif_present"]} == {"whole"}


def test_batch_lookup_reads_a_range_and_moves_no_images(spark, tmp_path):
    spark.range(5000).selectExpr("id AS idx", "cast(repeat('x', 50) AS binary) AS image").write.parquet(str(tmp_path / "d"))
    data = spark.read.parquet(str(tmp_path / "d"))
    from samplelake.operators.keyed import lookup_batch

    found = lookup_batch(spark.createDataFrame([(7,), (9,), (9,), (6000,), (None,)], "idx long"), data)
    got = [(r["idx"], r["image"] is not None) for r in found.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, [(7, True), (9, True), (9, True), (6000, False), (None, False)]))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(idx,7)" in plan and "LeftSemi, BuildRight" in plan
