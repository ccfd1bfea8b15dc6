import hashlib

import pytest
from pyspark.sql import functions as F

from samplelake.functions import paths as p
from samplelake.functions import values as val
from samplelake.operators import batches, joins, keyed, labels, ledger, listing, numbering, selection


def keys(spark, *names):
    return spark.createDataFrame([(n, 1) for n in names], "key string, size_bytes long")


def column(df, name):
    return [r[name] for r in df.select(name).collect()]


def test_image_keys(spark):
    df = keys(spark, "a.jpg", "a.JPEG", "a.png", "a.txt", "a")
    assert column(listing.filter_images(df), "key") == ["a.jpg", "a.JPEG", "a.png"]


def test_class_folders(spark):
    df = keys(spark, "root/class_a/1.jpg", "root/class_a/2.jpg", "root/class_b/3.png", "root/class_b/readme.txt")
    rows = {r["key"]: r["label"] for r in listing.labelled_samples(df, "root/").collect()}
    assert rows == {
        "root/class_a/1.jpg": "class_a",
        "root/class_a/2.jpg": "class_a",
        "root/class_b/3.png": "class_b",
    }


def test_empty_listing(spark):
    assert listing.labelled_samples(keys(spark).limit(0), "root/").count() == 0
    assert listing.shard_manifest(listing.labelled_samples(keys(spark).limit(0), "root"), 10).count() == 0


def test_extensions(spark):
    df = keys(spark, "a.jpg", "b.gif", "c.png")
    got = listing.labelled_samples(df, "", extensions=[".jpg", "png"], with_labels=False)
    assert sorted(column(got, "key")) == ["a.jpg", "c.png"]
    assert set(column(got, "label")) == {None}


def test_sidecars(spark):
    df = keys(spark, "n1/img.jpg", "n1/n1_boxes.txt", "val/val_annotations.txt")
    got = listing.labelled_samples(df, "", extensions=["jpg", "txt"])
    assert column(got, "key") == ["n1/img.jpg"]


def test_split(spark):
    df = keys(spark, "d/train/c1/a.jpg", "d/val/c1/b.jpg", "d/val/val_0_x.jpg")
    train = listing.labelled_samples(df, "d", split="train").collect()
    val_rows = listing.labelled_samples(df, "d/", split="val").orderBy("key").collect()
    assert [(r["key"], r["label"]) for r in train] == [("d/train/c1/a.jpg", "c1")]
    assert [(r["key"], r["label"]) for r in val_rows] == [("d/val/c1/b.jpg", "c1"), ("d/val/val_0_x.jpg", "val")]


def test_manifest_columns_and_values(spark):
    df = spark.createDataFrame(
        [("train/c1/a.jpg", "c1"), ("train/c1/b.jpg", "c1"), ("train/c2/c.jpg", "c2")], "key string, label string"
    )
    m = listing.shard_manifest(df, 2, split="train")
    assert m.columns == ["shard", "shard_idx", "sample_idx", "__key__", "cls", "source"]
    assert [tuple(r) for r in m.orderBy("source").collect()] == [
        ("train_00000.tar", 0, 0, "a", "c1", "train/c1/a.jpg"),
        ("train_00000.tar", 0, 1, "b", "c1", "train/c1/b.jpg"),
        ("train_00001.tar", 1, 0, "c", "c2", "train/c2/c.jpg"),
    ]


def test_chunks(spark):
    df = spark.range(5500).select(F.format_string("p%05d", "id").alias("key"))
    sizes = numbering.with_chunks(numbering.number_rows(df, ["key"]), 2000).groupBy("chunk").count()
    assert sorted((r["chunk"], r["count"]) for r in sizes.collect()) == [(0, 2000), (1, 2000), (2, 1500)]


def test_numbers_over_many_partitions(spark):
    df = spark.range(0, 20000, 1, 16).select(F.md5(F.col("id").cast("string")).alias("key"))
    got = numbering.number_rows(df, ["key"]).orderBy("pos").collect()
    expected = sorted(hashlib.md5(str(i).encode()).hexdigest() for i in range(20000))
    assert [r["key"] for r in got] == expected
    assert [r["pos"] for r in got] == list(range(20000))


def test_first_per_group_both_ways(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 40).cast("string")).alias("g"),
        F.col("id").alias("pos"),
    )
    by_window = {tuple(r) for r in numbering.first_per_group(df, ["g"], ["pos"], 20).collect()}
    usual = spark.conf.get(numbering.GROUP_LIMIT)
    spark.conf.set(numbering.GROUP_LIMIT, "1")
    by_range = {tuple(r) for r in numbering.first_per_group(df, ["g"], ["pos"], 20).select("g", "pos").collect()}
    spark.conf.set(numbering.GROUP_LIMIT, usual)
    assert by_window == by_range
    assert sum(1 for g, _ in by_range if g == "hot") == 20


def test_rank_filter_is_pushed_below_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 5).alias("g"), F.col("id").alias("pos"))
    plan = numbering.first_per_group(df, ["g"], ["pos"], 3)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_shard_size():
    assert numbering.shard_size_for(100, 7) == 15
    assert numbering.shard_size_for(0, 7) == 1
    assert numbering.shard_size_for(100, None) == 2000
    assert numbering.shard_size_for(100, None, 30) == 30


def test_order_by_parts_differs_from_key_order(spark):
    df = keys(spark, "a-b/x", "a/x")
    by_parts = numbering.number_rows(df, listing.listing_order("parts")).orderBy("pos")
    by_key = numbering.number_rows(df, listing.listing_order()).orderBy("pos")
    assert column(by_parts, "key") == ["a/x", "a-b/x"]
    assert column(by_key, "key") == ["a-b/x", "a/x"]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_split_join_with_a_hot_key(spark, how):
    left = spark.range(1000).select(
        F.when(F.col("id") < 400, F.lit(7)).otherwise(F.col("id")).alias("k"), F.lit("same").alias("x")
    )
    right = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plain = left.join(right, "k", how)
    split = joins.join_split(left, right, ["k"], how, hot_rows=50)
    assert sorted(map(repr, split.collect())) == sorted(map(repr, plain.collect()))


def test_grown_dictionary_is_not_broadcast(spark):
    left = spark.range(300).select((F.col("id") % 3).alias("k"))
    right = spark.range(100).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    assert joins.join_narrow(left, right, ["k"], rows=10).count() == 300
    with pytest.raises(ValueError):
        joins.join_narrow(left, right, ["k"], "full")


def test_label_ids(spark):
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, "b"), (3, None)], "pos long, label string")
    seen = {r["label"]: r["idx"] for r in labels.label_ids_first_seen(df).collect()}
    by_name = {r["label"]: r["idx"] for r in labels.label_ids_sorted(df).collect()}
    assert seen == {"b": 0, "a": 1}
    assert by_name == {"a": 0, "b": 1}
    coded = labels.encode_labels(df, labels.label_ids_sorted(df), missing=0).orderBy("pos")
    assert column(coded, "cls_idx") == [1, 0, 1, 0]


def test_grown_label_dictionary(spark, monkeypatch):
    df = spark.range(500).select(F.col("id").alias("pos"), F.md5((F.col("id") % 90).cast("string")).alias("label"))
    small = {tuple(r) for r in labels.label_ids_first_seen(df).collect()}
    monkeypatch.setattr(labels, "fits_broadcast", lambda _: False)
    assert {tuple(r) for r in labels.label_ids_first_seen(df).collect()} == small
    assert len(small) == 90


def test_lookup(spark):
    data = spark.createDataFrame([(i, f"im{i}") for i in range(5)], "idx long, image string")
    requests = spark.createDataFrame([(3,), (3,), (9,)], "idx long")
    found = keyed.lookup_batch(requests, data)
    assert sorted((r["idx"], r["image"]) for r in found.filter("image is not null").collect()) == [(3, "im3")] * 2
    assert column(keyed.missing_keys(requests, data), "idx") == [9]
    with pytest.raises(Exception, match="Key not found: 9"):
        keyed.check_found(found, "image").collect()


def test_reconcile(spark):
    a = spark.createDataFrame([("img0",), ("img1",)], "k string")
    assert ledger.reconcile_keys(a, a, ["k"]).count() == 0
    b = spark.createDataFrame([("img1",), ("img2",)], "k string")
    assert {tuple(r) for r in ledger.reconcile_keys(a, b, ["k"]).collect()} == {
        ("img0", "unexpected"), ("img2", "missing"),
    }


def test_batches_depend_on_seed_and_epoch_only(spark):
    df = spark.range(70).select(F.col("id").alias("idx"), F.col("id").cast("string").alias("key"))
    one = batches.epoch_batches(df, 32, epoch=1, seed=5).collect()
    again = batches.epoch_batches(df.repartition(5), 32, epoch=1, seed=5).collect()
    other = batches.epoch_batches(df, 32, epoch=2, seed=5).collect()
    assert sorted(one) == sorted(again)
    assert sorted(one) != sorted(other)
    assert sorted({(r["batch_id"]) for r in one}) == [0, 1, 2]
    padded = batches.epoch_batches(df, 32, epoch=1, seed=5, pad_last=True)
    assert padded.count() == 96


def subset_by_hand(names, classes, per_class):
    """What the selection rule keeps, row by row."""
    ends = (".jpg", ".jpeg", ".png", ".gif", ".webp", ".bmp", ".tiff", ".tif")
    order = sorted({n.split("/train/", 1)[1].split("/")[0] for n in names if "/train/" in n})[:classes]
    seen, kept = {}, []
    for n in names:
        meta = any(m in n for m in ("wnids.txt", "words.txt", "val_annotations.txt", "boxes.txt"))
        own = n.split("/train/", 1)[1].split("/")[0] if "/train/" in n else None
        group = own or ("val" if "/val/" in n else "test" if "/test/" in n else None)
        if n.endswith("/"):
            continue
        if not meta:
            if own is not None and own not in order:
                continue
            if group and n.lower().endswith(ends):
                seen[group] = seen.get(group, 0) + 1
                if seen[group] > per_class:
                    continue
        kept.append(n)
    return kept


def test_subset(spark):
    names = [f"s/train/c{i % 4}/images/{i}.JPEG" for i in range(40)]
    names += [f"s/val/images/v{i}.jpg" for i in range(9)] + [f"s/test/images/t{i}.jpg" for i in range(3)]
    names += ["s/", "s/train/c1/c1_boxes.txt", "s/train/c3/c3_boxes.txt", "s/wnids.txt", "s/val/val_annotations.txt"]
    names += ["s/train/c0/notes.txt", "s/train/c3/notes.txt", "s/other/x.jpg"]
    df = spark.createDataFrame(list(enumerate(names)), "pos long, name string")
    got = column(selection.select_subset(df, 2, 5).orderBy("pos"), "name")
    assert got == subset_by_hand(names, 2, 5)
    assert sorted(column(selection.select_subset(df), "name")) == sorted(n for n in names if not n.endswith("/"))


@pytest.mark.parametrize(
    "uri, bucket, prefix",
    [("s3://b", "b", ""), ("s3://b/", "b", ""), ("s3://b/p/q", "b", "p/q/"), ("s3://b/p/", "b", "p/"), ("x://b", None, None)],
)
def test_parse_uri(spark, uri, bucket, prefix):
    row = spark.range(1).select(p.parse_uri(F.lit(uri)).alias("u")).first()["u"]
    assert (row and row["bucket"], row and row["prefix"]) == (bucket, prefix)


def test_strict_uri(spark):
    with pytest.raises(Exception, match="URI must start with"):
        spark.range(1).select(p.parse_uri_strict(F.concat(F.lit("x://"), F.col("id")))).collect()


def one(spark, expression):
    return spark.range(1).select(expression.alias("v")).first()["v"]


def test_names(spark):
    assert one(spark, p.metadata_key(F.lit(""))) == "metadata/scan.jsonl"
    assert one(spark, p.metadata_key(F.lit("a/b/"))) == "metadata/a_b.jsonl"
    assert one(spark, p.job_id(F.lit("lake"), F.lit("a/b/"))) == "lake_a_b"
    assert one(spark, p.dest_key(F.lit("out/"), F.lit("k"))) == "out/k"
    assert one(spark, p.dest_key(F.lit(""), F.lit("k"))) == "k"
    assert one(spark, p.ext_from_content_type(F.lit("Image/PNG; a=b"))) == ".png"
    assert one(spark, p.ext_from_content_type(F.lit(None).cast("string"))) == ".jpg"
    assert one(spark, p.download_ext(F.lit("text/html"), F.lit("http://x/y.tif?z=.png"))) == ".tif"
    assert one(spark, p.shard_name("train", F.lit(123456))) == "train_123456.tar"
    assert one(spark, p.sample_key(F.lit("a/b.c.jpg"))) == "b.c"


@pytest.mark.parametrize("value", [0, 1, 258, -1, -2147483648, 2147483647])
def test_class_bytes(spark, value):
    raw = one(spark, val.class_to_bytes(F.lit(value).cast("int")))
    assert bytes(raw) == value.to_bytes(4, "little", signed=True)
    assert one(spark, val.class_from_bytes(F.lit(bytes(raw)))) == value
