import math
import os
import struct
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from samplelake.functions import kernels, pixels
from samplelake.plans import steps as st
from samplelake.plans.config import pipeline_from_config
from samplelake.functions import codecs as png


def image_table(spark, arrays):
    rows = [
        (f"k{i}", (a.shape[0], a.shape[1], a.shape[2], [float(x) for x in a.ravel()])) for i, a in enumerate(arrays)
    ]
    return spark.createDataFrame(rows, f"key string, image {st.IMAGE_TYPE}")


def arrays_of(df):
    out = []
    for r in df.orderBy("key").collect():
        im = r["image"]
        out.append(np.asarray(im["px"], np.float32).reshape(im["h"], im["w"], im["c"]))
    return out


def run(spark, arrays, steps, levels):
    return arrays_of(st.transform_images(image_table(spark, arrays), steps, levels=levels))


def levels(shape, seed=0):
    return np.random.default_rng(seed).integers(0, 256, shape, dtype=np.uint8)


# --- assertions on the steps' results ---------------------------------------------


def test_resize(spark):
    wide = np.full((100, 200, 3), 128, np.uint8)
    (out,) = run(spark, [wide], [st.Resize((50, 50))], True)
    assert out.shape == (50, 50, 3)
    assert out[25, 25].tolist() == [128, 128, 128] and out[0, 0].tolist() == [0, 0, 0]
    (small,) = run(spark, [wide / 255.0], [st.Resize((25, 25), pad=False)], False)
    assert small.shape == (12, 25, 3)
    assert np.allclose(small, 128 / 255, atol=1 / 255)


def test_fit_size_rounds_half_to_even(spark):
    size = spark.range(1).select(pixels.fit_size(F.lit(100), F.lit(200), 25, 25).alias("s")).first()["s"]
    assert (size["h"], size["w"]) == (12, 25)


def test_normalize(spark):
    white, black = np.full((10, 10, 3), 255, np.uint8), np.zeros((10, 10, 3), np.uint8)
    out = run(spark, [white, black], [st.Normalize()], True)
    assert np.allclose(out[0], 1.0) and np.allclose(out[1], 0.0)
    (centred,) = run(spark, [black], [st.Normalize((0.5,) * 3, (0.5,) * 3)], True)
    assert np.allclose(centred, -1.0)


def test_normalize_range(spark):
    dark = np.ones((4, 4, 3), np.uint8)
    assert np.allclose(run(spark, [dark], [st.Normalize()], True)[0], 1.0)
    assert np.allclose(run(spark, [dark], [st.Normalize(input_range="known")], True)[0], 1 / 255)


def test_flips_invert(spark):
    arr = np.arange(12, dtype=np.uint8).reshape(2, 2, 3)
    (h,) = run(spark, [arr], [st.Augment(flip_h=True)], True)
    (v,) = run(spark, [arr], [st.Augment(flip_v=True)], True)
    assert np.array_equal(h[:, ::-1], arr) and np.array_equal(v[::-1], arr)


def test_pipeline(spark):
    (out,) = run(spark, [np.full((64, 64, 3), 128, np.uint8)], [st.Resize((32, 32)), st.Normalize()], True)
    assert out.shape == (32, 32, 3) and 0 <= out.min() and out.max() <= 1


def test_user_functions(spark):
    steps = [st.Custom(lambda im: im[:5, :5]), st.Custom(lambda im: im.astype(np.float32) / 255)]
    (out,) = run(spark, [np.ones((10, 10, 3), np.uint8)], steps, True)
    assert out.shape == (5, 5, 3) and np.allclose(out, 1 / 255)


def test_camera_noise(spark):
    grey = np.full((20, 20, 3), 128, np.uint8)
    (out,) = run(spark, [grey], [st.CameraNoise(0.02, None)], True)
    assert out.shape == grey.shape and np.allclose(out, 128, atol=30)
    assert abs(out.std() / 255 - 0.02) < 0.004


def test_poisson_moments(spark):
    grey = np.full((64, 64, 3), 0.5, np.float32)
    out = run(spark, [grey] * 4, [st.CameraNoise(0.0, 0.01, seed=3)], False)
    values = np.concatenate([o.ravel() for o in out])
    assert abs(values.mean() - 0.5) < 0.005
    assert abs(values.var() - 0.5 * 0.01) < 0.0005
    assert not np.array_equal(out[0], out[1])


def test_poisson_counts_follow_the_law():
    u = (np.arange(200_000) + 0.5) / 200_000
    for mean in (0.0, 0.3, 7.0, 480.0):
        counts = kernels.poisson(np.full(u.size, mean), u, u)
        law = np.cumsum([math.exp(k * math.log(mean) - mean - math.lgamma(k + 1)) if mean else k == 0 for k in range(900)])
        for k in range(0, 900, 7):
            assert abs(np.mean(counts <= k) - law[k]) < 1e-5


def test_noise_is_the_same_in_any_layout(spark):
    df = image_table(spark, [levels((6, 6, 3), i) for i in range(12)])
    chain = [st.CameraNoise(0.05, 0.1, seed=1)]
    a = arrays_of(st.transform_images(df.coalesce(1), chain, levels=True))
    b = arrays_of(st.transform_images(df.repartition(6), chain, levels=True))
    assert all(np.array_equal(x, y) for x, y in zip(a, b))


def test_lens_and_vignetting(spark):
    flat = np.full((32, 32, 3), 200, np.uint8)
    (out,) = run(spark, [flat], [st.LensDistortion(-0.2)], True)
    assert out.shape == flat.shape and np.all(np.abs(out - 200) <= 1)
    (dark,) = run(spark, [np.full((32, 32, 3), 255, np.uint8)], [st.Vignetting(0.5)], True)
    assert dark[0, 0].mean() < dark[16, 16].mean()


# --- the two forms of a step agree --------------------------------------------------

TWINS = [
    ([st.Normalize()], True),
    ([st.Normalize()], False),
    ([st.Normalize(pixels.IMAGENET_MEAN, pixels.IMAGENET_STD)], True),
    ([st.Normalize((0.5,), (0.25,), input_range="known")], True),
    ([st.Augment(flip_h=True, flip_v=True)], True),
    ([st.Augment(color_jitter={"brightness": [0.8, 1.2], "saturation": [0.5, 1.5]}, seed=4)], True),
    ([st.Augment(color_jitter={"contrast": 1.3}, seed=4)], False),
    ([st.Vignetting(0.4)], True),
    ([st.Vignetting(0.4)], False),
    ([st.ToLevels()], False),
    ([st.TrainView(size=4, resize=None, seed=2)], True),
    ([st.Vignetting(0.3), st.Augment(flip_h=True), st.Normalize(), st.ToLevels()], True),
    ([st.Augment(rotate_deg=30)], True),
    ([st.Augment(rotate_deg=90, flip_h=True)], False),
    ([st.LensDistortion(-0.2)], True),
    ([st.LensDistortion(0.3)], False),
    ([st.CameraNoise(0.05, None, seed=3)], True),
    ([st.CameraNoise(0.05, None, seed=3)], False),
    ([st.CameraNoise(0.05, 0.1, seed=3)], True),
    ([st.CameraNoise(0.0, 0.02, seed=3)], False),
    ([st.CameraNoise(0.0, 0.001, seed=3)], False),  # means on both sides of the largest inverted one
]


@pytest.mark.parametrize("chain, as_levels", TWINS)
def test_column_and_kernel_agree(spark, chain, as_levels):
    stack = [levels((6, 9, 3), i) for i in range(4)]
    if not as_levels:
        stack = [(a / np.float32(255)).astype(np.float32) for a in stack]
    df = image_table(spark, stack)
    by_column = arrays_of(st.transform_images(df, chain, levels=as_levels))
    kernel = st.kernel_column(chain, F.col("image"), F.col("key"), levels=as_levels)
    by_kernel = arrays_of(df.withColumn("image", kernel))
    for a, b in zip(by_column, by_kernel):
        # Levels may differ by one where a sum in another order crosses a whole number.
        assert a.shape == b.shape
        assert np.max(np.abs(a - b)) <= (1 if max(a.max(), b.max()) > 2 else 1e-6)
        assert np.mean(np.abs(a - b) > 1e-6) < 0.01


def test_a_resampling_step_makes_one_python_stage(spark):
    df = image_table(spark, [levels((6, 9, 3))])
    mixed = st.transform_images(df, [st.Vignetting(), st.Resize((4, 4)), st.Normalize()], levels=True)
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    chain = [st.Vignetting(), st.LensDistortion(), st.Augment(rotate_deg=30), st.CameraNoise(0.1, None), st.Normalize()]
    plain = st.transform_images(df, chain, levels=True)
    assert "Python" not in plain._jdf.queryExecution().executedPlan().toString()


# --- kernels against slow, literal code -----------------------------------------------


def lanczos_by_hand(line, new):
    def curve(x):
        return 1.0 if x == 0 else 3 * math.sin(math.pi * x) * math.sin(math.pi * x / 3) / (math.pi * x) ** 2

    size, out = len(line), []
    spread = max(size / new, 1.0)
    for o in range(new):
        mid = (o + 0.5) * size / new
        first, last = max(int(mid - 3 * spread + 0.5), 0), min(int(mid + 3 * spread + 0.5), size)
        weights = [curve(x) if abs(x) < 3 else 0.0 for x in ((i + 0.5 - mid) / spread for i in range(first, last))]
        fixed = [int(w / sum(weights) * (1 << 22) + (0.5 if w >= 0 else -0.5)) for w in weights]
        value = ((1 << 21) + sum(f * int(v) for f, v in zip(fixed, line[first:last]))) >> 22
        out.append(min(255, max(0, value)))
    return out


@pytest.mark.parametrize("shape, new", [((9, 17), (5, 7)), ((5, 6), (11, 13)), ((8, 8), (8, 3))])
def test_resample_by_hand(shape, new):
    im = levels(shape + (1,), 7)
    across = np.array([lanczos_by_hand(row, new[1]) for row in im[..., 0]]) if new[1] != shape[1] else im[..., 0]
    down = np.array([lanczos_by_hand(col, new[0]) for col in across.T]).T if new[0] != shape[0] else across
    got = kernels.resample(im[None], *new, "lanczos", {})[0, ..., 0]
    assert np.array_equal(got, down)


def lens_by_hand(im, k):
    h, w = im.shape
    out = np.zeros((h, w))

    def at(y, x):
        def fold(i, n):
            while i < 0 or i >= n:
                i = -i - 1 if i < 0 else 2 * n - 1 - i
            return i

        return im[fold(y, h), fold(x, w)]

    for y in range(h):
        for x in range(w):
            dy, dx = y - (h - 1) / 2, x - (w - 1) / 2
            r = math.sqrt(dx * dx + dy * dy) / (max(h, w) * 0.5 + 1e-6)
            sy, sx = (h - 1) / 2 + dy * (1 + k * r * r), (w - 1) / 2 + dx * (1 + k * r * r)
            y0, x0 = math.floor(sy), math.floor(sx)
            fy, fx = sy - y0, sx - x0
            out[y, x] = (
                at(y0, x0) * (1 - fy) * (1 - fx) + at(y0, x0 + 1) * (1 - fy) * fx
                + at(y0 + 1, x0) * fy * (1 - fx) + at(y0 + 1, x0 + 1) * fy * fx
            )
    return np.clip(out, 0, 1)


@pytest.mark.parametrize("k", [-0.2, 0.0, 0.8])
def test_lens_by_hand(k):
    im = np.random.default_rng(1).random((7, 10)).astype(np.float32)
    got = kernels.lens_distortion(im[None, ..., None], [""], {}, k=k)[0, ..., 0]
    assert np.allclose(got, lens_by_hand(im, k), atol=1e-6)


def test_quarter_turns():
    im = levels((5, 5, 3))[None]
    assert np.array_equal(kernels.rotate(im, [""], {}, 90)[0], np.rot90(im[0], -1))
    assert np.array_equal(kernels.rotate(im, [""], {}, -90)[0], np.rot90(im[0], 1))
    assert np.array_equal(kernels.rotate(im, [""], {}, 360), im)
    turned = kernels.rotate(np.full((1, 9, 9, 1), 100, np.uint8), [""], {}, 45)[0, ..., 0]
    assert turned[4, 4] == 100 and turned[0, 0] == 0


def test_area_crop_covers_the_stated_share():
    stack = np.repeat(levels((40, 60, 3))[None], 5, axis=0)
    out = kernels.random_area_crop(
        stack, [f"k{i}" for i in range(5)], {}, size=16, area=(0.8, 1.0), aspect=(0.75, 4 / 3), seed=1, step="s"
    )
    assert out.shape == (5, 16, 16, 3) and out.dtype == np.uint8


def test_area_crop_of_everything_is_a_resize():
    im = levels((20, 20, 3))[None]
    out = kernels.random_area_crop(
        im, ["k"], {}, size=7, area=(1.0, 1.0), aspect=(1.0, 1.0), seed=1, step="s"
    )
    assert np.array_equal(out, kernels.resample(im, 7, 7, "bilinear", {}))


def test_area_crop_windows_by_hand():
    keys = [f"k{i}" for i in range(40)]
    gradient = np.add.outer(np.arange(40), np.arange(60))[..., None].astype(np.uint8)
    out = kernels.random_area_crop(
        np.repeat(gradient[None], 40, axis=0), keys, {}, size=8, area=(0.8, 1.0), aspect=(0.75, 4 / 3), seed=1, step="s"
    )
    for key, got in zip(keys, out):
        u = kernels.uniforms(kernels.draw_bases(1, "s", [key]), 0, 4)[0]
        share, ratio = 0.8 + 0.2 * u[0], math.exp(math.log(0.75) + u[1] * (math.log(4 / 3) - math.log(0.75)))
        h = min(40, round(math.sqrt(share * 2400 / ratio)))
        w = min(60, round(math.sqrt(share * 2400 * ratio)))
        top, left = int(u[2] * (41 - h)), int(u[3] * (61 - w))
        window = gradient[None, top : top + h, left : left + w]
        assert np.array_equal(got, kernels.resample(window, 8, 8, "bilinear", {})[0])


def test_uniform_draws_match(spark):
    from samplelake.functions.values import draw_base, uniform

    got = spark.range(5).select(
        F.col("id").cast("string").alias("k"),
        F.array(*[uniform(draw_base(3, "s", F.col("id").cast("string")), i) for i in range(4)]).alias("u"),
    )
    for r in got.collect():
        want = kernels.uniforms(kernels.draw_bases(3, "s", [r["k"]]), 0, 4)[0]
        assert r["u"] == want.tolist()
    many = kernels.uniforms(kernels.draw_bases(3, "s", ["a"]), 0, 100_000)[0]
    assert abs(many.mean() - 0.5) < 0.005 and abs(many.var() - 1 / 12) < 0.002


# --- config ---------------------------------------------------------------------------


def test_config(spark, tmp_path):
    given = {"steps": [{"name": "resize", "target_size": [32, 32]}, {"name": "Normalize "}]}
    assert pipeline_from_config(given) == [st.Resize((32, 32)), st.Normalize()]
    path = tmp_path / "pipeline.yaml"
    path.write_text("steps:\n  - name: resize\n    target_size: 16\n  - name: normalize\n    mean: 0.5\n    std: [0.5]\n")
    loaded = pipeline_from_config(str(path))
    assert loaded == [st.Resize((16, 16)), st.Normalize((0.5,), (0.5,))]
    (out,) = run(spark, [np.full((64, 64, 3), 128, np.uint8)], loaded, True)
    assert out.shape == (16, 16, 3)


def test_config_defaults():
    names = ["resize", "normalize", "augment", "camera_noise", "lens_distortion", "vignetting"]
    got = pipeline_from_config({"steps": [{"name": n, "seed": None} for n in names]})
    assert got == [st.Resize((224, 224)), st.Normalize(), st.Augment(), st.CameraNoise(), st.LensDistortion(), st.Vignetting()]


@pytest.mark.parametrize(
    "config, text",
    [
        ([], "must be a dict"),
        ({"steps": {}}, "'steps' as a list"),
        ({"steps": ["resize"]}, "Step 0 must be a dict"),
        ({"steps": [{"size": 3}]}, "must have a 'name'"),
        ({"steps": [{"name": "blur"}]}, "Unknown pipeline step: blur"),
    ],
)
def test_config_errors(config, text):
    with pytest.raises(ValueError, match=text):
        pipeline_from_config(config)


def test_config_file_missing(tmp_path):
    with pytest.raises(FileNotFoundError):
        pipeline_from_config(str(tmp_path / "none.yaml"))


# --- PNG --------------------------------------------------------------------------------


@pytest.mark.parametrize("channels", [1, 2, 3, 4])
def test_png_round_trip(channels):
    im = levels((7, 5, channels))
    assert np.array_equal(png.decode_png(png.encode_png(im)), im)


def filtered_png(im, kind):
    """A PNG whose rows all use one filter."""
    h, w, c = im.shape
    flat, out = im.reshape(h, w * c).astype(int), bytearray()
    for y in range(h):
        out.append(kind)
        for i in range(w * c):
            left = flat[y, i - c] if i >= c else 0
            up = flat[y - 1, i] if y else 0
            corner = flat[y - 1, i - c] if y and i >= c else 0
            near = left + up - corner
            paeth = min((left, up, corner), key=lambda v: abs(near - v))
            guess = (0, left, up, (left + up) // 2, paeth)[kind]
            out.append((flat[y, i] - guess) & 255)

    def chunk(name, data):
        return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))

    head = struct.pack(">IIBBBBB", w, h, 8, {1: 0, 3: 2}[c], 0, 0, 0)
    return png.SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(bytes(out))) + chunk(b"IEND", b"")


@pytest.mark.parametrize("kind", range(3))
def test_png_filters(kind):
    im = levels((6, 8, 3), kind)
    assert np.array_equal(png.decode_png(filtered_png(im, kind)), im)


def test_png_filters_of_every_kind_by_content(spark):
    from samplelake.sources.images import decode_content

    ims = [levels((6, 8, 3), kind) for kind in range(5)]
    rows = [(kind, filtered_png(im, kind)) for kind, im in enumerate(ims)] + [(5, b"no"), (6, None), (7, b"")]
    got = {r["k"]: r for r in decode_content(spark.createDataFrame(rows, "k int, content binary")).collect()}
    for kind, im in enumerate(ims):
        read = got[kind]["image"]
        assert np.array_equal(np.frombuffer(read["px"], np.uint8).reshape(read["h"], read["w"], read["c"]), im)
        assert got[kind]["format"] == "PNG"
    assert all(got[k]["image"] is None and got[k]["format"] is None for k in (5, 6, 7))


@pytest.mark.parametrize("data", [b"", b"not an image", png.SIGNATURE, png.encode_png(levels((4, 4, 3)))[:40]])
def test_png_damage(data):
    with pytest.raises(ValueError):
        png.decode_png(data)


# --- throughput ---------------------------------------------------------------------------


def test_throughput(spark):
    rng = np.random.default_rng(42)
    rows = [(f"k{i}", (64, 64, 3, rng.integers(0, 256, 64 * 64 * 3, dtype=np.uint8).tobytes())) for i in range(1000)]
    df = spark.createDataFrame(rows, f"key string, image {st.BYTES_TYPE}").repartition(8).cache()
    df.count()
    start = time.perf_counter()
    done = st.transform_images(df, [st.Resize((32, 32)), st.Normalize()], levels=True)
    assert done.filter(F.size("image.px") == 32 * 32 * 3).count() == 1000
    rate = 1000 / (time.perf_counter() - start)
    print(f"{rate:.0f} images/s on {os.cpu_count()} cores")
    assert rate > 10
    df.unpersist()
