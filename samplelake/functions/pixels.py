"""Image steps as Column expressions on ``struct<h, w, c, px>``.

``px`` is row-major HWC.  Levels 0..255 and floats in 0..1 are both held as floats;
``levels`` tells which one an image is in.  A step that uses its input pixels
several times binds them once with :func:`let`, so steps can be chained without the
optimizer repeating an earlier step inside a later one's lambda.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from samplelake.functions.values import draw_base, uniform

# Channel means and deviations for training, and the smallest deviation.
IMAGENET_MEAN = (0.485, 0.456, 0.406)
IMAGENET_STD = (0.229, 0.224, 0.225)
MIN_STD = 1e-7
TINY = 1e-6
# Shot noise of a greater mean is drawn from the normal law of the same mean and variance.
LARGEST_INVERTED = 500.0


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``use``."""
    return F.element_at(F.transform(F.array(value), use), 1)


def make_image(h: Column, w: Column, c: Column, px: Column) -> Column:
    return F.struct(h.cast("int").alias("h"), w.cast("int").alias("w"), c.cast("int").alias("c"), px.alias("px"))


def _clip(x: Column, low: float, high: float) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), x))


def _same_size(img: Column, px: Column) -> Column:
    return make_image(img["h"], img["w"], img["c"], px)


def _unit(x: Column, levels: bool) -> Column:
    x = x.cast("double")
    return _clip(x / 255.0 if levels else x, 0.0, 1.0)


def _back(x: Column, levels: bool) -> Column:
    """From 0..1 to the kind of value the image came in: truncated levels, or floats."""
    return (F.floor(x * 255.0) if levels else x).cast("float")


def fit_size(h: Column, w: Column, target_h: int, target_w: int) -> Column:
    """``struct<h, w>`` of the largest same-aspect size inside the target, half to even."""
    scale = F.least(F.lit(target_h) / h, F.lit(target_w) / w)
    return F.struct(F.rint(h * scale).cast("int").alias("h"), F.rint(w * scale).cast("int").alias("w"))


def centre_pad(img: Column, target_h: int, target_w: int) -> Column:
    """Put the image in the middle of a zero canvas."""

    def pad(im: Column) -> Column:
        h, w, c = im["h"], im["w"], im["c"]
        top, left = F.floor((F.lit(target_h) - h) / 2), F.floor((F.lit(target_w) - w) / 2)

        def zeros(n: Column) -> Column:
            return F.array_repeat(F.lit(0.0).cast("float"), n.cast("int"))

        def row(r: Column) -> Column:
            inner = F.slice(im["px"], r * w * c + 1, w * c)
            return F.concat(zeros(left * c), inner, zeros((F.lit(target_w) - w - left) * c))

        rows = F.flatten(F.transform(F.sequence(F.lit(0), h - 1), row))
        px = F.concat(
            zeros(top * target_w * c), rows, zeros((F.lit(target_h) - h - top) * target_w * c)
        )
        return make_image(F.lit(target_h), F.lit(target_w), c, px)

    return let(img, pad)


def normalize(
    img: Column, mean: Sequence[float] | None = None, std: Sequence[float] | None = None
) -> Column:
    """Scale to 0..1 where any value lies outside it, then standardise if both are given."""

    standardise = mean is not None and std is not None
    means = F.array(*[F.lit(float(m)) for m in mean]) if standardise else None
    stds = F.array(*[F.lit(max(float(s), MIN_STD)) for s in std]) if standardise else None

    def value(x: Column, i: Column, outside: Column) -> Column:
        x = x.cast("double")
        x = F.when(outside, _clip(x, 0.0, 255.0) / 255.0).otherwise(x)
        if standardise:
            x = (x - F.get(means, i % len(mean))) / F.get(stds, i % len(std))
        return x.cast("float")

    def scaled(im: Column) -> Column:
        outside = (F.array_max(im["px"]) > 1.0) | (F.array_min(im["px"]) < 0.0)
        px = let(outside, lambda out: F.transform(im["px"], lambda x, i: value(x, i, out)))
        return _same_size(im, px)

    return let(img, scaled)


def flip_h(img: Column) -> Column:
    def flipped(im: Column) -> Column:
        w, c = im["w"], im["c"]

        def row(r: Column) -> Column:
            pixels = F.transform(
                F.sequence(F.lit(0), w - 1), lambda q: F.slice(im["px"], (r * w + q) * c + 1, c)
            )
            return F.flatten(F.reverse(pixels))

        return _same_size(im, F.flatten(F.transform(F.sequence(F.lit(0), im["h"] - 1), row)))

    return let(img, flipped)


def flip_v(img: Column) -> Column:
    def flipped(im: Column) -> Column:
        width = im["w"] * im["c"]
        rows = F.transform(
            F.sequence(F.lit(0), im["h"] - 1), lambda r: F.slice(im["px"], r * width + 1, width)
        )
        return _same_size(im, F.flatten(F.reverse(rows)))

    return let(img, flipped)


def jitter_factors(jitter: dict, base: Column) -> dict[str, Column]:
    """Brightness, contrast and saturation; each pair takes the next draw of the row."""
    factors, draws = {}, 0
    for name in ("brightness", "contrast", "saturation"):
        given = jitter.get(name, 1.0)
        if isinstance(given, (list, tuple)):
            low, high = map(float, given)
            factors[name] = F.lit(low) + uniform(base, draws) * F.lit(high - low)
            draws += 1
        else:
            factors[name] = F.lit(float(given))
    return factors


def color_jitter(img: Column, jitter: dict, key: Column, seed: int, step: str, levels: bool) -> Column:
    """Brightness, contrast about the image mean, saturation about the pixel's mean."""

    def jittered(im: Column, f: Column) -> Column:
        px = im["px"]

        def bright(high: Column) -> Column:
            return F.transform(
                px,
                lambda x: _clip(F.when(high, x.cast("double") / 255.0).otherwise(x.cast("double")), 0.0, 1.0)
                * f["brightness"],
            )

        def contrast(p: Column) -> Column:
            total = F.aggregate(p, F.lit(0.0), lambda a, x: a + x)
            return let(
                total / F.size(p), lambda m: F.transform(p, lambda x: (x - m) * f["contrast"] + m)
            )

        def saturate(p: Column) -> Column:
            grey = F.transform(
                F.sequence(F.lit(0), im["h"] * im["w"] - 1),
                lambda q: (F.get(p, q * 3) + F.get(p, q * 3 + 1) + F.get(p, q * 3 + 2)) / 3.0,
            )
            return let(
                grey,
                lambda g: F.transform(
                    p,
                    lambda x, i: x * f["saturation"]
                    + (F.lit(1.0) - f["saturation"]) * F.get(g, F.floor(i / 3).cast("int")),
                ),
            )

        def finish(p: Column) -> Column:
            return _same_size(im, F.transform(p, lambda x: _back(_clip(x, 0.0, 1.0), levels)))

        lit_up = let(F.array_max(px) > 1.0, bright)
        return let(
            let(lit_up, contrast),
            lambda p: F.when(im["c"] == 3, let(let(p, saturate), finish)).otherwise(finish(p)),
        )

    factors = jitter_factors(jitter, draw_base(seed, step, key))
    packed = F.struct(*[v.alias(k) for k, v in factors.items()])
    return let(img, lambda im: F.when(im["c"] < 3, im).otherwise(let(packed, lambda f: jittered(im, f))))


def vignetting(img: Column, strength: float, levels: bool) -> Column:
    """Darken with the square of the distance from the centre."""

    def shaded(im: Column) -> Column:
        w, c = im["w"], im["c"]
        cy, cx = (im["h"] - 1) / 2.0, (w - 1) / 2.0
        reach = F.sqrt(cx * cx + cy * cy) + TINY

        def value(x: Column, i: Column, cy: Column, cx: Column, reach: Column) -> Column:
            at = F.floor(i / c)
            dy, dx = F.floor(at / w) - cy, at % w - cx
            near = _clip(F.sqrt(dx * dx + dy * dy) / reach, 0.0, 1.0)
            x = x.cast("double") / 255.0 if levels else x.cast("double")
            return _back(_clip(x * (F.lit(1.0) - F.lit(float(strength)) * near * near), 0.0, 1.0), levels)

        centre = F.struct(cy.alias("cy"), cx.alias("cx"), reach.alias("reach"))
        return _same_size(
            im,
            let(centre, lambda g: F.transform(im["px"], lambda x, i: value(x, i, g["cy"], g["cx"], g["reach"]))),
        )

    return let(img, shaded)


def _each(im: Column, value: Callable[[Column, Column, Column], Column]) -> Column:
    """Pixels of ``value(y, x, channel)`` over an image of the same size."""
    w, c = im["w"], im["c"]

    def at(i: Column) -> Column:
        cell = F.floor(i / c)
        return value(F.floor(cell / w).cast("int"), (cell % w).cast("int"), i % c)

    return F.transform(F.sequence(F.lit(0), im["h"] * w * c - 1), at)


def rotate(img: Column, degrees: float, levels: bool) -> Column:
    """A clockwise turn about the centre, on levels, by four neighbours; zero outside the image."""
    angle = math.radians(degrees % 360.0)
    cos, sin = F.lit(round(math.cos(angle), 15)), F.lit(round(math.sin(angle), 15))

    def turned(im: Column) -> Column:
        h, w, c = im["h"], im["w"], im["c"]

        def value(y: Column, x: Column, ch: Column) -> Column:
            dy, dx = y + 0.5 - h / 2.0, x + 0.5 - w / 2.0
            place = F.struct((cos * dx + sin * dy + w / 2.0).alias("x"), (cos * dy - sin * dx + h / 2.0).alias("y"))

            def seen(p: Column) -> Column:
                inside = (p["x"] >= 0) & (p["x"] < w) & (p["y"] >= 0) & (p["y"] < h)
                sx, sy = p["x"] - 0.5, p["y"] - 0.5
                x0, y0 = F.floor(sx).cast("int"), F.floor(sy).cast("int")

                def near(b: int, a: int) -> Column:
                    row = F.least(h - 1, F.greatest(F.lit(0), y0 + b))
                    column = F.least(w - 1, F.greatest(F.lit(0), x0 + a))
                    return F.get(im["px"], (row * w + column) * c + ch).cast("double")

                top = near(0, 0) + (near(0, 1) - near(0, 0)) * (sx - x0)
                low = near(1, 0) + (near(1, 1) - near(1, 0)) * (sx - x0)
                return F.when(inside, F.floor(top + (low - top) * (sy - y0)).cast("float")).otherwise(F.lit(0.0))

            return let(place, seen).cast("float")

        return _same_size(im, _each(im, value))

    out = let(to_levels(img, levels), turned)
    if levels:
        return out
    scale = F.lit(255.0).cast("float")
    return let(out, lambda im: _same_size(im, F.transform(im["px"], lambda x: (x / scale).cast("float"))))


def lens_distortion(img: Column, k: float, levels: bool) -> Column:
    """Radial distortion by four neighbours, reflected at the edges."""

    def bent(im: Column) -> Column:
        h, w, c = im["h"], im["w"], im["c"]
        cy, cx = (h - 1) / 2.0, (w - 1) / 2.0
        half = F.greatest(h, w) * 0.5 + TINY

        def mirrored(i: Column, size: Column) -> Column:
            wrapped = F.pmod(i, 2 * size)
            return F.when(wrapped < size, wrapped).otherwise(2 * size - 1 - wrapped)

        def value(y: Column, x: Column, ch: Column) -> Column:
            dy, dx = y - cy, x - cx
            r = F.sqrt(dx * dx + dy * dy) / half
            place = let(
                F.struct(r.alias("r"), dy.alias("dy"), dx.alias("dx")),
                lambda d: F.struct(
                    (cy + d["dy"] * (F.lit(1.0) + F.lit(float(k)) * d["r"] * d["r"])).alias("y"),
                    (cx + d["dx"] * (F.lit(1.0) + F.lit(float(k)) * d["r"] * d["r"])).alias("x"),
                ),
            )

            def seen(p: Column) -> Column:
                x0, y0 = F.floor(p["x"]).cast("int"), F.floor(p["y"]).cast("int")
                fx, fy = p["x"] - x0, p["y"] - y0

                def near(b: int, a: int) -> Column:
                    at = (mirrored(y0 + b, h) * w + mirrored(x0 + a, w)) * c + ch
                    x = F.get(im["px"], at).cast("double")
                    return x / 255.0 if levels else x

                total = near(0, 0) * (1 - fy) * (1 - fx) + near(0, 1) * (1 - fy) * fx
                total = total + near(1, 0) * fy * (1 - fx) + near(1, 1) * fy * fx
                return _back(_clip(total, 0.0, 1.0), levels)

            return let(place, seen)

        return _same_size(im, _each(im, value))

    return let(img, bent)


def _normal(u1: Column, u2: Column) -> Column:
    return F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def most_counted(mean):
    """A count that no draw of 32 bits passes at this mean."""
    sqrt = F.sqrt if isinstance(mean, Column) else math.sqrt
    return mean + 8.0 * sqrt(mean) + 24.0


def poisson(mean: Column, u1: Column, u2: Column) -> Column:
    """A Poisson count by inversion: how many partial sums of the law lie at or below ``u1``.

    Above ``LARGEST_INVERTED`` it is the normal draw of ``u1`` and ``u2``, rounded.
    """

    def counted(m: Column) -> Column:
        first = F.exp(-m["mean"])
        start = F.struct(first.alias("p"), first.alias("total"), F.lit(0).alias("n"))

        def add(a: Column, k: Column) -> Column:
            p = a["p"] * m["mean"] / k
            passed = F.when(a["total"] <= m["u1"], a["n"] + 1).otherwise(a["n"])
            return F.struct(p.alias("p"), (a["total"] + p).alias("total"), passed.alias("n"))

        places = F.sequence(F.lit(1), most_counted(m["mean"]).cast("int"))
        normal = F.greatest(F.lit(0.0), F.rint(m["mean"] + F.sqrt(m["mean"]) * _normal(m["u1"], m["u2"])))
        inverted = F.aggregate(places, start, add, lambda a: a["n"].cast("double"))
        return F.when(m["mean"] <= LARGEST_INVERTED, inverted).otherwise(normal)

    return let(F.struct(mean.alias("mean"), u1.alias("u1"), u2.alias("u2")), counted)


def camera_noise(
    img: Column, std: float, scale: float | None, key: Column, seed: int, step: str, levels: bool
) -> Column:
    """Normal noise, then shot noise of mean ``value / scale`` in units of ``scale``.

    Each takes two draws per value, which depend on seed, step, key and place alone.
    """

    def noisy(im: Column, b: Column) -> Column:
        def value(x: Column, i: Column) -> Column:
            seen = _unit(x, levels)
            if std > 0:
                seen = seen + F.lit(float(std)) * _normal(uniform(b["read"], i * 2), uniform(b["read"], i * 2 + 1))
            if scale:
                mean = _clip(seen / F.lit(max(float(scale), TINY)), 0.0, 1e10)
                shots = poisson(mean, uniform(b["shot"], i * 2), uniform(b["shot"], i * 2 + 1))
                seen = shots * F.lit(float(scale))
            return _back(_clip(seen, 0.0, 1.0), levels)

        return _same_size(im, F.transform(im["px"], value))

    bases = F.struct(draw_base(seed, step, key).alias("read"), draw_base(seed, step + ".shot", key).alias("shot"))
    return let(img, lambda im: let(bases, lambda b: noisy(im, b)))


def to_levels(img: Column, levels: bool) -> Column:
    """To 0..255 by truncation; floats are multiplied in single precision."""
    if levels:
        return let(img, lambda im: _same_size(im, F.transform(im["px"], lambda x: _clip(x, 0.0, 255.0).cast("float"))))
    scale = F.lit(255.0).cast("float")

    def level(x: Column) -> Column:
        return F.floor(_clip(x, 0.0, 1.0).cast("float") * scale).cast("float")

    return let(img, lambda im: _same_size(im, F.transform(im["px"], level)))


def to_unit(img: Column, levels: bool) -> Column:
    """To floats in 0..1."""
    return let(
        img, lambda im: _same_size(im, F.transform(im["px"], lambda x: _unit(x, levels).cast("float")))
    )


def crop(img: Column, top: Column, left: Column, size_h: int, size_w: int) -> Column:
    def cropped(im: Column, t: Column, q: Column) -> Column:
        w, c = im["w"], im["c"]
        rows = F.transform(
            F.sequence(F.lit(0), F.lit(size_h - 1)),
            lambda r: F.slice(im["px"], (((t + r) * w + q) * c + 1).cast("int"), c * size_w),
        )
        return make_image(F.lit(size_h), F.lit(size_w), c, F.flatten(rows))

    corner = F.struct(top.cast("int").alias("t"), left.cast("int").alias("q"))
    return let(img, lambda im: let(corner, lambda at: cropped(im, at["t"], at["q"])))


def random_crop(img: Column, size: int, key: Column, seed: int, step: str) -> Column:
    """A ``size`` x ``size`` window at a drawn place."""
    base = draw_base(seed, step, key)
    top = F.floor(uniform(base, 0) * (img["h"] - F.lit(size - 1)))
    left = F.floor(uniform(base, 1) * (img["w"] - F.lit(size - 1)))
    return crop(img, top, left, size, size)


def random_mirror(img: Column, key: Column, seed: int, step: str, p: float = 0.5) -> Column:
    return F.when(uniform(draw_base(seed, step, key), 0) < p, flip_h(img)).otherwise(img)


def to_chw(img: Column) -> Column:
    """Pixels in channel-first order."""

    def planes(im: Column) -> Column:
        c = im["c"]
        plane = F.transform(
            F.sequence(F.lit(0), c - 1),
            lambda k: F.transform(
                F.sequence(F.lit(0), im["h"] * im["w"] - 1), lambda q: F.get(im["px"], q * c + k)
            ),
        )
        return F.flatten(plane)

    return let(img, planes)


def pixel_stats(img: Column) -> Column:
    """``struct<low, high, mean>`` of an image."""
    px = img["px"]
    total = F.aggregate(px, F.lit(0.0), lambda a, x: a + x.cast("double"))
    return F.struct(
        F.array_min(px).alias("low"), F.array_max(px).alias("high"), (total / F.size(px)).alias("mean")
    )
