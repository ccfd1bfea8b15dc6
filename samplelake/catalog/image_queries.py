"""Registered queries on images.  Pixels are compared through position-weighted sums."""

from __future__ import annotations

from pyspark.sql import functions as F

from samplelake.catalog import views as v
from samplelake.catalog.registering import query
from samplelake.functions import pixels
from samplelake.plans import steps as st
from samplelake.plans.config import pipeline_from_config

W = v.with_views
MEAN, STD = list(pixels.IMAGENET_MEAN), list(pixels.IMAGENET_STD)


def image():
    return F.col("image")


def sums(df, px=None):
    """Per image: pixel count, sum, and sum weighted by position."""
    px = image()["px"] if px is None else px
    held = df.select("key", px.alias("px"))
    doubles = F.transform("px", lambda x: x.cast("double"))
    placed = F.transform("px", lambda x, i: x.cast("double") * (i + 1))
    add = lambda a, x: a + x
    return held.select(
        "key",
        F.size("px").cast("long").alias("n"),
        F.round(F.aggregate(doubles, F.lit(0.0), add), 4).alias("total"),
        F.round(F.aggregate(placed, F.lit(0.0), add), 3).alias("placed"),
    )


def sums_sql(source: str, px: str = "px") -> str:
    return f"""SELECT key, len(p)::BIGINT AS n,
      round(list_sum(list_transform(p, lambda x: x::DOUBLE)), 4) AS total,
      round(list_sum(list_transform(p, lambda x, i: x::DOUBLE * i)), 3) AS placed
      FROM (SELECT key, {px} AS p FROM {source})"""


# From rows (key, pos, val) of single pixels.
CELL_SUMS = """SELECT key, count(*) AS n, round(sum(val::DOUBLE), 4) AS total,
  round(sum(val::DOUBLE * pos), 3) AS placed FROM cells GROUP BY key"""


def on(view, steps, levels=False):
    def run(spark, sf):
        return sums(st.transform_images(view(spark, sf), steps, levels=levels))

    return run


def column_on(view, build):
    def run(spark, sf):
        return sums(view(spark, sf).withColumn("image", build(image())))

    return run


# --- sizes, padding, resampling ------------------------------------------------


@query("fit_size", """SELECT doc_id, round_even(h * s, 0)::INTEGER AS h, round_even(w * s, 0)::INTEGER AS w FROM
  (SELECT doc_id, h, w, least(224 / h, 160 / w) AS s FROM
    (SELECT doc_id, (1 + n_chars % 700)::DOUBLE AS h, (1 + doc_id % 900)::DOUBLE AS w FROM documents))""")
def fit_size(spark, sf):
    d = v.table(spark, sf, "documents")
    size = pixels.fit_size(1 + F.col("n_chars") % 700, 1 + F.col("doc_id") % 900, 224, 160)
    return d.select("doc_id", size.alias("s")).select("doc_id", "s.h", "s.w")


def weights_sql(*axes: tuple[str, int, int]) -> str:
    rows = ", ".join(f"('{a}', {size}, {new})" for a, size, new in axes)
    return f"""weights AS (
  SELECT axis, o, i, trunc(u / sum(u) OVER (PARTITION BY axis, o) * 4194304
         + CASE WHEN u < 0 THEN -0.5 ELSE 0.5 END) AS k
  FROM (SELECT axis, o, i, CASE
          WHEN i < greatest(trunc(mid - 3 * spread + 0.5), 0) OR i >= least(trunc(mid + 3 * spread + 0.5), size)
            OR abs(x) >= 3 THEN 0.0::DOUBLE WHEN x = 0 THEN 1.0::DOUBLE
          ELSE sin(pi() * x) / (pi() * x) * sin(pi() * x / 3) / (pi() * x / 3) END AS u
        FROM (SELECT *, (i + 0.5::DOUBLE - mid) / spread AS x
              FROM (SELECT axis, size, o, i, (o + 0.5::DOUBLE) * size / new AS mid,
                           greatest(size::DOUBLE / new, 1.0::DOUBLE) AS spread
                    FROM (VALUES {rows}) t(axis, size, new), range(new) a(o), range(size) b(i)))))"""


def pixels_sql(view: str, w: int, c: int) -> str:
    return f"""pixels AS (SELECT key, (p - 1) // {c} // {w} AS y, (p - 1) // {c} % {w} AS x, (p - 1) % {c} AS ch,
  val::DOUBLE AS val FROM (SELECT key, unnest(px) AS val, unnest(range(1, len(px) + 1)) AS p FROM {view}))"""


ROUNDED = "greatest(0, least(255, floor((sum(k * val) + 2097152) / 4194304)))"


@query("resize_lanczos", W(v.RGB, v.RGB_U8, weights_sql(("w", 6, 5), ("h", 4, 3)), pixels_sql("rgb_u8", 6, 3)) + f""",
  across AS (SELECT key, y, o AS x, ch, {ROUNDED} AS val FROM pixels JOIN weights ON axis = 'w' AND i = x
             GROUP BY key, y, o, ch),
  down AS (SELECT key, o AS y, x, ch, {ROUNDED} AS val FROM across JOIN weights ON axis = 'h' AND i = y
           GROUP BY key, o, x, ch)
  SELECT key, 90::BIGINT AS n, round(sum(val), 4) AS total,
         round(sum(val * (((y + 1) * 5 + x) * 3 + ch + 1)), 3) AS placed FROM down GROUP BY key""")
def resize_lanczos(spark, sf):
    return on(v.rgb_u8, [st.Resize((6, 5))], levels=True)(spark, sf)


@query("resize_normalize", W(v.IMAGES, v.TILES, weights_sql(("w", 64, 32))) + f""",
  across AS (SELECT key, y, o AS x, ch, {ROUNDED} AS val FROM tiles JOIN weights ON i = x AND k <> 0
             GROUP BY key, y, o, ch),
  down AS (SELECT key, o AS y, x, ch, {ROUNDED} AS val FROM across JOIN weights ON i = y AND k <> 0
           GROUP BY key, o, x, ch),
  cells AS (SELECT key, (y * 32 + x) * 3 + ch + 1 AS pos, (val / 255)::FLOAT AS val FROM down)
  {CELL_SUMS}""")
def resize_normalize(spark, sf):
    return on(v.tiles, [st.Resize((32, 32)), st.Normalize()], levels=True)(spark, sf)


query("centre_pad", W(v.RGB, pixels_sql("rgb", 6, 3)) + """SELECT key, 189::BIGINT AS n, round(sum(val), 4) AS total,
  round(sum(val * (((y + 1) * 9 + x + 1) * 3 + ch + 1)), 3) AS placed FROM pixels GROUP BY key""")(
    column_on(v.rgb, lambda i: pixels.centre_pad(i, 7, 9))
)

# --- values ----------------------------------------------------------------------

MIXED = """mixed AS (SELECT key, CASE WHEN label % 2 = 0 THEN px
  ELSE list_transform(px, lambda x: (x::DOUBLE * 300 - 20)::FLOAT) END AS px FROM rgb)"""
UNIT = """CASE WHEN list_max(px) > 1 OR list_min(px) < 0
  THEN list_transform(px, lambda x: (least(255.0::DOUBLE, greatest(0.0::DOUBLE, x::DOUBLE)) / 255.0::DOUBLE)::FLOAT)
  ELSE px END"""


def mixed(spark, sf):
    """Images in 0..1, and others with values outside it."""
    wide = F.transform(image()["px"], lambda x: (x.cast("double") * 300 - 20).cast("float"))
    px = F.when(F.col("label") % 2 == 0, image()["px"]).otherwise(wide)
    return v.rgb(spark, sf).withColumn("image", pixels.make_image(image()["h"], image()["w"], image()["c"], px))


query("normalize_unit", W(v.RGB, MIXED) + sums_sql("mixed", UNIT))(on(mixed, [st.Normalize()]))



def doubles(values):
    return "[" + ", ".join(f"{x}::DOUBLE" for x in values) + "]"


STANDARD = f"""list_transform(px, lambda x, i: ((x::DOUBLE / 255.0::DOUBLE - {doubles(MEAN)}[(i - 1) % 3 + 1])
  / {doubles(STD)}[(i - 1) % 3 + 1])::FLOAT)"""
query("standardize", W(v.RGB, v.RGB_U8) + sums_sql("rgb_u8", STANDARD))(
    on(v.rgb_u8, [st.Normalize(MEAN, STD)], levels=True)
)

query("to_uint8", W(v.RGB, MIXED) + sums_sql("mixed", """list_transform(px,
  lambda x: floor(least(1.0::FLOAT, greatest(0.0::FLOAT, x)) * 255.0::FLOAT))"""))(on(mixed, [st.ToLevels()]))

query("to_unit_float", W(v.RGB, MIXED, v.RGB_U8) + """, parts AS (SELECT 'f' || key AS key,
  list_transform(px, lambda x: least(1.0::FLOAT, greatest(0.0::FLOAT, x))) AS px FROM mixed
  UNION ALL SELECT 'u' || key, list_transform(px, lambda x: (x::DOUBLE / 255.0::DOUBLE)::FLOAT) FROM rgb_u8)
  """ + sums_sql("parts"))(
    lambda spark, sf: sums(
        mixed(spark, sf).select(F.concat(F.lit("f"), "key").alias("key"), pixels.to_unit(image(), False).alias("image"))
        .unionByName(
            v.rgb_u8(spark, sf).select(
                F.concat(F.lit("u"), "key").alias("key"), pixels.to_unit(image(), True).alias("image")
            )
        )
    )
)


@query("pixel_stats", W(v.RGB) + """SELECT key, list_min(px) AS low, list_max(px) AS high,
  round(list_sum(list_transform(px, lambda x: x::DOUBLE)) / len(px), 6) AS mean FROM rgb""")
def pixel_stats(spark, sf):
    found = v.rgb(spark, sf).select("key", pixels.pixel_stats(image()).alias("s"))
    return found.select("key", "s.low", "s.high", F.round("s.mean", 6).alias("mean"))


# --- flips, rotation, lens ----------------------------------------------------------


def moved(view: str, w: int, c: int, y: str, x: str, new_w: int) -> str:
    """Sums after every pixel has moved to row ``y`` and column ``x``."""
    return W(*VIEWS[view], pixels_sql(view, w, c)) + f""", cells AS (
  SELECT key, ((({y}) * {new_w} + ({x})) * {c} + ch + 1) AS pos, val FROM pixels) {CELL_SUMS}"""


VIEWS = {
    "rgb": (v.RGB,),
    "rgb_u8": (v.RGB, v.RGB_U8),
    "images": (v.IMAGES,),
    "images_u8": (v.IMAGES, v.IMAGES_U8),
}

query("flip_h", moved("rgb", 6, 3, "y", "5 - x", 6))(on(v.rgb, [st.Augment(flip_h=True)]))
query("flip_v", moved("rgb", 6, 3, "3 - y", "x", 6))(on(v.rgb, [st.Augment(flip_v=True)]))
query("rotate_90", moved("images_u8", 8, 1, "x", "7 - y", 8))(
    on(v.images_u8, [st.Augment(rotate_deg=90)], levels=True)
)
query("rotate_180", moved("rgb_u8", 6, 3, "3 - y", "5 - x", 6))(
    on(v.rgb_u8, [st.Augment(rotate_deg=180)], levels=True)
)


@query("to_chw", W(v.RGB, pixels_sql("rgb", 6, 3)) + f""", cells AS (
  SELECT key, ch * 24 + y * 6 + x + 1 AS pos, val FROM pixels) {CELL_SUMS}""")
def to_chw(spark, sf):
    return sums(v.rgb(spark, sf), pixels.to_chw(image()))


# The four neighbours of a place, by distance from it.
def neighbours(edge_y: str, edge_x: str) -> str:
    return f"""near AS (
  SELECT g.y AS oy, g.x AS ox, i.a, j.b, fy, fx, {edge_y} AS y, {edge_x} AS x
  FROM (SELECT *, floor(sy) AS y0, floor(sx) AS x0, sy - floor(sy) AS fy, sx - floor(sx) AS fx FROM places) g,
       (VALUES (0), (1)) i(a), (VALUES (0), (1)) j(b)),
corners AS (
  SELECT key, oy, ox, any_value(fy) AS fy, any_value(fx) AS fx,
    max(val) FILTER (a = 0 AND b = 0) AS p00, max(val) FILTER (a = 0 AND b = 1) AS p01,
    max(val) FILTER (a = 1 AND b = 0) AS p10, max(val) FILTER (a = 1 AND b = 1) AS p11
  FROM near JOIN pixels USING (y, x) GROUP BY key, oy, ox)"""


ROTATE_PLACES = """places AS (
  SELECT y, x, c * (x + 0.5::DOUBLE - 4) + s * (y + 0.5::DOUBLE - 4) + 4 - 0.5 AS sx,
         c * (y + 0.5::DOUBLE - 4) - s * (x + 0.5::DOUBLE - 4) + 4 - 0.5 AS sy
  FROM range(8) a(y), range(8) b(x),
       (SELECT round(cos(radians(30)), 15) AS c, round(sin(radians(30)), 15) AS s)),
inside AS (SELECT * FROM places WHERE sx + 0.5 >= 0 AND sx + 0.5 < 8 AND sy + 0.5 >= 0 AND sy + 0.5 < 8)"""
query("rotate_30", W(*VIEWS["images_u8"], pixels_sql("images_u8", 8, 1), ROTATE_PLACES,
      neighbours("least(7, greatest(0, y0 + a))", "least(7, greatest(0, x0 + b))").replace("FROM places", "FROM inside"))
      + """, rows AS (SELECT *, p00 + (p01 - p00) * fx AS t, p10 + (p11 - p10) * fx AS l FROM corners)
  SELECT key, 64::BIGINT AS n, round(sum(trunc(t + (l - t) * fy)), 4) AS total,
    round(sum(trunc(t + (l - t) * fy) * (oy * 8 + ox + 1)), 3) AS placed FROM rows GROUP BY key""")(
    on(v.images_u8, [st.Augment(rotate_deg=30)], levels=True)
)


def lens_places(k: float) -> str:
    return f"""places AS (
  SELECT y, x, 3.5 + dy * (1 + {k}::DOUBLE * r * r) AS sy, 3.5 + dx * (1 + {k}::DOUBLE * r * r) AS sx
  FROM (SELECT y, x, y - 3.5::DOUBLE AS dy, x - 3.5::DOUBLE AS dx,
               sqrt((x - 3.5::DOUBLE) ** 2 + (y - 3.5::DOUBLE) ** 2) / (4 + 1e-6::DOUBLE) AS r
        FROM range(8) a(y), range(8) b(x)))"""


REFLECT = "CASE WHEN ({0} % 16 + 16) % 16 < 8 THEN ({0} % 16 + 16) % 16 ELSE 15 - ({0} % 16 + 16) % 16 END"
LENS_VALUE = "p00 * (1 - fy) * (1 - fx) + p01 * (1 - fy) * fx + p10 * fy * (1 - fx) + p11 * fy * fx"


def lens_sql(k: float) -> str:
    edges = neighbours(REFLECT.format("(y0 + a)"), REFLECT.format("(x0 + b)"))
    return W(v.IMAGES, pixels_sql("images", 8, 1), lens_places(k), edges) + f""", lensed AS (
  SELECT key, oy AS y, ox AS x, least(1, greatest(0, {LENS_VALUE}))::FLOAT AS val FROM corners)"""


LENS_CELLS = f""", cells AS (SELECT key, y * 8 + x + 1 AS pos, val FROM lensed) {CELL_SUMS}"""
query("lens_distortion", lens_sql(-0.2) + LENS_CELLS)(on(v.images, [st.LensDistortion(-0.2)]))
query("lens_pincushion", lens_sql(0.3) + LENS_CELLS)(on(v.images, [st.LensDistortion(0.3)]))


# --- light and noise ----------------------------------------------------------------


def shade(y: str, x: str, h: int, w: int, strength: float) -> str:
    cy, cx = (h - 1) / 2, (w - 1) / 2
    reach = f"(sqrt({cx * cx + cy * cy}::DOUBLE) + 1e-6::DOUBLE)"
    near = f"least(1.0::DOUBLE, sqrt(({y} - {cy}::DOUBLE) ** 2 + ({x} - {cx}::DOUBLE) ** 2) / {reach})"
    return f"(1 - {strength}::DOUBLE * {near} * {near})"


query("vignetting", W(v.RGB, pixels_sql("rgb", 6, 3)) + f""", cells AS (
  SELECT key, (y * 6 + x) * 3 + ch + 1 AS pos,
         least(1, greatest(0, val * {shade('y', 'x', 4, 6, 0.4)}))::FLOAT AS val FROM pixels) {CELL_SUMS}""")(
    on(v.rgb, [st.Vignetting(0.4)])
)
query("vignetting_u8", W(v.RGB, v.RGB_U8, pixels_sql("rgb_u8", 6, 3)) + f""", cells AS (
  SELECT key, (y * 6 + x) * 3 + ch + 1 AS pos,
         floor(least(1, greatest(0, val / 255 * {shade('y', 'x', 4, 6, 0.4)})) * 255) AS val FROM pixels) {CELL_SUMS}""")(
    on(v.rgb_u8, [st.Vignetting(0.4)], levels=True)
)


def draws_sql(name: str, source: str, seed: int, step: str, count: str) -> str:
    """``key, d, u``: uniform draws ``0 .. count-1`` of every key."""
    mask = 0xFFFFFFFF
    return f"""{name} AS (
  SELECT key, d, xor(v2, v2 >> 16) / 4294967296.0::DOUBLE AS u FROM (
    SELECT key, d, (xor(v1, v1 >> 16) * 73244475) & {mask} AS v2 FROM (
      SELECT key, d, (xor(v0, v0 >> 16) * 73244475) & {mask} AS v1 FROM (
        SELECT key, d, (('0x' || substr(md5('{seed}:{step}:' || key), 1, 8))::BIGINT + d * {0x9E3779B1}) & {mask} AS v0
        FROM {source}, range({count}) r(d)))))"""


JITTER = {"brightness": [0.8, 1.2], "contrast": [0.9, 1.1], "saturation": 0.7}
query("color_jitter", W(v.RGB, draws_sql("draws", "rgb", 42, "0Augment", "2"), pixels_sql("rgb", 6, 3)) + f""",
  factors AS (SELECT key, max(0.8::DOUBLE + u * (1.2::DOUBLE - 0.8::DOUBLE)) FILTER (d = 0) AS b,
                     max(0.9::DOUBLE + u * (1.1::DOUBLE - 0.9::DOUBLE)) FILTER (d = 1) AS c FROM draws GROUP BY key),
  bright AS (SELECT key, y, x, ch, val * b AS val, c FROM pixels JOIN factors USING (key)),
  middle AS (SELECT key, avg(val) AS m FROM bright GROUP BY key),
  contrast AS (SELECT key, y, x, ch, (val - m) * c + m AS val FROM bright JOIN middle USING (key)),
  grey AS (SELECT key, y, x, sum(val) / 3 AS g FROM contrast GROUP BY key, y, x),
  cells AS (SELECT key, (y * 6 + x) * 3 + ch + 1 AS pos,
    least(1, greatest(0, val * 0.7::DOUBLE + (1 - 0.7::DOUBLE) * g))::FLOAT AS val
    FROM contrast JOIN grey USING (key, y, x)) {CELL_SUMS}""")(
    on(v.rgb, [st.Augment(color_jitter=JITTER, seed=42)])
)

query("gaussian_noise", W(v.RGB, draws_sql("draws", "rgb", 5, "0CameraNoise", "144")) + f""",
  pairs AS (SELECT key, d // 2 + 1 AS pos, max(u) FILTER (d % 2 = 0) AS u1, max(u) FILTER (d % 2 = 1) AS u2
            FROM draws GROUP BY key, d // 2),
  flat AS (SELECT key, unnest(px)::DOUBLE AS val, unnest(range(1, len(px) + 1)) AS pos FROM rgb),
  cells AS (SELECT key, pos, least(1, greatest(0, val + 0.02::DOUBLE * sqrt(-2 * ln(1 - u1)) * cos(2 * pi() * u2)))::FLOAT AS val
            FROM flat JOIN pairs USING (key, pos)) {CELL_SUMS}""")(
    on(v.rgb, [st.CameraNoise(gaussian_std=0.02, poisson_scale=None, seed=5)])
)

# A count is the number of partial sums of the law at or below the draw.
query("poisson_noise", W(v.RGB, draws_sql("draws", "rgb", 5, "0CameraNoise.shot", "144")) + f""",
  flat AS (SELECT key, unnest(px)::DOUBLE / 0.1::DOUBLE AS mean, unnest(range(1, len(px) + 1)) AS pos FROM rgb),
  sums AS (SELECT key, pos, u, sum(CASE WHEN mean > 0 THEN exp(k * ln(mean) - mean - lgamma(k + 1))
                                        WHEN k = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)
                               OVER (PARTITION BY key, pos ORDER BY k) AS upto
           FROM flat JOIN draws USING (key), range(60) r(k) WHERE d = 2 * (pos - 1)),
  cells AS (SELECT key, pos, least(1.0::DOUBLE, count(*) FILTER (upto <= u) * 0.1::DOUBLE)::FLOAT AS val
            FROM sums GROUP BY key, pos) {CELL_SUMS}""")(
    on(v.rgb, [st.CameraNoise(gaussian_std=0.0, poisson_scale=0.1, seed=5)])
)


# --- chains ---------------------------------------------------------------------------

CHAIN = [st.Vignetting(0.5), st.Augment(flip_h=True, flip_v=True), st.Normalize(MEAN, STD), st.ToLevels()]
query("pipeline_chain", W(v.RGB, pixels_sql("rgb", 6, 3)) + f""", shaded AS (
  SELECT key, 3 - y AS y, 5 - x AS x, ch, (least(1, greatest(0, val * {shade('y', 'x', 4, 6, 0.5)}))::FLOAT)::DOUBLE AS val FROM pixels),
  cells AS (SELECT key, (y * 6 + x) * 3 + ch + 1 AS pos, floor(least(1.0::FLOAT, greatest(0.0::FLOAT,
    ((val - {doubles(MEAN)}[ch + 1]) / {doubles(STD)}[ch + 1])::FLOAT)) * 255.0::FLOAT) AS val FROM shaded) {CELL_SUMS}""")(
    on(v.rgb, CHAIN)
)

CONFIG = {
    "steps": [
        {"name": "lens_distortion", "k": -0.2, "seed": 42},
        {"name": "Vignetting", "strength": 0.4},
        {"name": "augment", "flip_v": True, "rotate_deg": 0},
        {"name": "normalize", "mean": 0.5, "std": [0.25]},
    ]
}
query("pipeline_from_config", lens_sql(-0.2) + f""", cells AS (
  SELECT key, (7 - y) * 8 + x + 1 AS pos,
    (((least(1, greatest(0, val::DOUBLE * {shade('y', 'x', 8, 8, 0.4)}))::FLOAT)::DOUBLE - 0.5::DOUBLE) / 0.25::DOUBLE)::FLOAT AS val
  FROM lensed) {CELL_SUMS}""")(on(v.images, pipeline_from_config(CONFIG)))

query("train_view", W(v.RGB, v.RGB_U8, draws_sql("places", "rgb", 9, "0TrainView", "2"),
      draws_sql("coins", "rgb", 9, "0TrainView.mirror", "1"), pixels_sql("rgb_u8", 6, 3)) + f""",
  corner AS (SELECT key, max(floor(u * 2)) FILTER (d = 0) AS top, max(floor(u * 4)) FILTER (d = 1) AS lft
             FROM places GROUP BY key),
  seen AS (SELECT key, y - top AS y, CASE WHEN u < 0.5 THEN 2 - (x - lft) ELSE x - lft END AS x, ch, val
           FROM pixels JOIN corner USING (key) JOIN coins USING (key)
           WHERE y >= top AND y < top + 3 AND x >= lft AND x < lft + 3),
  cells AS (SELECT key, (y * 3 + x) * 3 + ch + 1 AS pos, (((val / 255)::FLOAT::DOUBLE
    - {doubles(MEAN)}[(ch + 1)::INTEGER]) / {doubles(STD)}[(ch + 1)::INTEGER])::FLOAT AS val
    FROM seen) {CELL_SUMS}""")(
    on(v.rgb_u8, [st.TrainView(size=3, resize=None, seed=9)], levels=True)
)


def triangle_sql(sizes: str) -> str:
    """``size, new, o, i, k``: fixed-point weights of linear resampling for rows of ``size, new``."""
    return f"""weights AS (
  SELECT size, new, o, i, trunc(u / sum(u) OVER (PARTITION BY size, new, o) * 4194304 + 0.5) AS k
  FROM (SELECT size, new, o, i, greatest(0.0::DOUBLE, 1.0::DOUBLE - abs((i + 0.5::DOUBLE - mid) / spread)) AS u
        FROM (SELECT size, new, o, i, (o + 0.5::DOUBLE) * (size::DOUBLE / new) AS mid,
                     greatest(size::DOUBLE / new, 1.0::DOUBLE) AS spread
              FROM ({sizes}) t(size, new), range(20) a(o), range(20) b(i) WHERE o < new AND i < size)
        WHERE i >= greatest(trunc(mid - spread + 0.5), 0) AND i < trunc(mid + spread + 0.5)))"""


# The shorter side becomes 8 (so 6 x 4 pixels become 12 x 8), then the window 5 x 5.
query("random_area_crop", W(v.RGB, v.RGB_U8, draws_sql("places", "rgb", 9, "0AreaView", "4"),
      draws_sql("coins", "rgb", 9, "0AreaView.mirror", "1"), pixels_sql("rgb_u8", 6, 3),
      triangle_sql("VALUES (6, 12), (4, 8) UNION SELECT size, 5 FROM range(1, 13) s(size)")) + f""",
  wide AS (SELECT key, y, o AS x, ch, {ROUNDED} AS val FROM pixels JOIN weights ON size = 6 AND new = 12 AND i = x
           GROUP BY key, y, o, ch),
  large AS (SELECT key, o AS y, x, ch, {ROUNDED} AS val FROM wide JOIN weights ON size = 4 AND new = 8 AND i = y
            GROUP BY key, o, x, ch),
  drawn AS (SELECT key, max(u) FILTER (d = 0) AS u0, max(u) FILTER (d = 1) AS u1, max(u) FILTER (d = 2) AS u2,
                   max(u) FILTER (d = 3) AS u3 FROM places GROUP BY key),
  shapes AS (SELECT *, 0.8::DOUBLE + u0 * (1.0::DOUBLE - 0.8::DOUBLE) AS part,
                    exp(ln(0.75::DOUBLE) + u1 * (ln(4.0::DOUBLE / 3.0::DOUBLE) - ln(0.75::DOUBLE))) AS ratio FROM drawn),
  sides AS (SELECT *, least(8, greatest(1, round_even(sqrt(part * 8 * 12 / ratio), 0)))::BIGINT AS h,
                   least(12, greatest(1, round_even(sqrt(part * 8 * 12 * ratio), 0)))::BIGINT AS w FROM shapes),
  windows AS (SELECT key, h, w, floor(u2 * (8 - h + 1)) AS top, floor(u3 * (12 - w + 1)) AS lft FROM sides),
  across AS (SELECT key, h, y - top AS y, o AS x, ch, {ROUNDED} AS val
             FROM large JOIN windows USING (key) JOIN weights ON size = w AND new = 5 AND i = x - lft
             WHERE y >= top AND y < top + h GROUP BY key, h, y - top, o, ch),
  down AS (SELECT key, o AS y, x, ch, {ROUNDED} AS val FROM across JOIN weights ON size = h AND new = 5 AND i = y
           GROUP BY key, o, x, ch),
  cells AS (SELECT key, (y * 5 + CASE WHEN u < 0.5 THEN 4 - x ELSE x END) * 3 + ch + 1 AS pos,
                   (((val / 255)::FLOAT::DOUBLE - {doubles(MEAN)}[(ch + 1)::INTEGER]) / {doubles(STD)}[(ch + 1)::INTEGER])::FLOAT AS val
            FROM down JOIN coins USING (key)) {CELL_SUMS}""")(
    on(v.rgb_u8, [st.AreaView(size=5, resize=8, seed=9)], levels=True)
)
