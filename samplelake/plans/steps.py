"""Pipeline steps as plain data, and their compilation to one Column.

A chain of value steps compiles to a built-in expression.  As soon as one step moves
pixels, the whole chain becomes one Arrow function: pixels then cross to Python once,
which costs less than a crossing per step plus interpreted lambdas.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplelake.functions import pixels
from samplelake.functions.kernels import chain_function

IMAGE_TYPE = "struct<h:int,w:int,c:int,px:array<float>>"
BYTES_TYPE = "struct<h:int,w:int,c:int,px:binary>"
FORM_TYPES = {"floats": IMAGE_TYPE, "bytes": BYTES_TYPE, "png": "binary"}


@dataclass(frozen=True)
class Step:
    """One step.  ``calls`` lists its kernels; ``column`` builds it, where it can."""

    random = False

    def calls(self, name: str) -> list[tuple[str, dict[str, Any]]]:
        raise NotImplementedError

    def column(self, img: Column, key: Column, name: str, levels: bool) -> Column | None:
        return None

    def levels_after(self, levels: bool) -> bool:
        return levels


@dataclass(frozen=True)
class Resize(Step):
    target_size: tuple[int, int] = (224, 224)
    maintain_aspect: bool = True
    pad: bool = True

    def calls(self, name):
        return [("resize", vars(self).copy())]


@dataclass(frozen=True)
class Normalize(Step):
    """Scale to 0..1 and standardise.

    ``input_range`` "auto" divides by 255 only where a value lies outside 0..1, so a
    nearly black image of levels stays as it is; "known" goes by the kind of image.
    """

    mean: Sequence[float] | None = None
    std: Sequence[float] | None = None
    input_range: str = "auto"

    def calls(self, name):
        first = [("to_unit", {})] if self.input_range == "known" else []
        return [*first, ("normalize", {"mean": self.mean, "std": self.std})]

    def column(self, img, key, name, levels):
        if self.input_range == "known":
            img = pixels.to_unit(img, levels)
        return pixels.normalize(img, self.mean, self.std)

    def levels_after(self, levels):
        return False


@dataclass(frozen=True)
class Augment(Step):
    flip_h: bool = False
    flip_v: bool = False
    rotate_deg: float = 0
    color_jitter: dict | None = None
    seed: int = 0
    random = True

    def calls(self, name):
        out: list[tuple[str, dict[str, Any]]] = []
        if self.flip_h or self.flip_v:
            out.append(("flip", {"horizontal": self.flip_h, "vertical": self.flip_v}))
        if self.rotate_deg:
            out.append(("rotate", {"degrees": self.rotate_deg}))
        if self.color_jitter:
            out.append(("color_jitter", {"jitter": self.color_jitter, "seed": self.seed, "step": name}))
        return out

    def column(self, img, key, name, levels):
        if self.flip_h:
            img = pixels.flip_h(img)
        if self.flip_v:
            img = pixels.flip_v(img)
        if self.rotate_deg % 360:
            img = pixels.rotate(img, self.rotate_deg, levels)
        if self.color_jitter:
            img = pixels.color_jitter(img, self.color_jitter, key, self.seed, name, levels)
        return img


@dataclass(frozen=True)
class CameraNoise(Step):
    gaussian_std: float = 0.02
    poisson_scale: float | None = 0.1
    seed: int = 0
    random = True

    def calls(self, name):
        return [("camera_noise", {**vars(self), "step": name})]

    def column(self, img, key, name, levels):
        if self.gaussian_std <= 0 and not self.poisson_scale:
            return img
        return pixels.camera_noise(img, self.gaussian_std, self.poisson_scale, key, self.seed, name, levels)


@dataclass(frozen=True)
class LensDistortion(Step):
    k: float = -0.2

    def calls(self, name):
        return [("lens_distortion", vars(self).copy())]

    def column(self, img, key, name, levels):
        return pixels.lens_distortion(img, self.k, levels)


@dataclass(frozen=True)
class Vignetting(Step):
    strength: float = 0.4

    def calls(self, name):
        return [("vignetting", vars(self).copy())]

    def column(self, img, key, name, levels):
        return pixels.vignetting(img, self.strength, levels)


@dataclass(frozen=True)
class ToLevels(Step):
    """Output step: 0..255 by truncation, which loses standardised negatives."""

    def calls(self, name):
        return [("to_levels", {})]

    def column(self, img, key, name, levels):
        return pixels.to_levels(img, levels)

    def levels_after(self, levels):
        return True


@dataclass(frozen=True)
class ToRgb(Step):
    bgr: bool = False

    def calls(self, name):
        return [("to_rgb", vars(self).copy())]


@dataclass(frozen=True)
class Custom(Step):
    """A user function from one HWC array to one HWC array."""

    function: Callable = field(default=lambda im: im)
    levels_out: bool | None = None

    def calls(self, name):
        return [("custom", {"function": self.function})]

    def levels_after(self, levels):
        return levels if self.levels_out is None else self.levels_out


@dataclass(frozen=True)
class TrainView(Step):
    """Shorter side to ``resize``, random window, random mirror, channel statistics."""

    size: int = 224
    resize: int | None = 256
    mirror: float = 0.5
    seed: int = 0
    random = True

    def calls(self, name):
        shrink = [("resize_shorter", {"size": self.resize})] if self.resize else []
        return [
            *shrink,
            ("random_crop", {"size": self.size, "seed": self.seed, "step": name}),
            ("random_mirror", {"p": self.mirror, "seed": self.seed, "step": name + ".mirror"}),
            ("to_unit", {}),
            ("normalize", {"mean": pixels.IMAGENET_MEAN, "std": pixels.IMAGENET_STD}),
        ]

    def column(self, img, key, name, levels):
        if self.resize:
            return None
        cropped = pixels.random_crop(img, self.size, key, self.seed, name)
        seen = pixels.let(cropped, lambda im: pixels.random_mirror(im, key, self.seed, name + ".mirror", self.mirror))
        return pixels.normalize(pixels.to_unit(seen, levels), pixels.IMAGENET_MEAN, pixels.IMAGENET_STD)

    def levels_after(self, levels):
        return False


@dataclass(frozen=True)
class AreaView(Step):
    """Shorter side to ``resize``, a window of random area and aspect, mirror, statistics."""

    size: int = 224
    resize: int | None = 256
    area: tuple[float, float] = (0.8, 1.0)
    aspect: tuple[float, float] = (3.0 / 4.0, 4.0 / 3.0)
    mirror: float = 0.5
    seed: int = 0
    random = True

    def calls(self, name):
        window = {"size": self.size, "area": self.area, "aspect": self.aspect}
        shrink = [("resize_shorter", {"size": self.resize})] if self.resize else []
        return [
            *shrink,
            ("random_area_crop", {**window, "seed": self.seed, "step": name}),
            ("random_mirror", {"p": self.mirror, "seed": self.seed, "step": name + ".mirror"}),
            ("to_unit", {}),
            ("normalize", {"mean": pixels.IMAGENET_MEAN, "std": pixels.IMAGENET_STD}),
        ]

    def levels_after(self, levels):
        return False


def step_names(steps: Sequence[Step]) -> list[str]:
    """Names under which steps draw: the place in the chain and the kind."""
    return [f"{i}{type(s).__name__}" for i, s in enumerate(steps)]


def compile_steps(
    steps: Sequence[Step],
    image: Column,
    key: Column | None = None,
    *,
    levels: bool = False,
    form: str = "floats",
) -> Column:
    """The chain as one Column.

    ``image`` is an image struct, or encoded image bytes for a chain that ends in
    another ``form`` than "floats": "bytes" gives structs of levels, "png" PNG bytes.
    """
    if form == "floats":
        built, state = image, levels
        for step, name in zip(steps, step_names(steps)):
            built = step.column(built, key, name, state) if built is not None else None
            state = step.levels_after(state)
        if built is not None:
            return built
    return kernel_column(steps, image, key, levels=levels, form=form)


def kernel_column(
    steps: Sequence[Step],
    image: Column,
    key: Column | None = None,
    *,
    levels: bool = False,
    form: str = "floats",
) -> Column:
    """The chain as one Arrow function; keys go along only where a step draws."""
    calls = [c for step, name in zip(steps, step_names(steps)) for c in step.calls(name)]
    keyed = any(step.random for step in steps)
    kernel = F.arrow_udf(chain_function(calls, levels, form, keyed), FORM_TYPES[form])
    return kernel(image, key) if keyed else kernel(image)


def transform_images(
    df: DataFrame,
    steps: Sequence[Step],
    *,
    image: str = "image",
    key: str = "key",
    levels: bool = False,
    form: str = "floats",
) -> DataFrame:
    """Run a chain of steps over a table of images, keeping every other column."""
    return df.withColumn(
        image, compile_steps(steps, F.col(image), F.col(key), levels=levels, form=form)
    )
