"""Pipelines from YAML or a dict."""

from __future__ import annotations

import os
from collections.abc import Mapping
from typing import Any

from samplelake.plans.steps import (
    Augment,
    CameraNoise,
    LensDistortion,
    Normalize,
    Resize,
    Step,
    Vignetting,
)

STEP_KINDS: dict[str, type[Step]] = {
    "resize": Resize,
    "normalize": Normalize,
    "augment": Augment,
    "camera_noise": CameraNoise,
    "lens_distortion": LensDistortion,
    "vignetting": Vignetting,
}


# The keys of a shard config.
SHARD_KEYS = ("input_root", "output_dir", "shard_size", "extensions", "splits", "upload_uri")


def shard_config(source: str | os.PathLike | Mapping[str, Any], **given: Any) -> dict[str, Any]:
    """Settings of a shard job: values given in the call win over the config's."""
    config = dict(load_config(source) or {})
    config.update({k: v for k, v in given.items() if v is not None})
    for name in ("input_root", "output_dir"):
        if not config.get(name):
            raise ValueError(f"Shard config needs '{name}'")
    extensions = config.get("extensions")
    if isinstance(extensions, str):
        config["extensions"] = [e.strip() for e in extensions.split(",")]
    return {k: config.get(k) for k in (*SHARD_KEYS, "num_shards")}


def load_config(source: str | os.PathLike | Mapping[str, Any]) -> Any:
    """The config as Python data, from a YAML file or given directly."""
    if isinstance(source, Mapping):
        return source
    if not isinstance(source, (str, os.PathLike)):
        return source
    import yaml

    if not os.path.isfile(source):
        raise FileNotFoundError(f"Pipeline config not found: {source}")
    with open(source) as f:
        return yaml.safe_load(f)


def _option(name: str, value: Any) -> Any:
    if name == "target_size":
        return tuple(value) if isinstance(value, (list, tuple)) else (value, value)
    if name in ("mean", "std") and value is not None:
        return tuple(value) if isinstance(value, (list, tuple)) else (value,)
    return value


def _step(position: int, entry: Any) -> Step:
    if not isinstance(entry, Mapping):
        raise ValueError(f"Step {position} must be a dict")
    if not entry.get("name"):
        raise ValueError(f"Step {position} must have a 'name' key")
    name = str(entry["name"]).strip().lower()
    if name not in STEP_KINDS:
        raise ValueError(f"Unknown pipeline step: {name}")
    kind = STEP_KINDS[name]
    known = kind.__dataclass_fields__
    # Options a step does not have are ignored, and an absent seed keeps the default.
    options = {k: _option(k, v) for k, v in entry.items() if k in known}
    if options.get("seed", 0) is None:
        del options["seed"]
    return kind(**options)


def pipeline_from_config(source: str | os.PathLike | Mapping[str, Any]) -> list[Step]:
    """Steps of a pipeline config, in order."""
    config = load_config(source)
    if not isinstance(config, Mapping):
        raise ValueError("Pipeline config must be a dict with a 'steps' key")
    entries = config.get("steps")
    if not isinstance(entries, list):
        raise ValueError("Pipeline config must have 'steps' as a list")
    return [_step(i, entry) for i, entry in enumerate(entries)]
