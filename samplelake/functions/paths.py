"""Column functions on object keys, URIs and URLs."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffixes and names that must match for results to agree.
IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png", ".gif", ".webp", ".bmp", ".tiff", ".tif")
SHARD_EXTENSIONS = (".jpg", ".jpeg", ".png")
CONTENT_TYPE_EXTENSIONS = {
    "image/jpeg": ".jpg",
    "image/jpg": ".jpg",
    "image/png": ".png",
    "image/gif": ".gif",
    "image/webp": ".webp",
    "image/bmp": ".bmp",
    "image/tiff": ".tiff",
}
DEFAULT_EXTENSION = ".jpg"
WHITESPACE = " \t\n\r\f\v"
BOXES_SUFFIX = "_boxes.txt"
VAL_ANNOTATIONS = "val_annotations.txt"


def normalize_extensions(extensions: Iterable[str] | None) -> list[str]:
    """Lower-cased suffixes with a leading dot; nothing given means the shard defaults."""
    given = list(extensions or ()) or list(SHARD_EXTENSIONS)
    return sorted({"." + e.lower().removeprefix(".") for e in given})


def has_extension(key: Column, extensions: Iterable[str]) -> Column:
    """True where the key ends in one of the suffixes, whatever its case."""
    low = F.lower(key)
    return reduce(lambda a, b: a | b, [low.endswith(e) for e in extensions])


def strip(text: Column) -> Column:
    """Without white space at either end."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_image_key(key: Column) -> Column:
    return has_extension(key, IMAGE_EXTENSIONS)


def is_shard_key(key: Column, extensions: Iterable[str] | None = None) -> Column:
    return has_extension(key, normalize_extensions(extensions))


def is_sidecar(key: Column) -> Column:
    """Annotation files that sit beside the images."""
    return key.endswith(BOXES_SUFFIX) | key.contains(VAL_ANNOTATIONS)


def split_base(prefix: str, split: str | None = None) -> str:
    """Base under which keys are listed: the prefix with one slash, then the split."""
    base = prefix.rstrip("/") + "/" if prefix else ""
    return f"{base}{split}/" if split else base


def relative_key(key: Column, base: str) -> Column:
    return F.when(key.startswith(base), F.substring(key, len(base) + 1, 1 << 30)).otherwise(key)


def file_name(key: Column) -> Column:
    return F.substring_index(key, "/", -1)


def drop_extension(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]*$", "")


def sample_key(source: Column) -> Column:
    """File name without its last extension."""
    return drop_extension(file_name(source))


def sample_key_or_index(source: Column, index: Column) -> Column:
    """The sample key, or the zero-padded position where the stem is empty."""
    stem = sample_key(source)
    return F.when(stem == "", F.format_string("%06d", index)).otherwise(stem)


def label_from_key(key: Column, base: str) -> Column:
    """First folder under the base; a lone file gives its stem up to the first ``_``."""
    parts = F.filter(F.split(relative_key(key, base), "/", -1), lambda p: p != "")
    lone = F.substring_index(drop_extension(F.get(parts, F.lit(0))), "_", 1)
    return F.when(F.size(parts) >= 2, F.get(parts, F.lit(0))).when(F.size(parts) == 1, lone)


def path_parts(key: Column) -> Column:
    """Sort key for listing order by path parts (``a/x`` before ``a-b/x``)."""
    return F.split(key, "/", -1)


def parse_uri(uri: Column) -> Column:
    """``struct<bucket, prefix>`` of an ``s3://`` URI, or null for any other string."""
    rest = F.btrim(F.substring(uri, 6, 1 << 30), F.lit("/"))
    cut = F.locate("/", rest)
    bucket = F.when(cut == 0, rest).otherwise(F.substring_index(rest, "/", 1))
    prefix = F.when(cut == 0, F.lit("")).otherwise(
        F.concat(rest.substr(cut + 1, F.length(rest)), F.lit("/"))
    )
    return F.when(uri.startswith("s3://"), F.struct(bucket.alias("bucket"), prefix.alias("prefix")))


def parse_uri_strict(uri: Column) -> Column:
    return F.coalesce(parse_uri(uri), F.raise_error(F.lit("URI must start with s3://")))


def flat_prefix(prefix: Column) -> Column:
    return F.btrim(F.replace(prefix, F.lit("/"), F.lit("_")), F.lit("_"))


def metadata_key(prefix: Column) -> Column:
    flat = flat_prefix(prefix)
    name = F.when(flat == "", F.lit("scan")).otherwise(flat)
    return F.concat(F.lit("metadata/"), name, F.lit(".jsonl"))


def job_id(bucket: Column, prefix: Column) -> Column:
    return F.concat(bucket, F.lit("_"), flat_prefix(prefix))


def dest_key(prefix: Column, key: Column) -> Column:
    """Key under a destination prefix; also the key of a shard under its source prefix."""
    joined = F.concat(F.rtrim(prefix, F.lit("/")), F.lit("/"), key)
    return F.when(F.coalesce(prefix, F.lit("")) == "", key).otherwise(joined)


def _known_content_type(content_type: Column) -> Column:
    bare = F.lower(strip(F.substring_index(content_type, ";", 1)))
    pairs = [F.lit(x) for kv in CONTENT_TYPE_EXTENSIONS.items() for x in kv]
    return F.element_at(F.create_map(*pairs), bare)


def ext_from_content_type(content_type: Column) -> Column:
    return F.coalesce(_known_content_type(content_type), F.lit(DEFAULT_EXTENSION))


def ext_from_url(url: Column) -> Column:
    path = F.lower(F.substring_index(url, "?", 1))
    found = F.coalesce(*[F.when(path.endswith(e), F.lit(e)) for e in IMAGE_EXTENSIONS])
    return F.coalesce(found, F.lit(DEFAULT_EXTENSION))


def download_ext(content_type: Column, url: Column) -> Column:
    """Extension from a known content type, else from the URL."""
    return F.coalesce(_known_content_type(content_type), ext_from_url(url))


def download_name(index: Column, extension: Column) -> Column:
    return F.concat(F.format_string("%05d", index), extension)


def shard_name(prefix: str, shard_idx: Column) -> Column:
    return F.format_string("%s_%05d.tar", F.lit(prefix), shard_idx)
