"""Image format, size and Exif facts read from an object's bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from samplelake.functions.pixels import let

# Formats taken as expected, and leading bytes (hex) by format.
EXPECTED_FORMATS = ("JPEG", "PNG", "GIF", "WEBP", "BMP", "TIFF")
LEADING_BYTES = (
    ("JPEG", "FFD8FF"),
    ("PNG", "89504E470D0A1A0A"),
    ("GIF", "474946383761"),
    ("GIF", "474946383961"),
    ("BMP", "424D"),
    ("TIFF", "49492A00"),
    ("TIFF", "4D4D002A"),
    ("PPM", "5035"),
    ("PPM", "5036"),
)
JPEG_END = "FFD9"
PNG_END = "49454E44AE426082"
EXIF_MARKER = "457869660000"
PNG_EXIF_CHUNK = "65584966"
# Markers of JPEG frames, whose segment holds the size.
JPEG_FRAMES = (
    "FFC0", "FFC1", "FFC2", "FFC3", "FFC5", "FFC6", "FFC7", "FFC9", "FFCA", "FFCB", "FFCD", "FFCE", "FFCF",
)
# Steps of the first walk over a JPEG's segments; a file with more gets a second walk, as long as it needs.
JPEG_STEPS = 64
# Fill bytes that one step of the walk passes.
FILL_BYTES = 1 << 16
HEAD_BYTES = 32
UNKNOWN_DATA = "unrecognised image data"
TRUNCATED_DATA = "image data is truncated"


def _bytes(text: str) -> Column:
    return F.unhex(F.lit(text))


def image_format(content: Column) -> Column:
    known = [F.when(F.startswith(content, _bytes(m)), F.lit(n)) for n, m in LEADING_BYTES]
    riff = F.startswith(content, _bytes("52494646")) & (F.hex(F.substring(content, 9, 4)) == "57454250")
    return F.coalesce(*known, F.when(riff, F.lit("WEBP")))


def _number(content: Column, positions: list[int]) -> Column:
    digits = F.concat(*[F.hex(F.substring(content, p, 1)) for p in positions])
    return F.conv(digits, 16, 10).cast("int")


def _header_side(content: Column, fmt: Column, png: int, gif: int, bmp: int) -> Column:
    return (
        F.when(fmt == "PNG", _number(content, [png, png + 1, png + 2, png + 3]))
        .when(fmt == "GIF", _number(content, [gif + 1, gif]))
        .when(fmt == "BMP", _number(content, [bmp + 3, bmp + 2, bmp + 1, bmp]))
    )


def header_width(content: Column, fmt: Column) -> Column:
    return _header_side(content, fmt, 17, 7, 19)


def header_height(content: Column, fmt: Column) -> Column:
    return _header_side(content, fmt, 21, 9, 23)


def jpeg_facts(content: Column) -> Column:
    """``height, width, exif, truncated`` of a JPEG, from a walk over the segments before its pixels.

    The end marker is looked for behind the start of the pixels, so that one inside a
    thumbnail does not count; without pixels behind the frame, and without a frame where
    the walk ended, or, where a segment is said to pass the end of the data, in their last
    two bytes.
    """

    def number(at: Column) -> Column:
        return F.conv(F.hex(F.substring(content, at, F.lit(2))), 16, 10).cast("int")

    def fill(at: Column) -> Column:
        """Fill bytes from here on, without the one that belongs to a marker."""
        run = F.regexp_extract(F.hex(F.substring(content, at, F.lit(FILL_BYTES))), "^F+", 0)
        return F.greatest(F.floor(F.length(run) / 2).cast("int") - 1, F.lit(1))

    def looked(s: Column) -> Column:
        at = s["at"]

        def seen(marker: Column) -> Column:
            frame = marker.isin(*JPEG_FRAMES)
            exif = (marker == "FFE1") & (F.hex(F.substring(content, at + 4, F.lit(6))) == EXIF_MARKER)
            ended = marker.isin("FFDA", JPEG_END) | ~marker.startswith("FF") | (F.length(marker) < 4)
            behind = at + 2 + F.greatest(F.coalesce(number(at + 2), F.lit(2)), F.lit(2))
            return F.struct(
                F.when(ended, at).when(marker == "FFFF", at + fill(at)).otherwise(behind).alias("at"),
                ended.alias("ended"),
                F.when(marker == "FFDA", at).when(frame, at + 9).otherwise(s["pixels"]).alias("pixels"),
                F.when(frame, number(at + 5)).otherwise(s["height"]).alias("height"),
                F.when(frame, number(at + 7)).otherwise(s["width"]).alias("width"),
                (s["exif"] | exif).alias("exif"),
            )

        return let(F.hex(F.substring(content, at, F.lit(2))), seen)

    def step(s: Column, _: Column) -> Column:
        return F.when(s["ended"], s).otherwise(looked(s))

    def whole(s: Column) -> Column:
        # A segment has four bytes at least, and only runs of fill bytes take steps of their own.
        rest = F.greatest(F.floor((F.octet_length(content) - s["at"]) / 2), F.lit(0)) + 2
        return F.when(s["ended"], s).otherwise(F.aggregate(F.sequence(F.lit(1), rest.cast("int")), s, step))

    def told(s: Column) -> Column:
        size = F.octet_length(content)
        # A segment said to be longer than all the data leaves only their last two bytes to look at.
        stop = F.when(s["at"] > size + 1, size - 1).otherwise(s["at"])
        tail = F.substring(content, F.coalesce(s["pixels"], stop), size)
        return F.struct(
            s["height"].alias("height"),
            s["width"].alias("width"),
            s["exif"].alias("exif"),
            (~F.contains(tail, _bytes(JPEG_END))).alias("truncated"),
        )

    none = F.lit(None).cast("int")
    start = F.struct(
        F.lit(3).alias("at"),
        F.lit(False).alias("ended"),
        none.alias("pixels"),
        none.alias("height"),
        none.alias("width"),
        F.lit(False).alias("exif"),
    )
    first = F.aggregate(F.sequence(F.lit(1), F.lit(JPEG_STEPS)), start, step)
    return let(let(first, whole), told)


def lacks_last_chunk(content: Column) -> Column:
    """A PNG without its last chunk; more may follow it."""
    return ~F.contains(content, _bytes(PNG_END))


def has_exif_marker(content: Column) -> Column:
    """The marker anywhere, for formats other than JPEG and PNG."""
    return F.contains(content, _bytes(EXIF_MARKER))


def has_exif_chunk(content: Column) -> Column:
    """The Exif chunk of a PNG."""
    return F.contains(content, _bytes(PNG_EXIF_CHUNK))


def is_unexpected_format(fmt: Column) -> Column:
    return fmt.isNotNull() & (fmt != "") & ~F.upper(fmt).isin(*EXPECTED_FORMATS)


def image_error(truncated: Column, fmt: Column) -> Column:
    return F.when(fmt.isNull(), F.lit(UNKNOWN_DATA)).when(truncated, F.lit(TRUNCATED_DATA))
