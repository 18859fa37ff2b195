"""Column functions: units, names, dates, paths and colours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Names of display colours.
COLORS = {"black": "000000", "blue": "0000FF", "cyan": "00FFFF", "green": "00FF00", "magenta": "FF00FF", "red": "FF0000", "white": "FFFFFF", "yellow": "FFFF00"}


def convert_scale(value: Column, old: float, new: float, power: int = 1) -> Column:
    """A distance to a power in pixels of another scale, scales being pixels per micron."""
    return value * F.lit((new / old) ** power)


def floor_to_pixel(value: Column, pixel: float, eps: float = 1e-10) -> Column:
    return F.floor((value + eps) / pixel) * pixel


def strict_long(value: Column, tolerance: float) -> Column:
    """The nearest integer; an error if it is further away than the tolerance."""
    near = F.rint(value)
    return F.when(F.abs(value - near) <= tolerance, near).otherwise(F.raise_error(F.concat(F.lit("not an integer: "), value.cast("string"))).cast("double")).cast("long")


def color_hex(name: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in COLORS.items() for x in kv])[F.lower(name)]


def parse_time(value: Column, *formats: str) -> Column:
    """The first format that fits."""
    return F.coalesce(*[F.try_to_timestamp(value, F.lit(f)) for f in formats])


def replace_suffix(path: Column, suffix: str) -> Column:
    return F.regexp_replace(path, r"\.[^./]*$", suffix)


def map_mount(path: Column, mounts: dict[str, str]) -> Column:
    """Replaces the first of the given prefixes that a path has."""
    out = path
    for old, new in reversed(mounts.items()):
        out = F.when(F.startswith(path, F.lit(old)), F.concat(F.lit(new), F.substring(path, len(old) + 1, 1 << 30))).otherwise(out)
    return out


def keep_second_measurement(files: DataFrame, column: str) -> DataFrame:
    """Of files that differ by a closing _M2 alone the one with it, under the name without."""
    name = F.regexp_replace(column, "_M2$", "")
    first = F.row_number().over(Window.partitionBy("name").orderBy((~F.endswith(column, F.lit("_M2"))).cast("int")))
    return files.withColumn("name", name).withColumn("_r", first).where("_r = 1").drop("_r").select("name", column)


def cell_type(segmentation: Column, algorithm: Column, bits: int = 8) -> Column:
    """Segment type in the low bits, algorithm above."""
    return segmentation.bitwiseOR(F.shiftleft(algorithm, bits))
