"""Keys, buckets, dates and JSON fields; seeded draws."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: where images lie.
IMAGE_PREFIX = "http://i.pinimg.com/400x"


def image_key_to_url(key: Column, prefix: str = IMAGE_PREFIX) -> Column:
    return F.concat_ws(
        "/", F.lit(prefix), F.substring(key, 1, 2), F.substring(key, 3, 2), F.substring(key, 5, 2),
        F.concat(key, F.lit(".jpg")),
    )


def path_to_key(path: Column) -> Column:
    """Base name up to its first dot."""
    return F.substring_index(F.substring_index(path, "/", -1), ".", 1)


def album_bucket(album: Column, buckets: int = 100000) -> Column:
    return F.pmod(album, F.lit(buckets)).cast("bigint")


def pair_key(user: Column, item: Column) -> Column:
    return F.xxhash64(user, item)


def parse_ts(text: Column) -> Column:
    """Timestamp of an ISO string, null where it is not one."""
    return F.try_to_timestamp(text)


def json_field(text: Column, path: str) -> Column:
    return F.get_json_object(text, path)


def draw(size: Column | int, *parts: Column, seed: int = 0) -> Column:
    """Uniform integer in [0, size) that depends on the key columns and seed alone."""
    size = F.lit(size) if isinstance(size, int) else size
    return F.pmod(F.xxhash64(*parts, F.lit(seed)), size).cast("bigint")


def unit_draw(*parts: Column, seed: int = 0) -> Column:
    """Uniform number in [0, 1) that depends on the key columns and seed alone."""
    span = 1 << 52
    return draw(span, *parts, seed=seed) / F.lit(float(span))
