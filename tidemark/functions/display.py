"""Display text and number formats of the dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: image address by app id.
IMAGE_FORMAT = "https://cdn.cloudflare.steamstatic.com/steam/apps/%s/header.jpg"

MISSING = "N/A"


def whole_number(value: Column) -> Column:
    """Rounded half up, with thousands separators."""
    return F.format_number(F.floor(value + 0.5), 0)


def one_decimal(value: Column) -> Column:
    """One decimal, nearest to the exact binary value, ties upwards.

    ``20x - (2n ± 1)`` is computed as ``(16x - (2n ± 1)) + 4x``; near the tie
    both steps are exact in floating point, so its sign decides the rounding.
    Zero and NULL print as missing.
    """
    n = F.floor(value * 10 + 0.5).cast("double")
    below = (value * 16 - (n * 2 - 1)) + value * 4 < 0
    above = (value * 16 - (n * 2 + 1)) + value * 4 >= 0
    tenths = F.when(below, n - 1).when(above, n + 1).otherwise(n).cast("bigint")
    text = F.concat(
        (F.floor(tenths / 10)).cast("string"), F.lit("."), F.pmod(tenths, F.lit(10)).cast("string")
    )
    return F.when(value.isNull() | (value == 0), F.lit(MISSING)).otherwise(text)


def whole_or_missing(value: Column) -> Column:
    rounded = F.floor(value + 0.5).cast("bigint").cast("string")
    return F.when(value.isNull() | (value == 0), F.lit(MISSING)).otherwise(rounded)


def top_tags(tags: Column, n: int = 5) -> Column:
    """The ``n`` heaviest tags of a map, ties by name."""

    def heavier(a: Column, b: Column) -> Column:
        return (
            F.when(a["value"] > b["value"], -1)
            .when(a["value"] < b["value"], 1)
            .when(a["key"] < b["key"], -1)
            .when(a["key"] > b["key"], 1)
            .otherwise(0)
        )

    entries = F.array_sort(F.map_entries(tags), heavier)
    return F.transform(F.slice(entries, 1, n), lambda e: e["key"])


def image_url(app_id: Column) -> Column:
    """Image of an app; no app id (or 0) gives an empty address."""
    usable = app_id.isNotNull() & (app_id != 0)
    return F.when(usable, F.format_string(IMAGE_FORMAT, app_id.cast("string"))).otherwise(F.lit(""))


def _joined(items: Column, default: str) -> Column:
    return F.coalesce(F.nullif(F.array_join(items, ", "), F.lit("")), F.lit(default))


def profile_text(dim: DataFrame) -> DataFrame:
    """The text fields of an entity page, with their fallbacks."""
    return dim.select(
        "canonical_id",
        F.coalesce(
            F.nullif("store_description", F.lit("")),
            F.nullif("summary", F.lit("")),
            F.lit("No description available"),
        ).alias("description"),
        F.array_join(F.slice("platforms", 1, 3), ", ").alias("platform_badge"),
        _joined(F.col("developers"), "Unknown").alias("developer"),
        _joined(F.col("publishers"), "Unknown").alias("publisher"),
        F.coalesce(F.date_format("first_release_date", "yyyy-MM-dd"), F.lit("TBA")).alias("release_date"),
        _joined(F.transform("platforms", F.upper), MISSING).alias("platform_list"),
        image_url(F.col("app_id")).alias("image_url"),
    )
