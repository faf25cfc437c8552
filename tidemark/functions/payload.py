"""Nested landed payloads to typed columns, row-local and JVM-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_by

STORE_SCHEMA = """map<string, struct<
    success: boolean,
    data: struct<
        type: string, name: string, short_description: string,
        developers: array<string>, publishers: array<string>,
        is_free: boolean, required_age: int,
        release_date: struct<coming_soon: boolean, date: string>,
        platforms: map<string, boolean>,
        metacritic: struct<score: int, url: string>,
        categories: array<struct<id: int, description: string>>,
        genres: array<struct<id: string, description: string>>,
        price_overview: struct<currency: string, initial: bigint, final: bigint, discount_percent: int>>>>"""

CATALOGUE_SCHEMA = """struct<
    id: bigint, name: string, slug: string, summary: string, first_release_date: bigint,
    cover: struct<url: string>,
    genres: array<struct<name: string>>, themes: array<struct<name: string>>,
    platforms: array<struct<name: string>>, game_modes: array<struct<name: string>>,
    involved_companies: array<struct<
        company: struct<name: string>, developer: boolean, publisher: boolean>>,
    websites: array<struct<url: string, category: int>>>"""

RATING_SCHEMA = (
    "struct<id: bigint, rating: double, aggregated_rating: double, total_rating_count: int>"
)

PRICE_SCHEMA = (
    "struct<currency: string, price: double, initial_price: double, is_free: boolean, discount: int>"
)

# External-id source code -> platform.
EXTERNAL_SOURCES = {
    1: "steam",
    5: "gog",
    10: "youtube",
    11: "microsoft",
    13: "steam_alt",
    14: "twitch",
    15: "android",
    20: "discord",
    26: "epic",
    28: "oculus",
    33: "battlenet",
    34: "origin",
    35: "uplay",
}

# Website category code -> label.
WEBSITE_CATEGORIES = {
    1: "official",
    2: "wikia",
    3: "wikipedia",
    4: "facebook",
    5: "twitter",
    6: "twitch",
    8: "instagram",
    9: "youtube",
    10: "iphone",
    11: "ipad",
    12: "android",
    13: "steam",
    14: "reddit",
    15: "itch",
    16: "epicgames",
    17: "gog",
    18: "discord",
}

# External platform -> column of the entity dimension.
PLATFORM_ID_COLUMNS = {
    "steam": "app_id",
    "twitch": "channel_id",
    "youtube": "video_channel_id",
    "epic": "epic_id",
    "gog": "gog_id",
}


def _lookup(codes: dict[int, str]) -> Column:
    return F.create_map(*[F.lit(part) for pair in codes.items() for part in pair])


def _strings() -> Column:
    return F.array().cast("array<string>")


def true_keys(flags: Column) -> Column:
    """Keys of a boolean map whose value is true."""
    return F.coalesce(F.map_keys(F.map_filter(flags, lambda _, v: v)), _strings())


def descriptions(items: Column) -> Column:
    """``description`` of every item, missing ones as empty text."""
    return F.coalesce(
        F.transform(items, lambda x: F.coalesce(x["description"], F.lit(""))), _strings()
    )


def names(items: Column) -> Column:
    return F.coalesce(F.transform(items, lambda x: x["name"]), _strings())


def price_info(data: Column) -> Column:
    """Price struct: zero when free or unpriced, else cents as dollars."""
    price = data["price_overview"]
    free = F.struct(
        F.lit("USD").alias("currency"),
        F.lit(0.0).alias("price"),
        F.lit(None).cast("double").alias("initial_price"),
        F.lit(True).alias("is_free"),
        F.lit(0).alias("discount"),
    )
    paid = F.struct(
        F.coalesce(price["currency"], F.lit("USD")).alias("currency"),
        (F.coalesce(price["final"], F.lit(0)) / 100).alias("price"),
        (F.coalesce(price["initial"], F.lit(0)) / 100).alias("initial_price"),
        F.lit(False).alias("is_free"),
        F.coalesce(price["discount_percent"], F.lit(0)).alias("discount"),
    )
    is_free = F.coalesce(data["is_free"], F.lit(False))
    return F.when(is_free | price.isNull(), free).otherwise(paid).cast(PRICE_SCHEMA)


def _successful(landed: DataFrame) -> DataFrame:
    """Payload entries filed under their own app id and flagged as successful.

    Exploding the zero or one usable entries keeps the parsing in one place: a
    filter on the parsed entry would be pushed below and parse once more.
    """
    parsed = F.from_json("payload", STORE_SCHEMA)
    entry = F.try_element_at(parsed, F.col("app_id").cast("string"))
    usable = F.filter(F.array(entry), lambda e: F.coalesce(e["success"], F.lit(False)))
    return landed.select("app_id", F.explode(usable).alias("__entry")).select(
        "app_id", F.col("__entry.data").alias("data")
    )


def store_kpis(landed: DataFrame) -> DataFrame:
    """Store payload to static fields and KPI fields; price only when not free."""
    data = F.col("data")
    free = F.coalesce(data["is_free"], F.lit(False))
    return _successful(landed).select(
        "app_id",
        data["short_description"].alias("store_description"),
        F.coalesce(data["required_age"], F.lit(0)).alias("required_age"),
        free.alias("is_free"),
        data["metacritic"]["score"].alias("score"),
        F.when(~free, data["price_overview"]["final"]).alias("price_cents"),
    )


def store_metadata(landed: DataFrame) -> DataFrame:
    """Store payload to the full descriptive row."""
    data = F.col("data")

    def text(column: Column) -> Column:
        return F.coalesce(column, F.lit(""))

    return _successful(landed).select(
        "app_id",
        text(data["name"]).alias("name"),
        text(data["type"]).alias("type"),
        text(data["short_description"]).alias("description"),
        F.coalesce(data["developers"], _strings()).alias("developers"),
        F.coalesce(data["publishers"], _strings()).alias("publishers"),
        F.coalesce(data["is_free"], F.lit(False)).alias("is_free"),
        F.coalesce(data["required_age"], F.lit(0)).alias("required_age"),
        text(data["release_date"]["date"]).alias("release_date"),
        true_keys(data["platforms"]).alias("platforms"),
        data["metacritic"]["score"].alias("metacritic_score"),
        data["metacritic"]["url"].alias("metacritic_url"),
        descriptions(data["categories"]).alias("categories"),
        descriptions(data["genres"]).alias("genres"),
        price_info(data).alias("price_info"),
    )


def static_metadata(landed: DataFrame, tracked: DataFrame) -> DataFrame:
    """Static and KPI fields of the tracked apps that have details."""
    return store_kpis(landed).join(tracked.select("app_id", "title"), "app_id")


def cover_url(url: Column) -> Column:
    """Secure, large form of a catalogue cover path."""
    return F.concat(F.lit("https:"), F.replace(url, F.lit("t_thumb"), F.lit("t_cover_big")))


def last_per_label(labelled: Column) -> Column:
    """array<struct<label,value>> to a map in which the last entry of a label wins.

    One pass over the array; the map never holds more than the known labels.
    """
    return F.aggregate(
        labelled,
        F.create_map().cast("map<string,string>"),
        lambda held, e: F.map_concat(
            F.map_filter(held, lambda label, _: label != e["label"]), F.create_map(e["label"], e["value"])
        ),
    )


def websites_map(sites: Column) -> Column:
    """Website array to category -> url; unknown codes are ``other``."""
    labels = _lookup(WEBSITE_CATEGORIES)
    with_url = F.filter(sites, lambda s: F.coalesce(s["url"], F.lit("")) != "")
    labelled = F.transform(
        with_url,
        lambda s: F.struct(
            F.coalesce(F.try_element_at(labels, s["category"]), F.lit("other")).alias("label"),
            s["url"].alias("value"),
        ),
    )
    return F.coalesce(last_per_label(labelled), F.create_map().cast("map<string,string>"))


def catalogue_row(landed: DataFrame) -> DataFrame:
    """Catalogue payload to the entity row."""
    g = F.col("g")

    def company(role: str) -> Column:
        held = F.filter(g["involved_companies"], lambda c: F.coalesce(c[role], F.lit(False)))
        return F.coalesce(F.transform(held, lambda c: c["company"]["name"]), _strings())

    epoch = F.nullif(g["first_release_date"], F.lit(0))
    # As in ``_successful``: filters on the entity must not parse the payload again.
    parsed = F.explode(F.array(F.from_json("payload", CATALOGUE_SCHEMA))).alias("g")
    return landed.select(parsed).select(
        g["id"].alias("canonical_id"),
        g["name"].alias("title"),
        g["slug"].alias("slug"),
        g["summary"].alias("summary"),
        F.timestamp_seconds(epoch).cast("timestamp_ntz").alias("first_release_date"),
        cover_url(g["cover"]["url"]).alias("cover_url"),
        names(g["genres"]).alias("genres"),
        names(g["themes"]).alias("themes"),
        names(g["platforms"]).alias("platforms"),
        names(g["game_modes"]).alias("game_modes"),
        company("developer").alias("developers"),
        company("publisher").alias("publishers"),
        websites_map(g["websites"]).alias("websites"),
    )


def external_platform(source: Column) -> Column:
    """Platform of a source code; unlisted codes become ``unknown_<code>``."""
    known = F.try_element_at(_lookup(EXTERNAL_SOURCES), source)
    return F.coalesce(known, F.concat(F.lit("unknown_"), source.cast("string")))


def _usable_ids(rows: DataFrame) -> DataFrame:
    return rows.where(
        F.col("uid").isNotNull() & (F.col("uid") != "") & F.col("source").isNotNull()
        & (F.col("source") != 0)
    )


def external_ids(rows: DataFrame) -> DataFrame:
    """(canonical_id, platform, uid): the last usable uid of every platform."""
    named = _usable_ids(rows).withColumn("platform", external_platform(F.col("source")))
    return latest_by(named, ["canonical_id", "platform"], ["position"], ["uid"])


def external_ids_pivot(rows: DataFrame) -> DataFrame:
    """One row per entity with its five platform ids, in one aggregation.

    Entities whose ids all belong to other platforms keep a row of NULLs.
    """
    codes = {platform: code for code, platform in EXTERNAL_SOURCES.items()}
    last = F.struct("position", "uid")
    picked = [
        F.max(F.when(F.col("source") == codes[platform], last))["uid"].alias(column)
        for platform, column in PLATFORM_ID_COLUMNS.items()
    ]
    wide = _usable_ids(rows).groupBy("canonical_id").agg(*picked)
    return wide.withColumn("app_id", F.expr("try_cast(app_id AS BIGINT)"))


def ratings(landed: DataFrame) -> DataFrame:
    """Rating payload to (ts, canonical_id, rating, critic_rating, rating_count)."""
    g = F.col("g")
    usable = F.filter(F.array(F.from_json("payload", RATING_SCHEMA)), lambda r: r["id"].isNotNull())
    return landed.select("ts", F.explode(usable).alias("g")).select(
        "ts",
        g["id"].alias("canonical_id"),
        g["rating"].alias("rating"),
        g["aggregated_rating"].alias("critic_rating"),
        g["total_rating_count"].alias("rating_count"),
    )


def activity_sample(counts: DataFrame, tracked: DataFrame, details: DataFrame) -> DataFrame:
    """Sampled counts with title and store KPIs; KPIs are NULL without details."""
    named = counts.join(tracked.select("app_id", "title"), "app_id", "left")
    kpis = details.select("app_id", "score", "price_cents", "is_free")
    return named.join(kpis, "app_id", "left").select(
        "ts",
        "app_id",
        F.coalesce("title", F.concat(F.lit("Game "), F.col("app_id").cast("string"))).alias("title"),
        "player_count",
        "score",
        "price_cents",
        "is_free",
    )


def viewer_sample(viewership: DataFrame, moment: Column) -> DataFrame:
    return viewership.select(
        moment.alias("ts"), "app_id", "title", "channel_id", "viewer_count", "channel_count",
        "top_streams",
    )
