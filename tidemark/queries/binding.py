"""The engine's tables expressed over the test tables.

Samples come from ``events``, entities from ``customer``, the discovery
catalogue from ``orders``, external ids and live streams from ``lineitem``,
and landed payloads from ``part``. ``oracles.py`` states the same in SQL.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.clock import EVERYTHING, Range
from tidemark.functions import payload
from tidemark.operators import latest, rollup
from tidemark.session import pin_utc

AS_OF = date(2024, 1, 30)
AS_OF_TS = datetime(2024, 1, 30, 23, 30)
CATALOGUE_NOW = datetime(2001, 3, 1)

_SCHEMAS: dict[str, StructType] = {}

# One second per customer key, from the given day of January.
_SECONDS = (
    "timestamp_ntz'2024-01-{} 00:00:00' + make_dt_interval(0, 0, 0, cast(c_custkey AS decimal(18, 6)))"
)


def _cat(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


class Model:
    """Lazy frames over one folder of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        pin_utc(spark)
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        """A test table; its schema is read from the files once per process."""
        path = f"{self.sf_dir}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    # -- samples ---------------------------------------------------------
    def events(self, *kinds: str) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("int")
        return self.table("events").where(F.col("event_type").isin(*kinds)).withColumn("k", k)

    @property
    def raw_activity(self) -> DataFrame:
        return activity_of(self.events("click", "view"))

    @property
    def raw_viewers(self) -> DataFrame:
        return self.events("purchase").select(
            "ts",
            F.col("user_id").cast("string").alias("channel_id"),
            _cat("Game ", F.col("user_id")).alias("title"),
            F.round(F.col("value") * 100).cast("bigint").alias("viewer_count"),
            F.col("k").alias("channel_count"),
        )

    @property
    def raw_ratings(self) -> DataFrame:
        return self.events("signup").select(
            "ts",
            (F.col("user_id") + 100000).alias("canonical_id"),
            F.col("value").alias("rating"),
            F.col("k").cast("double").alias("critic_rating"),
            F.col("k").alias("rating_count"),
        )

    # -- entities --------------------------------------------------------
    @cached_property
    def dim(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey + 100000 AS canonical_id",
            "c_name AS title",
            "lower(replace(c_name, '#', '-')) AS slug",
            "if(c_acctbal >= 0, c_custkey, NULL) AS app_id",
            "CASE WHEN c_acctbal < 0 THEN '' WHEN c_mktsegment != 'BUILDING' THEN string(c_custkey) END AS channel_id",
            "string(NULL) AS video_channel_id",
            "if(c_nationkey > 20, 'e' || c_custkey, NULL) AS epic_id",
            "string(NULL) AS gog_id",
            "if(c_acctbal > 9000, '', c_name || ' in ' || c_mktsegment) AS summary",
            "if(c_nationkey > 0, timestamp_ntz'2000-01-01 00:00:00' + make_dt_interval(c_nationkey), NULL) AS first_release_date",
            "if(c_acctbal >= 500, 'https://img/t_cover_big/' || c_custkey || '.jpg', NULL) AS cover_url",
            "CASE WHEN c_nationkey >= 8 THEN c_mktsegment || ' store' WHEN c_nationkey >= 5 THEN '' END AS store_description",
            "c_nationkey AS required_age",
            "if(c_nationkey < 24, array(c_mktsegment), NULL) AS genres",
            "array('Theme ' || c_nationkey, 'Shared') AS themes",
            """CASE WHEN c_nationkey < 3 THEN cast(array() AS array<string>)
                    WHEN c_nationkey < 9 THEN array('pc', 'linux')
                    ELSE array('pc', 'linux', 'mac', 'web') END AS platforms""",
            "cast(array() AS array<string>) AS game_modes",
            "if(c_nationkey > 1, array('Dev ' || c_nationkey, c_mktsegment), NULL) AS developers",
            "array('Pub ' || c_nationkey) AS publishers",
            "map('official', 'https://o/' || c_custkey) AS websites",
            "c_mktsegment AS discovery_source",
            f"{_SECONDS.format('01')} AS discovery_date",
            f"{_SECONDS.format('02')} AS last_updated",
            "c_mktsegment != 'MACHINERY' AS is_active",
            "c_nationkey != 3 AS track_app",
            "c_nationkey != 5 AS track_channel",
            "false AS track_forum",
        )

    @cached_property
    def worklist(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey + 100000 AS canonical_id",
            "c_name AS title",
            "c_acctbal > 5000 AS enriched",
            f"{_SECONDS.format('01')} AS discovered_at",
            "c_mktsegment AS discovery_source",
            "bigint(c_nationkey) AS discovery_rank",
        )

    # -- period tables ---------------------------------------------------
    def hourly_activity(self, window: Range = EVERYTHING) -> DataFrame:
        return rollup.hourly_activity(self.raw_activity, window)

    def daily_activity(self, window: Range = EVERYTHING) -> DataFrame:
        return rollup.daily_activity(self.raw_activity, self.dim, window)

    def daily_viewers(self, window: Range = EVERYTHING) -> DataFrame:
        return rollup.daily_viewers(self.raw_viewers, self.dim, window)

    def ratings_daily(self, window: Range = EVERYTHING) -> DataFrame:
        return latest.ratings_daily(self.raw_ratings, self.dim, window)

    def weekly_activity(self) -> DataFrame:
        return rollup.weekly_activity(self.daily_activity())

    def weekly_viewers(self) -> DataFrame:
        return rollup.weekly_viewers(self.daily_viewers())

    def ratings_weekly(self) -> DataFrame:
        return latest.ratings_weekly(self.ratings_daily())

    def monthly_activity(self) -> DataFrame:
        return rollup.monthly_activity(self.weekly_activity())

    def monthly_viewers(self) -> DataFrame:
        return rollup.monthly_viewers(self.weekly_viewers())

    def ratings_monthly(self) -> DataFrame:
        return latest.ratings_monthly(self.ratings_weekly())

    # -- discovery inputs ------------------------------------------------
    @property
    def catalogue(self) -> DataFrame:
        price = F.col("o_totalprice")
        return self.table("orders").select(
            F.col("o_orderkey").alias("id"),
            F.when(F.col("o_orderpriority") != "5-LOW", _cat("Order ", F.col("o_orderkey"))).alias("name"),
            F.col("o_orderdate").alias("first_release_date"),
            (price / 5000).alias("rating"),
            F.when(F.col("o_orderstatus") != "P", price / 6000).alias("critic_rating"),
            F.floor(price / 2000).cast("int").alias("rating_count"),
        )

    @property
    def external_ids(self) -> DataFrame:
        line = F.col("l_linenumber")
        source = (
            F.when(line == 1, 1).when(line == 2, 14).when(line == 3, 10).when(line == 4, 26)
            .when(line == 5, 5).when(line == 6, 99)
        )
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("canonical_id"),
            source.alias("source"),
            F.when(F.col("l_quantity") == 1, "").otherwise(F.col("l_partkey").cast("string")).alias("uid"),
            F.col("l_suppkey").alias("position"),
        )

    @property
    def feed(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.table("part").select(
            F.when(F.col("p_brand") == "Brand#3", _cat("bad-", key)).otherwise(key.cast("string")).alias("key"),
            F.when(F.col("p_type") != "LARGE", F.col("p_name")).alias("title"),
            F.when(F.col("p_type") != "PROMO", F.col("p_size") * 100).alias("ccu"),
            key.alias("feed_rank"),
        )

    @property
    def live_feed(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").cast("string").alias("channel_id"),
            F.col("p_name").alias("title"),
            F.col("p_partkey").alias("feed_rank"),
        )

    @property
    def featured_pages(self) -> DataFrame:
        key, name = F.col("p_partkey"), F.col("p_name")

        def item(identifier: Column, label: Column) -> Column:
            return F.struct(identifier.cast("string").alias("id"), label.alias("name"))

        return self.table("part").select(
            key.alias("page"),
            F.array(item(key, name), item(_cat("x", key), name)).alias("featured_win"),
            F.array(item(F.col("p_size"), F.col("p_brand"))).alias("featured_mac"),
            F.array(item(key + 5, F.lit(None).cast("string"))).alias("featured_linux"),
            F.array(item(key + 100, F.col("p_type"))).alias("large_capsules"),
        )

    @property
    def player_counts(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("app_id"),
            F.col("p_name").alias("title"),
            (F.round(F.col("p_retailprice") * 100) + F.col("p_size")).cast("bigint").alias("player_count"),
        )

    @property
    def incoming(self) -> DataFrame:
        """Discovered entities with repeats; about half are on the work list."""
        key = F.col("p_partkey")
        return self.table("part").select(
            (F.floor(key * 9 / 10) + 100000).cast("bigint").alias("canonical_id"),
            F.col("p_name").alias("title"),
            key.alias("feed_rank"),
        )

    # -- live streams ----------------------------------------------------
    @property
    def streams(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_suppkey").cast("string").alias("channel_id"),
            _cat("u", F.col("l_orderkey"), "-", F.col("l_linenumber")).alias("user_name"),
            F.round("l_extendedprice").cast("bigint").alias("viewer_count"),
            _cat(F.col("l_returnflag"), F.col("l_linestatus")).alias("stream_title"),
        )

    @property
    def requested(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("app_id"),
            F.col("p_name").alias("title"),
            F.col("p_partkey").cast("string").alias("channel_id"),
        )

    # -- landed payloads -------------------------------------------------
    @property
    def store_landed(self) -> DataFrame:
        size, brand, kind, key = (F.col(c) for c in ("p_size", "p_brand", "p_type", "p_partkey"))
        cents = F.round(F.col("p_retailprice") * 100).cast("bigint")
        data = F.struct(
            F.lit("game").alias("type"),
            F.col("p_name").alias("name"),
            F.when(kind != "PROMO", _cat(kind, " ", brand)).alias("short_description"),
            F.when(size >= 5, F.array(brand)).alias("developers"),
            F.array(kind, brand).alias("publishers"),
            F.when(kind != "MEDIUM", kind == "ECONOMY").alias("is_free"),
            F.when(size > 40, 18).alias("required_age"),
            F.struct(F.lit(False).alias("coming_soon"), _cat("2001-", size).alias("date")).alias("release_date"),
            F.create_map(
                F.lit("windows"), F.lit(True), F.lit("mac"), size > 25, F.lit("linux"), kind == "SMALL"
            ).alias("platforms"),
            F.when(size >= 20, F.struct((size + 50).alias("score"), _cat("https://m/", key).alias("url"))).alias(
                "metacritic"
            ),
            F.array(
                F.struct(F.lit(1).alias("id"), kind.alias("description")),
                F.struct(F.lit(2).alias("id"), F.lit(None).cast("string").alias("description")),
            ).alias("categories"),
            F.when(size > 2, F.array(F.struct(F.lit("1").alias("id"), brand.alias("description")))).alias("genres"),
            F.when(
                brand != "Brand#1",
                F.struct(
                    F.lit("EUR").alias("currency"), cents.alias("initial"),
                    (cents - size * 10).alias("final"), size.alias("discount_percent"),
                ),
            ).alias("price_overview"),
        )
        entry = F.create_map(
            key.cast("string"), F.struct((size != 13).alias("success"), data.alias("data"))
        )
        return self.table("part").select(key.alias("app_id"), F.to_json(entry).alias("payload"))

    @property
    def tags(self) -> DataFrame:
        size, brand, kind = F.col("p_size"), F.col("p_brand"), F.col("p_type")
        tags = F.create_map(
            kind, size.cast("bigint"), brand, (size + 1).cast("bigint"), F.lit("Co-op"), F.lit(20).cast("bigint"),
            F.lit("Shooter"), F.lit(20).cast("bigint"), F.lit("War"), F.lit(35).cast("bigint"),
            F.lit("PvP"), (50 - size).cast("bigint"),
        )
        return self.table("part").where(kind != "LARGE").select(F.col("p_partkey").alias("app_id"), tags.alias("tags"))

    @property
    def catalogue_landed(self) -> DataFrame:
        size, brand, kind, key = (F.col(c) for c in ("p_size", "p_brand", "p_type", "p_partkey"))

        def company(label: Column, dev: Column, pub: Column) -> Column:
            return F.struct(
                F.struct(label.alias("name")).alias("company"), dev.alias("developer"), pub.alias("publisher")
            )

        def site(url: Column, category: Column) -> Column:
            return F.struct(url.alias("url"), category.cast("int").alias("category"))

        body = F.struct(
            key.alias("id"),
            F.col("p_name").alias("name"),
            F.lower(F.replace("p_name", F.lit(" "), F.lit("-"))).alias("slug"),
            F.when(kind != "PROMO", _cat("About ", F.col("p_name"))).alias("summary"),
            F.when(size > 1, F.lit(1000000000) + key * 86400).otherwise(F.lit(0)).cast("bigint").alias(
                "first_release_date"
            ),
            F.when(size > 10, F.struct(_cat("//img/t_thumb/", key, ".jpg").alias("url"))).alias("cover"),
            F.array(F.struct(kind.alias("name"))).alias("genres"),
            F.when(size > 5, F.array(F.struct(brand.alias("name")), F.struct(F.lit("Shared").alias("name")))).alias(
                "themes"
            ),
            F.array(F.struct(F.lit("PC").alias("name"))).alias("platforms"),
            F.array(
                company(brand, size > 25, size <= 30), company(kind, F.lit(None).cast("boolean"), F.lit(True))
            ).alias("involved_companies"),
            F.array(
                site(_cat("https://a/", key), F.lit(1)),
                site(_cat("https://b/", key), F.lit(99)),
                site(F.lit(""), F.lit(13)),
                site(_cat("https://c/", key), F.when(size > 25, 1).otherwise(9)),
                site(_cat("https://d/", key), F.lit(None)),
            ).alias("websites"),
        )
        return self.table("part").select(F.to_json(body).alias("payload"))

    @property
    def ratings_landed(self) -> DataFrame:
        body = F.struct(
            (F.col("user_id") + 100000).alias("id"),
            F.col("value").alias("rating"),
            F.when(F.col("k") > 50, F.col("k").cast("double")).alias("aggregated_rating"),
            F.col("k").alias("total_rating_count"),
        )
        return self.events("signup").select("ts", F.to_json(body).alias("payload"))

    @property
    def store_kpis(self) -> DataFrame:
        return payload.store_kpis(self.store_landed)


def activity_of(events: DataFrame) -> DataFrame:
    k = F.col("k")
    return events.select(
        "ts",
        F.col("user_id").alias("app_id"),
        _cat("Game ", F.col("user_id")).alias("title"),
        F.round(F.col("value") * 100).cast("bigint").alias("player_count"),
        F.when(k % 3 != 0, k).alias("score"),
        F.when(k % 2 != 0, k * 100).alias("price_cents"),
        (k % 2 == 0).alias("is_free"),
    )
