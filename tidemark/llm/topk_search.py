"""Exact top-k search by incremental multi-index hashing of binary codes.

A 64-bit code is cut into segments of about log2(number of codes) bits. A code within
distance ``m (r + 1) - 1`` of a query lies within ``r`` of it in one of the ``m`` segments,
so the search radius of the segments grows by one each round until the k-th
verified distance is covered. A candidate is taken only from its nearest segment,
so it arrives once; from the second round on, candidates beyond the query's k-th
distance so far are left out in the join itself.

The index holds distinct codes: equal vectors are one code with the ``k + 1`` smallest
ids, and equal queries are searched once.

Defined cases: a NULL or empty vector has no code, is not found and finds nothing;
NULL and NaN elements count as not positive; element ``i`` beyond the 64th is added
to bit ``i mod 64`` by exclusive or; NULL ids are left out; repeated rows of one id
count once; ties go to the smaller id; a row does not find itself; fewer than k
other rows give fewer results; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations
from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stage

BITS = 64
K = 10


def sign_code(vector: Column) -> Column:
    """The signs of a vector as a 64-bit number."""
    def fold(code: Column, item: Column) -> Column:
        return F.when(
            item["v"] > 0, code.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), item["i"]))
        ).otherwise(code)

    marked = F.transform(
        vector,
        lambda v, i: F.struct(
            F.when(~F.isnan(v), v).otherwise(F.lit(0.0)).alias("v"), (i % BITS).cast("int").alias("i")
        ),
    )
    return F.when(F.size(vector) > 0, F.aggregate(marked, F.lit(0).cast("bigint"), fold))


def segments(codes: int) -> list[tuple[int, int]]:
    """First bit and width of the segments for so many distinct codes."""
    width = min(BITS, max(4, round(log2(max(2, codes)))))
    count = ceil(BITS / width)
    edges = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _segment(code: Column, start: int, width: int) -> Column:
    cut = F.shiftrightunsigned(code, start)
    return cut if width == BITS else cut.bitwiseAND(F.lit((1 << width) - 1))


def _masks(width: int, radius: int) -> list[int]:
    return [sum(1 << b for b in bits) for bits in combinations(range(width), radius)]


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _from_nearest(query: Column, code: Column, parts: list, at: Column, radius: int) -> Column:
    """True in the first segment that is nearest; all nearer ones were searched before."""
    apart = [_distance(_segment(query, *p), _segment(code, *p)) for p in parts]
    nearer = F.lit(False)
    for i, d in enumerate(apart):
        nearer = nearer | (d < radius) | ((d == radius) & (F.lit(i) < at))
    return ~nearer


def search(items: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """``query_id, neighbours`` of ``id, code`` tables; neighbours are ``distance, id`` in order."""
    spark = items.sparkSession
    nth = Window.partitionBy("code").orderBy("id")
    known = items.where(F.col("id").isNotNull() & F.col("code").isNotNull()).distinct()
    index, _ = stage(
        known.withColumn("n", F.row_number().over(nth)).where(F.col("n") <= k + 1)
        .groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")),  # at most k + 1
        "codes",
    )
    codes = index.count()
    parts = segments(codes)
    asked = queries.where(F.col("id").isNotNull() & F.col("code").isNotNull()).distinct()
    best = "array<struct<distance:int,id:bigint>>"
    state, _ = stage(
        asked.select(F.col("code").alias("query")).distinct().select(
            "query", F.array().cast(best).alias("found"), F.lit(BITS).alias("limit"), F.lit(False).alias("done")
        ),
        "search",
    )
    spread = index.select("code", F.explode(F.array(*[
        F.struct(F.lit(i).alias("at"), _segment(F.col("code"), *p).alias("value")) for i, p in enumerate(parts)
    ])).alias("s")).select("code", "s.at", "s.value")
    table, _ = stage(spread, "segments")
    for radius in range(max(w for _, w in parts) + 1):
        # Broadcast: the bit patterns of one radius, at most 2 to the segment's width.
        flips = F.broadcast(spark.createDataFrame(
            [(i, m) for i, (_, width) in enumerate(parts) for m in _masks(width, radius)], "at int, flip long"
        ))
        cut = F.explode(F.array(*[
            F.struct(F.lit(i).alias("at"), _segment(F.col("query"), *p).alias("value")) for i, p in enumerate(parts)
        ]))
        probes = (
            state.where(~F.col("done")).select("query", "limit", cut.alias("s"))
            .select("query", "limit", "s.at", "s.value").join(flips, "at")
            .select("query", "limit", "at", F.col("value").bitwiseXOR(F.col("flip")).alias("value"))
        )
        met = probes.alias("p").join(
            table.alias("t"),
            (F.col("p.at") == F.col("t.at")) & (F.col("p.value") == F.col("t.value"))
            & (_distance(F.col("query"), F.col("code")) <= F.col("limit"))
            & _from_nearest(F.col("query"), F.col("code"), parts, F.col("p.at"), radius),
        ).select("query", "code", _distance(F.col("query"), F.col("code")).cast("int").alias("distance"))
        new = met.join(index, "code").select("query", "distance", F.explode("ids").alias("id"))
        old = state.select("query", F.explode("found").alias("f")).select("query", "f.distance", "f.id")
        ahead = Window.partitionBy("query").orderBy("distance", "id")
        top = (
            old.unionByName(new).withColumn("n", F.row_number().over(ahead)).where(F.col("n") <= k + 1)
            .groupBy("query").agg(F.sort_array(F.collect_list(F.struct("distance", "id"))).alias("top"))
        )
        covered = len(parts) * (radius + 1) - 1
        full = F.size("found") > k
        merged = state.drop("found", "limit", "done").join(top, "query", "left").select(
            "query", F.coalesce("top", F.array().cast(best)).alias("found")
        ).select(
            "*",
            F.when(full, F.element_at("found", -1)["distance"]).otherwise(F.lit(BITS)).alias("limit"),
        ).withColumn("done", full & (F.col("limit") <= covered))
        state, _ = stage(merged, "search")
        if state.where(~F.col("done")).isEmpty():
            break
    others = F.slice(F.filter("found", lambda f: f["id"] != F.col("query_id")), 1, k)
    return (
        asked.select(F.col("id").alias("query_id"), F.col("code").alias("query"))
        .join(state, "query")
        .select("query_id", others.alias("neighbours"))
    )


def report(embeddings: DataFrame) -> DataFrame:
    """The ten nearest of every vector whose id is divisible by 100, one row per neighbour."""
    items = embeddings.select(F.col("vec_id").cast("bigint").alias("id"), sign_code(F.col("embedding")).alias("code"))
    found = search(items, items.where(F.col("id") % 100 == 0))
    return found.select("query_id", F.posexplode("neighbours").alias("at", "n")).select(
        "query_id", (F.col("at") + 1).cast("bigint").alias("position"),
        F.col("n.id").alias("neighbour_id"), F.col("n.distance").cast("bigint").alias("distance"),
    )


SQL = """
WITH codes AS (
  SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS bits FROM embeddings
), apart AS (
  SELECT q.vec_id AS query_id, c.vec_id AS neighbour_id,
         CAST(list_sum(list_transform(range(1, 65), lambda i: CASE WHEN q.bits[i] <> c.bits[i] THEN 1 ELSE 0 END)) AS BIGINT) AS distance
  FROM codes q JOIN codes c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS position FROM apart
)
SELECT query_id, position, neighbour_id, distance FROM ranked WHERE position <= 10
"""
