"""Mixing sources to target weights by exponential-key sampling.

Every source gets a share of all tokens by its weight. Whole epochs come first;
the rest of a source's budget goes to the documents with the largest keys
``u ** (1 / quality)``, ``u`` uniform by document id: sorted within the source and
summed up to the budget, the last one in part.

No source is sorted in one task. Keys lie between 0 and 1, so sizes are summed
per source and 65,536th of that range, which is at most 65,536 sums a source; the
running sum over them tells the cell in which the budget ends, and only that
cell's documents are put in exact order.

Defined cases: NULL text has size 0 and is never taken; NULL source is a source of
its own, last in order; NULL, NaN or non-positive quality counts as the smallest
weight; equal ids draw equal keys, ties go by id, then size; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import word_count
from tidemark.operators.ordering import global_position
from tidemark.session import stage

CELLS = 65_536
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
_LEAST_QUALITY = 1e-3


def uniform(identity: Column, seed: int = 0) -> Column:
    """A number in (0, 1) that depends on the identity and the seed alone."""
    text = F.concat(F.coalesce(identity.cast("string"), F.lit("")), F.lit(f":{seed}"))
    figure = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")
    return (figure + 0.5) / F.lit(float(1 << 52))


def text_quality(text: Column) -> Column:
    """Weight of a document: 1 plus the share of its characters that are letters, digits or spaces."""
    plain = F.char_length(text) - F.char_length(F.regexp_replace(text, r"[\p{L}\p{N}\x20]+", ""))
    return F.coalesce(1 + plain / F.greatest(F.char_length(text), F.lit(1)), F.lit(1.0))


def water_fill(sources: DataFrame, max_epochs: int) -> DataFrame:
    """Adds ``target``: shares by ``weight``, none above ``max_epochs`` times its size.

    ``sources`` is stored and has one row per source; each round sums it once
    and brings two numbers to the driver.
    """
    cap = F.col("source_size") * max_epochs
    total, weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level = (total or 0) / weights if weights else 0.0
    while True:
        capped = cap < F.col("weight") * level
        fixed, free = sources.agg(
            F.sum(F.when(capped, cap)), F.sum(F.when(~capped, F.col("weight")))
        ).first()
        if not free:
            break
        raised = (total - (fixed or 0)) / free
        if raised <= level:
            break
        level = raised
    share = (F.col("weight") * F.lit(float(level))).cast("double")
    return sources.withColumn("target", F.round(F.least(share, cap.cast("double")), 6))


def plan(sized: DataFrame, weights: Sequence[float], max_epochs: int) -> DataFrame:
    """One row per source: ``source_key, source_size, weight, target, epochs, rest``."""
    sources = sized.groupBy("source_key", "source").agg(F.sum("size").alias("source_size"))
    placed, _ = stage(global_position(sources, [F.col("source").asc_nulls_last()]), "mix-sources")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = placed.withColumn(
        "weight", F.get(cycle, ((F.col("position") - 1) % len(weights)).cast("int"))
    )
    filled = water_fill(weighed, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    return filled.withColumn("epochs", epochs.cast("bigint")).withColumn(
        "rest", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("bigint")
    )


def mix(
    docs: DataFrame,
    size: Column,
    id_col: str = "doc_id",
    source_col: str = "source",
    quality: Column | None = None,
    weights: Sequence[float] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = 0,
    carry: Column | None = None,
) -> DataFrame:
    """``doc_id, size, source_size, target, taken, epochs, part, carried`` per document.

    ``taken`` counts whole epochs and the fractional selection ``part``; ``carry``
    is handed through as ``carried``.
    """
    quality = F.lit(1.0) if quality is None else quality
    sane = F.when(quality > _LEAST_QUALITY, F.when(~F.isnan(quality), quality)).otherwise(F.lit(None))
    source = F.col(source_col).cast("string")
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        source.alias("source"),
        F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source)).alias("source_key"),
        size.cast("bigint").alias("size"),
        F.pow(uniform(F.col(id_col), seed), 1 / F.coalesce(sane, F.lit(_LEAST_QUALITY))).alias("draw"),
        (F.lit(None).cast("string") if carry is None else carry).alias("carried"),
    ).withColumn("cell", F.least(F.floor(F.col("draw") * CELLS), F.lit(CELLS - 1)).cast("int"))
    sized, _ = stage(narrow, "mix-sizes")  # texts are read once; what follows is a few numbers a row
    sources, _ = stage(plan(sized, weights, max_epochs).drop("source", "position"), "mix-plan")

    above = F.sum("cell_size").over(
        Window.partitionBy("source_key").orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, -1)
    )
    cells = sized.groupBy("source_key", "cell").agg(F.sum("size").alias("cell_size"))
    reached = cells.withColumn("above", F.coalesce(above, F.lit(0))).join(
        sources.select("source_key", "rest"), "source_key"
    )
    cut = (
        reached.where(F.col("above") <= F.col("rest"))
        .groupBy("source_key")
        .agg(F.min_by(F.struct(F.col("cell").alias("cut"), F.col("above").alias("before_cut")), "cell").alias("c"))
        .select("source_key", "c.cut", "c.before_cut")
    )
    known, _ = stage(sources.join(cut, "source_key", "left"), "mix-cuts")
    rows = sized.join(known, "source_key")
    outside = rows.where(F.col("cell") != F.col("cut")).withColumn(
        "part", F.when(F.col("cell") > F.col("cut"), F.col("size")).otherwise(F.lit(0)).cast("bigint")
    )
    order = Window.partitionBy("source_key").orderBy(F.desc("draw"), "doc_id", "size")
    earlier = F.coalesce(
        F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    inside = rows.where(F.col("cell") == F.col("cut")).withColumn(
        "part",
        F.greatest(
            F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before_cut") - earlier)
        ).cast("bigint"),
    )
    return outside.unionByName(inside).select(
        "doc_id", "size", "source_size", "target",
        (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"),
        "epochs", "part", "carried",
    )


def first_words(text: Column, count: Column) -> Column:
    """The first ``count`` words of a text with the white space before them."""
    pieces = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])", -1)
    return F.array_join(F.slice(pieces, F.lit(1), count.cast("int")), "")


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The mixed documents themselves: one row per whole epoch, and one for the rest.

    Every row of ``docs`` is carried along with its draw, so repeated ids need no join.
    A row whose size is cut holds its first words only.
    """
    names = docs.columns
    mixed = mix(
        docs, word_count(F.col(text_col)), id_col=id_col,
        carry=F.struct(*[F.col(c) for c in names]), **options,
    )
    copies = F.when(F.col("epochs") > 0, F.array_repeat(F.col("size"), F.col("epochs").cast("int"))).otherwise(
        F.array().cast("array<bigint>")
    )
    wanted = F.filter(F.concat(copies, F.array("part")), lambda n: n > 0)
    taken = mixed.select("carried", "size", F.explode(wanted).alias("words"))
    whole = F.col("words") == F.col("size")
    return taken.select(
        *[
            F.when(whole, F.col("carried")[c]).otherwise(first_words(F.col("carried")[c], F.col("words"))).alias(c)
            if c == text_col else F.col("carried")[c].alias(c)
            for c in names
        ]
    )


def report(docs: DataFrame) -> DataFrame:
    """All documents with sizes in words, targets and taken words."""
    return mix(docs, word_count(F.col("text")), quality=text_quality(F.col("text"))).select(
        "doc_id", "size", "source_size", "target", "taken"
    )



SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    coalesce(1 + length(regexp_replace(text, '[^\p{L}\p{N}\x20]', '', 'g')) / greatest(length(text), 1), 1.0) AS quality,
    (CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':0'), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM documents
), drawn AS (
  SELECT *, pow(u, 1 / quality) AS draw FROM sized
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight
  FROM drawn GROUP BY source
), ordered AS (
  SELECT *, 3 * source_size AS cap,
    coalesce(sum(3 * source_size) OVER w, 0) AS cap_before, coalesce(sum(weight) OVER w, 0) AS weight_before,
    sum(source_size) OVER () AS total, sum(weight) OVER () AS weights
  FROM sources WINDOW w AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT arg_min((total - cap_before) / (weights - weight_before), cap / weight) FILTER (
    cap >= weight * ((total - cap_before) / (weights - weight_before))) AS level FROM ordered
), planned AS (
  SELECT source, source_size, round(least(weight * level, CAST(3 * source_size AS DOUBLE)), 6) AS target
  FROM sources, level
), split AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM planned
), placed AS (
  SELECT d.doc_id, d.size, s.source_size, s.target, s.epochs,
    CAST(round(s.target - s.epochs * s.source_size) AS BIGINT) AS rest,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw DESC, d.doc_id, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
  FROM drawn d JOIN split s ON d.source IS NOT DISTINCT FROM s.source
)
SELECT doc_id, size, source_size, target,
  CAST(epochs * size + greatest(0, least(size, rest - earlier)) AS BIGINT) AS taken
FROM placed
"""
