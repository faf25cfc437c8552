"""Source divergence audit: how the words of a source differ from its language and its other sources.

Counts become integer shares ``p = 1 + floor(10^9 (count + 1) / (N + V))`` of the ``V`` terms a
language keeps; two shares differ by ``f = floor((p - q)^2 / q)``.

1. Map tasks count terms per language and source in dictionaries of bounded size;
   their shuffled sums are the exact counts and tell the terms that a language keeps.
   Both come from one shuffle by language and term.
2. Leading terms: ``f`` grows with a group's count and falls with the language's, and ties
   go to the earlier term. So a term with ``k`` others of a count at least as high, a language count
   at most as high and an earlier name cannot be among the first ``k``. Every part of a group
   keeps the skyband of its terms (those that fewer than ``k`` others dominate), skybands
   are merged per group batch by batch, and what is left is ranked exactly.
3. Pairs of sources: terms are dealt into blocks; a block's shares are a matrix of terms and
   sources, whose sums of ``f`` per pair are added up. No pair is made per term.
   Sources beyond ``TILE`` are taken in tiles, a block per pair of tiles; terms
   that neither tile has count by the shares of a zero count.

Defined cases: NULL text, language and source count as ''; a document is a row; a language
without kept terms has pairs of value 0 and no leading terms; a group alone in its
language has no pairs; an empty table gives an empty result; extra columns are ignored.
Counts may exceed 2^33: shares are divided as decimals.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stage

#: Bytes of UTF-8: A to Z become a to z, those from 0x80 on stay, all others part terms.
PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
LEAST = 3
TOP = 200
#: Terms that a task counts before it sends them on.
FLUSH = 1 << 19
#: Bytes of a text that are cut into terms at a time.
CHUNK = 1 << 20
#: Sources that one block compares with each other.
TILE = 512
#: Count rows of one block.
BLOCK = 50_000
#: Rows that wait to be merged into a skyband.
WAITING = 1 << 17
#: Count rows of one part of all groups.
PART = 1 << 22

GROUP = ["lang", "source"]


def _arrow(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in pieces, so that a long text is never held as one list."""
    plain, at = text.translate(PLAIN), 0
    while at < len(plain):
        end = plain.find(b" ", at + CHUNK)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def count_terms(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs`` in parts, and one row without a term per group and task."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()),
                        ("n", pa.int64()), ("docs", pa.int64())])

    def sent(group: tuple, seen: Counter, held: Counter) -> Iterator[pa.RecordBatch]:
        names = list(seen)
        for at in range(0, len(names), 50_000):
            part = names[at : at + 50_000]
            size = len(part)
            yield pa.RecordBatch.from_arrays([
                *[pa.repeat(pa.scalar(g, pa.string()), size) for g in group], pa.array(part, pa.binary()),
                pa.array(np.fromiter(map(seen.__getitem__, part), np.int64, size)),
                pa.array(np.fromiter(map(held.__getitem__, part), np.int64, size)),
            ], schema=schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, Counter] = defaultdict(Counter)
        held: dict[tuple, Counter] = defaultdict(Counter)
        groups, size = set(), 0
        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang, source, text in zip(langs, sources, batch.column(2).to_pylist()):
                group = lang, source
                if group not in groups:
                    groups.add(group)
                    yield _arrow([[lang], [source], [None], [0], [0]], schema)
                total, mine = seen[group], set()
                size -= len(total)
                for piece in terms(text):
                    total.update(piece)
                    mine.update(piece)
                held[group].update(mine)
                size += len(total)
                if size >= FLUSH:
                    for g in seen:
                        yield from sent(g, seen[g], held[g])
                    seen.clear()
                    held.clear()
                    size = 0
        for g in seen:
            yield from sent(g, seen[g], held[g])

    texts = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in GROUP],
                        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    return texts.mapInArrow(scan, "lang string, source string, term binary, n long, docs long")


def share(n: Column, total: Column) -> Column:
    """The share of a count among ``total = N + V``, in billionths."""
    scaled = (n + 1).cast("decimal(19,0)") * F.lit(1_000_000_000).cast("decimal(10,0)")
    return F.call_function("div", scaled, total.cast("decimal(20,0)")).cast("bigint") + 1


def differ(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def skyband(term: np.ndarray, high: np.ndarray, low: np.ndarray, k: int) -> np.ndarray:
    """Places of the terms, given by their rank in order, that fewer than ``k`` others dominate.

    One dominates another with a count ``high`` no smaller, a count ``low`` no larger and
    an earlier term. Dominators of a place outside the skyband number ``k`` within it, so
    each chunk of terms, in order, is compared with those kept before it.
    """
    order = np.lexsort((term, low, -high))
    new = np.concatenate(([True], (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])))
    nth = np.arange(len(order)) - np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    order = order[nth < k]  # of equal counts, the k earliest terms
    order = order[np.argsort(term[order], kind="stable")]
    kept = np.zeros(0, np.int64)
    for at in range(0, len(order), 512):
        part = order[at : at + 512]
        before = _dominators(high[kept], low[kept], high[part], low[part]).sum(axis=0)
        within = np.triu(_dominators(high[part], low[part], high[part], low[part]), 1).sum(axis=0)
        kept = np.concatenate((kept, part[before + within < k]))
    return kept


def _dominators(high: np.ndarray, low: np.ndarray, their_high: np.ndarray, their_low: np.ndarray) -> np.ndarray:
    return (high[:, None] >= their_high) & (low[:, None] <= their_low)


def leading(rows: DataFrame, n_rows: int, k: int) -> DataFrame:
    """The merged skybands of ``lang, source, term, n, lang_n`` per group.

    A group is dealt over parts by its terms, so that no task gets a hot group whole.
    """
    kind = "lang string, source string, term binary, n long, lang_n long"
    columns = ["lang", "source", "term", "n", "lang_n"]

    def reduced(table: pa.Table) -> pa.Table:
        rank = np.empty(len(table), np.int64)
        rank[pc.sort_indices(table["term"]).to_numpy()] = np.arange(len(table))
        return table.take(skyband(rank, table["n"].to_numpy(), table["lang_n"].to_numpy(), k))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, waiting, rows = [], [], 0
        for batch in batches:
            waiting.append(pa.Table.from_batches([batch]).select(columns))
            rows += batch.num_rows
            if rows >= WAITING:
                kept, waiting, rows = [reduced(pa.concat_tables(kept + waiting))], [], 0
        yield from (reduced(pa.concat_tables(kept + waiting)) if waiting else kept[0]).to_batches()

    part = F.pmod(F.xxhash64("term"), F.lit(max(1, -(-n_rows // PART)))).cast("int").alias("part")
    parts = rows.select(*columns, part).groupBy(*GROUP, "part").applyInArrow(merge, kind)
    return parts.groupBy(*GROUP).applyInArrow(merge, kind)


def pair_sums(rows: DataFrame, groups: DataFrame, n_rows: int, n_sources: int, tile: int) -> DataFrame:
    """``lang, source, item, value, terms``: sums of ``f`` over the terms of all blocks, and their number.

    ``rows (lang, source, term, p)`` are the shares of counted terms, ``groups (lang, source, p)``
    those of a zero count.
    """
    tiles = -(-n_sources // tile)
    # The blocks follow the count rows alone: each repeats all sources once and returns all their pairs.
    blocks = max(1, -(-n_rows // BLOCK))
    of_tile = F.pmod(F.xxhash64("source"), F.lit(tiles)).cast("int")
    meets = F.explode(F.array(*[
        F.struct(F.least(of_tile, F.lit(i)).alias("a"), F.greatest(of_tile, F.lit(i)).alias("b")) for i in range(tiles)
    ]))
    counted = rows.select("lang", "source", "term", "p", F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int").alias("block"),
                          of_tile.alias("tile"), meets.alias("at"))
    zero = groups.select("lang", "source", F.lit(None).cast("binary").alias("term"), "p",
                         F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), of_tile.alias("tile"), meets.alias("at"))
    dealt = counted.unionByName(zero).select("lang", "block", "at.a", "at.b", "source", "tile", "term", "p")

    def add(key: tuple, table: pa.Table) -> pa.Table:
        lang, _, a, b = (k.as_py() for k in key)
        table = table.combine_chunks()
        base = table.filter(table["term"].is_null())
        names, home = base["source"].to_pylist(), np.array(base["tile"].to_pylist())
        at = {s: i for i, s in enumerate(names)}
        zero = base["p"].to_numpy()
        table = table.filter(table["term"].is_valid())
        place = table["term"].combine_chunks().dictionary_encode()
        count = len(place.dictionary)
        line = place.indices.to_numpy()
        column = np.array([at[s] for s in table["source"].to_pylist()], np.int64)
        value, order = table["p"].to_numpy(), np.argsort(line, kind="stable")
        line, column, value = line[order], column[order], value[order]
        sums = np.zeros((len(names), len(names)), np.int64)
        step = max(1, (1 << 21) // max(1, len(names)))
        for first in range(0, count, step):
            lo, hi = np.searchsorted(line, (first, min(count, first + step)))
            shares = np.tile(zero, (min(count, first + step) - first, 1))
            shares[line[lo:hi] - first, column[lo:hi]] = value[lo:hi]
            for g in range(len(names)):
                gap = shares[:, g, None] - shares
                sums[g] += (gap * gap // shares).sum(axis=0)
        apart = ~np.eye(len(names), dtype=bool) if a == b else home[:, None] != home[None, :]
        left, right = np.nonzero(apart)
        return pa.table({
            "lang": pa.array([lang] * len(left), pa.string()),
            "source": pa.array([names[i] for i in left], pa.string()),
            "item": pa.array([names[i] for i in right], pa.string()),
            "value": pa.array(sums[left, right], pa.int64()),
            "terms": pa.array(np.full(len(left), count), pa.int64()),
        })

    found = dealt.groupBy("lang", "block", "a", "b").applyInArrow(
        add, "lang string, source string, item string, value long, terms long"
    )
    return found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"))


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP, tile: int = TILE) -> DataFrame:
    """``lang, source, part, item, value, rank`` of ``docs (text, lang, source)``."""
    # Map tasks send one row per group and term, so a term of all sources is few rows.
    counts = count_terms(docs).repartition("lang", "term").groupBy(*GROUP, "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )
    same = Window.partitionBy("lang", "term")
    kept = counts.select(
        *GROUP, "term", "n", F.sum("n").over(same).alias("lang_n"), F.sum("docs").over(same).alias("held"),
        (F.min("source").over(same) == F.col("source")).alias("first"),
    ).where(F.col("term").isNull() | (F.col("held") >= least))
    stored, _ = stage(kept.drop("held"), "kept-terms")
    rows = stored.where(F.col("term").isNotNull())
    names = stored.where(F.col("term").isNull()).select(*GROUP)
    totals = rows.groupBy(*GROUP).agg(F.sum("n").alias("total"))
    langs = rows.where("first").groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count(F.lit(1)).alias("v"))
    groups, _ = stage(
        names.join(totals, GROUP, "left").join(langs, "lang", "left").select(
            *GROUP, F.coalesce("v", F.lit(0)).alias("v"),
            (F.coalesce("total", F.lit(0)) + F.coalesce("v", F.lit(0))).alias("total"),
            (F.col("lang_total") + F.col("v")).alias("lang_total"),
        ),
        "term-groups",
    )
    size = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()
    n_rows = rows.count()

    best = leading(rows, n_rows, top).join(groups, GROUP).select(
        *GROUP, F.col("term").cast("string").alias("item"),
        share(F.col("n"), F.col("total")).alias("p"), share(F.col("lang_n"), F.col("lang_total")).alias("q"),
    ).where(F.col("p") > F.col("q")).select(*GROUP, F.lit("term").alias("part"), "item", differ(F.col("p"), F.col("q")).alias("value"))

    live = groups.where(F.col("v") > 0)
    zero = live.select(*GROUP, share(F.lit(0).cast("bigint"), F.col("total")).alias("p"), "v")
    priced = rows.join(live, GROUP).select(*GROUP, "term", share(F.col("n"), F.col("total")).alias("p"))
    summed = pair_sums(priced, zero.drop("v"), n_rows, max(1, size[0] or 1), tile)
    other = zero.select("lang", F.col("source").alias("item"), F.col("p").alias("q")).alias("o")
    rest = differ(F.col("p"), F.col("q")) * (F.col("v") - F.col("terms"))
    counted = summed.join(zero, GROUP).join(other, ["lang", "item"]).select(
        *GROUP, F.lit("pair").alias("part"), "item", (F.col("value") + rest).alias("value")
    )
    # Languages without kept terms: every pair of sources is a row of the result, of value 0.
    dead = groups.where(F.col("v") == 0).select(*GROUP)
    empty = dead.join(dead.select("lang", F.col("source").alias("item")), "lang").where(F.col("source") != F.col("item")).select(
        *GROUP, F.lit("pair").alias("part"), "item", F.lit(0).cast("bigint").alias("value")
    )
    ahead = Window.partitionBy(*GROUP, "part").orderBy(F.desc("value"), "item")
    pairs = counted.unionByName(empty).withColumn("rank", F.row_number().over(ahead))
    firsts = best.withColumn("rank", F.row_number().over(ahead)).where(F.col("rank") <= top)
    return pairs.unionByName(firsts).select(*GROUP, "part", "item", "value", "rank")


def report(documents: DataFrame) -> DataFrame:
    return audit(documents.select("text", "lang", "source"))


SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), words AS (
  SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 3
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL
), langs AS (
  SELECT lang, sum(n)::HUGEINT AS total, count(*) AS v FROM kept GROUP BY lang
), names AS (
  SELECT DISTINCT lang, source FROM docs
), totals AS (
  SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM names LEFT JOIN counts USING (lang, source) GROUP BY ALL
), shares AS (
  SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (t.total + l.v) AS p,
         1 + (1000000000::HUGEINT * (k.n + 1)) // (l.total + l.v) AS q
  FROM totals t JOIN langs l USING (lang) JOIN kept k USING (lang)
  LEFT JOIN counts c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term
), found AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value FROM shares WHERE n > 0 AND p > q
  UNION ALL
  SELECT a.lang, a.source, 'pair', b.source, coalesce(s.value, 0) FROM names a JOIN names b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
  ) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
