"""Hard negatives by an STR-packed R-tree over whole-number vectors.

Of the rows with another label than an anchor's, the highest scores are wanted that lie in
a window given by the score of one of the anchor's positives.

1. Of equal vectors with one label only the smallest ids can be returned; no others
   enter the tree, so a vector that many rows share costs a few entries.
2. Tiles: sort-tile-recursive cuts by label, then by the coordinates of largest
   variance, at quantiles of a bounded sample; every row gets a tile of about
   ``8 sqrt(n)`` rows. A tile is packed into leaves and pages of leaves, each with its
   minimum bounding box.
3. A box gives an interval of inner products: the sum over coordinates of the lesser
   and the greater product with its two edges. Anchors go, packed in blocks, to the tiles
   whose interval meets their windows.
4. In a tile every window has a best-first queue of boxes by their upper end. Boxes
   outside the window or strictly below the k-th score so far are pruned. The k
   best of each tile are merged per window in Spark.

Positives are found in the same trees: the highest scores of the anchor's own label.

Defined cases: rows with a NULL id, label or vector, or with a NULL or non-finite component,
take no part, nor do vectors with a scaled component of 2^26 or more, whose scores need
not fit a long; of rows of one id, the one of the smallest label, then vector, takes part;
missing components of shorter vectors count 0; ties go to the smaller id; a window of no
rows or an anchor without positives returns nothing; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import remove_path, stage

POSITIVES, NEGATIVES = 5, 10
#: Window of a negative's score, in percent of the positive's.
LOW, HIGH = 30, 90
LARGEST = 1 << 26
#: Rows that the cuts between tiles are learned from; all rows are indexed.
SAMPLE = 1 << 14
LEAF = 128
FANOUT = 8
#: Anchors in one packed block.
BLOCK = 256


def _arrow(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column, shorter ones filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    found = np.zeros((len(column), dims), np.int64)
    rows = np.repeat(np.arange(len(column)), lengths)
    found[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return found


def tiles_of(keys: np.ndarray, parts: int, depth: int = 0) -> tuple | None:
    """Nested cuts ``(coordinate, value, parts to the left, left, right)`` into ``parts`` tiles."""
    if parts <= 1 or len(keys) < 2:
        return None
    for step in range(keys.shape[1]):
        at = (depth + step) % keys.shape[1]
        value = int(np.quantile(keys[:, at], (parts // 2) / parts, method="lower"))
        left = keys[:, at] <= value
        if not left.all():
            break
    else:
        return None
    return (at, value, parts // 2, tiles_of(keys[left], parts // 2, at + 1),
            tiles_of(keys[~left], parts - parts // 2, at + 1))


def tile_of(keys: np.ndarray, cuts: tuple | None, first: int = 0) -> np.ndarray:
    """The tile of every row by the same cuts."""
    found = np.full(len(keys), first, np.int32)
    if cuts is not None and len(keys):
        at, value, parts, lower, upper = cuts
        left = keys[:, at] <= value
        found[left] = tile_of(keys[left], lower, first)
        found[~left] = tile_of(keys[~left], upper, first + parts)
    return found


def leaves_of(keys: np.ndarray, size: int) -> list[np.ndarray]:
    """Sort-tile-recursive packing: the places of each leaf, neighbours side by side."""

    def pack(places: np.ndarray, at: int) -> list[np.ndarray]:
        count = ceil(len(places) / size)
        if count <= 1:
            return [places]
        left = keys.shape[1] - at
        slabs = count if left <= 1 else ceil(count ** (1 / left) - 1e-9)
        places = places[np.argsort(keys[places, at], kind="stable")]
        if left <= 1:
            return [places[i : i + size] for i in range(0, len(places), size)]
        step = ceil(count / slabs) * size
        return [leaf for i in range(0, len(places), step) for leaf in pack(places[i : i + step], at + 1)]

    return pack(np.arange(len(keys)), 0)


class Tree:
    """The packed rows of a tile with the boxes of its leaves and pages."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, starts: np.ndarray):
        self.ids, self.labels, self.starts = ids, labels, starts
        self.ends = np.append(starts[1:], len(ids))
        self.pages = np.arange(0, len(starts), FANOUT)
        self.largest = int(np.abs(vectors).max(initial=0))
        self.vectors = vectors
        self.leaf = self._boxes(vectors, labels, starts)
        self.page = tuple(
            op.reduceat(x, self.pages, axis=0) for op, x in zip((np.minimum, np.maximum) * 2, self.leaf)
        )

    @staticmethod
    def _boxes(vectors: np.ndarray, labels: np.ndarray, starts: np.ndarray) -> tuple:
        return (np.minimum.reduceat(vectors, starts, axis=0), np.maximum.reduceat(vectors, starts, axis=0),
                np.minimum.reduceat(labels, starts), np.maximum.reduceat(labels, starts))

    def exact(self, asked: np.ndarray) -> type:
        """Floats where all sums are exact in them, as they multiply faster; else whole numbers."""
        most = int(np.abs(asked).max(initial=0)) * self.largest * max(1, asked.shape[-1])
        return np.float64 if most < 1 << 53 else np.int64


def intervals(asked: np.ndarray, lo: np.ndarray, hi: np.ndarray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of every vector with every box."""
    up, down = np.maximum(asked, 0).astype(kind), np.minimum(asked, 0).astype(kind)
    lo, hi = lo.astype(kind).T, hi.astype(kind).T
    return up @ lo + down @ hi, up @ hi + down @ lo


class Probe:
    """One anchor in one tree: bounds of all boxes, and scores of the leaves met so far."""

    def __init__(self, tree: Tree, vectors: np.ndarray, asked: np.ndarray, anchor: int, label: int, bounds: tuple):
        self.tree, self.vectors, self.asked, self.anchor, self.label = tree, vectors, asked, anchor, label
        self.page_low, self.page_up, self.leaf_low, self.leaf_up = bounds
        self.scores: dict[int, np.ndarray] = {}

    def _meets(self, box: tuple, at: int, same: bool) -> bool:
        first, last = box[2][at], box[3][at]
        return first <= self.label <= last if same else not first == last == self.label

    def best(self, k: int, same: bool, low: int | None = None, high: int | None = None) -> list[tuple[int, int]]:
        """``(score, id)`` of the k first rows of the same or of another label within the window."""
        tree = self.tree
        low = -(1 << 62) if low is None else low
        high = 1 << 62 if high is None else high
        queue = [
            (-self.page_up[p], 0, p) for p in np.flatnonzero((self.page_up >= low) & (self.page_low <= high)).tolist()
            if self._meets(tree.page, p, same)
        ]
        heapq.heapify(queue)
        scores, ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        kth = low
        while queue:
            bound, leaf, at = heapq.heappop(queue)
            if -bound < kth:
                break
            if not leaf:
                for i in range(at * FANOUT, min(len(tree.starts), (at + 1) * FANOUT)):
                    if self.leaf_up[i] >= kth and self.leaf_low[i] <= high and self._meets(tree.leaf, i, same):
                        heapq.heappush(queue, (-self.leaf_up[i], 1, i))
                continue
            rows = slice(tree.starts[at], tree.ends[at])
            found = self.scores.get(at)
            if found is None:
                found = self.scores[at] = (self.vectors[rows] @ self.asked).astype(np.int64)
            fits = (found >= kth) & (found <= high)
            fits &= ((tree.labels[rows] == self.label) & (tree.ids[rows] != self.anchor)) if same else tree.labels[rows] != self.label
            if fits.any():
                scores, ids = np.append(scores, found[fits]), np.append(ids, tree.ids[rows][fits])
                order = np.lexsort((ids, -scores))[:k]
                scores, ids = scores[order], ids[order]
                if len(scores) == k:
                    kth = int(scores[-1])
        return list(zip(scores.tolist(), ids.tolist()))


def _keys(labels: np.ndarray, vectors: np.ndarray, order: list[int]) -> np.ndarray:
    return np.column_stack((labels, vectors[:, order]))


def build(entries: DataFrame, rows: int, dims: int) -> tuple[DataFrame, str, list[dict]]:
    """Stored pages of all tiles ``(tile, page, ids, labels, vectors, starts)``, and the box of every tile."""
    tiles = max(1, round(sqrt(rows) / 8))
    sample = entries.orderBy(F.xxhash64("id", "label"), "id").limit(SAMPLE).toArrow()
    labels, vectors = sample["label"].to_numpy(), matrix(sample["vector"], dims)
    order = np.argsort(-vectors.astype(np.float64).var(axis=0), kind="stable").tolist() if len(vectors) else []
    cuts = tiles_of(_keys(labels, vectors, order), tiles)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            tile = tile_of(_keys(table["label"].to_numpy(), matrix(table["vector"], dims), order), cuts)
            yield batch.append_column("tile", pa.array(tile, pa.int32()))

    page_schema = pa.schema([("tile", pa.int32()), ("page", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()),
                             ("vectors", pa.binary()), ("starts", pa.binary()), ("box", pa.binary())])

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        labels, vectors = table["label"].to_numpy(), matrix(table["vector"], dims)
        ids = table["id"].to_numpy()
        leaves = leaves_of(_keys(labels, vectors, order), LEAF)
        box = np.concatenate((vectors.min(axis=0), vectors.max(axis=0), [labels.min(), labels.max()])).astype("<i8")
        columns: list[list] = [[] for _ in page_schema]
        for page, at in enumerate(range(0, len(leaves), FANOUT)):
            part = leaves[at : at + FANOUT]
            places = np.concatenate(part)
            starts = np.cumsum([0, *map(len, part[:-1])])
            for column, value in zip(columns, (
                key[0].as_py(), page, ids[places].astype("<i8").tobytes(), labels[places].astype("<i8").tobytes(),
                vectors[places].astype("<i4").tobytes(), starts.astype("<i8").tobytes(), None if page else box.tobytes(),
            )):
                column.append(value)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, page_schema)], schema=page_schema)

    dealt = entries.mapInArrow(deal, "id long, label long, vector array<int>, tile int")
    pages, path = stage(dealt.groupBy("tile").applyInArrow(
        pack, "tile int, page int, ids binary, labels binary, vectors binary, starts binary, box binary"
    ), "hard-negative-pages")
    # One row per tile, at most sqrt(n) / 8 of them.
    boxes = [
        {"tile": tile, "box": np.frombuffer(box, "<i8")}
        for tile, box in pages.where(F.col("page") == 0).select("tile", "box").collect()
    ]
    return pages.drop("box"), path, boxes


def search(pages: DataFrame, boxes: list[dict], probes: DataFrame, dims: int, k: int, same: bool) -> DataFrame:
    """``anchor, positive, positive_score, score, id``: the k best of every tile per window.

    ``probes (id, label, vector, windows)`` with windows ``(positive, score, low, high)``;
    without windows the same label is searched, and ``positive`` is NULL.
    """
    schema = pa.schema([("tile", pa.int32()), ("page", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()),
                        ("vectors", pa.binary()), ("starts", pa.binary()), ("windows", pa.binary())])
    tile = np.array([b["tile"] for b in boxes], np.int32)
    edges = np.stack([b["box"] for b in boxes])
    low, high, first, last = edges[:, :dims], edges[:, dims : 2 * dims], edges[:, -2], edges[:, -1]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of anchors for each tile whose box meets one of their windows."""
        for whole in batches:
            for batch in (whole.slice(at, BLOCK) for at in range(0, whole.num_rows, BLOCK)):
                ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                asked = matrix(batch.column(2), dims)
                windows = batch.column(3).to_pylist()
                most = int(np.abs(asked).max(initial=0)) * int(np.abs(edges[:, :-2]).max(initial=0)) * max(1, dims)
                under, over = intervals(asked, low, high, np.float64 if most < 1 << 53 else np.int64)
                if same:
                    meets = (first <= labels[:, None]) & (labels[:, None] <= last)
                else:
                    meets = np.zeros(under.shape, bool)
                    for q, some in enumerate(windows):
                        for w in some:
                            meets[q] |= (over[q] >= w["low"]) & (under[q] <= w["high"])
                    meets &= ~((first == last) & (labels[:, None] == first))
                for t in np.flatnonzero(meets.any(axis=0)):
                    at = np.flatnonzero(meets[:, t])
                    some = [(i, w["positive"], w["score"], w["low"], w["high"]) for i, q in enumerate(at) for w in windows[q] or ()]
                    yield _arrow([
                        [int(tile[t])], [None], [ids[at].astype("<i8").tobytes()], [labels[at].astype("<i8").tobytes()],
                        [asked[at].astype("<i4").tobytes()], [None], [np.array(some, "<i8").tobytes()],
                    ], schema)

    found_schema = pa.schema([(c, pa.int64()) for c in ("anchor", "positive", "positive_score", "score", "id")])

    def grow(parts: list[dict]) -> Tree:
        starts, at = [], 0
        for p in parts:
            starts.append(np.frombuffer(p["starts"], "<i8") + at)
            at += len(p["ids"]) // 8
        joined = {c: np.concatenate([np.frombuffer(p[c], d) for p in parts])
                  for c, d in (("ids", "<i8"), ("labels", "<i8"), ("vectors", "<i4"))}
        vectors = joined["vectors"].reshape(at, dims)
        return Tree(joined["ids"], joined["labels"], vectors, np.concatenate(starts))

    def answer(tree: Tree, cast: dict, block: dict) -> Iterator[tuple]:
        ids, labels = np.frombuffer(block["ids"], "<i8"), np.frombuffer(block["labels"], "<i8")
        asked = np.frombuffer(block["vectors"], "<i4").reshape(len(ids), dims).astype(np.int64)
        windows: dict[int, list] = {}
        for i, *window in np.frombuffer(block["windows"], "<i8").reshape(-1, 5).tolist():
            windows.setdefault(i, []).append(window)
        kind = tree.exact(asked)
        if kind not in cast:
            cast[kind] = tree.vectors.astype(kind)
        vectors = cast[kind]
        bounds = [b for box in (tree.page, tree.leaf) for b in intervals(asked, box[0], box[1], kind)]
        for i, (anchor, label) in enumerate(zip(ids.tolist(), labels.tolist())):
            probe = Probe(tree, vectors, asked[i].astype(kind), anchor, label, [b[i] for b in bounds])
            if same:
                yield from ((anchor, None, None, score, found) for score, found in probe.best(k, True))
            known: dict[tuple, list] = {}
            for positive, score_, low_, high_ in windows.get(i, ()):
                if (low_, high_) not in known:
                    known[low_, high_] = probe.best(k, False, low_, high_)
                yield from ((anchor, positive, score_, score, found) for score, found in known[low_, high_])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, tree, cast = None, [], None, {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["tile"] != at:
                    at, parts, tree, cast = row["tile"], [], None, {}
                if row["page"] is not None:
                    parts.append(row)
                    continue
                if tree is None:
                    tree, parts = grow(parts), []
                rows = list(answer(tree, cast, row))
                if rows:
                    yield _arrow(list(zip(*rows)), found_schema)

    kind = "tile int, page int, ids binary, labels binary, vectors binary, starts binary, windows binary"
    stored = pages.withColumn("windows", F.lit(None).cast("binary"))
    met = stored.unionByName(probes.select("id", "label", "vector", "windows").mapInArrow(route, kind))
    # A tile's pages come first; its blocks of anchors then stream past the tree.
    sorted_ = met.repartition("tile").sortWithinPartitions("tile", F.col("page").asc_nulls_last())
    return sorted_.mapInArrow(run, "anchor long, positive long, positive_score long, score long, id long")


def _hundredth(value: Column) -> Column:
    """A hundredth of a whole number, rounded down, without floats."""
    hundred = F.lit(100).cast("bigint")
    return F.call_function("div", value - F.pmod(value, hundred), hundred)


def whole_vectors(embedding: Column) -> Column:
    """``floor(256 x)`` of every component; NULL where one is NULL, not finite or too large."""
    scaled = F.transform(embedding, lambda x: F.floor(x.cast("double") * 256))
    fine = F.forall(embedding, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double") * 256) < LARGEST), F.lit(False)))
    return F.when(fine, scaled.cast("array<int>"))


def mine(
    items: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``items (id, label, vector)`` hold whole-number vectors; ``anchor`` is a condition on them.
    """
    spark = items.sparkSession
    fine = items.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull())
    rows, rows_path = stage(
        fine.select(F.col("id").cast("bigint").alias("id"), F.struct(F.col("label").cast("bigint").alias("label"), F.col("vector").cast("array<int>").alias("vector")).alias("row"))
        .groupBy("id").agg(F.min("row").alias("row")).select("id", "row.label", "row.vector"),
        "hard-negative-rows",
    )
    nth = Window.partitionBy("label", "vector").orderBy("id")
    entries, entries_path = stage(
        rows.withColumn("n", F.row_number().over(nth)).where(F.col("n") <= max(positives + 1, negatives)).drop("n"),
        "hard-negative-entries",
    )
    count, dims = entries.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not count:
        remove_path(spark, rows_path)
        remove_path(spark, entries_path)
        return spark.createDataFrame([], result)
    pages, _, boxes = build(entries, count, dims)
    window = "array<struct<positive:bigint,score:bigint,low:bigint,high:bigint>>"
    asked = rows.where(anchor).withColumn("windows", F.array().cast(window))
    ahead = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    own = search(pages, boxes, asked, dims, positives, True).withColumn("n", F.row_number().over(ahead)).where(F.col("n") <= positives)
    score = F.col("score")
    windows = own.groupBy(F.col("anchor").alias("id")).agg(F.collect_list(F.struct(
        F.col("id").alias("positive"), score.alias("score"),
        (-_hundredth(-score * low)).alias("low"), _hundredth(score * high).alias("high"),
    )).cast(window).alias("windows"))  # at most ``positives``
    probes, _ = stage(asked.drop("windows").join(windows, "id"), "hard-negative-probes")
    remove_path(spark, rows_path)
    remove_path(spark, entries_path)
    ahead = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "id")
    found = search(pages, boxes, probes, dims, negatives, False).withColumn("rank", F.row_number().over(ahead))
    return found.where(F.col("rank") <= negatives).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank",
        F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )


def report(embeddings: DataFrame) -> DataFrame:
    """Ten hard negatives per positive of every vector whose id is divisible by 100."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    items = embeddings.select(F.col("vec_id").alias("id"), label.alias("label"), whole_vectors(F.col("embedding")).alias("vector"))
    return mine(items, F.col("id") % 100 == 0)


SQL = """
WITH items AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.id AS anchor, b.id AS other, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM items a JOIN items b ON a.id % 100 = 0 AND a.id <> b.id
), positives AS (
  SELECT anchor, other AS positive, score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5
)
SELECT p.anchor AS anchor_id, p.positive AS positive_id,
       (row_number() OVER (PARTITION BY p.anchor, p.positive ORDER BY s.score DESC, s.other))::INTEGER AS rank,
       s.other AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor = p.anchor AND NOT s.same
  AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY rank <= 10
"""
