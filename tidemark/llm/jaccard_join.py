"""N-gram Jaccard self-join: one row per document with the component of its links.

1. Equal shingle sets are one node, so copies cost one row each and no pair.
2. Shingles are counted over all documents, in packed arrays by hash range. In the
   global order those that occur once come first, then the others, the most
   frequent ones (at most ``HEAVY``, a fixed number) last. Which occur once is told by
   a bit map as large as the number of shingles, up to a fixed size; beyond it more
   of them count as repeated. Any order is right; this one keeps passages that
   many documents share out of the prefixes.
3. Two similar sets share an element of their prefixes. Every node is linked to the
   smallest node of each of its prefix elements: one link per node and element. A link
   stays if sizes and parity maps of its sets leave room for similarity. Where one of an
   element's links does not, the pairs of up to ``PAIRED`` nodes are judged instead, so
   chance meetings join nothing; larger groups keep all links. Components of these links
   contain all similar pairs.
4. A component is split into blocks of bounded size; each block's sets go into a
   prefix tree, and its searches give the true links (one per merger).
5. Components of several blocks: all nodes outside the largest group of links are
   searched in the trees of all blocks, which covers every pair across blocks.

Equality of shingles and of sets is equality of 64-bit hashes.

Defined cases: NULL, empty and blank texts have an empty set and are linked with
nothing; a text of fewer words than ``n`` has one shingle, its whole sequence;
repeated rows (also of one id) are each returned; a row with a NULL id belongs to the
component of an equal set with an id and else to none (NULL); an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.prefix_tree import Groups, PrefixTree, Similar
from tidemark.llm.shared import Scratch, give_back, shuffle_partitions, shuffles_removed, sparing
from tidemark.llm.shingles import shingle_set
from tidemark.session import stage

HEAVY = 1 << 20
#: The bit map of shingles that occur more than once has at most 2 to this power bits (128 MB).
MAP_BITS = 30
#: Bits that an id has in the map of :func:`only_with`.
PROBES = 4
#: Nodes of an element of which all pairs are judged.
PAIRED = 64
#: Cells of a parity map at most.
CELLS = 1 << 16
#: Shingles that one block of a component may hold, unless a single set is larger.
BLOCK = 1 << 18


def set_id(elements: np.ndarray) -> int:
    """A 64-bit name of a sorted set."""
    return int.from_bytes(hashlib.blake2b(elements.tobytes(), digest_size=8).digest(), "little", signed=True)


def _arrow(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1_000) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that a task holds few sets at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def profiles(docs: DataFrame, n: int) -> DataFrame:
    """``doc_id, n_shingles, node`` of ``doc_id, text``."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64())])

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = (shingle_set(t, n) for t in batch.column(1).to_pylist())
            rows = [(len(s), set_id(s)) for s in sets]
            yield _arrow([batch.column(0), [r[0] for r in rows], [r[1] for r in rows]], schema)

    return docs.mapInArrow(sparing(profile), "doc_id long, n_shingles long, node long")


def bit_map(hashes: DataFrame, bits: int) -> np.ndarray:
    """A map of ``1 << bits`` bits, set where a ``hash`` begins with their number.

    Executors pack 65,536 bits at a time; the driver gets the packed map alone.
    """
    inner = min(16, bits)

    def pack(key, table):
        marked = np.zeros(1 << inner, bool)
        marked[table["cell"].to_numpy()] = True
        return pa.table({
            "chunk": pa.array([key[0].as_py()], pa.int32()),
            "packed": pa.array([np.packbits(marked, bitorder="little").tobytes()], pa.binary()),
        })

    cells = hashes.select(F.shiftrightunsigned("hash", 64 - bits).alias("at")).distinct().select(
        F.shiftright("at", inner).cast("int").alias("chunk"), F.col("at").bitwiseAND((1 << inner) - 1).alias("cell")
    )
    packed = np.zeros((1 << bits) // 8, np.uint8)
    width = (1 << inner) // 8
    for row in cells.groupBy("chunk").applyInArrow(pack, "chunk int, packed binary").toArrow().to_pylist():
        packed[row["chunk"] * width : (row["chunk"] + 1) * width] = np.frombuffer(row["packed"], np.uint8)
    return packed


def marked(packed: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the map has the bits of 64-bit hashes."""
    at = hashes >> np.uint64(64 - (8 * len(packed)).bit_length() + 1)
    return (packed[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def only_with(docs: DataFrame, ids: DataFrame, count: int) -> DataFrame:
    """``doc_id, text`` rows whose id may be among ``ids``: few others, none of those missing.

    A bounded bit map is broadcast, so the texts of the other documents are not shuffled.
    An id has ``PROBES`` bits; of 16 or more bits an id, it keeps one in 400 of the others.
    """
    hashed = F.array(*[F.xxhash64("doc_id", F.lit(i)) for i in range(PROBES)])
    bits = min(MAP_BITS, max(10, (16 * count).bit_length()))
    shared = docs.sparkSession.sparkContext.broadcast(bit_map(ids.select(F.explode(hashed).alias("hash")), bits))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = marked(shared.value, batch.column(2).flatten().to_numpy().view(np.uint64))
            yield batch.select(["doc_id", "text"]).filter(pa.array(found.reshape(-1, PROBES).all(axis=1)))

    return docs.select("doc_id", "text", hashed.alias("hashes")).mapInArrow(keep, "doc_id long, text string")


class Frequencies:
    """How often shingles occur: which occur more than once, and how often the most frequent do.

    ``seen`` is a bit map of shingles that occur in two documents. ``fine`` and ``df`` are
    the most frequent shingles by their first ``bits`` bits, sorted, and their numbers of
    documents.
    """

    def __init__(self, bits: int, seen: np.ndarray, fine: np.ndarray, df: np.ndarray):
        self.bits, self.seen, self.fine, self.df = bits, seen, fine, df

    def weights(self, tokens: np.ndarray) -> np.ndarray:
        """0 for shingles that occur once, the number of documents for frequent ones, else 1."""
        weight = marked(self.seen, tokens).astype(np.int64)
        if len(self.fine):
            fine = tokens >> np.uint64(64 - self.bits)
            where = np.minimum(np.searchsorted(self.fine, fine), len(self.fine) - 1)
            weight = np.where(self.fine[where] == fine, self.df[where], weight)
        return weight


def frequencies(docs: DataFrame, n: int, shingles: int, limit: int = HEAVY) -> Frequencies:
    """Counts all shingles of all documents; ``shingles`` is their number.

    Shingles travel as packed arrays, one row per batch and hash range, cut to as
    many bytes as keep nearly all of them apart (16 values for each). Every range
    returns its part of the bit map and at most its part of ``limit``.
    """
    # About a million shingles a range, so that a task's arrays do not grow with the input.
    ranged = max(8, shuffle_partitions(docs.sparkSession).bit_length(), (shingles >> 20).bit_length())
    width = min(6, max(1, -(-((16 * max(1, shingles)).bit_length() - ranged) // 8)))
    bits, low = ranged + 8 * width, 8 * width
    inner = max(3, min(MAP_BITS, max(1, shingles).bit_length()) - ranged)
    ranges = 1 << ranged
    schema = pa.schema([("range", pa.int32()), ("packed", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingle_set(t, n) for t in batch.column(1).to_pylist()]
            fine = np.sort(np.concatenate(sets or [np.zeros(0, np.uint64)]) >> np.uint64(64 - bits))
            cuts = np.searchsorted(fine >> np.uint64(low), np.arange(ranges + 1, dtype=np.uint64))
            packed = fine.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
            full = np.flatnonzero(cuts[1:] > cuts[:-1])
            yield _arrow([full.astype(np.int32), [packed[cuts[r] : cuts[r + 1]].tobytes() for r in full]], schema)

    def count(key, table):
        size = sum(len(p) // width for p in table["packed"].to_pylist())
        wide, at = np.zeros((size, 8), np.uint8), 0
        for part in table["packed"]:
            raw = np.frombuffer(part.as_buffer(), np.uint8).reshape(-1, width)
            wide[at : at + len(raw), :width] = raw
            at += len(raw)
        every = wide.view("<u8").ravel()
        every.sort()
        first = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
        counts = np.diff(np.append(first, len(every)))
        values, counts = every[first][counts > 1], counts[counts > 1]
        del wide, every, first
        seen = np.zeros(1 << inner, bool)
        seen[values >> np.uint64(low - inner) if low >= inner else values << np.uint64(inner - low)] = True
        top = np.sort(np.lexsort((values, -counts))[: max(1, limit // ranges)])
        fine = (np.uint64(key[0].as_py()) << np.uint64(low)) + values[top]
        give_back()
        return pa.table({
            "range": pa.array([key[0].as_py()], pa.int32()),
            "seen": pa.array([np.packbits(seen, bitorder="little").tobytes()], pa.binary()),
            "fine": pa.array([fine.astype("<u8").tobytes()], pa.binary()),
            "df": pa.array([counts[top].astype(np.int64).tobytes()], pa.binary()),
        })

    packed = docs.mapInArrow(sparing(pack), "range int, packed binary")
    # At most 1 << MAP_BITS bits and ``limit`` shingles come to the driver.
    found = packed.groupBy("range").applyInArrow(count, "range int, seen binary, fine binary, df binary").toArrow()
    rows = sorted(found.to_pylist(), key=lambda r: r["range"])
    part = (1 << inner) // 8
    seen = np.zeros(ranges * part, np.uint8)
    for row in rows:
        seen[row["range"] * part : (row["range"] + 1) * part] = np.frombuffer(row["seen"], np.uint8)
    fine, df = (np.frombuffer(b"".join(r[c] for r in rows), t) for c, t in (("fine", np.uint64), ("df", np.int64)))
    return Frequencies(bits, seen, fine, df)


def parity_map(elements: np.ndarray) -> bytes:
    """Whether each cell holds an odd number of elements; a cell or more for each element, up to ``CELLS``."""
    cells = min(CELLS, max(64, 1 << (len(elements) - 1).bit_length()))
    counts = np.bincount((elements & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
    return np.packbits(counts & 1 == 1).tobytes()


def apart(a: bytes, b: bytes) -> int:
    """In how many elements the sets of two parity maps differ at least."""
    small, large = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    folded = np.bitwise_xor.reduce(large.reshape(-1, len(small)), axis=0)
    return int(np.bitwise_count(folded ^ small).sum())


def prefixes(docs: DataFrame, n: int, similar: Similar, known: Frequencies) -> DataFrame:
    """``node, size, map, elements``: the prefix of every set in the global order, without what occurs once.

    Sets of which nothing is left are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(known)  # bounded by MAP_BITS and HEAVY
    schema = pa.schema([
        ("node", pa.int64()), ("size", pa.int32()), ("map", pa.binary()), ("elements", pa.list_(pa.int64())),
    ])

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                tokens = shingle_set(text, n)
                if not len(tokens):
                    continue
                weight = shared.value.weights(tokens)
                order = np.lexsort((tokens, weight))[: similar.prefix(len(tokens))]
                order = order[weight[order] > 0]
                if len(order):
                    rows.append((set_id(tokens), len(tokens), parity_map(tokens), tokens[order].view(np.int64)))
            if rows:
                yield _arrow(list(zip(*rows)), schema)

    return docs.mapInArrow(sparing(take), "node long, size int, map binary, elements array<long>")


def judged(pairs: DataFrame, marks: DataFrame, similar: Similar) -> DataFrame:
    """``a, b, near``: whether the sets of ``a, b`` may be similar by size and parity map. No similar pair is refused."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("near", pa.bool_())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [
                similar.num * max(x, y) <= similar.den * min(x, y)
                and apart(one, other) <= x + y - 2 * similar.overlap(x, y)
                for x, one, y, other in zip(*(batch.column(i).to_pylist() for i in range(2, 6)))
            ]
            yield _arrow([batch.column(0), batch.column(1), near], schema)

    named = marks.select(F.col("node").alias("a"), F.col("size").alias("x"), F.col("map").alias("one"))
    other = marks.select(F.col("node").alias("b"), F.col("size").alias("y"), F.col("map").alias("other"))
    both = pairs.join(named, "a").join(other, "b").select("a", "b", "x", "one", "y", "other")
    return both.mapInArrow(judge, "a long, b long, near boolean")


def coarse_links(keys: DataFrame, similar: Similar, scratch: Scratch) -> DataFrame:
    """``a, b``: links whose components contain all similar pairs of the rows of :func:`prefixes`.

    An element whose nodes are all linked to its smallest one has them in one component.
    If a link is refused, the smallest node has been judged with all others, which are
    judged with each other then. More than ``PAIRED`` of them are linked unjudged.
    """
    marks = scratch(keys.groupBy("node").agg(F.first("size").alias("size"), F.first("map").alias("map")), "jaccard-marks")
    prefix = keys.select("node", "size", F.explode("elements").alias("element"))
    least = prefix.groupBy("element").agg(F.min("node").alias("b"), F.count(F.lit(1)).alias("members"))
    least = least.where(F.col("members") > 1)
    stars = prefix.join(least, "element").where(F.col("node") != F.col("b")).withColumnRenamed("node", "a")
    first = scratch(judged(stars.select("a", "b").distinct(), marks, similar), "jaccard-judged")
    near, refused = first.where("near").select("a", "b"), first.where(~F.col("near")).select("a", "b")

    loose = scratch(stars.join(refused, ["a", "b"], "left_semi").select("element").distinct(), "jaccard-loose")
    rest = scratch(stars.join(loose, "element", "left_semi"), "jaccard-rest")
    many = rest.where(F.col("members") > PAIRED).select("a", "b").distinct()
    few = rest.where(F.col("members") <= PAIRED)
    others = few.select("element", F.col("a").alias("other"), F.col("size").alias("other_size"))
    close = similar.num * F.greatest("size", "other_size") <= similar.den * F.least("size", "other_size")
    pairs = few.join(others, "element").where((F.col("a") < F.col("other")) & close)
    second = judged(pairs.select("a", F.col("other").alias("b")).distinct(), marks, similar)
    return near.unionByName(many).unionByName(second.where("near").select("a", "b")).distinct()


LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _by_group(rows: DataFrame, work: Callable) -> DataFrame:
    """``work(nodes, texts, probes)`` per ``root, block, part``; groups are bounded and follow each other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            for *new, node, text, probe in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if new != key and held:
                    yield work(held)
                    held = []
                key = new
                held.append((node, text, probe))
        if held:
            yield work(held)

    spread = rows.select("root", "block", "part", "node", "text", "probe")
    spread = spread.repartition(shuffle_partitions(rows.sparkSession), "root", "block", "part")
    return spread.sortWithinPartitions("root", "block", "part", "node").mapInArrow(sparing(run), "a long, b long")


def _tree_links(n: int, similar: Similar) -> Callable:
    """Links among the rows that are no probes, or between those and the probes."""
    def work(held: list[tuple[int, str, bool]]) -> pa.RecordBatch:
        sets = [shingle_set(text, n) for _, text, _ in held]
        kept = [i for i, row in enumerate(held) if not row[2]]
        asked = [i for i, row in enumerate(held) if row[2]] or kept
        tree, groups, links = PrefixTree([sets[i] for i in kept]), Groups(len(held)), []
        for q in asked:
            for found in tree.search(tree.ranks(sets[q]), len(sets[q]), similar):
                if groups.join(q, kept[found]):
                    links.append((held[q][0], held[kept[found]][0]))
        links = [pair for pair in links if pair[0] != pair[1]]
        return _arrow([[a for a, _ in links], [b for _, b in links]], LINK)

    return work


def similar_nodes(
    docs: DataFrame, nodes: DataFrame, coarse: DataFrame, n: int, similar: Similar, scratch: Scratch
) -> DataFrame:
    """``node, root`` of the true components within the coarse ones.

    ``docs``: doc_id, text. ``nodes``: node, doc_id (one of its documents), n_shingles.
    """
    known = coarse.join(nodes, "node")
    blocks = known.groupBy("root").agg(F.ceil(F.sum("n_shingles") / BLOCK).cast("int").alias("blocks"))
    place = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = known.join(blocks, "root").withColumn("block", place)
    placed = scratch(placed, "jaccard-placed")
    wanted = only_with(docs, placed.select("doc_id"), placed.count())
    members = scratch(wanted.join(placed, "doc_id").drop("doc_id"), "jaccard-members")
    nowhere = F.lit(0)

    # The root is in every block of its component, so most blocks meet through it.
    roots = members.where((F.col("node") == F.col("root")) & (F.col("blocks") > 1)).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    ).where(F.col("block") != place)
    first = members.unionByName(roots).withColumns({"part": nowhere, "probe": F.lit(False)})
    links = scratch(_by_group(first, _tree_links(n, similar)), "jaccard-links")
    found = components(links)
    split = members.where(F.col("blocks") > 1)
    if split.isEmpty():
        return found

    grouped = scratch(
        split.join(found.withColumnRenamed("root", "inner"), "node", "left")
        .withColumn("inner", F.coalesce("inner", "node")),
        "jaccard-groups",
    )
    largest = (
        grouped.groupBy("root", "inner").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("root").agg(F.max_by("inner", F.struct("n", "inner")).alias("largest"))
    )
    outside = grouped.join(largest, "root").where(F.col("inner") != F.col("largest"))
    parts = outside.groupBy("root").agg(F.ceil(F.sum("n_shingles") / BLOCK).cast("int").alias("parts"))
    share = F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")).cast("int")
    asked = (
        outside.join(parts, "root").withColumn("part", share)
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("probe", F.lit(True))
    )
    stored = (
        grouped.join(parts, "root")
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("probe", F.lit(False))
    )
    columns = ["root", "block", "part", "node", "text", "probe"]
    both = asked.select(columns).unionByName(stored.select(columns))
    more = scratch(_by_group(both, _tree_links(n, similar)), "jaccard-links")
    return components(links.unionByName(more))


def named_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def join(
    docs: DataFrame,
    n: int = 5,
    num: int = 4,
    den: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for links with Jaccard at least ``num / den``."""
    return classes(*named_classes(named_text(docs, id_col, text_col), n, Similar(num, den)))


def profiled(docs: DataFrame, n: int, scratch: Scratch, keep: bool = True) -> tuple[DataFrame, DataFrame]:
    """``doc_id, n_shingles, node`` of all documents; the nodes with their smallest id and copies."""
    found = profiles(docs, n)
    profile = stage(found, "jaccard-profiles")[0] if keep else scratch(found, "jaccard-profiles")
    nodes = profile.where(F.col("n_shingles") > 0).groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.count(F.lit(1)).alias("copies")
    )
    return profile, scratch(nodes, "jaccard-nodes")


def one_per_node(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The documents that stand for their sets, and few others; no text is shuffled.

    A copy that stays costs its share of the work and changes no result: it names the same node.
    """
    return only_with(docs, nodes.select("doc_id"), nodes.count())


def class_names(
    docs: DataFrame, nodes: DataFrame, links: DataFrame, n: int, similar: Similar, scratch: Scratch
) -> DataFrame:
    """``node, component`` of the sets that are linked or have copies.

    ``links (a, b)`` join all similar nodes, over others if need be; similarity is verified here.
    """
    coarse = scratch(components(links), "jaccard-coarse")
    true = similar_nodes(docs, nodes.drop("copies"), coarse, n, similar, scratch)
    linked = true.join(nodes.select("node", F.col("doc_id").alias("least")), "node")
    names = linked.join(linked.groupBy("root").agg(F.min("least").alias("component")), "root").select("node", "component")
    copied = nodes.where(F.col("copies") > 1).select("node", F.col("doc_id").alias("copy_of"))
    return stage(
        names.join(copied, "node", "full").select("node", F.coalesce("component", "copy_of").alias("component")),
        "jaccard-names",
    )[0]


def named_classes(docs: DataFrame, n: int, similar: Similar) -> tuple[DataFrame, DataFrame]:
    """The profile of ``doc_id, text``, and the names of its classes."""
    scratch, early = Scratch(), Scratch()
    with shuffles_removed(docs.sparkSession):
        profile, nodes = profiled(docs, n, scratch)
        total = nodes.agg(F.sum("n_shingles")).first()[0] or 0
        single = one_per_node(docs, nodes)
        known = frequencies(single, n, total)
        keys = early(prefixes(single, n, similar, known), "jaccard-keys")
        links = scratch(coarse_links(keys, similar, early), "jaccard-coarse-links")
        early.clear()
        names = class_names(docs, nodes, links, n, similar, scratch)
    scratch.clear()
    return profile, names


def classes(profile: DataFrame, known: DataFrame) -> DataFrame:
    """The result of :func:`join` from what :func:`named_classes` gives."""
    named = profile.where(F.col("n_shingles") > 0).join(known, "node", "left")
    return named.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")).unionByName(
        profile.where(F.col("n_shingles") == 0).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    )


def report(docs: DataFrame) -> DataFrame:
    """Three-word shingles, links from a Jaccard similarity of 0.9 on."""
    return join(docs, n=3, num=9, den=10)


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(w) - 2, 1) + 1),
    lambda i: array_to_string(w[i : i + 2], ' '))) AS s FROM words WHERE len(w) > 0
), elements AS (
  SELECT doc_id, unnest(s) AS e FROM sets
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
  FROM elements a JOIN elements b ON a.e = b.e AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
  WHERE 100 * i >= 90 * (len(x.s) + len(y.s) - i)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
  SELECT a AS doc_id, b AS other FROM both_ways
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN both_ways l ON r.other = l.a
)
SELECT d.doc_id, CAST(coalesce(any_value(len(x.s)), 0) AS BIGINT) AS n_shingles,
  least(d.doc_id, coalesce(min(r.other), d.doc_id)) AS component_id
FROM documents d LEFT JOIN sets x ON x.doc_id = d.doc_id LEFT JOIN reached r ON r.doc_id = d.doc_id
GROUP BY d.doc_id
"""
