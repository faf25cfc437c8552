"""Line dedup: lines that several documents share stay in one of them only.

1. Every map task hashes the lines of its documents and sends the bit positions of
   two Bloom filters, by page of the filter: positions of what it saw once and of what
   it saw twice. Pages are merged apart from each other: a position seen by two tasks is
   seen twice. The filters have 8 bits per line, up to ``MAP_BITS``.
2. Only lines that the twice-seen filter lets through are suspects. Their 128-bit
   digests are shuffled, counted exactly (one row per task and digest after the
   map-side combine) and get their document, the one with the largest id.
3. Texts are not shuffled to lose their lines: up to ``HELD`` repeated digests are
   broadcast; beyond that number the digests to drop are joined to the documents by
   a key of id and text, which shuffles every text once. Both ways give the same rows.

Beyond 2 to the power ``MAP_BITS - 3`` lines the filters fill up, so that more
single lines are shuffled as digests; the result stays exact.

Defined cases: a document is a row, so rows of one id count apart; a NULL text has one
empty line and stays NULL; a NULL id is smaller than all others, and if all documents of
a line have none, all keep it; lines are cut at \\n only; a line repeated within its
document counts once, and goes or stays whole; an empty table gives an empty result;
columns of the names ``n_lines`` and ``n_dropped`` are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import remove_path, stage

SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
SHORTEST = 20
LEAST = 3
#: The twice-seen filter has at most 2 to this power bits (64 MB).
MAP_BITS = 29
#: So many repeated digests are broadcast (24 MB).
HELD = 1 << 20
#: Hashes that a task holds before it sends positions.
FLUSH = 1 << 21


def keys(text: bytes, shortest: int) -> Iterator[tuple[int, bytes]]:
    """Number and key of every line whose key has at least ``shortest`` code points."""
    for at, line in enumerate(text.lower().split(b"\n")):
        key = line.strip(SPACE)
        if len(key) >= shortest and (
            len(key) >= 4 * shortest or key.isascii() or len(key.decode("utf-8", "replace")) >= shortest
        ):
            yield at, key


def digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def row_key(doc_id: int | None, text: bytes) -> bytes:
    return digest(f"{doc_id}:".encode() + text)


def positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Two positions of each hash, one row per hash."""
    mask = np.uint64((1 << bits) - 1)
    return np.stack([hashes & mask, hashes >> np.uint64(64 - bits)], axis=1)


def _bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def _arrow(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def seen_twice(texts: DataFrame, bits: int, shortest: int) -> np.ndarray:
    """Packed bits of the twice-seen filter over ``text`` of all rows."""
    page_bits = max(13, bits - 9)
    schema = pa.schema([("page", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])

    def pages(spots: np.ndarray) -> dict[int, bytes]:
        spots = np.unique(spots)
        page = spots >> np.uint64(page_bits)
        inside = (spots & np.uint64((1 << page_bits) - 1)).astype("<u4")
        cuts = np.flatnonzero(np.concatenate(([True], page[1:] != page[:-1]))) if len(spots) else []
        ends = [*cuts[1:], len(spots)]
        return {int(page[a]): inside[a:b].tobytes() for a, b in zip(cuts, ends)}

    def send(hashes: list[int]) -> pa.RecordBatch:
        values, counts = np.unique(np.array(hashes, np.uint64), return_counts=True)
        once, twice = pages(positions(values, bits)), pages(positions(values[counts > 1], bits))
        return _arrow([list(once), list(once.values()), [twice.get(p, b"") for p in once]], schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[int] = []
        for batch in batches:
            for text in _bytes(batch.column(0)):
                held.extend({xxhash.xxh3_64_intdigest(key) for _, key in keys(text or b"", shortest)})
                if len(held) >= FLUSH:
                    yield send(held)
                    held = []
        if held:
            yield send(held)

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, again = np.zeros(1 << page_bits, bool), np.zeros(1 << page_bits, bool)
        for batch in batches:
            for once, twice in zip(batch.column("once").to_pylist(), batch.column("twice").to_pylist()):
                spots = np.frombuffer(once, "<u4")
                again[spots] |= seen[spots]
                again[np.frombuffer(twice, "<u4")] = True
                seen[spots] = True
        yield _arrow([[key[0].as_py()], [np.packbits(again, bitorder="little").tobytes()]],
                     pa.schema([("page", pa.int32()), ("again", pa.binary())]))

    sent = texts.select("text").mapInArrow(scan, "page int, once binary, twice binary")
    found = sent.groupBy("page").applyInArrow(merge, "page int, again binary").toArrow()  # at most 2^MAP_BITS bits
    again, size = np.zeros((1 << bits) // 8, np.uint8), (1 << page_bits) // 8
    for page, part in zip(found["page"].to_pylist(), found["again"].to_pylist()):
        again[page * size : (page + 1) * size] = np.frombuffer(part, np.uint8)
    return again


def _suspects(texts: list[bytes], again: np.ndarray, bits: int, shortest: int) -> Iterator[tuple[int, int, bytes]]:
    """Row, line and key of the lines that the twice-seen filter lets through."""
    rows, lines, found = [], [], []
    for row, text in enumerate(texts):
        for line, key in keys(text, shortest):
            rows.append(row)
            lines.append(line)
            found.append(key)
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(k) for k in found), np.uint64, len(found))
    spots = positions(hashes, bits)
    for i in np.flatnonzero((again[spots >> np.uint64(3)] >> (spots & np.uint64(7)).astype(np.uint8) & 1).all(axis=1)):
        yield rows[i], lines[i], found[i]


def dedup(docs: DataFrame, least: int = LEAST, shortest: int = SHORTEST, held: int = HELD) -> DataFrame:
    """``docs (doc_id, text, ...)`` with repeated lines cut out of ``text``, and ``n_lines``, ``n_dropped``.

    A line whose key has at least ``shortest`` code points and lies in at least ``least``
    documents stays in the document with the largest id only.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    lines = texts.select(F.sum(F.regexp_count("text", F.lit("\n")) + 1)).first()[0] or 0
    bits = min(MAP_BITS, max(16, (8 * int(lines)).bit_length()))
    again = spark.sparkContext.broadcast(seen_twice(texts, bits, shortest))  # at most 2^MAP_BITS bits

    def suspects(keyed: bool) -> DataFrame:
        schema = pa.schema([("digest", pa.binary()), ("doc_id", pa.int64()), ("row", pa.binary())])

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, rows = batch.column(0).to_pylist(), [t or b"" for t in _bytes(batch.column(1))]
                found = {(row, digest(key)) for row, _, key in _suspects(rows, again.value, bits, shortest)}
                names = {row: row_key(ids[row], rows[row]) for row, _ in found} if keyed else {}
                yield _arrow([[d for _, d in found], [ids[r] for r, _ in found], [names.get(r) for r, _ in found]], schema)

        return texts.mapInArrow(scan, "digest binary, doc_id long, row binary")

    counted = suspects(False).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper"))
    repeated, path = stage(counted.where(F.col("n") >= least).select("digest", "keeper"), "repeated-lines")
    if repeated.count() <= held:
        table = repeated.toArrow()
        order = np.argsort(known := np.array(table["digest"].to_pylist(), "S16"))
        has = ~table["keeper"].is_null().to_numpy(zero_copy_only=False)
        keeper = table["keeper"].fill_null(0).to_numpy().astype(np.int64)
        shared = spark.sparkContext.broadcast((known[order], has[order], keeper[order]))  # at most ``held`` digests
        remove_path(spark, path)

        def drops(batch: pa.RecordBatch, ids: list, rows: list[bytes]) -> dict[int, set[int]]:
            known, has, keeper = shared.value
            cut: dict[int, set[int]] = {}
            if not len(known):
                return cut
            met = list(_suspects(rows, again.value, bits, shortest))
            names = np.array([digest(key) for *_, key in met], "S16")
            at = np.minimum(np.searchsorted(known, names), len(known) - 1)
            for (row, line, _), k, same in zip(met, at, known[at] == names):
                if same and has[k] and keeper[k] != ids[row]:
                    cut.setdefault(row, set()).add(line)
            return cut

        return _without(docs, docs.schema, drops)
    wanted = suspects(True).join(repeated, "digest").where(F.col("keeper").isNotNull() & ~F.col("keeper").eqNullSafe(F.col("doc_id")))
    # One row per document, with no more digests than the text has lines.
    lost = wanted.groupBy("row").agg(F.collect_set("digest").alias("digests"))
    named = docs.select(
        F.struct(*docs.columns).alias("doc"), F.col("doc_id").cast("bigint").alias("id"), "text"
    )
    schema = T.StructType([*named.schema.fields, T.StructField("row", T.BinaryType())])

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column("id").to_pylist(), [t or b"" for t in _bytes(batch.column("text"))]
            names = pa.array([row_key(i, t) for i, t in zip(ids, rows)], pa.binary())
            yield batch.append_column("row", names)

    joined = named.mapInArrow(name, schema).join(lost, "row", "left").select("doc.*", F.col("digests").alias("_digests"))

    def listed(batch: pa.RecordBatch, ids: list, rows: list[bytes]) -> dict[int, set[int]]:
        wanted = batch.column("_digests").to_pylist()
        return {
            row: {line for line, key in keys(rows[row], shortest) if digest(key) in set(gone)}
            for row, gone in enumerate(wanted) if gone
        }

    return _without(joined, docs.schema, listed)


def _without(docs: DataFrame, wanted: T.StructType, drops: Callable) -> DataFrame:
    """Cuts out the lines that ``drops`` names by row, and counts lines."""
    kept = [f for f in wanted.fields if f.name not in ("n_lines", "n_dropped")]
    schema = T.StructType([*kept, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _bytes(batch.column("text"))
            rows = [t or b"" for t in texts]
            gone = drops(batch, batch.column("doc_id").to_pylist(), rows)
            for row, lines in gone.items():
                texts[row] = b"\n".join(x for i, x in enumerate(rows[row].split(b"\n")) if i not in lines)
            shorter = pa.array(texts, pa.binary()).cast(batch.column("text").type)
            columns = [shorter if f.name == "text" else batch.column(f.name) for f in kept]
            columns.append(pa.array([t.count(b"\n") + 1 for t in rows], pa.int64()))
            columns.append(pa.array([len(gone.get(i, ())) for i in range(len(rows))], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    return docs.mapInArrow(cut, schema)


def report(documents: DataFrame) -> DataFrame:
    """Lines, dropped lines and the digest of what stays, per document."""
    found = dedup(documents.select("doc_id", "text"))
    return found.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256")
    )


SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
  SELECT r, doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS i FROM docs
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), repeated AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT r) >= 3
), judged AS (
  SELECT r, keyed.doc_id, line, i, keeper IS NOT NULL AND keyed.doc_id IS DISTINCT FROM keeper AS gone
  FROM keyed LEFT JOIN repeated USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r, doc_id
"""
