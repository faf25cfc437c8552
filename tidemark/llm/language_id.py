"""Language identification with bit-sliced Bloom filters over character n-grams.

Every language's typical 4-grams fill one bit slice of a Bloom filter; one cell
holds a bit per language, so combining the cells of an n-gram's hashes answers
"which languages contain it" for all languages at once. Bits are counted per
language, the share that false positives add is taken off, and the language
with the most n-grams left decides.

The filter has ``CELLS`` words whatever the corpus; it is fitted on at most
``SAMPLE`` labelled documents per language, chosen by a hash of their id. All labelled
documents are counted by bins of that hash, so the choice is one filter per language.

Defined cases: NULL text or one without a letter is ``und`` with score 0; a text
whose n-grams are all unknown gets the first learned language with score 0; without
any labelled document everything is ``und``; ties go to the first language by code
point; repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stage

UNKNOWN = "und"
GRAM = 4
CELLS = 1 << 21
HASHES = 3
SAMPLE = 4_000
#: Bins of the sampling draw per halving of its probability.
BINS = 64
MAX_LANGUAGES = 64
#: A gram belongs to a language if its share there is at least this part of its largest share,
#: and at least so many of a million grams.
CONTRAST = 0.2
PER_MILLION = 3.0
_CHUNK = 1 << 20


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x30000)), bool, 0x30000)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def grams(text: str) -> Iterator[np.ndarray]:
    """Hashes of all 4-grams of lower-cased letters and single word boundaries, in chunks."""
    for at in range(0, len(text), _CHUNK):
        part = text[at : at + _CHUNK + GRAM - 1].lower()
        codes = np.frombuffer(f" {part} ".encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[np.minimum(codes, 0x2FFFF)]
        codes = np.where(letter, codes, 32)
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # one boundary after each word
        codes = codes[keep].astype(np.uint64)
        codes = np.concatenate([np.array([32], np.uint64), codes])
        if len(codes) < GRAM:
            codes = np.concatenate([codes, np.full(GRAM - len(codes), 32, np.uint64)])
        h = np.zeros(len(codes) - GRAM + 1, np.uint64)
        for i in range(GRAM):
            h = h * np.uint64(0x100000001B3) + codes[i : i + len(h)]
        yield _mix(h)


def _cells(h: np.ndarray, number: int) -> np.ndarray:
    """The cell of hash function ``number``: double hashing on the halves."""
    return ((h + np.uint64(number) * ((h >> np.uint64(32)) | np.uint64(1))) & np.uint64(CELLS - 1)).astype(np.int64)


def gram_counts(labelled: DataFrame) -> DataFrame:
    """``lang, gram, n`` of ``lang, text`` rows; each task adds up its own rows first."""
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.setdefault(lang, []).extend(grams(text or ""))
            for lang, parts in found.items():
                values, counts = np.unique(np.concatenate(parts or [np.zeros(0, np.uint64)]), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(values), pa.string()), pa.array(values.view(np.int64)), pa.array(counts)],
                    schema=schema,
                )

    rows = labelled.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Model:
    """Languages, filter words and the false-positive rate of every slice."""

    def __init__(self, languages: list[str], words: np.ndarray):
        self.languages, self.words = languages, words
        filled = [(words >> np.uint64(b) & np.uint64(1)).mean() if len(words) else 0.0 for b in range(len(languages))]
        self.false_rate = np.array([f**HASHES for f in filled])

    def decide(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        hits, total = np.zeros(len(self.languages)), 0
        for h in grams(text):
            mask = self.words[_cells(h, 0)]
            for number in range(1, HASHES):
                mask &= self.words[_cells(h, number)]
            hits += [np.count_nonzero(mask & np.uint64(1 << b)) for b in range(len(self.languages))]
            total += len(h)
        true = np.maximum(0, hits - self.false_rate * total) / np.maximum(1e-9, 1 - self.false_rate)
        best = int(true.argmax())
        return self.languages[best], float(min(1.0, true[best] / true.sum())) if true.sum() > 0 else 0.0


def has_letter(text: str) -> bool:
    import regex

    return regex.search(r"\p{L}", text) is not None


def draw_bin(identity: Column) -> Column:
    """Bin of a uniform draw by the id's hash; each bin above holds a 64th of a halving less."""
    draw = (F.shiftrightunsigned(F.xxhash64(identity), 11) + 1) / F.lit(float(1 << 53))
    return F.floor(-F.log2(draw) * BINS).cast("int")


def draw_limits(known: DataFrame, id_col: str, sample: int) -> dict[str, int]:
    """The least bin that is learned from, per language.

    All rows are counted by language and bin (at most 53 * ``BINS`` bins each); the highest
    bins that hold no more than ``sample`` rows together are taken.
    """
    bins = known.groupBy("lang", draw_bin(F.col(id_col)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("bin"))
    limits = (
        bins.withColumn("held", F.sum("n").over(order))
        .groupBy("lang")
        .agg(F.min(F.when(F.col("held") <= sample, F.col("bin"))).alias("least"))
        .select("lang", F.coalesce("least", F.lit(54 * BINS)).alias("least"))
    )
    return {r["lang"]: r["least"] for r in limits.limit(MAX_LANGUAGES + 1).collect()}


def fit(labelled: DataFrame, id_col: str = "doc_id", sample: int = SAMPLE) -> Model:
    """Learn from ``lang`` and ``text`` of labelled rows; NULL languages and texts are left out."""
    known = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    limits = draw_limits(known, id_col, sample)
    if len(limits) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not limits:
        return Model([], np.zeros(0, np.uint64))
    drawn = [(F.col("lang") == lang) & (draw_bin(F.col(id_col)) >= least) for lang, least in limits.items()]
    rows = known.where(reduce(or_, drawn))  # the texts are filtered where they are read, not shuffled
    counts, _ = stage(gram_counts(rows), "language-grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    languages = sorted(limits)
    share = F.col("n") / F.col("total")
    order = F.array(*[F.lit(x) for x in languages])
    masks = (
        counts.join(F.broadcast(totals), "lang")  # at most 64 rows
        .select("gram", share.alias("share"), (F.array_position(order, F.col("lang")) - 1).cast("int").alias("at"))
        .where(F.col("share") >= PER_MILLION / 1e6)
        .groupBy("gram")
        .agg(F.max("share").alias("top"), F.collect_list(F.struct("share", "at")).alias("each"))  # at most 64
        .select("gram", "top", F.explode("each").alias("e"))
        .where(F.col("e.share") >= CONTRAST * F.col("top"))
        .groupBy("gram").agg(F.bit_or(F.expr("shiftleft(1L, e.at)")).alias("mask"))
    )
    return Model(languages, _filter_words(masks))


def _filter_words(masks: DataFrame) -> np.ndarray:
    """The filter's words; at most ``CELLS`` rows come to the driver."""
    schema = pa.schema([("cell", pa.int64()), ("mask", pa.int64())])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(0).to_numpy().view(np.uint64)
            for number in range(HASHES):
                yield pa.RecordBatch.from_arrays([pa.array(_cells(h, number)), batch.column(1)], schema=schema)

    cells = masks.select("gram", "mask").mapInArrow(spread, "cell long, mask long")
    table = cells.groupBy("cell").agg(F.bit_or("mask").alias("mask")).toArrow()
    words = np.zeros(CELLS, np.uint64)
    if table.num_rows:
        words[table["cell"].to_numpy()] = table["mask"].to_numpy().view(np.uint64)
    return words


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (replacing columns of that name)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # CELLS words, 16 MB
    schema = docs.drop("lang_pred", "score").schema.add("lang_pred", "string").add("score", "double")

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results = [shared.value.decide(t) for t in batch.column(text_col).to_pylist()]
            fields = [n for n in batch.schema.names if n not in ("lang_pred", "score")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in fields]
                + [pa.array([r[0] for r in results], pa.string()), pa.array([r[1] for r in results], pa.float64())],
                names=[*fields, "lang_pred", "score"],
            )

    return docs.mapInArrow(decide, schema)


def held_out(identity: Column) -> Column:
    """Every fourth document by checksum of its id is not learned from."""
    return F.coalesce(F.crc32(identity.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def report(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", "text", "lang")
    model = fit(rows.where(~held_out(F.col("doc_id"))))
    named = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return identify(named, model).drop("text")
