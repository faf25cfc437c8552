"""Secrets: assignment, access key and hex patterns, and a battery of randomness tests.

The battery looks at every run of 20 or more token characters. The hypothesis
to reject is "structured text": symbols as uneven as in words, few changes of
character class, neighbours that predict each other. Three tests, each with the
length of the token in its variance, give three p-values; the token rejects
structure only as far as the weakest of them does. The p-values of all tokens of
all documents then pass the step-up rule for a false-discovery rate of 1%, on a
grid of twentieths of a decade (rounded up, so the rate still holds).

Defined cases: NULL text is empty; repeated rows give repeated results and count
each in the step-up rule; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import spans
from tidemark.llm.shared import let
from tidemark.session import stage

ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
KINDS = ("assign", "access", "hex", "random")
# A run shorter than the bound fails wherever it starts, so the bound can stand
# in the pattern; the value of an assignment has to be measured afterwards.
PATTERNS = {
    "assign": ASSIGN,
    "access": r"AKIA[A-Z0-9]{14,}",
    "hex": r"[0-9a-f]{16,}",
    "random": r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+",
}
MIN_VALUE = 12
RATE = 0.01
GRID = 20
MAX_BIN = 400

_UPPER, _LOWER, _FIGURES = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Encoding: pattern of its tokens, alphabet, chance that two symbols of structured text agree.
ENCODINGS = {
    "decimal": (r"^[0-9]+$", _FIGURES, 0.20),
    "hex": (r"^(?:[0-9a-f]+|[0-9A-F]+)$", _FIGURES + "abcdef", 0.12),
    "base32": (r"^[A-Z2-7]+$", _UPPER + "234567", 0.068),
    "base36": (r"^(?:[0-9a-z]+|[0-9A-Z]+)$", _FIGURES + _LOWER, 0.068),
    "base64": (r"", _UPPER + _LOWER + _FIGURES + "+/", 0.06),
}
#: Share of neighbours of structured text that lie on different sides of the alphabet's middle.
CHANGES = 0.25
#: Correlation of neighbouring symbols that structured text shows.
SERIAL = 0.6


def normal_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal law (Zelen and Severo's polynomial, error below 1e-7)."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-z * z / 2) * 0.3989422804014327 * poly
    return F.when(z >= 0, upper).otherwise(1 - upper)


def _p_of(token: Column, alphabet: str, agree: float, fold: bool) -> Column:
    k = len(alphabet)
    token = F.lower(token) if fold else F.translate(token, "-_", "+/")

    def battery(t: Column) -> Column:
        n = F.char_length(t).cast("double")
        squares = F.aggregate(
            F.array(*[(n - F.char_length(F.replace(t, F.lit(c), F.lit("")))) for c in alphabet]),
            F.lit(0.0), lambda a, c: a + c * c,
        )
        symbols = F.transform(
            F.filter(F.split(t, ""), lambda c: c != ""),
            lambda c: F.position(c, F.lit(alphabet)).cast("double") - 1,
        )

        def tests(s: Column) -> Column:
            # One pass over the symbols: sums, squares, products of neighbours and changes of half.
            none = F.lit(None).cast("double")
            start = F.struct(*[F.lit(0.0).alias(c) for c in ("total", "squares", "product", "changes")], none.alias("last"))

            def step(a: Column, y: Column) -> Column:
                before = a["last"]
                changed = F.when(before.isNull() | ((before < k / 2) == (y < k / 2)), 0.0).otherwise(1.0)
                return F.struct(
                    (a["total"] + y).alias("total"), (a["squares"] + y * y).alias("squares"),
                    (a["product"] + F.coalesce(before * y, F.lit(0.0))).alias("product"),
                    (a["changes"] + changed).alias("changes"), y.alias("last"),
                )

            return let(F.struct(F.aggregate(s, start, step).alias("sums"), F.get(s, F.lit(0)).alias("first")), serial)

        def serial(m: Column) -> Column:
            sums = m["sums"]
            mean = sums["total"] / n
            spread = sums["squares"] - sums["total"] * mean
            ends = 2 * sums["total"] - sums["last"] - m["first"]  # all symbols but the last, and all but the first
            product = sums["product"] - mean * ends + (n - 1) * mean * mean
            return F.struct(
                sums["changes"].alias("changes"),
                F.when(spread > 0, product / spread).otherwise(1.0).alias("serial"),
            )

        def combined(m: Column) -> Column:
            chi = k / n * squares - n
            delta = (n - 1) * (k * agree - 1)
            uniform = normal_tail((k - 1 + delta - chi) / F.sqrt(2 * (k - 1) + 4 * delta))
            runs = normal_tail(
                (m["changes"] - (n - 1) * CHANGES) / F.sqrt((n - 1) * (CHANGES * (1 - CHANGES)))
            )
            bounded = F.least(F.abs(m["serial"]), F.lit(0.999))
            serial = normal_tail((F.atanh(F.lit(SERIAL)) - F.atanh(bounded)) * F.sqrt(n - 3))
            return F.greatest(uniform, runs, serial)

        return let(tests(symbols), combined)

    return let(token, battery)


def p_value(token: Column) -> Column:
    """The weakest of the three tests, in the encoding inferred for the token."""
    chain = None
    for name, (pattern, alphabet, agree) in ENCODINGS.items():
        p = _p_of(token, alphabet, agree, fold=name in ("hex", "base36"))
        if not pattern:
            return chain.otherwise(p)
        test = F.regexp_like(token, F.lit(pattern))
        chain = F.when(test, p) if chain is None else chain.when(test, p)
    return chain


def grid_bin(p: Column) -> Column:
    """Largest grid step whose p-value is at least ``p``; higher is stronger."""
    return F.least(
        F.floor(-F.log10(F.greatest(p, F.lit(1e-30))) * GRID), F.lit(MAX_BIN)
    ).cast("int")


def step_up(bins: DataFrame, rate: float = RATE) -> int:
    """The weakest bin that the step-up rule accepts; one past the grid if none.

    ``bins`` has one row per token. At most 401 counts meet in one task.
    """
    counts = bins.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    above = F.sum("n").over(Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("n").over(Window.partitionBy())
    passed = counts.select("bin", above.alias("rank"), total.alias("m")).where(
        F.pow(F.lit(10.0), -F.col("bin") / GRID) <= rate * F.col("rank") / F.col("m")
    )
    weakest = passed.agg(F.min("bin")).first()[0]
    return MAX_BIN + 1 if weakest is None else weakest


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, confirmed base spans per kind, and tokens with the bin of their p-value."""
    def found(kind: str) -> Column:
        return spans.find(F.col(text_col), PATTERNS[kind])

    def placed(kind: str, keep=None) -> Column:
        hits = found(kind) if keep is None else F.filter(found(kind), keep)
        return F.transform(
            hits, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"))
        ).alias(kind)

    long_value = lambda m: F.char_length(F.regexp_extract(m["value"], ASSIGN, 2)) >= MIN_VALUE
    tokens = F.transform(
        found("random"),
        lambda m: F.struct(
            m["start"].alias("start"), m["end"].alias("end"), grid_bin(p_value(m["value"])).alias("bin")
        ),
    )
    return docs.select(
        F.col(id_col), placed("assign", long_value), placed("access"), placed("hex"), tokens.alias("tokens")
    )


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE) -> DataFrame:
    """Spans per kind; ``random`` holds the tokens that pass the false-discovery rule.

    The spans (no texts) are staged once, because the rule needs all p-values
    before the first token can be judged.
    """
    staged, _ = stage(candidates(docs, id_col, text_col), "secrets")
    weakest = step_up(staged.select(F.explode("tokens.bin").alias("bin")), rate)
    return staged.withColumn(
        "random", F.filter("tokens", lambda t: t["bin"] >= weakest)
    ).drop("tokens")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: counts, digest of the base spans, all spans."""
    found = detect(docs)
    tagged = [spans.tagged(F.col(k), k, i, F.lit(1.0)) for i, k in enumerate(KINDS)]
    both = found.select(
        "doc_id",
        *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.concat(*tagged[:3]).alias("base"),
        F.concat(*tagged).alias("all"),
    )
    return both.select(
        "doc_id", *[f"n_{k}" for k in KINDS],
        F.sha2(spans.listed(F.col("base"), by_start=True), 256).alias("base_sha256"),
        spans.listed(F.col("all"), by_start=True).alias("spans"),
    )
