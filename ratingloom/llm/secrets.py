"""Secrets in texts: fixed patterns, and runs of characters that look drawn at random.

Two Markov models of characters, one of random strings and one of ordinary identifiers,
give every long run of token characters a log-likelihood ratio.  Counting, scoring and
matching are DataFrame functions throughout; a row's spans are found where it is read.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.common import first_by_hash

# The base patterns and their names, in the order that breaks ties.
_KEYWORDS = "password passwd secret token".split()
_ANY_CASE = "|".join("".join(f"[{c}{c.upper()}]" for c in word) for word in _KEYWORDS)
_ASSIGN = (
    rf"({_ANY_CASE}|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
_ACCESS, _HEX = r"AKIA[A-Z0-9]+", r"[0-9a-f]+"
# A match of these that is long enough is a match as a whole, so length goes into the pattern.
_LONG_ACCESS, _LONG_HEX = r"AKIA[A-Z0-9]{16,}", r"(?<![0-9a-f])[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")

# Characters of candidate runs, the least length of one, and what counts as random.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
_RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}"
_PART = r"[A-Za-z0-9+/_-]{6,}"
# Samples to learn from: the texts of at most so many rows, first by hash.
SAMPLE_ROWS = 1000
_SPANS = "array<struct<start:int,kind:int,end:int>>"


@dataclass(frozen=True)
class RandomRuns:
    """Log-likelihood ratio of each pair of characters, and the least sum that is random."""

    ratios: tuple[float, ...]
    least: float = 10.0

    def score(self, run: Column) -> Column:
        """Sum of the ratios over a run's neighbouring characters."""
        table = F.split(F.lit(",".join(f"{x:.6f}" for x in self.ratios)), ",").cast("array<double>")
        places = F.transform(F.split(run, ""), lambda c: F.instr(F.lit(ALPHABET), c))
        pairs = F.zip_with(
            F.slice(places, 1, F.length(run) - 1),
            F.slice(places, 2, F.length(run) - 1),
            lambda a, b: (a - 1) * len(ALPHABET) + b,
        )
        return F.aggregate(pairs, F.lit(0.0), lambda total, at: total + F.element_at(table, at))


def labelled_samples(docs: DataFrame, most: int = SAMPLE_ROWS) -> DataFrame:
    """sample, label: random strings (1) and ordinary identifiers (0), from a bounded sample of rows.

    Identifiers are the runs of token characters in the texts outside of what the base
    patterns match; random strings are the texts' digests in the usual encodings.
    """
    rows = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    rows = first_by_hash(rows, "text", most)
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    coded = F.array(
        F.rtrim(F.base64(digest), F.lit("=")), F.lower(F.hex(digest)), F.hex(digest),
        F.translate(F.rtrim(F.base64(F.unhex(F.sha2(F.hex(digest).cast("binary"), 512))), F.lit("=")), "+/\r\n", "-_"),
    )
    plain = F.col("text")
    for pattern in (_ASSIGN, _LONG_ACCESS, _LONG_HEX):
        plain = F.regexp_replace(plain, pattern, " ")
    words = F.regexp_extract_all(plain, F.lit(_PART), F.lit(0))
    random = rows.select(F.explode(coded).alias("sample"), F.lit(1).alias("label"))
    return random.unionByName(rows.select(F.explode(words).alias("sample"), F.lit(0).alias("label")))


def fit_runs(samples: DataFrame, smoothing: float = 1.0) -> RandomRuns:
    """Count pairs of characters under either label; only the counts reach the driver.

    Without samples of a label its model is uniform.
    """
    chars = F.split("sample", "")
    pairs = F.transform(
        F.sequence(F.lit(1), F.length("sample") - 1),
        lambda i: F.concat(F.element_at(chars, i), F.element_at(chars, i + 1)),
    )
    pairs = samples.filter(F.length("sample") > 1).select("label", F.explode(pairs).alias("pair"))
    counts = pairs.groupBy("label", "pair").agg(F.count("*").alias("n")).collect()
    place = {c: i for i, c in enumerate(ALPHABET)}
    size = len(ALPHABET)
    models = []
    for label in (0, 1):
        table = [[smoothing] * size for _ in range(size)]
        for row in counts:
            a, b = (place.get(c) for c in row["pair"])
            if row["label"] == label and a is not None and b is not None:
                table[a][b] += row["n"]
        models.append([[log(n / sum(line)) for n in line] for line in table])
    ordinary, random = models
    return RandomRuns(tuple(random[a][b] - ordinary[a][b] for a in range(size) for b in range(size)))


def _located(text: Column, pattern: str, found: Column, kind: int, keep: Column) -> Column:
    """Spans of the matches ``found`` of a pattern; ``keep`` says which of them count.

    What lies between matches, by splitting at them, gives their places; texts without a
    match are not split.
    """
    between = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    steps = F.arrays_zip(
        F.slice(between, 1, F.size(found)).alias("gap"),
        F.transform(found, lambda m: F.length(m)).alias("size"),
        keep.alias("keep"),
    )

    def step(done: Column, x: Column) -> Column:
        start = done["at"] + x["gap"]
        end = start + x["size"]
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        out = F.when(x["keep"], F.concat(done["out"], F.array(span))).otherwise(done["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    none = F.array().cast(_SPANS)
    begin = F.struct(F.lit(0).alias("at"), none.alias("out"))
    spans = F.aggregate(steps, begin, step, lambda done: done["out"])
    return F.when(F.size(found) > 0, spans).otherwise(none)


def find_secrets(docs: DataFrame, model: RandomRuns) -> DataFrame:
    """doc_id and spans (start, kind, end) of every row, sorted; kind counts from 0 in KINDS.

    Places are code points of the whole text, end exclusive.  Random runs that touch a
    base span, or have no letter and digit both, are left out.  A null text counts as
    empty and has no spans; equal rows give equal results, an empty table none; other
    columns are not looked at.
    """
    text = F.col("text")

    def found(pattern: str) -> Column:
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    matched = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", "text",
        found(_ASSIGN).alias("assign"), found(_LONG_ACCESS).alias("access"),
        found(_LONG_HEX).alias("hex"), found(_RUN).alias("runs"),
    )

    def all_of(column: str) -> Column:
        return F.transform(column, lambda _: F.lit(True))

    # the value of an assignment is what follows the last separator and its quote
    value = F.regexp_extract_all(text, F.lit(_ASSIGN), F.lit(2))
    long_value = F.when(F.size("assign") > 0, F.transform(value, lambda v: F.length(v) >= 6))
    mixed = F.transform("runs", lambda r: r.rlike("[0-9]") & r.rlike("[A-Za-z]"))
    odd = F.zip_with("runs", mixed, lambda r, ok: F.when(ok, model.score(r) >= model.least).otherwise(False))
    judged = matched.select("*", F.when(F.size("runs") > 0, odd).alias("odd"))
    located = judged.select(
        "doc_id",
        F.concat(
            _located(text, _ASSIGN, F.col("assign"), 0, long_value),
            _located(text, _LONG_ACCESS, F.col("access"), 1, all_of("access")),
            _located(text, _LONG_HEX, F.col("hex"), 2, all_of("hex")),
        ).alias("base"),
        F.when(F.exists("odd", lambda x: x), _located(text, _RUN, F.col("runs"), 3, F.col("odd")))
        .otherwise(F.array().cast(_SPANS)).alias("random"),
    )
    apart = F.filter(
        "random", lambda r: ~F.exists("base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"]))
    )
    return located.select("doc_id", F.array_sort(F.concat("base", apart)).alias("spans"))


def secrets_digest(found: DataFrame) -> DataFrame:
    """Counts by kind, a digest of the base spans and all spans as text, of each row."""
    names = F.array(*(F.lit(k) for k in KINDS))

    def text_of(spans: Column) -> Column:
        one = F.transform(
            spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"], x["end"])
        )
        return F.array_join(one, ",")

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("bigint")

    base = text_of(F.filter("spans", lambda x: x["kind"] < 3))
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)),
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        text_of(F.col("spans")).alias("spans"),
    )
