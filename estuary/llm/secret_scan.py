"""Operator 12: secrets in texts, by patterns and by character Markov models (DataFrame functions only).

Base spans are assignments to names like ``password``, access keys and long
hexadecimal runs.  Two first-order Markov models of characters are trained on
labelled samples: runs of ``SYMBOLS`` from the values of base spans are
random strings, runs of ``MIN_SAMPLE`` to ``MIN_RUN - 1`` characters outside
them are ordinary identifiers.  Longer runs are what is judged, so they train
neither model: a key that no pattern finds does not pass as ordinary.
A run of ``MIN_RUN`` characters or more outside base spans is a span of kind
``markov`` if the random model makes it ``MIN_BITS`` bits likelier than the
ordinary one, its first character included.  Counts cover all samples of all
documents; a character after another is smoothed towards the character's
own frequency, and that towards the uniform one, so a context that ordinary
identifiers never show counts against them, and without samples a model is uniform.
The model is a table of character pairs whose size the alphabet fixes.

Defined results: a null or empty text has no spans; an empty table gives no
rows; repeated rows and ids are counted and scanned as rows of their own, a null
id stays null; texts and runs of any length are scanned whole; letters of
other scripts end a run.  Positions are code points, ends exclusive.  Only the
id and text columns are read.
"""

from __future__ import annotations

import math
import string
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from estuary.llm.common import table
from estuary.llm.text_spans import let, matches, outside

SYMBOLS = string.ascii_letters + string.digits + "+/_.=-"
_RUN = "[A-Za-z0-9+/_.=-]"
KINDS = ("assign", "access", "hex")
MIN_SAMPLE, MIN_RUN, MIN_BITS = 8, 16, 24.0
PRIOR = 16.0  # characters of the frequencies alone that each context is given
_ORIGIN, _WIDTH = 42, 81  # code points 43 to 122 hold all symbols; 0 stands for the start of a run

# Possessive loops need no backtracking: nothing behind them could take what they took.
_ASSIGN = rf"""(?i:password|passwd|secret|token|api_?key)["']?+\x20*+[:=]\x20*+["']?+({_RUN}++)"""
PATTERNS = {"assign": _ASSIGN, "access": r"AKIA[A-Z0-9]++", "hex": r"(?<![0-9a-f])[0-9a-f]{24,}+"}


def secret(kind: str, span: Column) -> Column:
    """The random part of a base span's text."""
    return F.regexp_extract(span, _ASSIGN, 1) if kind == "assign" else span


def base_spans(kind: str, text: Column) -> Column:
    least = {"assign": 6, "access": 20, "hex": 24}[kind]
    return F.filter(matches(text, PATTERNS[kind]), lambda x: F.length(secret(kind, x["v"])) >= least)


_SAMPLE = rf"(?<!{_RUN}){_RUN}{{{MIN_SAMPLE},{MIN_RUN - 1}}}+(?!{_RUN})"
_JUDGED = rf"(?<!{_RUN}){_RUN}{{{MIN_RUN},}}+"


def pairs(run: Column) -> Column:
    """Numbers of a run's pairs of neighbouring characters, the first with the start."""
    codes = F.transform(F.split(run, ""), lambda c: F.ascii(c) - _ORIGIN)
    return let(codes, lambda xs: F.zip_with(F.concat(F.array(F.lit(0)), F.slice(xs, F.lit(1), F.size(xs) - 1)), xs, lambda a, b: a * _WIDTH + b))


def with_base(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, t, one array of spans for each kind); null texts are empty."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return rows.select("*", *(base_spans(k, F.col("t")).alias(k) for k in KINDS))


def places(*kinds: str) -> Column:
    """All spans of these columns without their texts."""
    return F.concat(*(F.transform(k, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))) for k in kinds))


def labelled_samples(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(random, run): the values of base spans, and the identifiers outside them."""
    rows = with_base(docs, text_col, text_col)

    def value(kind: str, x: Column) -> Column:
        return F.struct(F.lit(True).alias("random"), secret(kind, x["v"]).alias("run"))

    values = F.concat(*(F.transform(k, partial(value, k)) for k in KINDS))
    words = F.regexp_extract_all("t", F.lit(_SAMPLE), F.lit(0))
    free = F.transform(outside(matches(F.col("t"), _SAMPLE), places(*KINDS)), lambda x: x["v"])
    others = F.when(F.size(places(*KINDS)) == 0, words).otherwise(free)
    other = F.transform(others, lambda v: F.struct(F.lit(False).alias("random"), v.alias("run")))
    return rows.select(F.explode(F.concat(values, other)).alias("x")).select("x.random", "x.run")


def train(samples: DataFrame) -> list[float]:
    """Bits by which each pair of characters speaks for a random string, from (random, run).

    What reaches the driver is a count for each pair of symbols and label,
    13,122 at most.
    """
    counted = samples.select("random", F.explode(pairs(F.col("run"))).alias("pair")).groupBy("random", "pair").agg(F.count(F.lit(1)).alias("n"))
    counts = {(r["random"], r["pair"]): r["n"] for r in counted.collect()}
    codes = [ord(c) - _ORIGIN for c in SYMBOLS]
    seen = {(label, a, b): counts.get((label, a * _WIDTH + b), 0) for label in (True, False) for a in (0, *codes) for b in codes}
    bits = [0.0] * (_WIDTH * _WIDTH)
    for label, sign in ((True, 1.0), (False, -1.0)):
        column = {b: sum(seen[label, a, b] for a in (0, *codes)) for b in codes}
        every = sum(column.values())
        for a in (0, *codes):
            after = sum(seen[label, a, b] for b in codes)
            for b in codes:
                alone = (column[b] + 1) / (every + len(codes))
                bits[a * _WIDTH + b] += sign * math.log2((seen[label, a, b] + PRIOR * alone) / (after + PRIOR))
    return bits


def likelihood_ratio(run: Column, model: list[float]) -> Column:
    """Bits by which a run is likelier as a random string than as an identifier."""
    weights = F.split(F.lit(",".join(map(repr, model))), ",").cast("array<double>")  # a constant of the plan
    return F.aggregate(pairs(run), F.lit(0.0), lambda bits, p: bits + F.get(weights, p))


def detect(docs: DataFrame, model: list[float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, assign, access, hex, markov): arrays of spans for every row."""
    rows = with_base(docs, id_col, text_col)
    found = F.filter(outside(matches(F.col("t"), _JUDGED), places(*KINDS)), lambda x: likelihood_ratio(x["v"], model) >= MIN_BITS)
    rows = rows.withColumn("markov", found)
    return rows.select("id", *(places(k).alias(k) for k in (*KINDS, "markov")))


def written(*kinds: str) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    def marked(n: int, x: Column) -> Column:
        return F.struct(x["s"].alias("s"), F.lit(n).alias("n"), x["e"].alias("e"))

    spans = F.array_sort(F.concat(*(F.transform(k, partial(marked, n)) for n, k in enumerate(kinds))))
    names = F.array(*map(F.lit, kinds))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["n"]), x["s"], x["e"])), ",")


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = detect(docs, train(labelled_samples(docs)))
    return found.select(F.col("id").alias("doc_id"), *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
                        F.sha2(written(*KINDS), 256).alias("base_sha256"), written(*KINDS, "markov").alias("spans"),
                        F.size("markov").cast("long").alias("n_markov"))
