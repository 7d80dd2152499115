"""Length frequencies per sample x species."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estuary.functions.rsem import num, num_text, tail_first, tail_last
from estuary.operators.catch import IN_HAUL, RECORD, by_record, kept_records, sample_sql
from estuary.operators.physical import HAUL, HAUL_TAIL, by_haul


def length_rows(lengths: DataFrame) -> DataFrame:
    """L1: numeric length and record ids; rows without a readable length dropped."""
    df = lengths.withColumns({
        "sl": num("length"),
        "species_record_id": num("species_record_id"),
        "length_record_id": num("length_record_id"),
    })
    return df.where(F.col("sl").isNotNull())


def counted(fish: DataFrame) -> DataFrame:
    """Records with a count, neither missing nor 0."""
    return fish.where(F.col("number").isNotNull() & (F.col("number") != 0))


def matched_records(fish: DataFrame, lens: DataFrame) -> DataFrame:
    """L2 for catch records by ``_haul`` and ``_record``, see ``catch.by_record``.

    Equi-join on the two: both sides are shuffled on those keys (or the smaller
    broadcast when AQE measures it small).  A length without a record id
    becomes '-', which no catch record has: without NULL in the key, Spark adds no
    filter that would work the text out a second time."""
    record = F.coalesce(num_text("species_record_id"), F.lit("-"))
    return fish.join(by_haul(lens).select(HAUL, record.alias(RECORD), "length_record_id", "sl"), [HAUL, RECORD], "inner")


def lengths_matched(rows: DataFrame, lens: DataFrame) -> DataFrame:
    """L2: lengths attached to their catch record; records without a count dropped."""
    return matched_records(counted(by_record(rows)), lens).select(
        F.expr(tail_last(HAUL, HAUL_TAIL)).alias("reference"), F.expr(sample_sql()).alias("bio_reference"),
        F.col(RECORD).cast("double").alias("species_record_id"), "length_record_id", "species", "sl")


def length_frequency(matched: DataFrame) -> DataFrame:
    """L3: number of fish per sample x species x length."""
    return matched.groupBy("bio_reference", "species", "sl").agg(F.count(F.lit(1)).alias("count"))


def n_measured(freq: DataFrame) -> DataFrame:
    """L4: fish measured per sample x species."""
    return freq.groupBy("bio_reference", "species").agg(F.sum("count").alias("nl"))


def length_dataset(freq: DataFrame) -> DataFrame:
    """Frequency rows with the sample's ``nl``.

    A window sum over (bio_reference, species) on the already aggregated
    frequencies: one group holds at most one row per distinct length, so
    the window partition stays small even for a hot sample, and no second
    aggregate + join-back is needed."""
    w = Window.partitionBy("bio_reference", "species")
    return freq.select("bio_reference", "species", F.sum("count").over(w).alias("nl"),
                       "count", "sl")


# A sample or species may be missing, and missing matches missing (L6).  The
# same pair as texts without NULL: plain equality does, and what is dealt
# by these columns for one step is dealt right for the next.  The sample leads
# with its end (see ``tail_first``): haul number, SC and split level.
PAIR = ["_sample", "_species"]
SAMPLE_TAIL = HAUL_TAIL + 2


def pair_columns(df: DataFrame) -> DataFrame:
    """``df`` with the normalised (sample, species) pair."""
    return df.withColumns({
        "_sample": F.expr(f"coalesce(concat({tail_first('bio_reference', SAMPLE_TAIL)}, '='), '')"),
        "_species": F.expr("coalesce(concat('=', species), '')"),
    })


def pair_values(df: DataFrame) -> DataFrame:
    """``bio_reference`` and ``species`` back from the pair."""
    sample = "substring(_sample, 1, length(_sample) - 1)"
    return df.withColumns({
        "bio_reference": F.expr(f"CASE WHEN _sample <> '' THEN {tail_last(sample, SAMPLE_TAIL)} END"),
        "species": F.expr("CASE WHEN _species <> '' THEN substring(_species, 2) END"),
    }).drop(*PAIR)


def lengths_in(lens: DataFrame, com: DataFrame) -> DataFrame:
    """Keep (sample, species) pairs present in the combined table.

    A semi join on the normalised pair (a zero-catch or unknown species
    is missing on both sides and still matches); never fans out.  The pairs are
    made distinct map-side first, as every zero-catch haul adds the same one,
    and the join takes the partitioning that ``distinct`` leaves."""
    pairs = pair_columns(com.select("bio_reference", "species")).select(*PAIR).distinct()
    return pair_columns(lens).join(pairs, PAIR, "left_semi").drop(*PAIR)


def length_pipeline(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """L1-L5."""
    return length_dataset(length_frequency(lengths_matched(rows, length_rows(lengths))))


def kept_length_dataset(rows: DataFrame, lengths: DataFrame, keys: DataFrame,
                        com: DataFrame | None = None) -> DataFrame:
    """L1-L6 for the kept hauls, written restrict -> join -> aggregate -> filter -> sum.

    The catch records are restricted to the kept hauls before the match.
    Frequencies are first counted by record, which takes the partitioning of
    the match; the rows are still in the order of the hauls then and
    compress well when they are dealt by the pair.

    Frequencies, filter and sum speak of the same normalised pair.  The
    filter keeps or drops whole pairs, so it may come before the sum: the
    frequencies are dealt by the pair once, for both and for the counts by
    sample, species, length and haul.  The sum comes before these counts, as
    it takes the order of the filter's join."""
    fish = counted(kept_records(rows, keys))
    matched = matched_records(fish, length_rows(lengths))
    freq = matched.groupBy(HAUL, RECORD, IN_HAUL, "species", "sl").agg(F.count(F.lit(1)).alias("count"))
    # tells the haul, together with the sample
    haul = F.expr(f"CASE WHEN startswith({IN_HAUL}, '=') THEN {IN_HAUL} ELSE concat('-', {HAUL}) END")
    freq = pair_columns(freq.withColumns({"bio_reference": F.expr(sample_sql()), "_of": haul})).select(*PAIR, "_of", "sl", "count")
    if com is not None:
        pairs = pair_columns(com.select("bio_reference", "species")).select(*PAIR).distinct()
        freq = freq.join(pairs, PAIR, "left_semi")
    total = F.sum("count").over(Window.partitionBy(*PAIR))
    freq = freq.withColumn("nl", total).groupBy(*PAIR, "nl", "_of", "sl").agg(F.sum("count").alias("count"))
    return pair_values(freq).select("bio_reference", "species", "nl", "count", "sl")
