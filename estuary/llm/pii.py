"""Operator 3: personal data, and the terms that give it away (DataFrame functions only).

Base spans are e-mail addresses, IP addresses, card and phone numbers.  Each
distinct value is a protected entity.  Terms outside base spans co-occur with
every entity of their document, however far off; over the whole corpus, counted
in documents, a term discloses an entity if

* ``n(t, e) >= MIN_SUPPORT`` documents show both together,
* ``n(t, e) / n(t) >= MIN_SHARE``: who meets the term mostly meets the entity,
* its bits of information ``log2(n(t, e) N / (n(t) n(e)))`` are ``MIN_PART`` of
  the entity's own ``log2(N / n(e))``, which bounds them, or more: an entity in a
  third of all documents has 1.58 bits only;
* over the documents that show both they add up to ``MIN_SUPPORT * MIN_BITS``, so
  that rare words beside a frequent entity by chance do not count.

A term is a whole run of letters and digits of any length, in any script.  No
word is exempt: what a common word shares with an entity is measured against
all documents that hold it.
Such terms are spans of kind ``term`` wherever they stand outside base spans, in
every document, with that entity or without it; ``sanitised`` puts a kind's name for each span.

Defined results: a null or empty text has no spans (and stays as it is);
repeated rows count as documents of their own and get equal spans; null ids
are told apart by text; an empty table gives no rows.  Positions are code
points, ends exclusive.  Columns other than id and text are passed on by
``sanitised`` and otherwise ignored; helper columns avoid their names.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from estuary.llm.common import fresh, stored, table
from estuary.llm.text_spans import SPANS, matches, outside

KINDS = ("email", "ip", "card", "phone")
MIN_SUPPORT, MIN_SHARE, MIN_BITS, MIN_PART = 2, 0.5, 3.0, 0.5

# Possessive loops run without recursion on texts of any length; the look-behinds
# try each run of characters once, at its start or where the last match ended.
_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_BYTE = "0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
TERM = r"(?<![\p{L}\p{N}])[\p{L}\p{N}]++"
#: Telling terms that every executor may hold, 16 bytes each; more are joined by shuffle.
MAX_HELD_TERMS = 2_000_000


def digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """Whether a short string of digits passes the checksum."""
    def add(total: Column, i: Column) -> Column:
        x = F.substring(d, i, F.lit(1)).cast("int")
        twice = x * 2
        return total + F.when((F.length(d) - i) % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add) % 10 == 0


def valid(kind: str, v: Column) -> Column:
    if kind == "ip":
        return v.rlike(rf"^{_BYTE}(\.{_BYTE}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits(v)).between(13, 19), luhn(digits(v))).otherwise(False)
    if kind == "phone":
        return F.length(digits(v)).between(9, 15)
    return F.lit(True)


def base_spans(kind: str, text: Column) -> Column:
    """Spans of one kind; the costly search runs only where its rarest sign occurs."""
    sign = {"email": text.contains("@"), "phone": text.contains("+")}.get(kind, text.rlike("[0-9][. -]?[0-9]"))
    found = F.filter(matches(text, PATTERNS[kind]), lambda x: valid(kind, x["v"]))
    return F.when(sign, found).otherwise(F.array().cast(SPANS))


def entity(kind: str, v: Column) -> Column:
    return F.concat(F.lit(f"{kind}:"), F.lower(v) if kind == "email" else v if kind == "ip" else digits(v))


def words_at(text: Column) -> Column:
    """Start, end and hash of every term of a text, in order."""
    return F.transform(matches(text, TERM), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.xxhash64(F.lower(x["v"])).alias("h")))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, h, t): h is the text's hash, and null texts are empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), text.alias("t"))


def found_in(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, h, one array of spans for each kind, entities, shown): hashes of the entities, and of the terms if there are entities."""
    rows = keyed(docs, id_col, text_col)
    rows = rows.select("*", *(base_spans(k, F.col("t")).alias(k) for k in KINDS))

    def hashed(kind: str, x: Column) -> Column:
        return F.xxhash64(entity(kind, x["v"]))

    entities = F.array_distinct(F.concat(*(F.transform(k, partial(hashed, k)) for k in KINDS)))
    slim = [F.transform(k, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))).alias(k) for k in KINDS]
    rows = rows.select("id", "h", "t", *slim, entities.alias("entities"))
    shown = F.array_distinct(F.transform(outside(words_at(F.col("t")), F.concat(*KINDS)), lambda x: x["h"]))
    return rows.select("id", "h", *KINDS, "entities", F.when(F.size("entities") > 0, shown).otherwise(F.array().cast("array<bigint>")).alias("shown"))


def term_hashes(text: Column) -> Column:
    """Distinct hashes of a text's terms."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), lambda w: F.xxhash64(F.lower(w))))


def term_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """(th, nt): documents that hold each term, by its 64-bit hash."""
    return docs.select(F.explode(term_hashes(F.col(text_col))).alias("th")).groupBy("th").agg(F.count(F.lit(1)).alias("nt"))


def telling_terms(docs: DataFrame, found: DataFrame, text_col: str) -> DataFrame:
    """(th): hashes of the terms that disclose an entity; repeated rows are documents of their own."""
    held = found.where(F.size("entities") > 0)
    pairs = stored(held.select(F.explode("entities").alias("entity"), "shown").select("entity", F.explode("shown").alias("th"))
                   .groupBy("entity", "th").agg(F.count(F.lit(1)).alias("nte")).where(F.col("nte") >= MIN_SUPPORT), "term_pairs")
    entities = stored(held.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("ne")), "entities")
    counts = term_counts(docs, text_col).where(F.col("nt") >= MIN_SUPPORT)
    total = found.count()
    own = F.log2(F.lit(float(total)) / F.col("ne"))
    bits = F.log2(F.col("nte") * F.lit(float(total)) / (F.col("nt") * F.col("ne")))
    return stored(counts.join(pairs, "th").join(entities, "entity").where(
        (F.col("nte") >= MIN_SHARE * F.col("nt")) & (bits >= MIN_PART * own) & (F.col("nte") * bits >= MIN_SUPPORT * MIN_BITS)).select("th").distinct(), "disclosing")


def disclosing(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, h, terms): where telling terms stand, in every text that holds any; one row for repeated ones.

    The places of all terms meet the telling ones, and only what is found is
    dealt, to be put together again for each text: texts are never dealt.
    """
    telling = telling_terms(docs, found, text_col)
    if telling.limit(MAX_HELD_TERMS + 1).count() <= MAX_HELD_TERMS:
        telling = F.broadcast(telling)
    places = keyed(docs, id_col, text_col).select("id", "h", F.explode(words_at(F.col("t"))).alias("w"))
    hits = places.select("id", "h", "w.s", "w.e", F.col("w.h").alias("th")).join(telling, "th", "left_semi")
    return hits.groupBy("id", "h").agg(F.sort_array(F.collect_set(F.struct("s", "e"))).alias("terms"))


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, h, email, ip, card, phone, term) for every row; h is the text's hash."""
    found = stored(found_in(docs, id_col, text_col), "pii")
    terms = disclosing(docs, found, id_col, text_col)
    nothing = F.array().cast("array<struct<s:int,e:int>>")
    return found.drop("entities", "shown").join(
        terms.select(F.col("id").alias("tid"), F.col("h").alias("th"), "terms"),
        F.col("id").eqNullSafe(F.col("tid")) & (F.col("h") == F.col("th")), "left").select(
        "id", "h", *KINDS, outside(F.coalesce("terms", nothing), F.concat(*KINDS)).alias("term"))


def written(*kinds: str) -> Column:
    """kind:start:end by kind, then start, comma-joined."""
    def one(kind: str, x: Column) -> Column:
        return F.concat_ws(":", F.lit(kind), x["s"], x["e"])

    return F.concat_ws(",", *(F.transform(F.array_sort(k), partial(one, k)) for k in kinds))


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with every span replaced by its kind in brackets; overlapping spans by the first one's."""
    h, at, spans = (fresh(c, docs.columns) for c in ("_h", "_id", "_spans"))

    def named(kind: str, x: Column) -> Column:
        return F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(kind).alias("k"))

    all_spans = F.array_sort(F.concat(*(F.transform(k, partial(named, k)) for k in (*KINDS, "term"))))
    found = detect(docs, id_col, text_col).dropDuplicates(["id", "h"]).select(F.col("id").alias(at), F.col("h").alias(h), all_spans.alias(spans))
    text = F.col(text_col)

    def step(acc: Column, x: Column) -> Column:
        inside = x["s"] < acc["at"]
        gap = text.substr(acc["at"] + 1, x["s"] - acc["at"])
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"),
                        F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], F.array(gap, F.concat(F.lit("["), F.upper(x["k"]), F.lit("]"))))).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    changed = F.aggregate(spans, start, step, lambda acc: F.concat(F.concat_ws("", acc["out"]), text.substr(acc["at"] + 1, F.length(text))))
    joined = docs.withColumn(h + "t", F.xxhash64(F.coalesce(text, F.lit("")))).join(
        found.where(F.size(spans) > 0), F.col(id_col).eqNullSafe(F.col(at)) & (F.col(h + "t") == F.col(h)), "left")
    new = F.when(F.col(spans).isNull(), text).otherwise(changed)
    return joined.select(*(new.alias(c) if c == text_col else F.col(c) for c in docs.columns))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
                        F.sha2(written(*KINDS), 256).alias("base_sha256"), written(*KINDS, "term").alias("spans"),
                        F.size("term").cast("long").alias("n_term"))
