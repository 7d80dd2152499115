"""Operator 7: licence notices by MinHash bands over text windows (DataFrame functions only).

Every text is cut into overlapping windows of as many word shingles as each
template length has, a quarter of that apart (at least one shingle).  Windows
and templates have ``BANDS`` bands of one minhash each; a window that shares a
band with a template of its length retrieves it.  The window best aligned with
a notice that keeps ``SHARE`` of its shingles has a similarity of 0.5 or more
and meets its template in a band with probability 1 - 0.5 ** 12 = 0.9998 or
more.  Then the template's distinct shingles are counted exactly in the whole
text, and a match is kept if the text holds ``SHARE`` of them.

Templates are a parameter: a table (license, text) of bounded size; the
default ones are notices of common licences and the whole bodies of
``license_texts``.  The bodies of AGPL-3.0 and of the Creative Commons licences
other than CC-BY-SA-4.0 and CC0-1.0 are not among them, their notices are.  A
licence whose wording holds another's (BSD-3-Clause that of BSD-2-Clause)
matches both.  Words are runs of bytes other than blank and 0x09-0x0D, with
A-Z lower-cased, punctuation included; a shingle is five words and a text of
fewer is none.

Defined results: null and empty texts match nothing and give no row; repeated
rows each give their rows; equal templates both match; an empty table gives
no rows.  Only the id and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estuary.llm.common import stored, table
from estuary.llm.license_texts import BODIES

WORDS = 5
SHARE = 0.8
BANDS = 12
#: Templates are broadcast; more than so many characters of them are refused.
MAX_TEMPLATE_CHARS = 4 << 20

# Fixed values.  Short wordings that documents use of themselves.
SHORT = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation; version 2"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]


def _notices() -> list[tuple[str, str]]:
    """Notices as their licences publish them.

    The GNU ones are cut to the words around the licence's name and version:
    a longer stretch is 0.8 alike from one of these licences to the next.
    """
    out = [(name, f"{start} under the {label} License{end}") for name, label in (("MIT", "MIT"), ("Apache-2.0", "Apache"), ("ISC", "ISC"))
           for start in ("Licensed", "Released") for end in ("", ".", ",")]
    out += [
        ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
                'documentation files (the "Software"), to deal in the Software without restriction'),
        ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
        ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
        ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                    "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ]
    gnu = (("GPL-2.0", "General", ";", "2"), ("GPL-3.0", "General", ",", "3"), ("LGPL-2.1", "Lesser General", ";", "2.1"),
           ("LGPL-3.0", "Lesser General", ",", "3"), ("AGPL-3.0", "Affero General", ",", "3"))
    for name, label, sign, version in gnu:
        out.append((name, f"the terms of the GNU {label} Public License as published by the Free Software Foundation{sign} either version {version} of the License"))
        out += [(name, f"GNU {label} Public License{comma} version {version}{end}") for comma in ("", ",") for end in ("", ".", ",")]
    out.append(("GPL-2.0", "the terms of the GNU General Public License as published by the Free Software Foundation; version 2 of the License"))
    for tail, label in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC", "Attribution-NonCommercial"),
                        ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")):
        out += [(f"CC-{tail}-4.0", f"licensed under {word} Creative Commons {label} 4.0 International License{end}") for word in ("a", "the") for end in ("", ".")]
        out += [(f"CC-{tail}-3.0", f"licensed under {word} Creative Commons {label.replace('NoDerivatives', 'NoDerivs')} 3.0 Unported License{end}")
                for word in ("a", "the") for end in ("", ".")]
        out += [(f"CC-{tail}-{v}", f"licensed under CC {tail} {v}{end}") for v in ("4.0", "3.0") for end in ("", ".", ",")]
    return out


#: A template's number is its place; new ones go to the end of their list.
TEMPLATES = SHORT + _notices() + BODIES
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is then evaluated once wherever the optimiser moves it."""
    return f"transform(array({value}), {name} -> {body})[0]"


def shingle_hashes(text_col: str) -> str:
    """Hashes of the five-word shingles of a text, in order."""
    words = (f"filter(split(translate(coalesce(`{text_col}`, ''), '{_UPPER}', '{_LOWER}'), '[ \\\\t\\\\n\\\\x0B\\\\f\\\\r]+'), v -> v <> '')")
    one = ", ".join(f"w[i + {j}]" for j in range(WORDS))
    return let(words, "w", f"CASE WHEN size(w) >= {WORDS} THEN transform(sequence(0, size(w) - {WORDS}), i -> xxhash64({one})) "
                           "ELSE cast(array() AS array<bigint>) END")


def band(hashes: str, number: int) -> str:
    """The key of a span of shingles in one band: its least value under the band's function."""
    return f"array_min(transform({hashes}, x -> xxhash64(x, {number})))"


def templates_of(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """(template, license, m, s, shingles): shingles in order, and distinct ones."""
    if sum(len(t) for _, t in templates) > MAX_TEMPLATE_CHARS:
        raise ValueError("templates are broadcast and must stay small")
    rows = spark.createDataFrame([(k, n, t) for k, (n, t) in enumerate(templates)], "template int, license string, t string")
    hashed = rows.select("template", "license", F.explode(F.expr(let(shingle_hashes("t"), "s", "CASE WHEN size(s) > 0 THEN array(s) ELSE array() END"))).alias("s"))
    return hashed.select(
        "template", "license", F.size("s").alias("m"), "s", F.array_distinct("s").alias("shingles"))


def longs(values: list[int]) -> str:
    return "array(" + ", ".join(f"{v}L" if v > -(1 << 63) else "(-9223372036854775807L - 1L)" for v in values) + ")"


def retrieved(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, s, found): texts that a window links to templates, with these.

    A window can share a band only if it holds the shingle that is a
    template's least one there, so bands are computed for windows around
    such shingles; all others share none.
    """
    bands = F.explode(F.array(*(F.struct(F.lit(b).alias("b"), F.expr(band("s", b)).alias("key"), F.expr(
        f"element_at(array_sort(transform(s, x -> struct(xxhash64(x, {b}) AS h, x AS x))), 1).x").alias("x")) for b in range(BANDS))))
    rows = known.select("template", "m", bands.alias("z")).select("template", "m", "z.*").collect()  # BANDS rows a template
    if not rows:
        return docs.select("doc_id", F.array().cast("array<bigint>").alias("s"), F.array().cast("array<int>").alias("found")).where("false")
    signs = longs(sorted({r.x for r in rows}))
    # a generator keeps the filter from being moved below, and the shingles from being made twice
    near = docs.select("doc_id", F.explode(F.expr(let(shingle_hashes("text"), "s", f"CASE WHEN arrays_overlap(s, {signs}) THEN array(s) ELSE array() END"))).alias("s"))
    near = stored(near.withColumn("at", F.expr(f"filter(transform(s, (x, i) -> CASE WHEN array_contains({signs}, x) THEN struct(i AS i, x AS x) END), p -> p IS NOT NULL)")),
                  "license_candidates")
    parts = []
    for m in sorted({r.m for r in rows}):
        step = max(1, m // 4)
        mine = longs(sorted({r.x for r in rows if r.m == m}))
        places = f"transform(filter(at, q -> array_contains({mine}, q.x)), q -> q.i)"  # signs of templates of this size only
        starts = (f"array_distinct(flatten(transform({places}, p -> transform(sequence(greatest(0, -((-(p - {m} + 1)) div {step})), greatest(0, p div {step})), "
                  f"k -> int(k * {step} + 1)))))")
        keys = ", ".join(band("z", b) for b in range(BANDS))
        ours = sorted({(r.b, r.key, r.template) for r in rows if r.m == m})
        table_keys = "array(" + ", ".join(f"struct({b} AS b, {longs([key])}[0] AS key, {t} AS t)" for b, key, t in ours) + ")"
        # per window: its band keys, then the templates that have one of them in the same band
        parts.append(f"flatten(transform(transform({starts}, i -> slice(s, i, {m})), z -> transform(filter("
                     f"transform({table_keys}, r -> struct(r.key AS want, array({keys})[r.b] AS have, r.t AS t)), q -> q.want = q.have), q -> q.t)))")
    return stored(near.withColumn("found", F.expr(f"array_distinct(flatten(array({', '.join(parts)})))")).where(F.size("found") > 0), "license_hits")


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, share: float = SHARE,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, template, license, n_template, n_found) of every template that a text holds."""
    known = templates_of(docs.sparkSession, templates)
    hits = retrieved(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), known).select("doc_id", "s", F.explode("found").alias("template"))
    verified = hits.join(F.broadcast(known.select("template", "license", "shingles")), "template").select(
        "doc_id", "template", "license", F.size("shingles").alias("n_template"), F.size(F.array_intersect("shingles", "s")).alias("n_found"))
    return verified.where(F.col("n_found") >= share * F.col("n_template"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    values = ", ".join("({}, '{}', '{}')".format(k, n, t.replace("'", "''")) for k, (n, t) in enumerate(TEMPLATES))

    def sets(text: str) -> str:
        words = (f"list_filter(string_split_regex(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), "
                 "'[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')")
        return f"(SELECT list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) FROM (SELECT {words} AS w))"

    return f"""
WITH templates AS (SELECT template, license, {sets('t')} AS ts FROM (VALUES {values}) v(template, license, t)),
docs AS (SELECT doc_id, {sets('text')} AS ds FROM documents)
SELECT doc_id, CAST(template AS INTEGER) AS template, license, CAST(len(ts) AS INTEGER) AS n_template,
       CAST(len(list_intersect(ts, ds)) AS INTEGER) AS n_found
FROM docs, templates WHERE len(ts) > 0 AND len(list_intersect(ts, ds)) >= {SHARE} * len(ts)
"""


#: Counts each template in every text, without windows or bands.
OP7_SQL = _sql()
