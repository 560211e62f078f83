"""Licence notices by Dice coefficient over word bigrams.

A unit (the whole text, a line, or a sentence of a longer line) is normalised to lower-case
letters and digits. Its distinct word bigrams are compared with those of each template;
a template is a candidate only if the sizes alone leave room for the threshold.

A notice may also be wrapped over lines, or be a part of a longer line. So for every
template, runs of words that begin and end with its bigrams are measured too, from the
places where enough of its bigrams lie close together.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltwatch.llm.common import lowered, nonnull_text, staged

# Public notices and permission texts that the licences ask to be quoted.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "BSD": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
}


@dataclass(frozen=True)
class LicenceSpec:
    least: float = 0.8


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(lowered(text), "[^a-z0-9]+", " "))


def _pairs(words: Column) -> Column:
    after = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    return F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), after, lambda a, b: F.concat_ws(" ", a, b))


def bigrams(words: Column) -> Column:
    """Distinct pairs of neighbouring words."""
    return F.array_distinct(_pairs(words))


def plain_bigrams(text: str) -> set[tuple[str, str]]:
    kept = "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()
    return set(zip(kept, kept[1:], strict=False))


def telling_bigrams(least: float) -> list[tuple[str, str]]:
    """Bigrams, at least one of which is in any text with a notice.

    Units at the threshold share at least t / (2 - t) of a template's bigrams, so of more
    bigrams than the rest, one is in the text. Long ones are taken, as they are rare.
    """
    found = set()
    for text in (t for _, texts in sorted(TEMPLATES.items()) for t in texts):
        pairs = sorted(plain_bigrams(text), key=lambda p: (-len(p[0] + p[1]), p))
        found |= set(pairs[: int(len(pairs) * (1 - least / (2 - least)) + 1e-9) + 1])
    return sorted(found)


def likely(docs: DataFrame, least: float) -> DataFrame:
    """(row, doc_id, text) of rows that can hold a notice."""
    after: dict[str, list[str]] = {}
    for one, two in telling_bigrams(least):
        after.setdefault(one, []).append(two)
    pattern = f"(?<![a-z0-9])(?:{'|'.join(f'{one}[^a-z0-9]++(?:' + '|'.join(twos) + ')' for one, twos in after.items())})(?![a-z0-9])"
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), nonnull_text().alias("text")).where(lowered(F.col("text")).rlike(pattern))
    return staged(own.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "licence-texts")


def units(rows: DataFrame) -> DataFrame:
    """(row, doc_id, level, unit, words): the text if it has lines, each line, and each sentence of a line with several."""
    rows = rows.select("row", "doc_id", F.explode(F.array("text")).alias("text"))
    lines = F.split("text", "\n", -1)
    whole = F.struct(F.lit("text").alias("level"), F.lit(0).alias("unit"), F.lit(0).alias("part"), F.col("text").alias("own"))
    each = F.transform(lines, lambda x, i: F.struct(F.lit("line").alias("level"), i.alias("unit"), F.lit(0).alias("part"), x.alias("own")))
    cut = F.transform(
        lines,
        lambda x, i: F.transform(F.split(x, r"[.!?][\x20\x09-\x0D]+", -1), lambda s, j: F.struct(F.lit("sentence").alias("level"), i.alias("unit"), j.alias("part"), s.alias("own"))),
    )
    cut = F.flatten(F.filter(cut, lambda s: F.size(s) > 1))
    every = F.concat(F.when(F.size(lines) > 1, F.array(whole)).otherwise(F.slice(F.array(whole), 1, 0)), each, cut)
    return rows.select("row", "doc_id", F.explode(every).alias("u")).select("row", "doc_id", "u.*")


def runs(rows: DataFrame, found: DataFrame, templates: DataFrame, least: float, longest: int) -> DataFrame:
    """Runs of words with a notice, at most half covered by the units ``found``: (row, doc_id, unit, part, licence, k, n, m, shared, dice).

    ``unit`` is the line where a run begins and ``part`` its first word in the text. Of
    runs that overlap the one with most of dice times template size counts; ties go to
    the earlier, then the shorter one.
    """
    ratio = least / (2 - least)
    sentence = lambda x, i: F.flatten(F.transform(
        F.split(x, r"[.!?][\x20\x09-\x0D]+", -1),
        lambda s, j: F.transform(F.filter(F.split(normalised(s), " "), lambda w: w != ""), lambda w: F.struct(w.alias("w"), i.alias("unit"), j.alias("part"))),
    ))
    words = rows.select("row", F.flatten(F.transform(F.split("text", "\n", -1), sentence)).alias("ws"))
    words = words.where(F.size("ws") > 1)
    words = words.select("row", F.col("ws.unit").alias("units"), F.col("ws.part").alias("parts"), _pairs(F.col("ws.w")).alias("pairs"))
    hits = words.select("row", F.posexplode("pairs").alias("at", "bigram")).join(templates, "bigram")
    ahead = Window.partitionBy("row", "template").orderBy("at").rangeBetween(0, longest - 1)
    near = F.filter(F.collect_list(F.struct("at", "bigram")).over(ahead), lambda e: e["at"] < F.col("at") + F.col("m") / ratio)
    begins = hits.withColumn("near", near).where(F.size("near") >= F.col("m") * ratio)
    begins = begins.where(F.size(F.array_distinct("near.bigram")) >= F.col("m") * ratio)
    begins = staged(begins.select("row", "licence", "k", "m", "at", "near"), "licence-begins")
    words = words.join(begins.select("row").distinct(), "row", "left_semi")
    ends = begins.select("row", "licence", "k", "m", F.col("at").alias("lo"), "near", F.explode("near.at").alias("hi"))
    shared = F.size(F.array_distinct(F.transform(F.filter("near", lambda e: e["at"] <= F.col("hi")), lambda e: e["bigram"])))
    ends = ends.withColumn("shared", shared.cast("long")).drop("near").where(F.col("shared") >= F.col("m") * ratio)
    n = F.size(F.array_distinct(F.slice("pairs", F.col("lo") + 1, F.col("hi") - F.col("lo") + 1)))
    dice = ends.join(words.select("row", "pairs"), "row").withColumn("n", n).drop("pairs")
    dice = dice.withColumn("dice", 2.0 * F.col("shared") / (F.col("n") + F.col("m"))).where(F.col("dice") >= least)
    order = F.struct((-F.col("dice") * F.col("m")).alias("d"), "licence", "k", (F.col("hi") - F.col("lo")).alias("size"))
    best = F.struct("lo", "hi", "licence", "k", "shared", "n", "m", "dice")
    heads = dice.groupBy("row", "lo").agg(F.min(F.struct(order.alias("o"), best.alias("b"))).alias("x"))
    listed = heads.groupBy("row").agg(F.sort_array(F.collect_list(F.struct(F.col("x.o.d").alias("d"), "lo", F.col("x.o.size").alias("size"), F.col("x.b").alias("b")))).alias("all"))
    apart = lambda kept, b: ~F.exists(kept, lambda o: (b["lo"] <= o["hi"] + 1) & (o["lo"] <= b["hi"] + 1))
    none = F.slice(F.transform("all", lambda a: a["b"]), 1, 0)
    kept = F.aggregate("all", none, lambda kept, a: F.when(apart(kept, a["b"]), F.array_append(kept, a["b"])).otherwise(kept))
    kept = listed.select("row", F.explode(kept).alias("b")).select("row", "b.*")
    marks = found.groupBy("row").agg(F.collect_set(F.struct("level", "unit", "part")).alias("marks"))
    placed = kept.join(words.select("row", "units", "parts"), "row").join(marks, "row", "left")
    covered = F.filter(
        F.sequence("lo", F.col("hi") + 1),
        lambda i: F.exists("marks", lambda x: (x["level"] == "text") | (x["unit"] == F.get("units", i)) & ((x["level"] == "line") | (x["part"] == F.get("parts", i)))),
    )
    placed = placed.where(2 * F.coalesce(F.when(F.col("marks").isNull(), F.lit(0)).otherwise(F.size(covered)), F.lit(0)) <= F.col("hi") - F.col("lo") + 2)
    return placed.join(rows.select("row", "doc_id"), "row").select("row", "doc_id", F.get("units", F.col("lo")).alias("unit"), F.col("lo").alias("part"), "licence", "k", "n", "m", "shared", "dice")


def licences(docs: DataFrame, spec: LicenceSpec = LicenceSpec()) -> DataFrame:
    """One row per unit that holds a notice: doc_id, level, unit, part, licence, shared, unit_bigrams, template_bigrams, dice.

    Levels are text, line, sentence and run. A run is a notice of consecutive words that
    the other units with a notice do not cover by more than half, such as a wrapped one
    (unit is the line where it begins, part its first word counted in the text).

    The best template counts; ties go to the licence that comes first, then to its
    lowest template number. Null and
    blank texts, and units of one word, match nothing. Rows that repeat a doc_id appear
    each; a null doc_id stays null. Other columns are ignored.
    """
    known = [(name, k, plain_bigrams(text)) for name, texts in sorted(TEMPLATES.items()) for k, text in enumerate(texts)]
    spark = docs.sparkSession
    t = spec.least
    sizes = [len(b) for _, _, b in known]
    # Dice of sets of n and m is at most 2 min(n, m) / (n + m).
    low, high = min(sizes) * t / (2 - t), max(sizes) * (2 - t) / t
    listed = [(n, name, k, len(b), " ".join(p)) for n, (name, k, b) in enumerate(known) for p in sorted(b)]
    templates = F.broadcast(spark.createDataFrame(listed, "template int, licence string, k int, m int, bigram string"))
    # Fewer characters than a bigram needs, or more than the largest unit can have, need no split.
    rows = likely(docs, t)
    own = units(rows).where(F.length("own") >= 3).withColumn("words", F.split(normalised(F.col("own")), " ")).drop("own")
    own = own.where(F.size("words") > low)
    own = own.select("row", "doc_id", "level", "unit", "part", F.monotonically_increasing_id().alias("u"), bigrams(F.col("words")).alias("pairs"))
    own = own.withColumn("n", F.size("pairs")).where(F.col("n").between(low, high))
    hits = own.select("row", "doc_id", "level", "unit", "part", "u", "n", F.explode("pairs").alias("bigram")).join(templates, "bigram")
    fits = (F.col("n") >= F.col("m") * t / (2 - t)) & (F.col("n") <= F.col("m") * (2 - t) / t)
    counts = hits.where(fits).groupBy("u", "row", "doc_id", "level", "unit", "part", "licence", "k", "n", "m").agg(F.count(F.lit(1)).alias("shared"))
    dice = counts.withColumn("dice", 2.0 * F.col("shared") / (F.col("n") + F.col("m"))).where(F.col("dice") >= t)
    rank = F.struct((-F.col("dice")).alias("d"), "licence", "k")
    best = dice.groupBy("u", "row", "doc_id", "level", "unit", "part").agg(F.min_by(F.struct("licence", "shared", "n", "m", "dice"), rank).alias("b"))
    best = staged(best.select("row", "doc_id", "level", "unit", "part", "b"), "licence-units")
    more = runs(rows, best, templates, t, int(high) + 1)
    more = more.select("row", "doc_id", F.lit("run").alias("level"), "unit", "part", F.struct("licence", "shared", "n", "m", "dice").alias("b"))
    return best.unionByName(more).select(
        "doc_id", "level", F.col("unit").cast("long").alias("unit"), F.col("part").cast("long").alias("part"), F.col("b.licence").alias("licence"),
        F.col("b.shared").alias("shared"), F.col("b.n").cast("long").alias("unit_bigrams"), F.col("b.m").cast("long").alias("template_bigrams"), F.col("b.dice").alias("dice"),
    )


def sql() -> str:
    values = ", ".join(f"('{name}', {k}, '{text.replace(chr(39), chr(39) * 2)}')" for name, texts in sorted(TEMPLATES.items()) for k, text in enumerate(texts))
    words = lambda c: f"list_filter(string_split(regexp_replace(translate({c}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '')"
    pairs = lambda w: f"list_distinct(list_transform(range(1, greatest(len({w}), 1)), lambda i: {w}[i] || ' ' || {w}[i + 1]))"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, generate_subscripts(ls, 1) - 1 AS unit, unnest(ls) AS own FROM d),
s AS (SELECT r, doc_id, unit, string_split_regex(own, '[.!?][\\x20\\x09-\\x0D]+') AS parts FROM l),
u AS (SELECT r, doc_id, 'text' AS level, 0 AS unit, 0 AS part, text AS own FROM d WHERE len(ls) > 1
      UNION ALL SELECT r, doc_id, 'line', unit, 0, own FROM l
      UNION ALL SELECT r, doc_id, 'sentence', unit, generate_subscripts(parts, 1) - 1, unnest(parts) FROM s WHERE len(parts) > 1),
w AS (SELECT *, {words('own')} AS ws FROM u),
b AS (SELECT * EXCLUDE (own, ws), {pairs('ws')} AS ps FROM w WHERE len(ws) >= 2),
t0(licence, k, own) AS (VALUES {values}),
t1 AS (SELECT licence, k, {words('own')} AS ws FROM t0),
t AS (SELECT licence, k, {pairs('ws')} AS ps FROM t1),
tp AS (SELECT licence, k, len(ps) AS m, unnest(ps) AS p FROM t),
bp AS (SELECT r, doc_id, level, unit, part, len(ps) AS n, unnest(ps) AS p FROM b),
c AS (SELECT r, doc_id, level, unit, part, licence, k, n, m, count(*) AS shared FROM bp JOIN tp USING (p) GROUP BY ALL),
x AS (SELECT *, 2.0 * shared / (n + m) AS dice FROM c WHERE 2.0 * shared / (n + m) >= 0.8),
o AS (SELECT *, row_number() OVER (PARTITION BY r, level, unit, part ORDER BY dice DESC, licence, k) AS best FROM x)
SELECT doc_id, level, unit::BIGINT AS unit, part::BIGINT AS part, licence, shared, n::BIGINT AS unit_bigrams, m::BIGINT AS template_bigrams, dice::DOUBLE AS dice
FROM o WHERE best = 1
"""
