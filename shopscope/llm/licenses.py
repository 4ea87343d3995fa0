"""Licence scan by the Dice coefficient over word bigrams, in DataFrame functions only.

A licence may be a whole file, a block or a single line, so a text is compared as a whole, by paragraphs, by lines and
by sentences. Only templates whose number of bigrams allows the wanted coefficient are candidates for a part: for a
coefficient of t, sizes lie between t / (2 - t) and (2 - t) / t times the template's. These sizes are spelled out, so
parts meet templates in a plain equality join with a table of a few thousand rows that does not grow with the data.

Where line ends and punctuation divide a notice (wrapped in a comment, or inside a longer line), no such part is the
notice, so windows of words are compared as well. A template's word pairs lie in a text in runs of neighbouring places.
Leaving out a pair at a window's end that the template lacks never lowers the coefficient, nor does adding one that it
has, so the best window begins with a run and ends with one, and only these are measured, up to (2 - t) / t times the
template's length (one run may be longer). The best of parts and windows is reported.

Texts that can't match are left out by the words they hold: a match shares at least t / (2 - t) of a template's
bigrams, so it holds at least one of any words that together touch more of the template's bigrams than may be missing.

Defined cases: null and empty texts match nothing; parts of fewer than two words have no bigrams and match nothing;
parts that repeat within a text count once; a licence that only windows match has no parts; rows that repeat a doc_id are reported together; an empty table gives no
rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopscope.llm.native_words import BETWEEN, words

THRESHOLD = 0.8
# Notices and openings of well-known public licences.
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
    "BSD": [
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ],
    "LGPL-3.0": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "LGPL-2.1": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."],
    "AGPL-3.0": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"],
    "Zlib": ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "0BSD": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
}
COMMON = set("a an and any as at be by for from in is it may not of on or that the this to under use was with work you".split())


def words_of(text: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def telling_words(text: str, threshold: float) -> set[str]:
    """Words of which every match of the template holds at least one: they touch more bigrams than a match may miss."""
    own = words_of(text)
    left = set(zip(own, own[1:]))
    missing, chosen = int(len(left) * (1 - threshold / (2 - threshold)) + 1e-9), set()
    touched = 0
    while touched <= missing:
        counts = Counter(w for pair in left for w in set(pair))
        word = max(counts, key=lambda w: (w not in COMMON, len(w) * counts[w], w))
        touched += counts[word]
        left = {pair for pair in left if word not in pair}
        chosen.add(word)
    return chosen


def parts(text: Column) -> Column:
    """The whole text, its paragraphs, lines and sentences, without repeats."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    sentences = F.split(F.regexp_replace(text, r"([.!?;])\s+", "$1\n"), "\n")
    return F.array_distinct(F.concat(F.array(text), F.split(text, r"\n\s*\n"), F.split(text, "\n"), sentences))


def bigrams(own: Column) -> Column:
    """Distinct pairs of neighbouring words; takes a column of words that is not computed anew for each pair."""
    pairs = F.transform(F.sequence(F.lit(0), F.size(own) - 2), lambda i: F.concat_ws(" ", F.get(own, i), F.get(own, i + 1)))
    return F.array_distinct(F.when(F.size(own) >= 2, pairs).otherwise(F.array().cast("array<string>")))


def windows(held: DataFrame, templates: dict[str, list[str]], threshold: float) -> DataFrame:
    """doc_id, license, part (a window's bigrams) and dice of each window that matches."""
    sets = [(name, sorted(set(zip(own, own[1:])))) for name, texts in templates.items() for own in map(words_of, texts)]
    sets = [(name, [" ".join(pair) for pair in pairs]) for name, pairs in sets if pairs]
    if not sets:
        return held.select("doc_id", F.lit("").alias("license"), F.array(F.lit("")).alias("part"), F.lit(0.0).alias("dice")).where("false")
    strings = lambda values: F.array(*map(F.lit, values))
    known = F.array(
        *(
            F.struct(
                F.lit(name).alias("license"),
                strings(pairs).alias("template"),
                F.lit(math.ceil(len(pairs) * threshold / (2 - threshold) - 1e-9)).alias("need"),
                F.lit(math.floor(len(pairs) * (2 - threshold) / threshold + 1e-9)).alias("limit"),
            )
            for name, pairs in sets
        )
    )
    every = sorted({pair for _, pairs in sets for pair in pairs})
    split = held.select("doc_id", words(F.col("text")).alias("own"))
    own = F.col("own")
    pairs = F.transform(own, lambda word, i: F.struct(i.alias("at"), F.concat_ws(" ", word, F.get(own, i + 1)).alias("pair")))
    hits = split.select("doc_id", "own", F.filter(pairs, lambda p: p["pair"].isin(every)).alias("hits"))
    # templates with enough hits close together; the hits of one are bound by a list of one, not found again for each
    of = lambda t: F.filter("hits", lambda h: F.array_contains(t["template"], h["pair"]))
    close = lambda mine, t: F.exists(F.transform(mine, lambda h, k: F.get(mine, k + t["need"] - 1)["at"] - h["at"] < t["limit"]), lambda x: x)
    near = F.filter(known, lambda t: F.exists(F.array(of(t)), lambda mine: close(mine, t)))
    met = hits.select("doc_id", "own", "hits", F.explode(near).alias("t"))
    met = met.select("doc_id", "own", "t", F.transform(of(F.col("t")), lambda h: h["at"]).alias("mine"))
    mine, limit = F.col("mine"), F.col("t")["limit"]
    firsts = F.filter(mine, lambda at, k: ~F.coalesce(F.get(mine, k - 1) == at - 1, F.lit(False)))
    lasts = F.filter(mine, lambda at, k: ~F.coalesce(F.get(mine, k + 1) == at + 1, F.lit(False)))
    runs = met.select("doc_id", "own", "t", firsts.alias("firsts"), lasts.alias("lasts"))
    ends = lambda first, k: F.filter(F.slice("lasts", k + 1, limit), lambda last, j: (j == 0) | (last - first < limit))
    pieces = F.flatten(F.transform("firsts", lambda first, k: F.transform(ends(first, k), lambda last: F.slice("own", first + 1, last - first + 2))))
    cut = runs.select("doc_id", "t", F.explode(pieces).alias("own"))
    measured = cut.select("doc_id", "t", bigrams(own).alias("part"))
    shared = F.size(F.array_intersect("part", F.col("t")["template"]))
    dice = 2 * shared / (F.size("part") + F.size(F.col("t")["template"]))
    return measured.select("doc_id", F.col("t")["license"].alias("license"), "part", dice.alias("dice")).where(F.col("dice") >= threshold)


def scan(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, license, the best ``dice`` of its templates over parts and windows, and how many different parts match it."""
    spark = docs.sparkSession
    known = spark.createDataFrame([(name, text) for name, texts in templates.items() for text in texts], "license string, template string")
    known = known.select("license", words(F.col("template")).alias("own")).select("license", bigrams(F.col("own")).alias("template"))
    n = F.size("template")
    sizes = F.sequence(F.ceil(n * (threshold / (2 - threshold)) - 1e-9).cast("int"), F.floor(n * ((2 - threshold) / threshold) + 1e-9).cast("int"))
    known = known.select("license", "template", F.explode(sizes).alias("n"))
    telling = sorted(set().union(*(telling_words(text, threshold) for texts in templates.values() for text in texts)))
    held = docs.select("doc_id", "text").where(F.lower("text").rlike(rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(telling)})(?![\p{{L}}\p{{N}}])"))
    split = held.select("doc_id", F.explode(parts(F.col("text"))).alias("part")).select("doc_id", words(F.col("part")).alias("own"))
    measured = split.select("doc_id", bigrams(F.col("own")).alias("part")).withColumn("n", F.size("part"))
    both = measured.join(F.broadcast(known), "n")  # the templates' possible sizes: bounded by the templates
    shared = F.size(F.array_intersect("part", "template"))
    scored = both.select("doc_id", "license", "part", (2 * shared / (F.col("n") + F.size("template"))).alias("dice")).where(F.col("dice") >= threshold)
    key = F.xxhash64(F.array_join("part", "|")).alias("part")
    by_parts = scored.select("doc_id", "license", key, "dice")
    by_windows = windows(held, templates, threshold).select("doc_id", "license", F.lit(None).cast("long").alias("part"), "dice")
    best = by_parts.union(by_windows).groupBy("doc_id", "license", "part").agg(F.max("dice").alias("dice"))
    return best.groupBy("doc_id", "license").agg(F.max("dice").alias("dice"), F.count("part").alias("parts"))


def _sql() -> str:
    rows = ", ".join(f"('{name}', '{text.replace(chr(39), chr(39) * 2)}')" for name, texts in TEMPLATES.items() for text in texts)
    own = lambda text: f"list_filter(string_split_regex(lower({text}), '{BETWEEN}'), lambda x: x <> '')"
    pairs = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    return f"""
with t(license, template) as (values {rows}),
tb as (select license, {pairs} as b from (select license, {own("template")} as w from t)),
p as (select doc_id, unnest(list_distinct(list_concat([text], string_split_regex(text, '\\n\\s*\\n'), string_split(text, chr(10)),
        string_split(regexp_replace(text, '([.!?;])\\s+', '\\1' || chr(10), 'g'), chr(10))))) as part from documents where text is not null),
pb as (select distinct doc_id, {pairs} as b from (select doc_id, {own("part")} as w from p)),
m as (select doc_id, license, pb.b as part, max(2 * len(list_intersect(pb.b, tb.b)) / (len(pb.b) + len(tb.b))) as dice
      from pb, tb where len(list_intersect(pb.b, tb.b)) > 0 group by all having dice >= 0.8),
d as (select row_number() over () as r, doc_id, {own("text")} as w from documents where text is not null),
g as (select r, i as place, w[i] || ' ' || w[i + 1] as pair from d, unnest(range(1, len(w))) as x(i)),
tp as (select row_number() over () as k, license, b, ceil(len(b) * 2 / 3 - 1e-9) as need, floor(len(b) * 3 / 2 + 1e-9) as lim from tb),
h as (select r, k, place from g join (select k, unnest(b) as pair from tp) using (pair)),
e as (select r, k, place, coalesce(lag(place) over v <> place - 1, true) as first, coalesce(lead(place) over v <> place + 1, true) as last
      from h join (select r, k from h join tp using (k) group by r, k, need having count(*) >= need) using (r, k) window v as (partition by r, k order by place)),
s as (select a.r, a.k, a.place as low, z.place as high from e a join e z on a.r = z.r and a.k = z.k and a.first and z.last and z.place >= a.place
      join tp on a.k = tp.k where z.place - a.place < lim or z.place = (select min(y.place) from e y where y.r = a.r and y.k = a.k and y.last and y.place >= a.place)),
sb as (select doc_id, k, {pairs} as b from (select doc_id, k, w[low:high + 1] as w from s join d using (r))),
n as (select doc_id, license, max(2 * len(list_intersect(sb.b, tp.b)) / (len(sb.b) + len(tp.b))) as dice from sb join tp using (k) group by all having dice >= 0.8)
select doc_id, license, max(dice) as dice, count(part) as parts
from (select doc_id, license, dice, part from m union all select doc_id, license, dice, null from n) group by doc_id, license
"""


SQL = _sql()
