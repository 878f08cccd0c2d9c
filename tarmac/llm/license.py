"""op2: licence scan by the Dice coefficient of word bigrams.

Texts are cut into units that may state a licence: lines, sentences, and blocks of lines.
A unit and a licence template are normalised alike (lower case, letters and digits only)
and compared by 2 * common bigrams / all bigrams, counting repeats. Sizes bound the
coefficient (at most 2 * smaller / (smaller + larger)), so a unit meets only templates of
a fitting size, and only through bigrams they share. A text without any of the templates'
``signals`` cannot reach the threshold and is not cut up.

A notice may be spread over several units (paragraphs, sentences of a long line). Licences
that no unit of a document states are sought in its runs: any neighbouring sentences and
lines, also across empty lines. A run that reaches the threshold counts where no better run
overlaps it (``run_matches``); ``n_units`` is then the number of such runs.

DataFrame functions only. The templates are a fixed list, so their bigrams go to every
task; texts are not shuffled, only the bigrams they share with a template are.

Defined results for odd input: null and blank texts match nothing; rows that repeat an id
count a unit once; equal coefficients give each licence its row; a null id is a document.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.llm.common import once, staged, table

THRESHOLD = (85, 100)  # 100 * 2 * common >= 85 * all

# Licence notices as their publishers word them.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
        software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
        permissions and limitations under the License."""),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", """This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International
        License."""),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", """This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International
        License."""),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the
        GNU General Public License as published by the Free Software Foundation, either version 3 of the License,
        or (at your option) any later version. This program is distributed in the hope that it will be useful,
        but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
        PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without
        fee is hereby granted, provided that the above copyright notice and this permission notice appear in all
        copies."""),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice shall be included in all
        copies or substantial portions of the Software."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy
        of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
]


def signals(texts: list[str], threshold: tuple[int, int] = THRESHOLD) -> list[str]:
    """Words such that a unit with none of them stays below the threshold for every text.

    Without a template's bigrams that hold its chosen words, b of n are left, and the best
    unit made of those reaches 2 * b / (b + n). Words of many templates are chosen first,
    words of under five letters last.
    """
    num, den = threshold
    chosen: set[str] = set()
    split = [re.findall(r"[a-z0-9]+", text.lower()) for text in texts]
    spread = Counter(w for words in split for w in set(words))
    for words in split:
        pairs = Counter(zip(words, words[1:]))
        n = sum(pairs.values())
        for word in sorted(set(words), key=lambda w: (w not in chosen, len(w) < 5, -spread[w], -len(w), w)):
            left = sum(c for (a, b), c in pairs.items() if a not in chosen and b not in chosen)
            if den * 2 * left < num * (left + n):
                break
            chosen.add(word)
    return sorted(chosen)


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def units(text: Column) -> Column:
    """Lines, sentences of a line, and blocks of several lines between empty ones."""
    lines = F.split(text, "\n")
    sentences = F.flatten(F.transform(lines, lambda x: F.split(x, r"(?<=[.!?])[ \t]+")))
    blocks = F.filter(F.split(text, r"\n[ \t\r]*\n"), lambda b: F.contains(b, F.lit("\n")))
    return F.array_distinct(F.transform(F.concat(lines, sentences, blocks), normalised))


def with_bigrams(df: DataFrame, text: str) -> DataFrame:
    """``df`` plus ``n``, the number of word bigrams of the normalised text, and one row
    per bigram."""
    words = df.withColumn("_words", F.split(text, " ")).withColumn("n", F.size("_words") - 1).filter("n > 0")
    pairs = F.transform(F.sequence(F.lit(1), F.col("n")), lambda i: F.concat_ws(
        " ", F.element_at("_words", i.cast("int")), F.element_at("_words", (i + 1).cast("int"))))
    return words.withColumn("bigram", F.explode(pairs)).drop("_words")


def template_bigrams(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """(template, license, tn, bigram, tc): every template's bigrams with their counts."""
    rows = F.array(*[F.struct(F.lit(k).alias("template"), F.lit(name).alias("license"), F.lit(text).alias("text"))
                     for k, (name, text) in enumerate(templates)])
    texts = spark.range(1).select(F.inline(rows)).withColumn("text", normalised(F.col("text")))
    return (with_bigrams(texts, "text").groupBy("template", "license", F.col("n").alias("tn"), "bigram")
            .agg(F.count(F.lit(1)).alias("tc")))


def text_bigrams(texts: DataFrame) -> DataFrame:
    """(doc_id, key, bigram, pos, s, e) of the texts (doc_id, text): the bigram at word
    ``pos``, the first word of the sentence in which it begins and the last word of the one
    in which it ends. ``key`` names the row's id and text."""
    key = F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.col("text")), 256)
    pieces = F.split("text", r"\n|(?<=[.!?])[ \t]+")
    split = once(texts, _pieces=F.filter(F.transform(pieces, lambda p: F.split(normalised(p), " ")),
                                         lambda w: w[0] != ""))
    split = split.select("doc_id", key.alias("key"), F.flatten(F.transform("_pieces", lambda w: F.transform(
        w, lambda x, k: F.struct(x.alias("w"), k.alias("k"), F.size(w).alias("n"))))).alias("_words"))
    split = once(split, _w=F.col("_words")).filter(F.size("_w") > 1)
    pairs = F.transform(F.sequence(F.lit(0), F.size("_w") - 2), lambda i: F.struct(
        F.concat_ws(" ", F.col("_w")[i]["w"], F.col("_w")[i + 1]["w"]).alias("bigram"), i.alias("pos"),
        (i - F.col("_w")[i]["k"]).alias("s"),
        (i + F.col("_w")[i + 1]["n"] - F.col("_w")[i + 1]["k"]).alias("e")))
    return split.select("doc_id", "key", F.inline(pairs))


def run_matches(texts: DataFrame, known: DataFrame, most: int, threshold: tuple[int, int]) -> DataFrame:
    """(doc_id, license, n_units, best_dice) by runs of neighbouring sentences and lines of
    the texts (doc_id, text); ``most`` bounds a run's bigrams.

    A run begins in a sentence in which a bigram of the template begins and ends in one in
    which such a bigram ends: more sentences only lower its coefficient. Where fewer of the
    template's bigrams stand within its largest size than any match must share, no run is
    formed. All joins are within a text and a stretch of ``most + 1`` words.
    """
    num, den = F.lit(threshold[0]), F.lit(threshold[1])
    width = F.lit(most + 1)
    place = lambda c: F.floor(F.col(c) / width)
    hits = text_bigrams(texts).join(known, "bigram").distinct()
    # common >= num / (2 * den - num) * tn, and n <= (2 * den - num) / num * tn.
    largest = (2 * den - num) * F.col("tn") / num
    text_order = Window.partitionBy("key", "template").orderBy(F.col("pos") / (largest + 1))
    near = lambda a, b: F.count(F.lit(1)).over(text_order.rangeBetween(a, b))
    dense = (hits.withColumn("before", near(-1, 0)).withColumn("after", near(0, 1))
             .withColumn("rank", F.count(F.lit(1)).over(text_order.rowsBetween(Window.unboundedPreceding, 0)))
             .withColumn("least", num * F.col("tn") / (2 * den - num) - 1e-6))
    begin = (dense.filter("after >= least").groupBy("doc_id", "key", "template", "license", "tn", "s")
             .agg(F.min("rank").alias("first")).withColumn("place", place("s")))
    end = (dense.filter("before >= least").groupBy("key", "template", "e").agg(F.max("rank").alias("last"))
           .withColumn("place", F.explode(F.array(place("e"), place("e") - 1))))
    n = F.col("e") - F.col("s")
    runs = (begin.join(end, ["key", "template", "place"]).withColumn("n", n)
            .filter((F.col("n") > 0) & (2 * den * F.least("n", "tn", F.col("last") - F.col("first") + 1)
                                        >= num * (F.col("n") + F.col("tn")))))
    parts = hits.select("key", "template", "bigram", "pos", "tc",
                        F.explode(F.array(place("pos"), place("pos") - 1)).alias("place"))
    run = ["doc_id", "key", "template", "license", "tn", "s", "e", "n"]
    common = (runs.join(parts, ["key", "template", "place"]).filter("pos >= s and pos < e")
              .groupBy(*run, "bigram").agg(F.least(F.count(F.lit(1)), F.max("tc")).alias("c"))
              .groupBy(*run).agg(F.sum("c").alias("c")))
    alike = common.filter(2 * den * F.col("c") >= num * (F.col("n") + F.col("tn")))
    alike = staged(alike.groupBy("doc_id", "key", "license", "s", "e")
                   .agg(F.max(2.0 * F.col("c") / (F.col("n") + F.col("tn"))).alias("d")), "license-runs")
    # A run counts where no better one of its licence overlaps it, and none of another
    # licence overlaps half of it: it states the licence it is closest to.
    other = alike.select("key", *[F.col(c).alias("o_" + c) for c in ("license", "s", "e", "d")])
    other = other.withColumn("place", F.explode(F.transform(F.array(*map(F.lit, (-1, 0, 1))),
                                                            lambda k: place("o_s") + k)))
    shared = F.least("e", "o_e") - F.greatest("s", "o_s") + 1
    same = F.col("license") == F.col("o_license")
    better = (same & ((F.col("o_d") > F.col("d")) | (F.col("o_d") == F.col("d")) & (
        (F.col("o_s") < F.col("s")) | (F.col("o_s") == F.col("s")) & (F.col("o_e") < F.col("e"))))
        | ~same & (F.col("o_d") > F.col("d")) & (2 * shared >= F.col("e") - F.col("s") + 1))
    mine = alike.withColumn("place", place("s"))
    beaten = (mine.join(other, ["key", "place"]).filter((shared > 0) & better)
              .select("key", "license", "s", "e").distinct())
    best = alike.join(beaten, ["key", "license", "s", "e"], "left_anti")
    return best.groupBy("doc_id", "license").agg(F.count(F.lit(1)).alias("n_units"), F.max("d").alias("best_dice"))


def license_matches(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES,
                    threshold: tuple[int, int] = THRESHOLD, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, license, n_units, best_dice): the licences a document states, with the
    number of its distinct units that do (of its runs, where no unit does) and the best
    coefficient."""
    num, den = threshold
    known = F.broadcast(template_bigrams(docs.sparkSession, templates))  # a fixed list
    sizes = [len(re.findall(r"[a-z0-9]+", t.lower())) - 1 for _, t in templates]
    # 2 * s / (s + n) >= num / den bounds n for the smallest and the largest template.
    least, most = min(sizes) * num // (2 * den - num), -(-max(sizes) * (2 * den - num) // num)
    texts = once(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("_text")),
                 text=F.lower("_text")).select("doc_id", "text")
    hopeful = reduce(lambda a, b: a | b, [F.contains("text", F.lit(s)) for s in signals([t for _, t in templates],
                                                                                        threshold)])
    texts = texts.filter(hopeful)
    found = texts.select("doc_id", F.explode(units(F.col("text"))).alias("unit"))
    spaces = F.length("unit") - F.length(F.replace("unit", F.lit(" ")))  # bigrams of the unit
    found = found.filter(spaces.between(least, most)).distinct()
    num_, den_ = F.lit(num), F.lit(den)
    shared = (with_bigrams(found, "unit").join(known, "bigram")
              .filter(2 * den_ * F.least("n", "tn") >= num_ * (F.col("n") + F.col("tn"))))
    common = (shared.groupBy("doc_id", "unit", "n", "template", "license", "tn", "bigram")
              .agg(F.least(F.count(F.lit(1)), F.max("tc")).alias("c"))
              .groupBy("doc_id", "unit", "n", "template", "license", "tn").agg(F.sum("c").alias("c")))
    alike = common.filter(2 * den_ * F.col("c") >= num_ * (F.col("n") + F.col("tn")))
    best = alike.groupBy("doc_id", "unit", "license").agg(F.max(2.0 * F.col("c") / (F.col("n") + F.col("tn"))).alias("d"))
    # A unit states the licence it is closest to.
    closest = Window.partitionBy("doc_id", "unit")
    best = best.withColumn("top", F.max("d").over(closest)).filter("d = top")
    single = staged(best.groupBy("doc_id", "license").agg(F.count(F.lit(1)).alias("n_units"),
                                                          F.max("d").alias("best_dice")), "license-units")
    runs = run_matches(texts, known, most, threshold)
    stated = single.select(F.col("doc_id").alias("_id"), F.col("license").alias("_license"))
    more = runs.join(stated, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("license") == F.col("_license")),
                     "left_anti")
    return single.unionByName(more)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_matches(table(spark, sf_dir, "documents"))


_VALUES = ", ".join("({}, '{}', '{}')".format(k, name, text.replace("'", "''"))
                    for k, (name, text) in enumerate(TEMPLATES))

ORACLE = rf"""
with templates(template, license, t) as (values {_VALUES}),
twords as (
  select template, license, string_split(trim(regexp_replace(lower(t), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') w
  from templates),
tgrams as (
  select template, license, len(w) - 1 tn, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) b
  from twords),
tcounts as (select template, license, tn, b, count(*) tc from tgrams group by all),
lines as (
  select doc_id, text, unnest(string_split(text, chr(10))) u from documents),
cut as (
  select doc_id, u from lines
  union all
  select doc_id, unnest(string_split(regexp_replace(u, '([.!?])[ \t]+', '\1' || chr(10), 'g'), chr(10))) from lines
  union all
  select doc_id, u from (
    select doc_id, unnest(string_split_regex(text, '\n[ \t\r]*\n')) u from documents) where contains(u, chr(10))),
units as (
  select distinct doc_id, trim(regexp_replace(lower(u), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) u from cut),
words as (select doc_id, u, string_split(u, ' ') w from units),
grams as (
  select doc_id, u, len(w) - 1 n, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) b
  from words),
counts as (select doc_id, u, n, b, count(*) c from grams group by all),
common as (
  select doc_id, u, n, template, license, tn, sum(least(c, tc)) c
  from counts join tcounts using (b) group by all),
best as (
  select doc_id, u, license, max(2.0 * c / (n + tn)::double) d from common
  where 200 * c >= 85 * (n + tn) group by all)
select doc_id, license, count(*) n_units, max(d) best_dice
from (select *, max(d) over (partition by doc_id, u) top from best) where d = top group by all
"""
