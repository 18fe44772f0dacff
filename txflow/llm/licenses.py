"""Licence scans: normalised passages against licence templates by Dice coefficient over word bigrams."""

from __future__ import annotations

import re
from math import ceil, floor

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txflow.llm.common import NOT_SPACE

THRESHOLD = 0.8

# The wording of public licence notices, each with its usual identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance'
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless"
        " required by applicable law or agreed to in writing, software distributed under the License is distributed on"
        ' an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for'
        " the specific language governing permissions and limitations under the License.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        ' documentation files (the "Software"), to deal in the Software without restriction, including without'
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the"
        " Software, and to permit persons to whom the Software is furnished to do so, subject to the following"
        " conditions: The above copyright notice and this permission notice shall be included in all copies or"
        ' substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS'
        " OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE"
        " AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR"
        " OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION"
        " WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met:",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("all-rights-reserved", "All rights reserved."),
)


def normal_words(text: str) -> list[str]:
    """Words of a template: runs of ASCII letters and digits, A-Z in lower case."""
    return [w for w in re.split("[^a-z0-9]+", text.lower()) if w]


def size_bounds(n: int, threshold: float) -> tuple[int, int]:
    """The bigram counts that a passage can have if its Dice coefficient with ``n`` bigrams reaches the threshold.

    The common bigrams are no more than the smaller set, so 2 min / (min + max) >= threshold.
    """
    ratio = threshold / (2 - threshold)
    return max(1, ceil(n * ratio - 1e-9)), floor(n / ratio + 1e-9)


def _templates(templates, threshold):
    for name, text in templates:
        w = normal_words(text)
        pairs = sorted(set(zip(w, w[1:], strict=False)))
        if pairs:
            yield (name, pairs, *size_bounds(len(pairs), threshold))


def _normal(text: Column) -> Column:
    ascii_lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.btrim(F.regexp_replace(ascii_lower, "[^a-z0-9]+", " "))


def _scores(passage: Column, known: list) -> Column:
    """Dice coefficients with each template; 0 where the numbers of bigrams alone rule a match out.

    Each step is bound as the variable of a function over one element, so that it is worked out once for a passage.
    """
    most = max((hi for *_, hi in known), default=0)

    def against(g: Column) -> Column:
        def each(n: Column) -> Column:
            out = [F.lit(0.0)]
            for _, pairs, lo, hi in known:
                hashes = F.split(F.lit(",".join(str(_hash(f"{a} {b}")) for a, b in pairs)), ",").cast("array<bigint>")
                dice = 2.0 * F.size(F.array_intersect(g, hashes)) / (n + len(pairs))
                out.append(F.when(n.between(lo, hi), dice).otherwise(0.0))
            return F.when(n.between(1, most), F.array(*out)).otherwise(F.array(F.lit(0.0)))

        return F.transform(F.array(F.size(g)), each)[0]

    def bigrams(w: Column) -> Column:
        pair = lambda i: F.xxhash64(F.concat_ws(" ", F.get(w, i - 1), F.get(w, i)))
        two = F.transform(F.sequence(F.lit(1), F.size(w) - 1), pair)
        return F.when(F.size(w) > 1, F.array_distinct(two)).otherwise(F.array().cast("array<bigint>"))

    return F.transform(F.transform(F.array(F.split(passage, " ")), bigrams), against)[0]


def _bigints(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _windows(templates, threshold: float) -> Column:
    """The best window of the running text ``t`` for each template that has one: name, minus its Dice coefficient, words.

    A window begins at a word pair of the template and is as many words long as the template, or ends with the text. A
    text with fewer of a template's pairs than a match needs is passed over.
    """
    known = list(_templates(templates, threshold))
    lengths = [n for n in (len(normal_words(text)) for _, text in templates) if n > 1]
    hashes = [[_hash(f"{a} {b}") for a, b in pairs] for _, pairs, *_ in known]
    every = _bigints(sorted({h for hs in hashes for h in hs}))

    def pairs_of(w: Column) -> Column:
        pair = lambda i: F.xxhash64(F.concat_ws(" ", F.get(w, i - 1), F.get(w, i)))
        two = F.transform(F.sequence(F.lit(1), F.size(w) - 1), pair)
        g = F.when(F.size(w) > 1, two).otherwise(F.array().cast("array<bigint>"))
        return F.struct(w.alias("w"), g.alias("g"))

    def with_common(x: Column) -> Column:
        return F.struct(x.w.alias("w"), x.g.alias("g"), F.array_intersect(x.g, every).alias("c"))

    def best_of(x: Column, name: str, hs: list[int], n: int, lo: int) -> Column:
        own = _bigints(hs)

        def against(i: Column) -> Column:
            def dice(held: Column) -> Column:
                return F.struct((-2.0 * F.size(F.array_intersect(held, own)) / (F.size(held) + len(hs))).alias("d"), i.alias("i"))

            return F.transform(F.array(F.array_distinct(F.slice(x.g, i, n - 1))), dice)[0]

        starts = F.filter(F.sequence(F.lit(1), F.size(x.g)), lambda i: F.array_contains(own, F.get(x.g, i - 1)))
        good = F.filter(F.transform(starts, against), lambda y: y.d <= -threshold)
        said = lambda y: F.struct(
            F.lit(name).alias("name"), y.d.alias("d"), F.array_join(F.slice(x.w, y.i, n), " ").alias("u")
        )
        return F.when(F.size(F.array_intersect(x.c, own)) >= lo, F.array_min(F.transform(good, said)))

    def best(x: Column) -> Column:
        found = [best_of(x, k[0], hs, n, k[2]) for k, hs, n in zip(known, hashes, lengths, strict=True)]
        some = F.array_compact(F.array(*found)) if found else F.array().cast("array<struct<name:string,d:double,u:string>>")
        return F.when(F.size(x.c) > 1, some) if min((k[2] for k in known), default=0) > 1 else some

    bound = F.transform(F.array(F.split(_normal(F.col("t")), " ")), pairs_of)
    return F.transform(F.transform(bound, with_common), best)[0]


def _hash(text: str) -> int:
    """The engine's 64-bit hash of a string, as a signed number."""
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each document: ``n_matches``, ``licenses`` (identifiers in order), ``best_dice``, ``best_passage``.

    Passages are the lines, the paragraphs of more than one line (blank lines part them) and, where there is more than
    one paragraph, the whole text. A passage matches if its set of word bigrams reaches ``threshold`` with that of a
    template; a template whose number of bigrams lies outside the bounds for the passage's is passed over, since it
    could not match.

    A licence that no passage has is also looked for in the running text, by windows of each template's number of words
    that begin at one of its word pairs: a licence in several paragraphs of a longer text, or a notice inside a line.
    The best window of such a licence counts as one more match.

    NULL and empty texts and documents without a match have 0 matches, '' for ``licenses``, 0.0 and NULL. Of equally
    good passages the first in alphabetical order is returned. Repeated rows get a row each. Only ``doc_id`` and
    ``text`` are read. No text is shuffled: what leaves the scan is one partial row for each document.
    """
    known = list(_templates(templates, threshold))
    text = F.coalesce("text", F.lit(""))
    blocks = F.filter(F.split(F.col("t"), r"\n[\x20\x09\x0B-\x0D]*\n", -1), lambda x: x.rlike(NOT_SPACE))
    step = docs.select("doc_id", F.monotonically_increasing_id().alias("rid"), text.alias("t")).withColumn("b", blocks)
    step = step.withColumn("windows", _windows(templates, threshold))
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(NOT_SPACE))
    paragraphs = F.filter("b", lambda x: x.rlike(NOT_SPACE + r"[\x20\x09\x0B-\x0D]*\n[\x20\x09\x0B-\x0D]*" + NOT_SPACE))
    whole = F.when(F.size("b") > 1, F.array("t")).otherwise(F.array().cast("array<string>"))
    # The first entry stands for the document itself, so that it stays when nothing matches.
    passages = F.concat(F.array(F.lit("")), lines, paragraphs, whole)
    step = step.select("rid", "doc_id", "windows", F.posexplode(passages).alias("i", "raw"))
    w = step.select("rid", "doc_id", "windows", "i", _normal(F.col("raw")).alias("u"))
    w = w.withColumn("scores", _scores(F.col("u"), known))
    w = w.withColumn("dice", F.array_max("scores")).where((F.col("i") == 0) | (F.col("dice") >= threshold))
    names = F.split(F.lit(",".join(name for name, *_ in known)), ",")
    hit = F.filter(F.transform("scores", lambda x, k: F.when(x >= threshold, F.get(names, k - 1))), lambda x: x.isNotNull())
    best = F.min(F.when(F.col("i") > 0, F.struct((-F.col("dice")).alias("d"), F.col("u").alias("u"))))
    out = w.withColumn("hit", hit).groupBy("rid", "doc_id").agg(
        F.count(F.when(F.col("i") > 0, 1)).alias("n"),
        F.array_distinct(F.flatten(F.collect_list("hit"))).alias("names"),
        best.alias("best"),
        F.flatten(F.collect_list(F.when(F.col("i") == 0, F.col("windows")))).alias("windows"),
    )
    more = F.filter("windows", lambda x: ~F.array_contains(F.col("names"), x["name"]))
    out = out.withColumn("more", more)
    out = out.withColumn("more_names", F.array_distinct(F.transform("more", lambda x: x["name"])))
    windows = F.transform("more", lambda x: F.struct(x.d.alias("d"), x.u.alias("u")))
    top = F.array_min(F.concat(F.array_compact(F.array("best")), windows))
    out = out.withColumn("n_matches", F.col("n") + F.size("more_names")).withColumn("top", top)
    found = F.col("n_matches") > 0
    return out.select(
        "doc_id",
        "n_matches",
        F.array_join(F.sort_array(F.concat("names", "more_names")), ",").alias("licenses"),
        F.when(found, -F.col("top.d")).otherwise(0.0).alias("best_dice"),
        F.when(found, F.col("top.u")).alias("best_passage"),
    )


def _sql() -> str:
    rows = ", ".join(
        f"({k}, '{name}', [{', '.join(repr(' '.join(p)) for p in pairs)}], {lo}, {hi})"
        for k, (name, pairs, lo, hi) in enumerate(_templates(TEMPLATES, THRESHOLD))
    )
    return f"""
with tpl(k, name, tg, lo, hi) as (values {rows}),
d as (select doc_id, coalesce(text, '') t from documents),
b as (select doc_id, t, [x for x in string_split_regex(t, '\\n[\\x20\\x09\\x0B-\\x0D]*\\n')
      if regexp_matches(x, '{NOT_SPACE}')] b from d),
u as (select doc_id, unnest([x for x in string_split(t, chr(10)) if regexp_matches(x, '{NOT_SPACE}')]
      || [x for x in b if len([y for y in string_split(x, chr(10)) if regexp_matches(y, '{NOT_SPACE}')]) > 1]
      || case when len(b) > 1 then [t] else [] end) u from b),
n as (select doc_id, row_number() over () i, trim(regexp_replace(
      translate(u, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g')) u from u),
g as (select *, list_distinct([w[p] || ' ' || w[p + 1] for p in range(1, len(w))]) g
      from (select *, string_split(u, ' ') w from n)),
s as (select doc_id, i, u, name, 2.0::double * len(list_intersect(g, tg)) / (len(g) + len(tg)) dice
      from g, tpl where len(g) > 0),
hits as (select * from s where dice >= {THRESHOLD}),
by_doc as (select doc_id, count(distinct i) n_matches, array_to_string(list_sort(list(distinct name)), ',') licenses,
           max(dice) best_dice from hits group by doc_id),
best as (select doc_id, min(u) best_passage from hits join by_doc using (doc_id) where dice = best_dice group by doc_id)
select doc_id, coalesce(n_matches, 0) n_matches, coalesce(licenses, '') licenses, coalesce(best_dice, 0.0::double) best_dice,
       best_passage
from d left join by_doc using (doc_id) left join best using (doc_id)
"""


SQL = _sql()
