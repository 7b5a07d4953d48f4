"""Licence scans: stretches of lines, paragraphs and whole texts compared with licence templates by Dice's coefficient of bigrams.

A text is normalised to small letters and digits. Its bigrams are the different pairs of neighbouring words. The
coefficient of sets of ``a`` and ``b`` is at most ``2 min(a, b) / (a + b)``, so a template of ``b`` bigrams can only
match units whose number lies between two bounds. Each template is listed once for each number it admits, and units
meet templates by an equal number: a hash join against that short list, in which no pair beyond the bounds is formed.

Before that, texts without any of a few words are left out, as too many of every template's bigrams have one of them,
and then those that hold fewer bigrams of each template than a unit must share with it.

Stretches of several lines are looked at for those templates alone. A line at either end whose bigrams of the template are all in the rest of the stretch too only lowers the
coefficient. So a stretch begins at a line where one of them begins, and reaches no further than to where all that begin
there have come again; and it ends at a line where one ends that hadn't come before. From one line on, then, no more is
read than up to the next place of its bigrams, and no more ends are tried than the template has bigrams: over all lines
of a text that grows with their number, not its square, whatever repeats.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ridelake.llm.common import checkpointed

THRESHOLD = 0.8
#: The list of templates by size is broadcast; beyond this many entries it is an error.
MOST_ENTRIES = 1_000_000
#: For stretches, so many times a template's greatest number of bigrams are read first, then ``WIDER`` times as many, ...
AHEAD, WIDER, WIDTHS = 4, 4, 5
#: Letters from which a word is looked for within others.
LONG = 5
#: Words in most texts, which tell little.
_COMMON = frozenset("a all and any as at be by for from in is it may no not of on or that the this to under use with you".split())

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by
applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution."""
_BSD3 = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""
_GPL3 = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
later version."""
_MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""

#: Texts and notices of common licences, by id and form.
TEMPLATES: dict[tuple[str, str], str] = {
    ("MIT", "text"): _MIT,
    ("MIT", "notice"): "Released under the MIT License.",
    ("MIT", "notice 2"): "Licensed under the MIT License.",
    ("ISC", "permission"): _ISC,
    ("ISC", "text"): f"{_ISC} {_ISC_DISCLAIMER}",
    ("Apache-2.0", "header"): _APACHE,
    ("Apache-2.0", "notice"): "Licensed under the Apache License, Version 2.0.",
    ("BSD-2-Clause", "conditions"): _BSD,
    ("BSD-2-Clause", "text"): f"{_BSD} {_BSD_DISCLAIMER}",
    ("BSD-3-Clause", "conditions"): f"{_BSD} {_BSD3}",
    ("BSD-3-Clause", "text"): f"{_BSD} {_BSD3} {_BSD_DISCLAIMER}",
    ("BSD-3-Clause", "notice"): "Licensed under the BSD 3-Clause License.",
    ("GPL-3.0", "header"): _GPL3,
    ("GPL-2.0", "header"): _GPL3.replace("version 3", "version 2"),
    ("LGPL-3.0", "header"): _GPL3.replace("GNU General", "GNU Lesser General").replace("GNU\nGeneral", "GNU Lesser General"),
    ("AGPL-3.0", "header"): _GPL3.replace("GNU General", "GNU Affero General").replace("GNU\nGeneral", "GNU Affero General"),
    ("GPL-3.0", "notice"): "This work is licensed under the GNU General Public License, version 3.",
    ("MPL-2.0", "header"): _MPL,
    ("CC-BY-4.0", "notice"): "Licensed under CC BY 4.0.",
    ("CC-BY-SA-4.0", "notice"): "Licensed under CC BY-SA 4.0.",
    ("CC-BY-NC-4.0", "notice"): "Licensed under CC BY-NC 4.0.",
}


#: Another spelling, and that of the templates.
_SPELT = ("licence", "license")


def words_of(text: str) -> list[str]:
    return re.sub("[^a-z0-9]+", " ", text.lower().replace(*_SPELT)).split()


def _small(text: Column) -> Column:
    return F.replace(F.lower(text), *map(F.lit, _SPELT))


def size_bounds(bigrams: int, threshold: float) -> tuple[int, int]:
    """The least and greatest number of bigrams that can reach the threshold with a template of so many."""
    low = math.ceil(bigrams * threshold / (2 - threshold) - 1e-9)
    return max(low, 1), math.floor(bigrams * (2 - threshold) / threshold + 1e-9)


def _holds(word: str, other: str) -> bool:
    return other in word if len(other) >= LONG else other == word


def _telling(text: Column, words: list[str]) -> Column:
    """Whether a text in small letters has any of the words."""
    short = [word for word in words if len(word) < LONG]
    tests = [F.contains(text, F.lit(word)) for word in words if len(word) >= LONG]
    tests += [F.rlike(text, F.lit(f"(?<![a-z0-9])(?:{'|'.join(short)})(?![a-z0-9])"))] if short else []
    return reduce(or_, tests, F.lit(False))


def least_shared(bigrams: int, threshold: float) -> float:
    """The bigrams that a unit must share with a template of so many to reach the threshold."""
    return threshold * (size_bounds(bigrams, threshold)[0] + bigrams) / 2 - 1e-9


def telling_words(
    threshold: float = THRESHOLD, templates: Mapping[tuple[str, str], str] = TEMPLATES
) -> list[str]:
    """Words such that a unit with none of them reaches the threshold with no template.

    Words of ``LONG`` letters count within others too, shorter ones don't. To reach it a unit must share some number of a template's bigrams. Words are chosen, those first that leave the
    templates fewest bigrams and are long, until without them each template has fewer bigrams left than that.
    """
    left: list[tuple[set[tuple[str, str]], float]] = []
    for text in templates.values():
        words = words_of(text)
        bigrams = set(zip(words, words[1:], strict=False))
        if bigrams:
            left.append((bigrams, least_shared(len(bigrams), threshold)))
    chosen: list[str] = []
    while left := [(bigrams, need) for bigrams, need in left if len(bigrams) >= need]:
        gains: dict[str, float] = {}
        for bigrams, need in left:
            for word in {word for pair in bigrams for word in pair}:
                hit = sum(_holds(a, word) or _holds(b, word) for a, b in bigrams)
                gains[word] = gains.get(word, 0.0) + min(hit, len(bigrams) - need + 1) / len(bigrams)
        best = max(sorted(gains), key=lambda word: gains[word] * len(word) ** 3 * (1e-3 if word in _COMMON else 1))
        chosen.append(best)
        left = [({(a, b) for a, b in bigrams if not _holds(a, best) and not _holds(b, best)}, need) for bigrams, need in left]
    return chosen


def _template_bigrams(text: str) -> list[str]:
    words = words_of(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


def template_list(
    spark: SparkSession, threshold: float = THRESHOLD, templates: Mapping[tuple[str, str], str] = TEMPLATES
) -> DataFrame:
    """(license_id, form, template, units_size): each template's bigrams, once for each size of unit it admits."""
    rows = []
    for (license_id, form), text in templates.items():
        bigrams = _template_bigrams(text)
        low, high = size_bounds(len(bigrams), threshold)
        rows += [(license_id, form, bigrams, size) for size in range(low, high + 1) if bigrams]
    if len(rows) > MOST_ENTRIES:
        raise ValueError("too many templates to broadcast")
    frame = spark.createDataFrame(rows, "license_id string, form string, bigrams array<string>, units_size int")
    hashed = F.transform("bigrams", lambda bigram: F.xxhash64(bigram))
    return frame.select("license_id", "form", hashed.alias("template"), "units_size")


def _bigrams(unit: Column) -> Column:
    """Hashes of the different bigrams of a text; none below two words."""
    words = F.split(F.trim(F.regexp_replace(_small(unit), "[^a-z0-9]+", " ")), " ")
    pairs = F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1), lambda a, b: F.xxhash64(F.concat_ws(" ", a, b)))
    return F.array_distinct(F.when(F.size(words) > 1, pairs).otherwise(F.array().cast("array<bigint>")))


def _units(text: Column) -> Column:
    """The lines of a text; if it has more than one, the whole too; if it has empty lines, also its paragraphs."""
    lines = F.split(text, "\n")
    whole = F.when(F.size(lines) > 1, F.array(text)).otherwise(F.array().cast("array<string>"))
    parts = F.split(text, r"\n\s*\n")
    paragraphs = F.when(F.size(parts) > 1, parts).otherwise(F.array().cast("array<string>"))
    return F.concat(lines, whole, paragraphs)


def _pairs(text: Column) -> Column:
    """(h, begins, ends) of each bigram of a text: its hash and the lines of its two words."""
    lines = F.transform(F.split(_small(text), "\n"), lambda line: F.split(F.regexp_replace(line, "[^a-z0-9]+", " "), " "))
    numbered = F.transform(lines, lambda line, k: F.transform(F.filter(line, lambda w: w != ""), lambda w: F.struct(w.alias("w"), k.alias("k"))))
    words = F.flatten(numbered)
    pair = lambda a, b: F.struct(F.xxhash64(F.concat_ws(" ", a.w, b.w)).alias("h"), a.k.alias("begins"), b.k.alias("ends"))
    return F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.when(b.isNotNull(), pair(a, b)))


def _line_starts() -> Column:
    """(first, at) of each line that one of the template's bigrams begins in: the line, and its place in pairs."""

    def start(pair: Column, k: Column) -> Column:
        new = (k == 0) | (F.get("pairs", k - 1)["begins"] != pair["begins"])
        return F.struct(pair["begins"].alias("first"), (k + 1).alias("at"), new.alias("new"))

    return F.filter(F.transform("pairs", start), lambda s: s["new"] & F.array_contains("lines", s["first"]))


def _read_from(start: Column) -> Column:
    """(first, pairs): what is read from a line on, the least width that is enough."""

    def enough(pairs: Column) -> Column:
        here = F.filter(pairs, lambda p: (p["begins"] == start["first"]) & F.array_contains("template", p["h"]))
        later = F.filter(pairs, lambda p: p["begins"] > start["first"])
        again = F.size(F.array_except(here["h"], later["h"])) == 0
        whole_line = F.element_at(pairs, -1)["begins"] > start["first"]
        return (F.size(F.array_distinct(pairs["h"])) > F.col("high")) | (whole_line & again)

    widths = [F.slice("pairs", start["at"], AHEAD * WIDER**k * F.col("high")) for k in range(WIDTHS)]
    tried = [F.get(F.filter(F.array(width), enough), F.lit(0)) for width in widths]
    rest = F.slice("pairs", start["at"], F.size("pairs"))
    return F.struct(start["first"].alias("first"), F.coalesce(*tried, rest).alias("pairs"))


def _new_ends() -> Column:
    """The lines in which one of the template's bigrams ends that hasn't come before."""
    new = F.array_distinct(F.col("hits.h"))
    first_at = lambda h: F.element_at(F.col("hits.ends"), F.array_position(F.col("hits.h"), h).cast("int"))
    return F.array_distinct(F.transform(new, first_at))


def _near(docs: DataFrame, threshold: float, templates: Mapping[tuple[str, str], str]) -> DataFrame:
    """(doc_id, text, near) of texts that hold as many bigrams of a template as a unit must share: with those templates.

    A unit's bigrams are its text's, so no match is lost.
    """
    hashed = lambda bigrams: F.array(*(F.xxhash64(F.lit(bigram)) for bigram in bigrams))
    listed, every = [], {}
    for (license_id, _), content in templates.items():
        if bigrams := _template_bigrams(content):
            low, high = size_bounds(len(bigrams), threshold)
            need = least_shared(len(bigrams), threshold)
            values = {"license_id": F.lit(license_id), "template": hashed(bigrams), "low": F.lit(low), "high": F.lit(high), "need": F.lit(need)}
            listed.append(F.struct(*(value.alias(name) for name, value in values.items())))
            every |= dict.fromkeys(bigrams)
    text = F.col("text").cast("string")
    shared = F.array_intersect(_bigrams(text), hashed(every))
    held = docs.select("doc_id", text.alias("text"), F.explode(F.array(shared)).alias("held")).filter(F.size("held") > 0)
    enough = F.filter(F.array(*listed), lambda t: F.size(F.array_intersect("held", t.template)) >= t.need)
    near = held.select("doc_id", "text", F.explode(F.array(enough)).alias("near"))
    return near.filter(F.size("near") > 0)


def _stretches(near: DataFrame, threshold: float) -> DataFrame:
    """(doc_id, license_id, score, first, last) of the stretches of two lines or more that reach the threshold, but for
    those that are as good or better without their first line or their last."""
    met = near.filter(F.contains("text", F.lit("\n"))).select("doc_id", "text", F.explode("near").alias("t")).select("doc_id", "text", "t.*")
    # Each array is a row's column, by way of explode, so that it is worked out once and not for each element.
    names = ["doc_id", "license_id", "template", "low", "high"]
    read = met.select(*names, F.explode(F.array(F.filter(_pairs(F.col("text")), F.isnotnull))).alias("pairs"))
    hits = F.filter("pairs", lambda p: F.array_contains("template", p.h))
    lines = F.array_distinct(F.transform(hits, lambda p: p.begins))
    read = read.select(*names, "pairs", F.explode(F.array(lines)).alias("lines"))
    begun = read.select(*names, F.explode(F.transform(_line_starts(), _read_from)).alias("s")).select(*names, "s.*")
    hits = F.filter("pairs", lambda p: F.array_contains("template", p.h))
    begun = begun.select(*names, "first", "pairs", F.explode(F.array(hits)).alias("hits"))
    ended = begun.select(*names, "first", "pairs", F.explode(_new_ends()).alias("last")).filter("last > first")
    own = F.transform(F.filter("pairs", lambda p: p.ends <= F.col("last")), lambda p: p.h)
    sets = ended.select(*names, "first", "last", F.explode(F.array(F.array_distinct(own))).alias("own"))
    sets = sets.withColumn("n", F.size("own")).filter("n BETWEEN low AND high")
    shared = F.size(F.array_intersect("own", "template"))
    scored = sets.withColumn("score", 2.0 * shared / (F.col("n") + F.size("template")))
    return scored.filter(F.col("score") >= threshold).select("doc_id", "license_id", "score", "first", "last")


def _places(stretches: Column) -> Column:
    """The number of stretches, those that overlap counted as one."""
    start = F.struct(F.lit(0).alias("n"), F.lit(-1).alias("upto"))
    count = lambda seen, s: F.struct(
        (seen.n + (s["first"] > seen.upto).cast("int")).alias("n"), F.greatest(seen.upto, s["last"]).alias("upto")
    )
    return F.aggregate(F.array_sort(stretches), start, count, lambda seen: seen.n)


def _best_there(matches: DataFrame) -> DataFrame:
    """Without the matches in whose every line another licence has a better one: BSD's two clauses within its three.

    Places are lines; a paragraph is a place of its own. A place has the best match of all there, whoever has how many.
    """
    of = ["doc_id", "license_id", "plain", "first", "last"]
    lines = matches.withColumn("line", F.explode(F.sequence("first", "last")))
    best = F.max(F.struct("score", "license_id")).over(Window.partitionBy("doc_id", "line"))
    lost = (best["license_id"] != F.col("license_id")) & (best["score"] > F.col("score"))
    judged = lines.withColumn("lost", lost).groupBy(*of).agg(F.bool_and("lost").alias("lost"), F.max("score").alias("score"))
    return judged.filter(~F.col("lost"))


def license_scan(
    docs: DataFrame,
    spark: SparkSession,
    threshold: float = THRESHOLD,
    templates: Mapping[tuple[str, str], str] = TEMPLATES,
) -> DataFrame:
    """(doc_id, license_id, score, n_units) for each row and licence with a unit at the threshold or above.

    Units are lines, stretches of lines, paragraphs and the whole. The score is the greatest coefficient of a unit
    with a form of the licence, and n_units counts lines, paragraphs and wholes that reach the threshold with any of
    its forms; where only other stretches do, it counts these, those that overlap as one. What another licence matches
    better in every line of it doesn't count. Null and empty texts match nothing, nor do units of one word. Rows that
    repeat count together, as one document with all their units. Other columns are ignored; no rows give none.
    """
    text = _small(F.col("text").cast("string"))
    some = docs.filter(_telling(text, telling_words(threshold, templates)))
    # Few texts are left, and they are read twice.
    some = checkpointed(_near(some, threshold, templates))
    content = F.col("text")
    n_lines = F.size(F.split(content, "\n"))
    units = some.select("doc_id", n_lines.alias("lines"), F.posexplode(_units(content)).alias("unit", "content"))
    sets = units.select("doc_id", "lines", "unit", _bigrams(F.col("content")).alias("own")).withColumn("n", F.size("own"))
    met = sets.join(F.broadcast(template_list(spark, threshold, templates)), F.col("n") == F.col("units_size"))
    shared = F.size(F.array_intersect("own", "template"))
    scored = met.withColumn("score", 2.0 * shared / (F.col("n") + F.size("template")))
    # The whole comes after the lines, paragraphs after that: those are places below 0.
    line, whole = F.col("unit") < F.col("lines"), F.col("unit") == F.col("lines")
    first = F.when(line, F.col("unit")).when(whole, 0).otherwise(-F.col("unit"))
    last = F.when(line, F.col("unit")).when(whole, F.col("lines") - 1).otherwise(-F.col("unit"))
    plain = scored.filter(F.col("score") >= threshold).select(
        "doc_id", "license_id", "score", F.when(whole, 2).otherwise(1).alias("plain"), first.alias("first"), last.alias("last")
    )
    stretches = _stretches(some, threshold).select("doc_id", "license_id", "score", F.lit(0).alias("plain"), "first", "last")
    found = _best_there(plain.unionByName(stretches)).groupBy("doc_id", "license_id")
    stretch = F.when(F.col("plain") == 0, F.struct("first", "last"))
    counted = found.agg(
        F.max("score").alias("score"), F.count_if(F.col("plain") > 0).alias("plain"), F.collect_set(stretch).alias("stretches")
    )
    n_units = F.when(F.col("plain") > 0, F.col("plain")).otherwise(_places(F.col("stretches")).cast("long"))
    return counted.select("doc_id", "license_id", "score", n_units.alias("n_units"))


def oracle(threshold: float = THRESHOLD, templates: Mapping[tuple[str, str], str] = TEMPLATES) -> str:
    """The same as SQL for DuckDB, without the bounds: every unit against every template."""

    def bigrams(text: str) -> str:
        words = f"string_split(trim(regexp_replace(replace(lower({text}), 'licence', 'license'), '[^a-z0-9]+', ' ', 'g')), ' ')"
        return f"(SELECT list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM (SELECT {words} AS w))"

    values = ", ".join(
        "('{}', '{}')".format(license_id, text.replace("'", "''")) for (license_id, _), text in templates.items()
    )
    return f"""
        WITH templates(license_id, content) AS (VALUES {values}),
        t AS (SELECT license_id, {bigrams("content")} AS bigrams FROM templates),
        units AS (
          SELECT doc_id, unnest(string_split(text, chr(10))) AS content, generate_subscripts(string_split(text, chr(10)), 1) AS first, first AS last
          FROM documents
          UNION ALL SELECT doc_id, text, 1, len(string_split(text, chr(10))) FROM documents WHERE contains(text, chr(10))
          UNION ALL SELECT doc_id, unnest(p), -generate_subscripts(p, 1) AS first, first
          FROM (SELECT doc_id, regexp_split_to_array(text, '\\n\\s*\\n') AS p FROM documents) WHERE len(p) > 1
        ),
        u AS (SELECT doc_id, first, last, {bigrams("content")} AS bigrams FROM units WHERE content IS NOT NULL),
        scored AS (
          SELECT doc_id, license_id, first, last,
            max(2.0::DOUBLE * len(list_intersect(u.bigrams, t.bigrams)) / (len(u.bigrams) + len(t.bigrams))) AS score
          FROM u, t WHERE len(u.bigrams) > 0 GROUP BY ALL HAVING score >= {threshold}
        ),
        lines AS (SELECT *, unnest(range(first, last + 1)) AS line FROM scored),
        judged AS (
          SELECT *, arg_max(license_id, (score, license_id)) OVER w AS best, max(score) OVER w AS most FROM lines
          WINDOW w AS (PARTITION BY doc_id, line)
        ),
        kept AS (
          SELECT doc_id, license_id, first, last, score FROM judged
          GROUP BY ALL HAVING NOT bool_and(best <> license_id AND most > score)
        )
        SELECT doc_id, license_id, max(score) AS score, count(*) AS n_units FROM kept GROUP BY doc_id, license_id"""
