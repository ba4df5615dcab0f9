"""Licence scans: texts against licence templates by the Dice coefficient over word bigrams.

A text is normalised (lower case, everything but letters and digits is a blank) and cut into units: the whole text,
its blocks between blank lines, and its lines. A unit matches a template when
2 * |shared bigrams| / (|its bigrams| + |the template's|) reaches the threshold; bigrams are sets. Since the shared bigrams are
at most the smaller set, a template can only match when its size lies within threshold / (2 - threshold) of
the unit's, or the inverse: other templates are pruned by size, and the bigrams of a unit that no template's size
fits are never built.

A licence need not fill a unit: with ``passages`` the words of the whole text, line ends or not, are also searched for
stretches of words that reach the threshold, of at most (2 - threshold) / threshold times the template's own length. A stretch that reaches
it shares threshold / (2 - threshold) of the template's bigrams at least, so a text with fewer of them is done; the best stretch
starts and ends with a bigram of the template. From the first start that reaches the threshold, its best end and then the best start for
that end are taken, and the search goes on behind them. A stretch that lies for the most part in a better one of another
licence is dropped, as a unit has one licence.

All are array expressions on the row: no shuffle, whole texts, JVM only. The templates are a
short list given by the caller.

Cases: null and empty texts and units of fewer than two words match nothing; ties go to the first
licence by name; repeated rows are scanned one by one; an empty table gives an empty result; a
column named ``matches`` is replaced, others pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. "
)
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED "
    "TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)

# Licence notices and the standard headers of public licences (several texts may name one licence).
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
                   "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or "
                   "agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                   "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
                   "limitations under the License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", _BSD_2 + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
                     "derived from this software without specific prior written permission. " + _BSD_END),
    ("BSD-2-Clause", _BSD_2 + _BSD_END),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program "
                "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
                "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
            "above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL "
            "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR "
            "BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
            "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
            "PERFORMANCE OF THIS SOFTWARE."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
            "so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
            "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
            "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
            "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
                "this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Proprietary", "All rights reserved."),
]

MATCH_TYPE = "array<struct<kind:string,unit:int,license:string,dice:double>>"


def normalised(text: Column) -> Column:
    """Lower case, runs of anything but letters, digits and line ends as one blank."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}\n]+", " ")


def _words(unit: Column) -> Column:
    """The words of a unit; one empty word if it has none."""
    return F.split(F.btrim(unit, F.lit(" \n")), "[ \n]+")


def _pairs(words: Column) -> Column:
    """Hashes of neighbouring words in order (empty below two words)."""
    pairs = F.zip_with(F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, F.lit(2), F.size(words)), lambda a, b: F.xxhash64(a, b))
    return F.when(F.size(words) >= 2, pairs).otherwise(F.array().cast("array<bigint>"))


def _bigrams(words: Column) -> Column:
    """Distinct hashes of neighbouring words (empty below two words)."""
    return F.array_distinct(_pairs(words))


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), 0)


def _template_rows(df: DataFrame, templates=None) -> DataFrame:
    rows = df.sparkSession.createDataFrame(templates or TEMPLATES, "license string, body string")
    pairs = _pairs(_words(normalised(F.col("body"))))
    return rows.select("license", F.array_distinct(pairs).alias("grams"), F.size(pairs).alias("length"))


def template_bigrams(df: DataFrame, templates=None) -> Column:
    """The templates as one array of (license, grams, length), a scalar subquery computed once."""
    rows = _template_rows(df, templates)
    return rows.agg(F.array_sort(F.collect_list(F.struct("license", "grams", "length"))).alias("t")).scalar()


def _fits(n: Column, m: Column, threshold: float) -> Column:
    """Whether sets of n and m bigrams can reach the threshold."""
    return 2.0 * F.least(n, m) >= threshold * (n + m)


def _best(words: Column, templates: Column, largest: Column, threshold: float) -> Column:
    """(dice, license) of the best template of a unit at or above the threshold, or null."""

    def judged(grams):
        near = F.filter(templates, lambda t: _fits(F.size(grams), F.size(t["grams"]), threshold))
        scored = F.transform(near, lambda t: F.struct(
            (2.0 * F.size(F.array_intersect(grams, t["grams"])) / (F.size(grams) + F.size(t["grams"]))).alias("dice"), t["license"].alias("license")
        ))
        good = F.filter(scored, lambda s: s["dice"] >= threshold)
        top = lambda a, b: F.when((b["dice"] > a["dice"]) | ((b["dice"] == a["dice"]) & (b["license"] < a["license"])), b).otherwise(a)
        return F.when(F.size(good) > 0, F.aggregate(good, F.get(good, 0), top))

    # each word that is new to a unit ends a new bigram, so a unit has at least as many bigrams as distinct words but
    # one; where the first words alone bring too many, the size bound already rules every template out
    least = F.size(F.array_distinct(F.slice(words, F.lit(1), 2 * largest + 2))) - 1
    possible = (F.size(words) >= 2) & ((least <= largest) | _fits(least, largest, threshold))
    return F.when(possible, _let(_bigrams(words), judged))


def _stretches(grams: Column, t: Column, threshold: float) -> Column:
    """(start, end, license, dice) of the stretches of a text's bigrams that reach the threshold with one template, first to last."""
    share = threshold / (2 - threshold)
    known = t["grams"]
    least = F.ceil(share * F.size(known) - 1e-9).cast("int")
    most = F.floor(t["length"] / share + 1e-9).cast("int")
    dice = lambda w: 2.0 * F.size(F.array_intersect(w, known)) / (F.size(F.array_distinct(w)) + F.size(known))
    ranked = lambda w, n: F.struct(dice(w).alias("dice"), (-n).alias("less"))  # noqa: E731  the shortest of equal ones

    def best_end(w):
        ends = F.filter(F.sequence(least, F.size(w)), lambda n: F.array_contains(known, F.get(w, n - 1)))
        return F.array_max(F.transform(ends, lambda n: ranked(F.slice(w, F.lit(1), n), n)))

    def best_start(w, size):
        lengths = F.filter(F.sequence(least, size), lambda n: F.array_contains(known, F.get(w, size - n)))
        return F.array_max(F.transform(lengths, lambda n: ranked(F.slice(w, size - n + 1, n), n)))

    def step(state, at):
        def noted(w, end):
            return _let(best_start(w, -end["less"]), lambda b: F.struct((at - end["less"]).alias("next"), F.concat(state["found"], F.array(F.struct(
                (at - end["less"] + b["less"]).alias("start"), (at - end["less"]).alias("end"), t["license"].alias("license"), b["dice"].alias("dice")
            ))).alias("found")))

        def tried(w):
            return F.when(F.size(F.array_intersect(w, known)) < least, state).otherwise(_let(best_end(w), lambda end: F.when(
                F.coalesce(end["dice"], F.lit(0.0)) < threshold, state
            ).otherwise(noted(w, end))))

        return F.when(at < state["next"], state).otherwise(_let(F.slice(grams, at + 1, most), tried))

    places = F.filter(F.sequence(F.lit(0), F.size(grams) - 1), lambda i: F.array_contains(known, F.get(grams, i)))
    start = F.struct(F.lit(0).alias("next"), F.array().cast("array<struct<start:int,end:int,license:string,dice:double>>").alias("found"))
    return F.aggregate(places, start, step, lambda state: state["found"])


def _near(grams: Column, templates: Column, known: list[int], threshold: float) -> Column:
    """The templates that any stretch of a text can match, from all its bigrams; ``known`` has all templates' bigrams."""
    enough = lambda hits, t: (F.size(t["grams"]) > 0) & (F.size(F.array_intersect(hits, t["grams"])) >= threshold / (2 - threshold) * F.size(t["grams"]) - 1e-9)
    return _let(F.array_distinct(F.filter(grams, lambda g: g.isin(known))), lambda hits: F.filter(templates, lambda t: enough(hits, t)))


def _passages(grams: Column, near: Column, threshold: float) -> Column:
    """Passages of a whole text (kind passage; the unit is the place of its first word)."""
    inside = lambda p, q: F.least(p["end"], q["end"]) - F.greatest(p["start"], q["start"])
    better = lambda p, q: (q["license"] != p["license"]) & ((q["dice"] > p["dice"]) | ((q["dice"] == p["dice"]) & (q["license"] < p["license"])))

    def kept(found):
        alone = F.filter(found, lambda p: ~F.exists(found, lambda q: better(p, q) & (2 * inside(p, q) > p["end"] - p["start"])))
        return F.transform(F.array_sort(alone), lambda p: F.struct(F.lit("passage").alias("kind"), p["start"].alias("unit"), p["license"].alias("license"), p["dice"].alias("dice")))

    return _let(F.flatten(F.transform(near, lambda t: _stretches(grams, t, threshold))), kept)


def scan(df: DataFrame, templates=None, threshold: float = THRESHOLD, text: str = "text", passages: bool = False) -> DataFrame:
    """Add ``matches``: (kind, unit, license, dice) for each unit with a template at or above the threshold; kind is
    text, block or line, and units of a kind count from 0 in order. With ``passages`` also kind passage, whose unit is the place of
    its first word in the text."""
    known = template_bigrams(df, templates)
    kept = [df[f"`{c}`"] for c in df.columns if c.lower() != "matches"]
    rows = df.select(*kept, normalised(df[f"`{text}`"]).alias("__norm"))
    rows = rows.withColumn("__templates", known)
    rows = rows.withColumn("__largest", F.array_max(F.transform("__templates", lambda t: F.size(t["grams"]))))

    def of(units, kind):
        best = lambda unit: _let(_words(unit), lambda words: _best(words, F.col("__templates"), F.col("__largest"), threshold))
        found = F.transform(units, lambda unit, i: _let(best(unit), lambda b: F.when(b.isNotNull(), F.struct(
            F.lit(kind).alias("kind"), i.alias("unit"), b["license"].alias("license"), b["dice"].alias("dice")
        ))))
        return F.filter(found, lambda m: m.isNotNull()).cast(MATCH_TYPE)

    norm = F.col("__norm")
    matches = F.concat(of(F.array(norm), "text"), of(F.split(norm, r"\n *\n[ \n]*"), "block"), of(F.split(norm, r"\n"), "line"))
    if passages:
        # a unit is a stretch too: where no template is near the whole text, no unit matches
        grams = [r[0] for r in _template_rows(df, templates).select(F.explode("grams")).distinct().collect()]  # bounded by the templates
        units, none = matches, F.array().cast(MATCH_TYPE)
        matches = _let(_pairs(_words(norm)), lambda pairs: _let(_near(pairs, F.col("__templates"), grams, threshold), lambda near: F.when(
            F.size(near) > 0, F.concat(units, _passages(pairs, near, threshold).cast(MATCH_TYPE))
        ).otherwise(none)))
    return rows.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() != "matches"], matches.cast(MATCH_TYPE).alias("matches"))
