"""Licence scan: pieces of texts against licence templates by Dice over word bigrams.

Native DataFrame operations only. Every line of a document (or piece, by ``separator``) and every
template becomes the set of its word bigrams after lower-casing and dropping punctuation. A piece
with a bigrams can only reach the coefficient ``t`` with a template of b bigrams where
t / (2 - t) <= a / b <= (2 - t) / t; every template is listed under the sizes in its bounds, and
pieces meet the templates of their own size in an equality join.

A notice may also be wrapped over lines or stand inside a longer line. A window is as many words as
a template has, whatever lines they are on; it can only match a template of which the document holds
b t / (2 - t) bigrams, which are counted by a join of bigrams. In these documents a window from every
bigram of the template on is scored. Of windows that overlap the best is reported, by the line of its
first word; a window with words of a line that matches the template as a whole is that line's match.

Defined results: a null or empty text, and a line of fewer than two words, matches nothing;
templates without bigrams match nothing; several templates may match a piece; repeated rows give
repeated rows; empty tables give an empty table. Other columns are not used. The table of
templates is broadcast if it is small, which is checked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.llm.frames import small, written
from reviewlab.llm.words import bound, folded, split_words

DICE = 0.8
# Templates are broadcast, each with all its bigrams, up to this many.
MOST_TEMPLATES = 5_000
# Notices that stand in texts for a licence.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License, version 2.",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
# Whole licence texts and the standard headers of the longer licences.
_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    'associated documentation files (the "Software"), to deal in the Software without restriction, '
    "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions: The above copyright notice and this permission notice shall be "
    "included in all copies or substantial portions of the Software. "
)
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN "
    "NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
    "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
    "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
    "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. "
)
_BSD_NAME = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission. "
)
_BSD_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR "
    "ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
    "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
    "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF "
    "ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)


def _gnu(name: str, version: str) -> str:
    return (
        f"This program is free software: you can redistribute it and/or modify it under the terms of the {name} "
        f"as published by the Free Software Foundation, either version {version} of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT "
        "ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
        f"See the {name} for more details."
    )


TEXTS = {
    "MIT text": _GRANT + _AS_IS,
    "BSD-2-Clause text": _BSD + _BSD_AS_IS,
    "BSD-3-Clause text": _BSD + _BSD_NAME + _BSD_AS_IS,
    "ISC text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
    "fee is hereby granted, provided that the above copyright notice and this permission notice appear in all "
    'copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS '
    "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
    "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
    "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
    "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "Apache-2.0 header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
    "except in compliance with the License. You may obtain a copy of the License at "
    "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
    'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS '
    "OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
    "limitations under the License.",
    "GPL-2.0 header": _gnu("GNU General Public License", "2"),
    "GPL-3.0 header": _gnu("GNU General Public License", "3"),
    "LGPL-3.0 header": _gnu("GNU Lesser General Public License", "3"),
    "AGPL-3.0 header": _gnu("GNU Affero General Public License", "3"),
    "MPL-2.0 header": TEMPLATES["MPL-2.0"] + " If a copy of the MPL was not distributed with this file, You can "
    "obtain one at https://mozilla.org/MPL/2.0/.",
}


def default_templates(spark: SparkSession) -> DataFrame:
    rows = [*TEMPLATES.items(), *TEXTS.items()]
    return spark.createDataFrame(rows, "template string, text string")


def bigrams(text: Column) -> Column:
    """The distinct word bigrams of a text; none for fewer than two words."""

    def pairs(w: Column) -> Column:
        joined = F.transform(
            F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))),
            lambda a, i: F.concat_ws(" ", a, F.get(w, i + 1)),
        )
        return F.array_distinct(joined)

    return bound(split_words(folded(F.coalesce(text, F.lit("")))), pairs)


def scan(
    docs: DataFrame,
    templates: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    template: str = "template",
    template_text: str = "text",
    dice: float = DICE,
    separator: str = "\n",
) -> DataFrame:
    """(key, line, template, dice) of the pieces that match a template; lines count from 0."""
    known = templates.select(
        templates[template].alias("template"),
        bigrams(templates[template_text]).alias("known"),
        F.size(split_words(folded(templates[template_text]))).alias("width"),
    ).filter(F.size("known") > 0)
    n = F.size("known")
    least, most = F.ceil(n * (dice / (2 - dice))), F.floor(n * ((2 - dice) / dice))
    sizes = known.select("template", "known", F.explode(F.sequence(least, most)).alias("size"))
    known = known.withColumn("least", least)
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    held = licensed(rows, known)
    texts = rows.join(small(_renamed(held.select("key", "code").distinct())), _same(rows), "left_semi")
    pieces = texts.select("key", F.posexplode(F.split("text", separator)).alias("line", "piece"))
    # a piece of a bigrams has at least a + 1 words, so as many gaps and characters
    longest = sizes.agg(F.max("size")).first()[0] or 0
    sized = (
        pieces.filter(F.length("piece") > 2)
        .select("key", "line", bigrams(F.col("piece")).alias("own"))
        .withColumn("size", F.size("own").cast("long"))
        .filter(F.col("size").between(1, longest))
    )
    lines = (
        sized.join(small(sizes), "size")
        .select("key", "line", "template", _score(F.col("own"), F.col("known")).alias("dice"))
        .filter(F.col("dice") >= dice)
    )
    found = lines.union(windows(rows, held, known, dice, separator))
    return found.select(F.col("key").alias(key), F.col("line").cast("long").alias("line"), "template", "dice")


def _score(own: Column, known: Column) -> Column:
    return F.lit(2.0) * F.size(F.array_intersect(own, known)) / (F.size(own) + F.size(known))


def licensed(rows: DataFrame, known: DataFrame) -> DataFrame:
    """(key, code, template) of the (key, text) rows with bigrams enough for a match anywhere.

    Of two sets of a and n bigrams that match, the smaller's share of the larger bounds what they
    have in common from below, for a line of the text as for a window.
    """
    bigram = known.select("template", "least", F.explode("known").alias("bigram"))
    code = F.xxhash64("text").alias("code")
    held = rows.select("key", code, F.explode(bigrams(F.col("text"))).alias("bigram"))
    # rows repeated in full are counted together, which can only let more through
    held = held.join(small(bigram), "bigram").groupBy("key", "code", "template", "least").count()
    return written(held.filter("count >= least").select("key", "code", "template"), "licensed")


def _renamed(held: DataFrame) -> DataFrame:
    return held.withColumnsRenamed({"key": "_key", "code": "_code"})


def _same(rows: DataFrame) -> Column:
    return rows["key"].eqNullSafe(F.col("_key")) & (F.xxhash64(rows["text"]) == F.col("_code"))


def windows(
    rows: DataFrame, held: DataFrame, known: DataFrame, dice: float, separator: str
) -> DataFrame:
    """(key, line, template, dice) of the windows of (key, text) rows that match a template.

    ``held`` says which template is looked for in which row; the templates themselves, with all
    their bigrams, are joined apart.
    """
    likely = rows.join(small(_renamed(held)), _same(rows)).select("key", "text", "template")
    likely = likely.join(small(known.select("template", "known", "width"), MOST_TEMPLATES), "template")
    width, terms = F.col("width"), F.col("known")

    def of_line(line: Column, i: Column) -> Column:
        return F.transform(split_words(folded(line)), lambda w: F.struct(w.alias("word"), i.alias("line")))

    def matches(lines: Column) -> Column:
        each = F.sequence(F.lit(0), F.size(lines) - 1)
        whole = F.filter(each, lambda i: _score(bigrams(F.get(lines, i)), terms) >= dice)
        words = F.flatten(F.transform(lines, of_line))
        return bound(whole, lambda done: bound(words, lambda w: bound(_pairs(w), lambda p: best(done, w, p))))

    def best(done: Column, words: Column, pairs: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(pairs) - 1), lambda i: F.array_contains(terms, F.get(pairs, i))
        )
        scored = F.transform(
            starts,
            lambda i: F.struct(
                i.alias("at"),
                F.get(words, i)["line"].alias("line"),
                F.get(words, F.least(i + width, F.size(words)) - 1)["line"].alias("last"),
                _score(F.array_distinct(F.slice(pairs, i + 1, width - 1)), terms).alias("dice"),
            ),
        )
        close = F.filter(
            scored,
            lambda x: (x["dice"] >= dice) & ~F.exists(done, lambda i: i.between(x["line"], x["last"])),
        )

        def add(kept: Column, x: Column) -> Column:
            last = F.get(kept, F.size(kept) - 1)
            apart = (F.size(kept) == 0) | (x["at"] >= last["at"] + width)
            front = F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))
            return (
                F.when(apart, F.concat(kept, F.array(x)))
                .when(x["dice"] > last["dice"], F.concat(front, F.array(x)))
                .otherwise(kept)
            )

        return bound(close, lambda c: F.aggregate(c, F.slice(c, 1, 0), add))

    found = likely.select(
        "key", "template", F.explode(bound(F.split("text", separator), matches)).alias("m")
    )
    return found.select("key", "m.line", "template", "m.dice")


def _pairs(words: Column) -> Column:
    """The word bigrams of (word, line) entries, in order."""
    return F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
        lambda a, i: F.concat_ws(" ", a["word"], F.get(words, i + 1)["word"]),
    )
