"""License scans: exact phrases, and an exact set-similarity join of text blocks with license templates.

A block is a run of consecutive words of the whole text, one and a half times as long as a template's text, wherever lines break; it is
compared as a set of lower-case words. A template matches a text if some block holds at least ``threshold`` of the template's
words. So a notice is found however it is wrapped or indented, and words scattered over a longer passage are not.

Words are ordered by the number of documents that they are in, rare ones first. A block and a template with an overlap of at least ``need`` words share
a word within the template's first ``size - need + 1`` words in that order (prefix filter). So an index table of these words alone is joined with each document's distinct words, and a document
without any of them is looked at no further. A pair that meets there must leave ``need`` words from its first shared one on (positional filter) in a text of at least ``need`` different words (length
filter). Only then are the other words of those texts joined with those of their templates, and every block is verified. The blocks of a text are
dealt into tiles of one block's length; a tile's group holds the places of template words in two such lengths, so its size is bounded by the template.
Words in no template cannot add to an overlap, so only template words are looked at. Templates are tables, written once: the plan does not grow with their number.
They are broadcast as long as they have at most ``BROADCAST_WORDS`` words. Matching depends on the text alone, so equal texts are matched once.

Edge cases: null and empty texts have no words and no labels; the label columns are then empty strings; repeated
rows (also of a null id) are each returned with the same labels; labels that tie are all given, the score is the greatest; very long texts are split
into words whole, and their blocks spread over many groups; an empty table gives no rows; extra columns are not carried along, so their names
cannot clash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tailframe.llm.common import staged

#: Java character class of what separates words after lower-casing: ASCII but for digits and a-z.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rows of a small table of words or of matches up to which it is broadcast; a row takes some hundred bytes at most.
BROADCAST_WORDS = 200_000


@dataclass(frozen=True)
class Template:
    label: str
    text: str

    def sequence(self) -> list[str]:
        return "".join(c if c.isascii() and c.isalnum() else " " for c in self.text.lower()).split()

    def words(self) -> list[str]:
        return sorted(set(self.sequence()))

    def span(self) -> int:
        """Words in a block that is compared with this template."""
        return -(-3 * len(self.sequence()) // 2)


#: Notices by which texts name their license, short ones and whole ones.
TEMPLATES = (
    Template("apache-2", "Licensed under the Apache License, Version 2.0"),
    Template(
        "apache-2",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    ),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    Template(
        "bsd",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code
        must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list
        of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND
        CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
        DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
        LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT,
        STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    ),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    Template("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    Template("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    Template(
        "gpl-3",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either
        version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
        warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    ),
    Template(
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this
        permission notice appear in all copies.""",
    ),
    Template("mit", "Released under the MIT License"),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    Template(
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without
        restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom
        the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial
        portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS
        FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
        TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    Template(
        "mpl-2",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at
        http://mozilla.org/MPL/2.0/.""",
    ),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    Template(
        "unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source
        code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
    ),
)

#: Phrases whose words must stand consecutively, and their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case wherever words are compared with ASCII words.

    ``lower`` is far faster than translating single characters. It also lowers other letters, which changes no
    word's bounds and no ASCII word; the two letters whose lower case holds an ASCII letter are replaced first.
    """
    text = F.replace(F.coalesce(text, F.lit("")), F.lit("İ"), F.lit("ı"))
    return F.lower(F.replace(text, F.lit("K"), F.lit("ĸ")))


def phrase_places(phrase: str, w: Column) -> Column:
    """Indices of the words at which the phrase's words stand consecutively."""
    parts = phrase.split(" ")

    def here(i: Column) -> Column:
        test = F.get(w, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            test = test & (F.get(w, i + k) == part)
        return F.coalesce(test, F.lit(False))

    return F.filter(F.sequence(F.lit(0), F.greatest(F.size(w) - 1, F.lit(0))), here)


def _small(df: DataFrame) -> DataFrame:
    """The table, broadcast if it is known to be small."""
    return F.broadcast(df) if df.count() <= BROADCAST_WORDS else df


def _keyed_words(docs: DataFrame, text_col: str) -> DataFrame:
    """(_key, _words): the words of each text in order, and a digest of the text."""
    low = docs.select(ascii_lower(F.col(text_col)).alias("_low"))
    return low.select(F.md5("_low").alias("_key"), F.array_remove(F.split("_low", BREAK + "+"), "").alias("_words"))


def template_words(docs: DataFrame, templates: tuple[Template, ...], threshold: float = 0.9, text_col: str = "text") -> DataFrame:
    """One row for each word of a template: _w, _template, _label, _size, _need, _span and ``_at``, its place in the order of frequency among the documents."""
    sets = [(k, t.label, t.words(), t.span()) for k, t in enumerate(templates)]
    rows = [(w, k, label, len(ws), math.ceil(round(threshold * len(ws), 9)), span) for k, label, ws, span in sets for w in ws]
    own = staged(docs.sparkSession.createDataFrame(rows, "_w string, _template int, _label string, _size int, _need int, _span int"), "template-words")
    seen = _keyed_words(docs, text_col).select(F.explode(F.array_distinct("_words")).alias("_w"))
    counts = seen.join(_small(own.select("_w").distinct()), "_w").groupBy("_w").agg(F.count("*").alias("_n"))
    order = Window.partitionBy("_template").orderBy(F.coalesce("_n", F.lit(0)), "_w")
    return staged(own.join(counts, "_w", "left").withColumn("_at", F.row_number().over(order) - 1).drop("_n"), "template-order")


def candidates(docs: DataFrame, words: DataFrame, text_col: str = "text") -> DataFrame:
    """(_key, _template): the texts that share a word with a template's prefix, and may hold enough of its words from there on."""
    index = words.where("_at <= _size - _need").select("_w", "_template", "_size", "_need", "_at")
    each = _keyed_words(docs, text_col).select("_key", F.array_distinct("_words").alias("_set"))
    each = each.select("_key", F.size("_set").alias("_n"), F.explode("_set").alias("_w"))
    met = each.join(_small(index), "_w").where("_n >= _need")
    first = met.groupBy("_key", "_template", "_size", "_need").agg(F.min("_at").alias("_first"))
    return first.where("_size - _first >= _need").select("_key", "_template")


def scan_licenses(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, phrases: tuple[tuple[str, str], ...] = PHRASES, threshold: float = 0.9, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``score`` is 1 with a base label, else the greatest containment of a matching template, else 0.
    """
    low = ascii_lower(F.col("text"))
    # A document can hold a phrase only if it holds each of its words; only then are its words looked at one by one.
    may_hold = F.lit(False)
    for phrase, _ in phrases:
        each = F.lit(True)
        for part in phrase.split(" "):
            each = each & F.contains(F.col("_low"), F.lit(part))
        may_hold = may_hold | each
    nowhere = F.array().cast("array<int>")
    places = {f"_at{k}": F.when(may_hold, phrase_places(phrase, F.col("_words"))).otherwise(nowhere) for k, (phrase, _) in enumerate(phrases)}
    base = (
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        .withColumn("_low", low)
        .withColumn("_words", F.array_remove(F.split("_low", BREAK + "+"), ""))
        .withColumns({"n_words": F.size("_words").cast("long"), **places})
        .select("doc_id", "n_words", *places, F.md5("_low").alias("_text"))
    )
    words = template_words(docs, templates, threshold, text_col)
    fits = candidates(docs, words, text_col).groupBy("_key").agg(F.collect_set("_template").alias("_fits"))
    fits = staged(fits, "license-candidates")
    texts = _keyed_words(docs, text_col).join(_small(fits), "_key").groupBy(F.col("_key").alias("_text")).agg(F.first("_fits").alias("_fits"), F.first("_words").alias("_words"))
    by_tile = (
        texts.select("_text", "_fits", F.posexplode("_words").alias("_pos", "_w"))
        .join(_small(words), "_w")
        .where(F.array_contains("_fits", F.col("_template")))
        .withColumn("_tile", F.floor(F.col("_pos") / F.col("_span")).cast("int"))
        .withColumn("_tile", F.explode(F.array("_tile", F.col("_tile") - 1)))
        .groupBy("_text", "_template", "_label", "_size", "_need", "_span", "_tile")
        .agg(F.collect_set(F.struct("_pos", "_at")).alias("_here"))
    )
    ahead = lambda o: F.transform(F.filter("_here", lambda x: x["_pos"].between(o["_pos"], o["_pos"] + F.col("_span") - 1)), lambda x: x["_at"])
    starts = F.filter("_here", lambda o: o["_pos"] < (F.col("_tile") + 1) * F.col("_span"))
    overlaps = F.transform(starts, lambda o: F.size(F.array_distinct(ahead(o))))
    matched = (
        by_tile.where(F.size(F.array_distinct(F.transform("_here", lambda o: o["_at"]))) >= F.col("_need"))
        .withColumn("_overlap", F.array_max(overlaps))
        .where("_overlap >= _need")
    )
    found = matched.groupBy(F.col("_text").alias("_t")).agg(F.collect_set("_label").alias("_found"), F.max(F.col("_overlap") / F.col("_size")).alias("_best"))
    base_labels = F.array_compact(F.array(*(F.when(F.size(f"_at{k}") > 0, label) for k, (_, label) in enumerate(phrases)))) if phrases else F.array().cast("array<string>")
    all_places = F.concat(nowhere, *(F.col(f"_at{k}") for k in range(len(phrases))))
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return (
        base.join(_small(staged(found, "license-found")), F.col("_text") == F.col("_t"), "left")
        .withColumns({"_all": all_places, "_base": base_labels})
        .select(
            "doc_id",
            "n_words",
            F.size("_all").cast("long").alias("n_base"),
            F.array_min("_all").cast("long").alias("first_word"),
            F.array_max("_all").cast("long").alias("last_word"),
            joined(F.col("_base")).alias("base_labels"),
            joined(F.concat("_base", F.coalesce("_found", F.array().cast("array<string>")))).alias("labels"),
            F.when(F.size("_base") > 0, 1.0).otherwise(F.coalesce("_best", F.lit(0.0))).alias("score"),
        )
    )
