"""License scanning by diagonal voting.

Every rolling word k-gram of every text meets the k-grams of the license phrases in one join. A hit at word p of the
text and gram q of the phrase votes for the diagonal p - q. A phrase that stands unchanged puts all its grams on one
diagonal; a phrase with words put in or left out spreads over neighbouring ones, which are merged before the span is
verified.

Only DataFrame operations are used. Grams that meet no phrase end in the task that made them: the phrases are a fixed
small table, sent to all tasks. Only hits and one row per document are shuffled, by document.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.common import ascii_lower, documents_of, identified

NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The phrases of the contract.
BASE_PHRASES = (
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
)

# Sentences by which licenses are usually named or granted, in words as the scan sees them.
PHRASES = (
    ("agpl", "gnu affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike license"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)

# Whole license texts and notices, without names and years, as they are usually published.
TEMPLATES = (
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS
IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED
"AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE
OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF
USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED
OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License."""),
    ("gpl-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You
should have received a copy of the GNU General Public License along with this program."""),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for
any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original
software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is
not required. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software. This notice may not be removed or altered from any source distribution."""),
)

GRAM = 2  # words; the shortest phrase has two
LONG, LONG_GRAM = 40, 5  # templates of so many words meet by longer grams, which common words do not make
DRIFT = 3  # diagonals at most this far apart belong to one occurrence
SHARE = 0.8  # of a phrase's grams that a verified span holds


def words_of(text: Column) -> Column:
    """Words of letters a-z, digits and anything beyond ASCII, after lower-casing A-Z."""
    return F.array_remove(F.split(ascii_lower(text), NON_WORD), "")


def grams_of(words: Column, k: int = GRAM) -> Column:
    """All runs of k words, joined by a space; none when there are fewer words."""
    n = F.greatest(F.size(words) - (k - 1), F.lit(0))
    grams = F.slice(words, F.lit(1), n)
    for step in range(1, k):
        grams = F.zip_with(grams, F.slice(words, F.lit(step + 1), n), lambda a, b: F.concat(a, F.lit(" "), b))
    return grams


def plain_words(text: str) -> list[str]:
    """The same words of a phrase or template."""
    return [w for w in re.split(NON_WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]


def listed_phrases(base: tuple, own: tuple, k: int = GRAM) -> list[tuple[int, str, str, bool, int]]:
    """(number, label, words joined by a space, whether it must stand unchanged, words of its grams)."""
    rows = [(i, label, plain_words(phrase), i < len(base)) for i, (label, phrase) in enumerate((*base, *own))]
    if any(len(words) < k for _, _, words, _ in rows):
        raise ValueError(f"phrases need at least {k} words")
    return [(i, label, " ".join(w), exact, k if exact or len(w) < LONG else LONG_GRAM) for i, label, w, exact in rows]


def phrase_grams(spark: SparkSession, base: tuple, own: tuple, k: int = GRAM) -> DataFrame:
    """One row per gram of every phrase, and the empty gram that stands for the document itself."""
    rows = listed_phrases(base, own, k)
    table = spark.createDataFrame(rows, "phrase_no int, label string, phrase string, exact boolean, k int")
    words = F.split("phrase", " ")
    grams = F.when(F.col("k") == k, grams_of(words, k)).otherwise(grams_of(words, LONG_GRAM))
    listed = table.withColumn("grams", grams).select(
        "phrase_no", "label", "exact", "k", F.size("grams").alias("n_grams"), F.posexplode("grams").alias("q", "gram")
    )
    whole = spark.sql("SELECT -1 AS phrase_no, CAST(NULL AS STRING) AS label, false AS exact, 0 AS k, 0 AS n_grams, 0 AS q, '' AS gram")
    return listed.unionByName(whole).withColumn("gram_hash", F.xxhash64("gram"))


def hits(docs: DataFrame, phrases: DataFrame, k: int = GRAM) -> DataFrame:
    """(row, doc_id, n_words, phrase, q, p) for every gram that stands in a phrase; one more row per document.

    Grams of both lengths are listed one after the other. They meet by hash and are then compared as text.
    """
    words = docs.withColumns({"row": F.monotonically_increasing_id(), "words": words_of(F.col("text"))})
    grams = words.select("row", "doc_id", F.size("words").alias("n_words"), F.concat(
        grams_of(F.col("words"), k), grams_of(F.col("words"), LONG_GRAM), F.array(F.lit(""))).alias("grams"))
    # The outer form keeps the optimizer from computing the array a second time for a size test.
    placed = grams.select("row", "doc_id", "n_words", F.posexplode_outer("grams").alias("at", "text_gram"))
    # The phrases are a fixed list of some hundred grams.
    met = placed.withColumn("gram_hash", F.xxhash64("text_gram")).join(F.broadcast(phrases), "gram_hash")
    short = F.greatest(F.col("n_words") - (k - 1), F.lit(0))
    place = F.when(F.col("k") == LONG_GRAM, F.col("at") - short).otherwise(F.col("at"))
    return met.filter(F.col("text_gram") == F.col("gram")).withColumn("p", place).drop("gram_hash", "text_gram", "gram", "at")


def scan(docs: DataFrame, base: tuple = BASE_PHRASES, own: tuple = (*PHRASES, *TEMPLATES), id_column: str = "doc_id",
         text_column: str = "text", k: int = GRAM, drift: int = DRIFT, share: float = SHARE) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    A base phrase counts where all its grams lie on one diagonal. The other phrases, among them whole license texts of any
    length, are found when one span, merged from diagonals at most ``drift`` apart, holds ``share`` of their grams; those
    of ``LONG`` words and more have grams of ``LONG_GRAM`` words. ``score`` is the largest share
    found in the text. ``spans`` lists (label, start, end) of what was found, in words. A missing or empty text has no
    words and the score 0; rows repeated in the table are reported each for itself, also without doc_id; a text may be of
    any length; other columns are left out, whatever their names; no rows give no rows.
    """
    phrases = phrase_grams(docs.sparkSession, base, own, k)
    found = hits(identified(docs, id_column, text_column), phrases, k).repartition("row")
    document = ["row", "doc_id", "n_words"]
    phrase = ["phrase_no", "label", "exact", "n_grams", "k"]
    diagonals = found.withColumn("diagonal", F.col("p") - F.col("q")).groupBy(*document, *phrase, "diagonal").agg(
        F.collect_set("q").alias("marks"), F.min("p").alias("start"), F.max("p").alias("end"),  # no more than the phrase has grams
    )
    along = Window.partitionBy("row", "phrase_no").orderBy("diagonal")
    apart = F.col("exact") | (F.col("diagonal") - F.lag("diagonal").over(along) > drift)
    spans = diagonals.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int")).withColumn(
        "occurrence", F.sum("new").over(along)
    ).groupBy(*document, *phrase, "occurrence").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("marks")))).alias("n_found"), F.min("start").alias("start"),
        (F.max("end") + F.col("k")).alias("end"),
    )
    reached = F.col("n_found") / F.col("n_grams")
    whole = F.col("exact") & (F.col("n_found") == F.col("n_grams"))
    verified = whole | (~F.col("exact") & (reached >= share))
    named = F.when((F.col("phrase_no") >= 0) & verified, F.col("label"))
    return spans.groupBy(*document).agg(
        F.count_if(whole).alias("n_base"),
        F.min(F.when(whole, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(whole, F.col("start"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(whole, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(named)), ",").alias("labels"),
        F.coalesce(F.max(F.when(F.col("phrase_no") >= 0, reached)), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(named.isNotNull(), F.struct(
            F.col("label"), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end")
        )))).alias("spans"),
    ).select("doc_id", F.col("n_words").cast("long").alias("n_words"), "n_base", "first_word", "last_word",
             "base_labels", "labels", "score", "spans")


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan(documents_of(spark, folder)).drop("spans")


def sql() -> str:
    rows = listed_phrases(BASE_PHRASES, (*PHRASES, *TEMPLATES))
    values = ", ".join(f"({i}, '{label}', '{phrase}', {exact}, {k})" for i, label, phrase, exact, k in rows)
    return rf"""
    WITH phrases AS (
        SELECT no, label, exact, k, string_split(phrase, ' ') AS w FROM (VALUES {values}) t(no, label, phrase, exact, k)),
    numbered_grams AS (SELECT no, label, exact, k, len(w) - k + 1 AS n_grams, unnest(range(1, len(w) - k + 2)) AS q, w FROM phrases),
    grams AS (SELECT no, label, exact, k, n_grams, q, array_to_string(w[q:q + k - 1], ' ') AS gram FROM numbered_grams),
    texts AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents),
    places AS (SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS p, w FROM texts, (VALUES ({GRAM}), ({LONG_GRAM})) x(k)),
    text_grams AS (SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS gram FROM places),
    diagonals AS (
        SELECT doc_id, no, label, exact, n_grams, p - q AS d, list(DISTINCT q) AS marks, min(p) - 1 AS start
        FROM text_grams JOIN grams USING (k, gram) GROUP BY ALL),
    steps AS (
        SELECT *, coalesce(exact OR d - lag(d) OVER along > {DRIFT}, true) AS new
        FROM diagonals WINDOW along AS (PARTITION BY doc_id, no ORDER BY d)),
    numbered AS (SELECT *, sum(new::INT) OVER (PARTITION BY doc_id, no ORDER BY d) AS occurrence FROM steps),
    spans AS (
        SELECT doc_id, no, label, exact, n_grams, len(list_distinct(flatten(list(marks)))) AS n_found, min(start) AS start
        FROM numbered GROUP BY doc_id, no, label, exact, n_grams, occurrence),
    found AS (
        SELECT doc_id, count(*) FILTER (exact AND n_found = n_grams) AS n_base,
               min(start) FILTER (exact AND n_found = n_grams) AS first_word,
               max(start) FILTER (exact AND n_found = n_grams) AS last_word,
               list_sort(list(DISTINCT label) FILTER (exact AND n_found = n_grams)) AS base_labels,
               list_sort(list(DISTINCT label) FILTER (
                   CASE WHEN exact THEN n_found = n_grams ELSE n_found / n_grams >= {SHARE} END)) AS labels,
               max(n_found / n_grams) AS score
        FROM spans GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
           coalesce(array_to_string(base_labels, ','), '') AS base_labels,
           coalesce(array_to_string(labels, ','), '') AS labels, coalesce(score, 0) AS score
    FROM texts LEFT JOIN found USING (doc_id)
    """


QUERIES = {"op4_license_scan": op4_license_scan}
ORACLES = {"op4_license_scan": sql()}
