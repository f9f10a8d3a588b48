"""License scan: sparse TF-IDF cosine to templates, and inheritance from the nearest licensed directory.

A file's header (its leading comment with the comment marks taken off, or its first paragraph) and, if its name is that
of a licence file, its whole text are each one vector, compared with published texts, notices and titles. Every sentence
is one more candidate, compared with one-sentence forms. An SPDX line names its license itself. Candidates and templates
are TF-IDF vectors over the templates' terms;
document frequencies are counted over all files, and a term no template has weighs as much as the rarest one. Only
candidates that can reach the threshold are compared: a template's heaviest terms, without which the rest of its vector
is shorter than the threshold, must occur in part (an exact bound, by the Cauchy-Schwarz inequality). A file without a
license of its own inherits that of the licence file in the nearest directory above it: directories, not files, are
expanded to their ancestors and joined by path.

Defined results: a NULL or empty text has no license of its own; a file without a path inherits nothing; among equal
scores the smaller license name wins, among licence files of one directory the best score; rows of one path share what
their texts say; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm.common import bind, stored

#: Short forms of public licenses, and the notice that grants nothing. Fixed texts.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "proprietary": "All rights reserved.",
}
#: Published license texts, notices and titles. Fixed texts; what follows a slash tells those of one license apart.
MIT_TEXT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    'the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to '
    'permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright '
    'notice and this permission notice shall be included in all copies or substantial portions of the Software. THE '
    'SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    'WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR '
    'COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR '
    'OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
)
BSD_START = (
    'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the '
    'following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of '
    'conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, '
    'this list of conditions and the following disclaimer in the documentation and/or other materials provided with the '
    'distribution. '
)
BSD_THIRD = (
    '3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote '
    'products derived from this software without specific prior written permission. '
)
BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    'INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE '
    'DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, '
    'SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR '
    'SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, '
    'WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE '
    'OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
)
PUBLISHED = {
    "MIT/text": MIT_TEXT,
    "MIT/title": "MIT License",
    "MIT/long title": "The MIT License (MIT)",
    "BSD-2-Clause/text": BSD_START + BSD_END,
    "BSD-3-Clause/text": BSD_START + BSD_THIRD + BSD_END,
    "BSD-3-Clause/title": "BSD 3-Clause License",
    "ISC/text": (
        'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby '
        'granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE '
        'IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        'WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, '
        'INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER '
        'IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR '
        'PERFORMANCE OF THIS SOFTWARE.'
    ),
    "Apache-2.0/notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        'with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless '
        'required by applicable law or agreed to in writing, software distributed under the License is distributed on an '
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        'specific language governing permissions and limitations under the License.'
    ),
    "Apache-2.0/title": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    "GPL-3.0/notice": (
        'This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public '
        'License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any '
        'later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without '
        'even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public '
        'License for more details. You should have received a copy of the GNU General Public License along with this '
        'program. If not, see https://www.gnu.org/licenses/.'
    ),
    "GPL-3.0/title": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "MPL-2.0/notice": (
        'This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not '
        'distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.'
    ),
    "MPL-2.0/title": "Mozilla Public License Version 2.0",
}
SPDX = r"(?m)SPDX-License-Identifier:[\x20\t]*([A-Za-z0-9.+-]+(?:[\x20\t]+(?:AND|OR|WITH)[\x20\t]+[A-Za-z0-9.+-]+)*)"
COMMENT = r"^[\x20\t]*(?:#|//|/\*+|\*+/?|--|;|<!--|%|REM\b)"
THRESHOLD = 0.8
LICENSE_FILE = r"(?i)^(license|licence|copying)([.-].*)?$"
TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
SENTENCE_END = r"\n|(?<=[.!?])[\x20\t\r]+"


def terms_of(text: str) -> list[str]:
    return re.findall(TERM, text.lower())


def vocabulary(templates: dict[str, str]) -> list[str]:
    return sorted({t for text in templates.values() for t in terms_of(text)})


def any_word(words: list[str]) -> str:
    """A pattern of the words that shares their beginnings, so a text is not tried against each of them."""
    ends: dict[str, list[str]] = {}
    for word in words:
        ends.setdefault(word[:1], []).append(word[1:])
    parts = [re.escape(first) + any_word(rest) for first, rest in sorted(ends.items(), reverse=True) if first]
    if "" in ends:
        parts.append("")
    return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"


def whole_terms(words: list[str]) -> str:
    """A pattern of the words where each is a term of its own."""
    return rf"(?<![a-z0-9])(?<![a-z0-9][.-]){any_word(words)}(?![a-z0-9])(?![.-][a-z0-9])"


def template_frequencies(files: DataFrame, templates: dict[str, str]) -> tuple[int, dict[str, int]]:
    """The number of files, and for each template term the number of files with it: one row for each term."""
    whole = whole_terms(vocabulary(templates))
    found = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(whole), F.lit(0)))
    counted = files.select(F.explode(found).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    return files.count(), {r["term"]: r["n"] for r in counted.collect()}  # at most the templates' terms


class Weights:
    """Inverse document frequencies, template vectors of length one, and the terms a match cannot do without."""

    def __init__(self, n_files: int, frequencies: dict[str, int], templates: dict[str, str], threshold: float):
        self.other = math.log(n_files + 1) + 1
        self.idf = {t: math.log((n_files + 1) / (frequencies.get(t, 0) + 1)) + 1 for t in vocabulary(templates)}
        self.vectors, self.needed = {}, set()
        for name, text in templates.items():
            vector = {t: n * self.idf[t] for t, n in Counter(terms_of(text)).items()}
            length = math.sqrt(sum(v * v for v in vector.values()))
            self.vectors[name] = {t: v / length for t, v in vector.items()}
            rest = 1.0
            for term, value in sorted(self.vectors[name].items(), key=lambda x: (-x[1], x[0])):
                if rest < (threshold - 1e-9) ** 2:
                    break
                self.needed.add(term)
                rest -= value * value

    def table(self, spark: SparkSession) -> DataFrame:
        """(license, term, value): as many rows as the templates have terms."""
        rows = [(name, t, v) for name, vector in self.vectors.items() for t, v in vector.items()]
        return spark.createDataFrame(rows, "license string, term string, value double")


def sentences_of(text: Column) -> Column:
    return F.split(text, SENTENCE_END, -1)


def header_of(text: Column) -> Column:
    """The leading comment without its marks, or else the first paragraph, as one line."""

    def comment(lines: Column) -> Column:
        end = F.array_position(F.transform(lines, lambda line: line.rlike(COMMENT)), False).cast("int")
        block = F.when(end > 0, F.slice(lines, F.lit(1), end - 1)).otherwise(lines)
        return F.array_join(F.transform(block, lambda line: F.regexp_replace(line, COMMENT, "")), " ")

    start = F.regexp_replace(text, r"^\s*+(?:#![^\n]*+\s*+)?", "")
    marked = start.rlike(COMMENT)
    return F.when(marked, bind(F.split(start, "\n"), comment)).otherwise(F.split(start, r"\n[\x20\t\r]*\n", 2)[0])


def blocks_of(text: Column, path: Column) -> Column:
    """The header, and the whole text of a licence file."""
    named = F.coalesce(F.regexp_extract(path, "[^/]*$", 0).rlike(LICENSE_FILE), F.lit(False))
    return F.when(named, F.array(header_of(text), text)).otherwise(F.array(header_of(text)))


def spdx_licenses(files: DataFrame) -> DataFrame:
    """(path, tkey, license, score 1) of files that name their license in an SPDX line; the first line counts."""
    named = F.regexp_extract("text", SPDX, 1)
    found = files.where(F.contains("text", F.lit("SPDX-License-Identifier:")))
    return found.select("path", "tkey", named.alias("license"), F.lit(1.0).alias("score")).where("license <> ''").distinct()


def file_licenses(files: DataFrame, templates: dict[str, str], published: dict[str, str], threshold: float) -> DataFrame:
    """(path, tkey, license, score) of the files that have a license of their own, from all their candidates."""
    counts = template_frequencies(files, templates | published)  # one pass for all
    pieces = [(templates, sentences_of(F.col("text"))), (published, blocks_of(F.col("text"), F.col("path")))]
    found = [own_licenses(files, t, threshold, counts, p) for t, p in pieces if t]
    every = reduce(DataFrame.unionByName, [*found, spdx_licenses(files)])
    every = every.withColumn("license", F.regexp_replace("license", "/.*$", ""))
    names = F.struct("score", first_name(F.col("license")).alias("order"), "license")
    best = every.groupBy("path", "tkey").agg(F.max(names).alias("best"))
    return best.select("path", "tkey", "best.license", "best.score")


def own_licenses(
    files: DataFrame, templates: dict[str, str], threshold: float, counts: tuple[int, dict[str, int]], pieces: Column
) -> DataFrame:
    """(path, tkey, license, score) of the best template for the files that have one among their ``pieces``.

    A piece's terms are counted where its file is read. Its cosine with any template is at most the share of its length
    that lies in the templates' terms, so only pieces whose share reaches the threshold are moved at all.
    """
    spark = files.sparkSession
    weights = Weights(*counts, templates, threshold)
    needed = any_word(sorted(weights.needed))
    sentences = F.filter(pieces, lambda s: F.lower(s).rlike(rf"(?<![a-z0-9]){needed}(?![a-z0-9])"))
    candidates = files.select("path", "tkey", F.posexplode(F.array_distinct(sentences)).alias("place", "sentence"))
    idf = F.create_map(*[F.lit(x) for pair in sorted(weights.idf.items()) for x in pair])
    low = F.lower("sentence")
    found = candidates.select(
        "path",
        "tkey",
        "place",
        F.regexp_extract_all(low, F.lit(whole_terms(sorted(weights.idf))), F.lit(0)).alias("known"),
        F.regexp_count(low, F.lit(TERM)).alias("n"),
    )
    weighted = F.transform(
        F.array_distinct("known"),
        lambda t: F.struct(
            t.alias("term"),
            (F.size(F.filter("known", lambda x: x == t)) * F.try_element_at(idf, t)).alias("weight"),
        ),
    )
    share = F.aggregate("terms", F.lit(0.0), lambda total, t: total + t["weight"] * t["weight"])
    # A word without a template's term is a dimension of its own for each occurrence.
    square = F.col("share") + (F.col("n") - F.size("known")) * weights.other**2
    lengths = (
        found.withColumn("terms", weighted)
        .withColumn("share", share)
        .withColumn("square", square)
        .where(F.col("share") >= (threshold - 1e-9) ** 2 * F.col("square"))
        .select("path", "tkey", "place", "terms", F.sqrt("square").alias("length"))
        .dropDuplicates(["path", "tkey", "place"])  # rows of one path and text are one file
    )
    scored = (
        lengths.select("path", "tkey", "place", "length", F.explode("terms").alias("t"))
        .select("path", "tkey", "place", "length", "t.*")
        .join(F.broadcast(weights.table(spark)), "term")
        .groupBy("path", "tkey", "place", "license", "length")
        .agg(F.sum(F.col("weight") * F.col("value")).alias("dot"))
        .select("path", "tkey", "license", F.round(F.col("dot") / F.col("length"), 6).alias("score"))
    )
    best = F.max(F.struct("score", negated_name(F.col("license"), sorted(templates)).alias("order"), "license"))
    return (
        scored.where(F.col("score") >= threshold)
        .groupBy("path", "tkey")
        .agg(best.alias("best"))
        .select("path", "tkey", "best.license", "best.score")
    )


def first_name(license: Column) -> Column:
    """Larger for names that come first, whatever the names are: an SPDX line may say anything."""
    codes = F.transform(F.split(license, ""), lambda c: -F.ascii(c))
    return F.concat(codes, F.array(F.lit(1)))


def negated_name(license: Column, names: list[str]) -> Column:
    """Larger for names that come first."""
    return -F.array_position(F.lit(names), license)


def folder(path: Column) -> Column:
    """The directory of a path, without a slash at its end; the root is empty."""
    return F.regexp_replace(path, "/[^/]*$", "")


def licenses(
    docs: DataFrame,
    path: str = "path",
    text: str = "text",
    templates: dict | None = None,
    threshold: float = THRESHOLD,
    published: dict | None = None,
) -> DataFrame:
    """(row, own_license, own_score, license, inherited_from) for every row; ``row`` holds all columns but the text,
    so texts are never shuffled."""
    templates = templates or TEMPLATES
    published = PUBLISHED if published is None else published
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text])
    rows = docs.select(whole.alias("row"), F.col(path).alias("path"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("tkey", F.xxhash64("text"))
    found = file_licenses(rows.select("path", "tkey", "text"), templates, published, threshold)
    own = stored(found, "own-licenses")

    files = own.where(F.regexp_extract("path", "[^/]*$", 0).rlike(LICENSE_FILE))
    order = first_name(F.col("license"))
    granted = files.groupBy(folder(F.col("path")).alias("above")).agg(
        F.max(F.struct("score", order.alias("order"), "license")).alias("best")
    )
    granted = granted.select("above", F.col("best.license").alias("given"))
    folders = rows.select(folder(F.col("path")).alias("folder")).where("folder is not null").distinct()
    parts = F.split("folder", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    nearest = (
        folders.select("folder", F.explode(above).alias("above"))
        .join(granted, "above")
        .groupBy("folder")
        .agg(F.max(F.struct(F.length("above").alias("depth"), "above", "given")).alias("near"))
        .select("folder", F.col("near.above").alias("above"), "near.given")
    )
    slim = rows.select("row", "path", "tkey", folder(F.col("path")).alias("folder"))
    mine = own.select(F.col("path").alias("own_path"), F.col("tkey").alias("own_key"), "license", "score")
    return (
        slim.join(mine, F.col("path").eqNullSafe(F.col("own_path")) & (F.col("tkey") == F.col("own_key")), "left")
        .join(nearest, "folder", "left")
        .select(
            "row",
            F.col("license").alias("own_license"),
            F.col("score").alias("own_score"),
            F.coalesce("license", "given").alias("license"),
            F.when(F.col("license").isNull() & F.col("given").isNotNull(), F.concat("above", F.lit("/"))).alias(
                "inherited_from"
            ),
        )
    )


def as_files(docs: DataFrame) -> DataFrame:
    """Documents as a file tree: /source/lang/thousands/hundreds/tens/name. Every tenth file is its directory's
    LICENSE, every hundredth and thousandth that of the directories above; all other files are texts."""
    number = F.col("doc_id")
    levels = [F.floor(number / size).cast("string") for size in (1000, 100, 10)]
    depth = F.when(number % 1000 == 0, 1).when(number % 100 == 0, 2).when(number % 10 == 0, 3).otherwise(4)
    name = F.when(depth < 4, F.concat(F.lit("LICENSE-"), number.cast("string"))).otherwise(
        F.concat(number.cast("string"), F.lit(".txt"))
    )
    base = [F.lit(""), F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none"))]
    path = F.concat_ws("/", *base, F.when(depth > 1, levels[0]), F.when(depth > 2, levels[1]), F.when(depth > 3, levels[2]), name)
    return docs.select("doc_id", "text", F.when(number.isNotNull(), path).alias("path"))


def license_report(docs: DataFrame) -> DataFrame:
    files = as_files(docs)
    found = licenses(files)
    return found.select(
        "row.doc_id", "row.path", "own_license", "own_score", "license", "inherited_from"
    )
