"""License scan: passages against licence templates by the Dice coefficient over word bigrams.

Texts and templates are normalised alike (A-Z lower-cased; every run of ASCII characters
that are neither letters nor digits becomes one space).  The passages of a document are its
lines, its paragraphs of several lines (parted by blank lines), and the whole text if it
has several paragraphs.  With a and b distinct bigrams the coefficient 2c / (a + b) cannot
reach t unless t / (2 - t) <= a / b <= (2 - t) / t, so each template is entered under every
passage size it could match, and a passage meets templates by an equi-join on its size.
A match shares so many bigrams that it must hold one of a few key words; passages without
any are dropped before.  Long template lists are scanned in blocks.  DataFrame functions only.

Defined cases: NULL and empty texts have no passages; passages and templates of fewer than
two words have no bigrams and match nothing; rows that share an id report together, a NULL
id as NULL; documents without a match have no row; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_DICE = 0.8
MAX_TEMPLATE_BIGRAMS = 20_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = "[\\x00-\\x09\\x0B-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

# Short notices, standard headers, and paragraphs of licence texts, as they are commonly written.
TEMPLATES: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                         "compliance with the License.",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
                "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
                "permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "AGPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
                       "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
                       "any later version.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                         "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
                         "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
                         "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
                         "specific language governing permissions and limitations under the License.",
    "Apache-2.0-warranty": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
                           "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
                           "for the specific language governing permissions and limitations under the License.",
    "Apache-2.0-copyright-grant": "Grant of Copyright License. Subject to the terms and conditions of this License, each Contributor hereby "
                                  "grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright "
                                  "license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and "
                                  "distribute the Work and such Derivative Works in Source or Object form.",
    "BSD-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                      "following conditions are met:",
    "BSD-source-clause": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
                         "disclaimer.",
    "BSD-binary-clause": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
                         "following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-3-Clause-endorsement": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                                "products derived from this software without specific prior written permission.",
    "BSD-warranty": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
                    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
                    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
                    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
                    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
                    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
                    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "GPL-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
                      "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later "
                      "version.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                      "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
                      "version.",
    "GPL-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
                    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "GPL-copy": "You should have received a copy of the GNU General Public License along with this program. If not, see "
                "<https://www.gnu.org/licenses/>.",
    "GPL-verbatim": "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    "GPL-3.0-preamble": "The GNU General Public License is a free, copyleft license for software and other kinds of works.",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
                "provided that the above copyright notice and this permission notice appear in all copies.",
    "ISC-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
                    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
                    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
                    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
                    "THIS SOFTWARE.",
    "LGPL-2.1-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
                       "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
                       "any later version.",
    "MIT-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
                  "Software.",
    "MIT-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
                    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
                    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
                    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                      "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense-text": "This is free and unencumbered software released into the public domain.",
    "Unlicense-permission": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code "
                            "form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}


def normalised(text: Column) -> Column:
    """Line breaks stay, to tell lines and paragraphs apart."""
    return F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _GAP, " ")


def words(passage: Column) -> Column:
    return F.filter(F.split(passage, "[ \\n]"), lambda w: w != "")


def bigrams(word_list: Column) -> Column:
    """Distinct pairs of neighbouring words (of a list of two words or more)."""
    n = F.size(word_list) - 1
    return F.array_distinct(F.zip_with(F.slice(word_list, F.lit(1), n), F.slice(word_list, F.lit(2), n),
                                       lambda a, b: F.concat(a, F.lit(" "), b)))


def size_range(n: int, min_dice: float) -> range:
    """Passage sizes whose coefficient with a template of ``n`` bigrams can reach ``min_dice``."""
    sizes = range(math.floor(n * min_dice / (2 - min_dice)), math.ceil(n * (2 - min_dice) / min_dice) + 1)
    ok = [a for a in sizes if a and 2 * min(a, n) >= min_dice * (a + n)]
    return range(ok[0], ok[-1] + 1) if ok else range(0)


def key_words(templates: list[list[str]], min_dice: float) -> list[str]:
    """Words of which every passage that matches a template holds one.

    A match shares at least ``least`` of a template's n bigrams; where n - least + 1 of them
    hold a key word, one of those is shared.
    """
    chosen: set[str] = set()
    for pairs in templates:
        sizes = size_range(len(pairs), min_dice)
        least = math.ceil(min_dice * (sizes[0] + len(pairs)) / 2 - 1e-9) if sizes else len(pairs) + 1
        left = [p for p in (set(b.split(" ")) for b in pairs) if not p & chosen]
        while len(left) > least - 1:
            counts = Counter(w for p in left for w in p)
            word = max(counts, key=lambda w: (len(w) >= 6, counts[w], w))  # short words are common in any text
            chosen.add(word)
            left = [p for p in left if word not in p]
    return sorted(chosen)


def template_blocks(spark: SparkSession, templates: dict[str, str], max_bigrams: int) -> list[list[tuple[str, list[str]]]]:
    """Names and bigrams of the templates, in blocks of at most ``max_bigrams`` (or one template)."""
    rows = (spark.createDataFrame(sorted(templates.items()), "license string, body string")
            .withColumn("w", words(normalised(F.col("body")))).filter(F.size("w") > 1)
            .select("license", bigrams(F.col("w")).alias("t_bigrams")).collect())  # the caller's own list
    blocks: list[list[tuple[str, list[str]]]] = [[]]
    held = 0
    for r in rows:
        if blocks[-1] and held + len(r.t_bigrams) > max_bigrams:
            blocks.append([])
            held = 0
        blocks[-1].append((r.license, r.t_bigrams))
        held += len(r.t_bigrams)
    return blocks


def scan_licenses(spark: SparkSession, docs: DataFrame, templates: dict[str, str] | None = None, min_dice: float = MIN_DICE,
                  id_col: str = "doc_id", text_col: str = "text", max_bigrams: int = MAX_TEMPLATE_BIGRAMS) -> DataFrame:
    """``doc_id, license, n_passages, dice``: templates that a document's passages match, and the best coefficient."""
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), normalised(F.col(text_col)).alias("t"))
    paragraphs = F.split("t", "\\n *\\n[ \\n]*")
    several = F.filter(paragraphs, lambda p: F.contains(p, F.lit("\n")))
    whole = F.when(F.size(paragraphs) > 1, F.array("t")).otherwise(F.array().cast("array<string>"))
    passages = text.select("doc_id", F.explode(F.concat(F.split("t", "\\n"), several, whole)).alias("p"))
    found = None
    for block in template_blocks(spark, TEMPLATES if templates is None else templates, max_bigrams):
        part = _scan_block(spark, passages, block, min_dice)
        found = part if found is None else found.unionByName(part)
    return found.groupBy("doc_id", "license").agg(F.count("*").alias("n_passages"), F.max("dice").alias("dice"))


def _scan_block(spark: SparkSession, passages: DataFrame, block: list[tuple[str, list[str]]], min_dice: float) -> DataFrame:
    """``doc_id, license, dice``: the matches of one block of templates."""
    entries = [(size, name) for name, pairs in block for size in size_range(len(pairs), min_dice)]
    least, most = min((e[0] for e in entries), default=0), max((e[0] for e in entries), default=0)
    keys = F.array(*(F.lit(w) for w in key_words([pairs for _, pairs in block], min_dice))).cast("array<string>")
    listed = (passages.filter(F.length("p") >= 2 * least + 1)  # a bigram takes two characters more at least
              .select("doc_id", words(F.col("p")).alias("w"))
              .filter((F.size("w") > F.lit(max(1, least))) & F.arrays_overlap("w", keys))
              .filter(F.size(F.array_distinct("w")) <= F.lit(most + 1))
              .select("doc_id", bigrams(F.col("w")).alias("b")).withColumn("size", F.size("b")))
    # A block has at most MAX_TEMPLATE_BIGRAMS bigrams, or one template: a proven bound. Bodies are joined by name, not kept under every size.
    sizes = spark.createDataFrame(entries, "size int, license string")
    bodies = spark.createDataFrame(block, "license string, t_bigrams array<string>")
    met = listed.join(F.broadcast(sizes), "size").join(F.broadcast(bodies), "license")
    dice = (2.0 * F.size(F.array_intersect("b", "t_bigrams"))) / (F.size("b") + F.size("t_bigrams"))
    return met.select("doc_id", "license", dice.alias("dice")).filter(F.col("dice") >= min_dice)


def oracle_sql(templates: dict[str, str] | None = None, min_dice: float = MIN_DICE) -> str:
    """DuckDB SQL for :func:`scan_licenses`: every passage against every template."""
    values = ", ".join("('{}', '{}')".format(*(s.replace("'", "''") for s in t)) for t in (TEMPLATES if templates is None else templates).items())

    def norm(c: str) -> str:
        return f"regexp_replace(translate(coalesce({c}, ''), '{_UPPER}', '{_LOWER}'), '{_GAP}', ' ', 'g')"

    pairs = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    split = "list_filter(regexp_split_to_array({}, '[ \\n]'), lambda w: w <> '')"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS row, doc_id, {norm('text')} AS t FROM documents),
    g AS (SELECT row, doc_id, t, regexp_split_to_array(t, '\\n *\\n[ \\n]*') AS ps FROM d),
    p AS (SELECT row, doc_id, unnest(string_split(t, chr(10))) AS p FROM g
          UNION ALL SELECT row, doc_id, unnest(list_filter(ps, lambda x: contains(x, chr(10)))) FROM g
          UNION ALL SELECT row, doc_id, t FROM g WHERE len(ps) > 1),
    b AS (SELECT doc_id, {pairs} AS b FROM (SELECT doc_id, {split.format('p')} AS w FROM p) WHERE len(w) > 1),
    t AS (SELECT license, {pairs} AS tb FROM (SELECT license, {split.format(norm('body'))} AS w
          FROM (VALUES {values}) AS v(license, body)) WHERE len(w) > 1),
    s AS (SELECT doc_id, license, 2.0::DOUBLE * len(list_intersect(b, tb)) / (len(b) + len(tb)) AS dice FROM b, t
          WHERE 2.0 * least(len(b), len(tb)) >= {min_dice} * (len(b) + len(tb)))
    SELECT doc_id, license, count(*) AS n_passages, max(dice) AS dice FROM s WHERE dice >= {min_dice} GROUP BY doc_id, license"""


__all__ = ["TEMPLATES", "MIN_DICE", "size_range", "scan_licenses", "oracle_sql"]
