"""Licence scan: normalised lines, paragraphs and texts against licence templates, by the Dice coefficient of their word bigrams.

The templates are a short fixed list of notices, headers and complete licences. A template can reach the threshold only if the numbers
of bigrams are in reach of one another, so it is compared with a text only within these bounds, and only if the text has one of the
few words without which too many of the template's bigrams would be missing. Everything is column expressions on the text's own row:
no shuffle.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce
from math import ceil
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Notices, headers and texts of public licences.
MIT_NOTICE = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
)
MIT_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF'
    " MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE"
    " FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN"
    " CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
ISC_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED'
    " WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR"
    " CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,"
    " NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
BSD_SOURCE = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
BSD_BINARY = (
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in"
    " the documentation and/or other materials provided with the distribution."
)
BSD_NAMES = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from"
    " this software without specific prior written permission."
)
BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT'
    " LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE"
    " COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES"
    " (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)"
    " HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)"
    " ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
APACHE_WARRANTY = (
    'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,'
    " WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing"
    " permissions and limitations under the License."
)
GPL_WARRANTY = (
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of"
    " MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
)
GPL_COPY = (
    "You should have received a copy of the GNU General Public License along with this program. If not, see"
    " <https://www.gnu.org/licenses/>."
)
TEMPLATES = {
    "mit-short": "Released under the MIT License.",
    "apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-short": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-short": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
        ' (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,'
        " merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is"
        " furnished to do so, subject to the following conditions:"
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided"
        " that the above copyright notice and this permission notice appear in all copies."
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
        " conditions are met:"
    ),
    "apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'
        " You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "gpl-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as"
        " published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "mit-notice": MIT_NOTICE,
    "mit-warranty": MIT_WARRANTY,
    "isc-warranty": ISC_WARRANTY,
    "bsd-warranty": BSD_WARRANTY,
    "apache-2.0-warranty": APACHE_WARRANTY,
    "gpl-warranty": GPL_WARRANTY,
}
TEMPLATES |= {
    "mit-text": "\n".join([TEMPLATES["mit"], MIT_NOTICE, MIT_WARRANTY]),
    "isc-text": "\n".join([TEMPLATES["isc"], ISC_WARRANTY]),
    "bsd-2-clause-text": "\n".join([TEMPLATES["bsd"], BSD_SOURCE, BSD_BINARY, BSD_WARRANTY]),
    "bsd-3-clause-text": "\n".join([TEMPLATES["bsd"], BSD_SOURCE, BSD_BINARY, BSD_NAMES, BSD_WARRANTY]),
    "apache-2.0-header": "\n".join([TEMPLATES["apache-2.0"], APACHE_WARRANTY]),
    "gpl-3.0-header": "\n".join([TEMPLATES["gpl-3.0"], GPL_WARRANTY, GPL_COPY]),
}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """A-Z in lower case, every run of other characters than a-z and 0-9 one space, none at the ends."""
    return F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), "[^a-z0-9]+", " "))


def bigrams(text: Column) -> Column:
    """The distinct pairs of neighbouring words of a normalised text; fewer than two words have none."""
    words = F.split(text, " ")
    pairs = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.size(words)), lambda a, b: F.concat_ws(" ", a, b))
    return F.when(F.size(words) > 1, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def _template_bigrams(text: str) -> list[str]:
    words = "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def _required(sets: dict[str, list[str]], least: float) -> list[str]:
    """Words of which every unit that comes to the threshold has at least one.

    A unit lacks at most a share of ``1 - least`` of a template's bigrams, so it cannot lack all the words that more bigrams than that
    touch. Long words that touch many are taken first, those that another template needs already before them.
    """
    taken: set[str] = set()
    for _, pairs in sorted(sets.items()):
        may_lack = len(pairs) - ceil(least * len(pairs) - 1e-9)
        left = [tuple(p.split(" ")) for p in pairs]
        own = {w for p in left for w in p}
        left = [p for p in left if not taken & set(p)]
        while len(pairs) - len(left) <= may_lack:
            touched = Counter(w for p in left for w in set(p))
            word = max(sorted(own & touched.keys()), key=lambda w: touched[w] * max(len(w) - 3, 0.1) ** 2)
            taken.add(word)
            left = [p for p in left if word not in p]
    return sorted(taken)


def _has_any(text: Column, words: list[str]) -> Column:
    """Whether a text contains one of the words; the text is computed once, not once a word."""
    return F.exists(F.array(text), lambda t: reduce(or_, [F.contains(t, F.lit(w)) for w in words], F.lit(False)))


def _units(lines: Column) -> Column:
    """(kind, unit, line) of the normalised lines of a text: its lines, its paragraphs of several lines, the whole text."""
    one = lambda kind, unit, line: F.struct(F.lit(kind).alias("kind"), unit.cast("int").alias("unit"), line.alias("line"))
    single = F.transform(lines, lambda line, i: one("line", i, line))
    cut = F.split(F.btrim(F.array_join(lines, "\n"), F.lit("\n")), "\n\n+")
    several = F.filter(F.transform(cut, lambda p, i: one("paragraph", i, p)), lambda u: F.contains(u["line"], F.lit("\n")) & (F.size(cut) > 1))
    several = F.transform(several, lambda u: one("paragraph", u["unit"], F.replace(u["line"], F.lit("\n"), F.lit(" "))))
    whole = F.array(one("text", F.lit(-1), F.array_join(F.filter(lines, lambda line: line != ""), " ")))
    return F.when(F.size(lines) > 1, F.concat(single, several, whole)).otherwise(single)


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.8, templates: dict[str, str] | None = None) -> DataFrame:
    """(key, kind, unit, license, dice): every template that a line or a paragraph of a text, or the whole text, resembles.

    ``kind`` is line, paragraph or text and ``unit`` its number from 0, or -1 for a whole text. Paragraphs end at lines without a letter
    a-z or digit; those of one line count as a line alone. The whole text, and paragraphs if there are several, are compared where a
    text has more than one line. Null and empty texts, and units of fewer than two words, resemble nothing. Other columns of ``docs``
    are ignored; repeated rows are reported each.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is a share above 0")
    sets = {name: _template_bigrams(body) for name, body in (TEMPLATES if templates is None else templates).items()}
    sets = {name: own for name, own in sets.items() if own}
    least, most = threshold / (2 - threshold), (2 - threshold) / threshold
    slack = 1e-9
    smallest, largest = min((len(s) for s in sets.values()), default=0), max((len(s) for s in sets.values()), default=0)
    words = _required(sets, least)
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("body")).where(_has_any(F.lower("body"), words))
    rows = rows.select("id", F.transform(F.split("body", "\n"), normalised).alias("lines"))
    rows = rows.select("id", F.explode(_units(F.col("lines"))).alias("u")).select("id", "u.kind", "u.unit", "u.line")
    # a text has at most as many bigrams as blanks, and at least as many as distinct words but one
    blanks = F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit("")))
    rows = rows.where((blanks >= least * smallest - slack) & _has_any(F.col("line"), words))
    rows = rows.where(F.size(F.array_distinct(F.split("line", " "))) - 1 <= most * largest + slack)
    rows = rows.select("id", "kind", "unit", bigrams(F.col("line")).alias("pairs"))
    tested = [F.struct(F.lit("").alias("license"), F.lit(None).cast("double").alias("dice"))]
    for name, own in sets.items():
        n = F.size("pairs")
        shared = F.size(F.array_intersect("pairs", F.split(F.lit("\n".join(own)), "\n")))
        dice = F.lit(2.0) * shared / (n + len(own))
        fits = F.when((n >= least * len(own) - slack) & (n <= most * len(own) + slack), dice)
        tested.append(F.struct(F.lit(name).alias("license"), fits.alias("dice")))
    found = rows.select("id", "kind", "unit", F.explode(F.filter(F.array(*tested), lambda t: t["dice"] >= threshold)).alias("t"))
    return found.select(F.col("id").alias(key), "kind", "unit", "t.license", "t.dice")


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def _sql() -> str:
    quoted = ", ".join("('{}', '{}')".format(n, b.replace("'", "''")) for n, b in TEMPLATES.items())
    norm = f"trim(regexp_replace(translate(line, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g'))"
    return f"""
WITH raw AS (SELECT doc_id, string_split(text, chr(10)) AS ls, text,
                    regexp_split_to_array(regexp_replace(text, '^([^A-Za-z0-9\\n]*\\n)+', ''), '\\n([^A-Za-z0-9\\n]*\\n)+') AS ps
             FROM documents WHERE text IS NOT NULL),
units AS (SELECT doc_id, 'line' AS kind, unnest(range(0, len(ls))) AS unit, unnest(ls) AS line FROM raw
          UNION ALL SELECT doc_id, 'paragraph', unnest(range(0, len(ps))), unnest(ps) FROM raw WHERE len(ps) > 1
          UNION ALL SELECT doc_id, 'text', -1, text FROM raw WHERE len(ls) > 1),
words AS (SELECT doc_id, kind, unit, string_split({norm}, ' ') AS ws FROM units WHERE kind <> 'paragraph' OR regexp_matches(line, '[A-Za-z0-9].*\\n.*[A-Za-z0-9]', 's')),
pairs AS (SELECT doc_id, kind, unit, list_distinct([ws[i] || ' ' || ws[i + 1] FOR i IN range(1, len(ws))]) AS a FROM words WHERE len(ws) > 1),
templates AS (SELECT license, list_distinct([ws[i] || ' ' || ws[i + 1] FOR i IN range(1, len(ws))]) AS b
              FROM (SELECT license, string_split({norm}, ' ') AS ws FROM (VALUES {quoted}) AS t(license, line)))
SELECT doc_id, kind, unit::INTEGER AS unit, license, 2.0::DOUBLE * len(list_intersect(a, b)) / (len(a) + len(b)) AS dice
FROM pairs, templates WHERE 2.0::DOUBLE * len(list_intersect(a, b)) / (len(a) + len(b)) >= 0.8
"""


SQL = _sql()
