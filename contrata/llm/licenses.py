"""Licence scan by canonical digest lookup, with DataFrame functions alone.

A text is canonical once A-Z are lower-cased, typographic quotes and dashes are plain, copyright and all-rights-reserved
lines are gone, equivalent spellings are one, and runs of ASCII characters other than letters and digits are a space.
Its SHA-256 is looked up among the digests of known texts, which pass through the same expressions. Two units are
looked up: the entire document, and each entire line that speaks of a licence (notices stand on lines of their own).

The table of known texts is a constant of this module, so the broadcast has a fixed bound; documents aren't shuffled.

Cases: null text: empty, and an empty canonical text is never a licence. Very long text: as any other. Null doc_id: carried
along. Repeated rows: a row each. Extra columns, whatever their names: left out. Empty table: no rows.
"""

from __future__ import annotations

import pkgutil
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts of public licences and of the notices that refer to one.
KNOWN: list[tuple[str, str]] = [
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n3. This notice may not be removed or altered from any source distribution."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
]

#: Complete texts that stand as files beside this module, each with its titles as far as they are on lines of their own.
FILES = {"Apache-2.0": "Apache-2.0", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-2.1": "LGPL-2.1", "LGPL-3.0": "LGPL-3", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0", "BSD-3-Clause": "BSD-3-Clause"}
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "0BSD License"],
    "Zlib": ["zlib License", "The zlib License", "zlib/libpng License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License"],
}
#: What begins the appendix on how to use a licence, and the terms after a title, where files may end or begin.
APPENDIX = re.compile(r"END OF TERMS AND CONDITIONS\n")


def _whole_texts() -> list[tuple[str, str]]:
    """The complete texts, with each of their titles, without the title and without the appendix."""
    own = [(name, text) for name, text in KNOWN if name in TITLES and len(text) > 500]
    for name, file in FILES.items():
        text = pkgutil.get_data(__package__, f"texts/{file}.txt").decode("utf-8")
        own.append((name, text))
        if (m := APPENDIX.search(text)) is not None:
            own += [(name, text[: m.end()]), (name, text[: m.start()])]
    three = next(text for name, text in own if name == "BSD-3-Clause")
    third = re.compile(r"3\. Neither.*?permission\.\n\n", re.S)
    own.append(("BSD-2-Clause", third.sub("", three)))
    own += [(name, re.sub(r"(?m)^\d\. ", "* ", text)) for name, text in own if name.startswith("BSD")]
    return own + [(name, f"{title}\n\n{text}") for name, text in own for title in TITLES.get(name, [])]


KNOWN += _whole_texts()

#: Equivalent spellings, the second one canonical, applied in this order to lower-cased text.
SPELLINGS: list[tuple[str, str]] = [
    ("licence", "license"), ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"), ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("capitalisation", "capitalization"), ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"), ("emphasised", "emphasized"), ("favour", "favor"), ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("judgement", "judgment"), ("labour", "labor"),
    ("merchantibility", "merchantability"), ("modelling", "modeling"), ("organisation", "organization"), ("organise", "organize"), ("practise", "practice"), ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"), ("signalling", "signaling"), ("utilisation", "utilization"),
    ("whilst", "while"), ("wilful", "willful"), ("non-commercial", "noncommercial"), ("non-infringement", "noninfringement"), ("sub-license", "sublicense"), ("per cent", "percent"), ("copyright owner", "copyright holder"), ("https", "http"), ("version 2.0", "version 2"), ("v. 2.0", "version 2"), ("3-clause", "3 clause"), ("2-clause", "2 clause"),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TYPOGRAPHIC, PLAIN = "“”‘’–—", "\"\"''--"
#: Words after which "copyright" at a line's beginning is part of a sentence, and names no holder.
SENTENCE = ["notice", "holder", "owner", "licen", "law", "statement", "interest", "protect", "disclaimer", "permission", "and ", "or ", "in ", "to ", "is ", "on ", "of "]


def _not_starting(words: list[str]) -> str:
    """A pattern of beginnings that none of the words has; DuckDB's patterns have no lookahead."""
    heads = sorted({w[0] for w in words})
    deeper = [(h, [w[1:] for w in words if w[0] == h]) for h in heads]
    return "(?:" + "|".join([f"[^{''.join(heads)}\\n]", *[h + _not_starting(rest) for h, rest in deeper if all(rest)]]) + ")"


#: Lines that name a holder or reserve rights; the mark must begin the line but for other signs.
DROPPED_LINE = rf"(^|\n)[^a-z0-9\n]*(copyright {_not_starting(SENTENCE)}|\(c\) |©|all rights reserved)[^\n]*"
NOT_ALNUM = r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def canonical(text: Column) -> Column:
    """The canonical form of a text; a sequence of expressions that stays in generated code."""
    x = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER + TYPOGRAPHIC, LOWER + PLAIN)
    x = F.regexp_replace(x, DROPPED_LINE, "\n")
    for a, b in SPELLINGS:
        x = F.replace(x, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(x, NOT_ALNUM, " "))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def known_digests(spark: SparkSession) -> DataFrame:
    """(digest, license) of the known texts, each digest once."""
    known = spark.createDataFrame(KNOWN, "license string, text string")
    return known.select(digest(F.col("text")).alias("digest"), "license").groupBy("digest").agg(F.min("license").alias("license"))


def license_scan(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, canonical_sha256, license (of the entire text, else null), notices (the licences whose text is an entire line, sorted and joined by commas)."""
    spark = docs.sparkSession
    known = [(r.digest, r.license) for r in known_digests(spark).collect()]  # a constant's digests
    table = spark.createDataFrame(known, "d string, license string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    speaking = F.filter(F.split("text", "\n", -1), lambda line: line.rlike("(?i)licen[sc]e|released under"))
    lookup = F.create_map(*[F.lit(x) for pair in known for x in pair])
    notices = F.filter(F.transform(speaking, lambda line: F.try_element_at(lookup, digest(line))), lambda x: x.isNotNull())
    found = rows.select("doc_id", digest(F.col("text")).alias("canonical_sha256"), F.array_join(F.array_sort(F.array_distinct(notices)), ",").alias("notices"))
    joined = found.join(F.broadcast(table), found["canonical_sha256"] == table["d"], "left")
    return joined.select("doc_id", "canonical_sha256", "license", "notices")


def _sql_canonical(text: str) -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    x = f"translate(coalesce({text}, ''), {quote(UPPER + TYPOGRAPHIC)}, {quote(LOWER + PLAIN)})"
    x = f"regexp_replace({x}, {quote(DROPPED_LINE)}, chr(10), 'g')"
    for a, b in SPELLINGS:
        x = f"replace({x}, {quote(a)}, {quote(b)})"
    return f"trim(regexp_replace({x}, {quote(NOT_ALNUM)}, ' ', 'g'), ' ')"


def oracle() -> str:
    """DuckDB SQL with the rows of license_scan(documents)."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({quote(name)}, {quote(text)})" for name, text in KNOWN)
    return f"""
WITH known AS (SELECT sha256({_sql_canonical("t")}) AS d, min(license) AS license FROM (VALUES {values}) AS k(license, t) GROUP BY 1),
line AS (SELECT DISTINCT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS t FROM documents),
notice AS (SELECT doc_id, text, string_agg(DISTINCT known.license, ',' ORDER BY known.license) AS notices FROM line JOIN known ON known.d = sha256({_sql_canonical("t")}) WHERE regexp_matches(t, '(?i)licen[sc]e|released under') GROUP BY 1, 2)
SELECT documents.doc_id, sha256({_sql_canonical("documents.text")}) AS canonical_sha256, known.license AS license, coalesce(notices, '') AS notices
FROM documents LEFT JOIN known ON known.d = sha256({_sql_canonical("documents.text")}) LEFT JOIN notice ON notice.doc_id IS NOT DISTINCT FROM documents.doc_id AND notice.text IS NOT DISTINCT FROM documents.text"""
