"""Licence scan by canonical digest (native: DataFrame functions only).

Texts are brought to a canonical form: lower case, copyright lines dropped,
punctuation and white space folded to single blanks, equivalent spellings
unified.  The SHA-256 of the canonical form of an *entire* unit is hash-joined
to the digests of known licences, canonicalised in the same way.  Units are the
whole document (licence texts) and each of its lines (licence notices).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Words that count as one (public licence-matching guidelines).
EQUIVALENT = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact",
    "authorisation": "authorization", "authorised": "authorized", "cancelled": "canceled",
    "catalogue": "catalog", "categorise": "categorize", "centre": "center", "favour": "favor",
    "favourite": "favorite", "fulfil": "fulfill", "fulfilment": "fulfillment", "initialise": "initialize",
    "judgement": "judgment", "labelling": "labeling", "labour": "labor", "licence": "license",
    "licences": "licenses", "licenced": "licensed", "maximise": "maximize", "modelled": "modeled",
    "modelling": "modeling", "offence": "offense", "optimise": "optimize", "organisation": "organization",
    "organise": "organize", "practise": "practice", "programme": "program", "realise": "realize",
    "recognise": "recognize", "signalling": "signaling", "utilisation": "utilization", "whilst": "while",
    "wilful": "willful", "sublicence": "sublicense", "https": "http",
}

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS
OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""

BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution.
"""

BSD_NO_NAME = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.
"""

BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter
it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software.
If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.

3. This notice may not be removed or altered from any source distribution."""

# (licence, unit, text): the licence texts as whole documents, the usual notices as lines.
KNOWN = [
    ("MIT", "document", MIT), ("MIT", "document", "MIT License\n\n" + MIT),
    ("ISC", "document", ISC), ("ISC", "document", "ISC License\n\n" + ISC),
    ("BSD-2-Clause", "document", BSD_HEAD + BSD_TAIL),
    ("BSD-3-Clause", "document", BSD_HEAD + BSD_NO_NAME + BSD_TAIL),
    ("Zlib", "document", ZLIB), ("Zlib", "document", "zlib License\n\n" + ZLIB),
    ("MIT", "line", "Released under the MIT License."), ("MIT", "line", "Licensed under the MIT License."),
    ("MIT", "line", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "line", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "line", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "line", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "line", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "line", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "line", "Licensed under CC BY 4.0."),
]

COPYRIGHT_LINE = r"(?m)^[ \t]*(?:copyright|\(c\)|©|all rights reserved)[^\n]*$"
PUNCTUATION = r"[^\p{L}\p{N}\n]+"


def known_licences(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KNOWN, "licence string, unit string, text string")


def _same_spelling(word):
    items = list(EQUIVALENT.items())
    out = F.when(word == items[0][0], items[0][1])
    for a, b in items[1:]:
        out = out.when(word == a, b)
    return out.otherwise(word)


def canonical_lines(text):
    """Array of the canonical non-empty lines of ``text`` (null: empty array)."""
    folded = F.regexp_replace(F.regexp_replace(F.lower(text), COPYRIGHT_LINE, ""), PUNCTUATION, " ")
    lines = F.filter(F.transform(F.split(folded, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    same = F.transform(lines, lambda x: F.array_join(F.transform(F.split(x, " "), _same_spelling), " "))
    return F.coalesce(same, F.array().cast("array<string>"))


def _digest(text):
    return F.sha2(text, 256)


def license_scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Licences of every row of ``docs(doc_id, text)``: one output row for each input row.

    Columns: ``doc_id``, ``canon_sha256`` (digest of the canonical whole text,
    null if that is empty), ``text_licence`` (the licence whose text the whole
    document is, else null), ``line_licences`` (sorted distinct licences that a
    line states, comma-joined, empty if none), ``n_lines`` (such lines).

    ``known(licence, unit, text)`` has unit ``document`` or ``line``; rows with a
    null field or an empty canonical text are ignored, and of licences with one
    digest the first name counts.  Null and empty documents have no licence.
    Repeated rows each get a row; other columns are not read.

    Only digests are exploded and joined, never texts.  The digests of a
    document meet again in a partial aggregate on its row number, so a notice
    that every document bears is no hot group.
    """
    k = (known.where("licence IS NOT NULL AND unit IS NOT NULL")
         .withColumn("lines", canonical_lines(F.col("text"))).where(F.size("lines") > 0)
         .groupBy(F.col("unit").alias("k_unit"), _digest(F.array_join("lines", " ")).alias("k_digest"))
         .agg(F.min("licence").alias("k_licence")))
    by_line = k.where("k_unit = 'line'").select("k_digest", "k_licence")
    by_text = k.where("k_unit = 'document'").select(F.col("k_digest").alias("canon_sha256"),
                                                    F.col("k_licence").alias("text_licence"))
    lines = (docs.select("doc_id", canonical_lines(F.col("text")).alias("lines"))
             .select(F.monotonically_increasing_id().alias("row"), "doc_id",
                     F.when(F.size("lines") > 0, _digest(F.array_join("lines", " "))).alias("canon_sha256"),
                     F.transform("lines", lambda x: _digest(x)).alias("digests"))
             .select("row", "doc_id", "canon_sha256", F.explode_outer("digests").alias("line_digest")))
    found = (lines.join(by_line, F.col("line_digest") == F.col("k_digest"), "left")
             .groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("canon_sha256").alias("canon_sha256"),
                                 F.array_join(F.sort_array(F.collect_set("k_licence")), ",").alias("line_licences"),
                                 F.count("k_licence").alias("n_lines")))
    return (found.join(by_text, "canon_sha256", "left")
            .select("doc_id", "canon_sha256", "text_licence", "line_licences", "n_lines"))
