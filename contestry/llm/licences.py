"""Licence scans by canonical digest lookup.

A text's canonical form is without copyright lines, in lower case, with equivalent spellings made one,
and with single spaces in place of punctuation and white space; so line breaks don't matter. A copyright
line is one that begins with a mark and a year, a name or a place for them; prose about "the copyright
notice" stays, also where a line happens to begin with it. The SHA-256 digests of canonical whole texts,
and of each of their lines (a notice is usually a line), are hash-joined to the digests of the known
licence texts: the fixed list here, or a table of the caller's, whose joins are broadcast only where it
is counted as small.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import UPPER, let, small, text_of, written

# Spellings that count as the same, wherever they stand.
SPELLINGS = {
    "licence": "license",
    "sublicence": "sublicense",
    "organisation": "organization",
    "acknowledgement": "acknowledgment",
    "authorised": "authorized",
    "whilst": "while",
    "favour": "favor",
    "honour": "honor",
    "merchantibility": "merchantability",
    "sub license": "sublicense",
    "non commercial": "noncommercial",
    "copyright holder": "copyright owner",
    "per cent": "percent",
    "https": "http",
}

# Licence texts as published.
MIT = """MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """ISC License

Copyright (c) <year> <owner>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
ZLIB = """zlib License

Copyright (c) <year> <owner>

This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""
BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""
BSL = """Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""

# Identifier and the names it goes by.
NAMES = {
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache 2.0"],
    "MIT": ["MIT License", "MIT"],
    "ISC": ["ISC License", "ISC"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "BSD-2-Clause"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "BSD-3-Clause"],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL 2.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU GPL v2", "GPL-2.0"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU GPL v3", "GPL-3.0"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "LGPL-3.0"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "AGPL-3.0"],
    "CC0-1.0": ["CC0 1.0", "CC0"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
}
PHRASES = ["{lead} under {the}{name}", "This work is {lead} under {the}{name}", "This software is {lead} under {the}{name}", "This project is {lead} under {the}{name}"]
LEADS = ["Licensed", "Released", "Distributed", "Available"]


def known_texts() -> list[tuple[str, str]]:
    """(identifier, text): whole licence texts, and the notices that name a licence."""
    titled = [("MIT", MIT), ("ISC", ISC), ("Zlib", ZLIB), ("BSL-1.0", BSL)]
    out = [*titled, *((identifier, text.partition("\n\n")[2]) for identifier, text in titled), ("Apache-2.0", APACHE_NOTICE), ("Unlicense", UNLICENSE)]
    bsd2, bsd3 = f"{BSD_HEAD}\n\n{BSD_TAIL}", f"{BSD_HEAD}\n\n{BSD_THIRD}\n\n{BSD_TAIL}"
    out += [("BSD-2-Clause", bsd2), ("BSD-2-Clause", f"BSD 2-Clause License\n\n{bsd2}"), ("BSD-3-Clause", bsd3), ("BSD-3-Clause", f"BSD 3-Clause License\n\n{bsd3}")]
    for identifier, names in NAMES.items():
        out.append((identifier, f"SPDX-License-Identifier: {identifier}"))
        for phrase in PHRASES:
            for lead in LEADS:
                for the in ("", "the "):
                    shown = lead.lower() if phrase.startswith("This") else lead
                    out += [(identifier, phrase.format(lead=shown, the=the, name=name)) for name in names]
    return out


#: Most lengths of known texts that lines are told apart by before they are digested.
LENGTHS = 2_000
LETTER = r"\p{L}\p{N}"
#: A mark with a year, a name or a place for one; the name is told by its capital.
COPYRIGHT_LINE = rf"(?m)^[^{LETTER}\n(©]*(?:(?i:copyright|copr)[.:,]? *(?:(?i:\(c\))|©|[<\[{{0-9]|(?i:by) |\p{{Lu}}\p{{Ll}}|$)|(?i:\(c\)) *(?:[<\[{{0-9]|(?i:copyright))|©|(?i:all rights reserved))[^\n]*$"

#: Words that make "Copyright" part of a sentence, however they are spelled: such a line is text, also where a wrap puts it first.
CONTINUED = r"((?i:copyright)) +((?i:holder|owner|proprietor|licen[cs]e|law|notice|act|statement|disclaimer|interest)s?)\b"


def canonical_lines(text: Column) -> Column:
    """The canonical form, line by line (joined by \\n); only A-Z are lower-cased, spellings count between words."""
    out = F.regexp_replace(text_of(text), CONTINUED, "$1 _$2")
    out = F.regexp_replace(out, COPYRIGHT_LINE, "")
    out = F.translate(out, UPPER, UPPER.lower())
    out = F.regexp_replace(out, rf"[^{LETTER}\n]+", " ")
    out = F.regexp_replace(out, r" ?\n[ \n]*", "\n")
    for old, new in SPELLINGS.items():
        out = let(out, lambda x, old=old, new=new: F.when(F.contains(x, F.lit(old)), F.regexp_replace(x, rf"(^|[ \n]){old}(s?)($|[ \n])", f"$1{new}$2$3")).otherwise(x))
    return F.trim(F.regexp_replace(out, r"^\n+|\n+$", ""))


def whole(lines: Column) -> Column:
    return F.trim(F.replace(lines, F.lit("\n"), F.lit(" ")))


def known_digests(known: DataFrame) -> DataFrame:
    """licence, digest, length: of the known texts (licence, text) by the same canonical form; one row a digest."""
    known = known.select("licence", whole(canonical_lines(F.col("text"))).alias("canonical")).where("canonical <> ''")
    return known.groupBy(F.sha2("canonical", 256).alias("digest")).agg(F.min("licence").alias("licence"), F.max(F.length("canonical")).alias("length"))


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """doc_id, digest, licence (of the whole text, or null), n_notices, notices (sorted identifiers of its lines).

    known: licence, text of the texts to look for; without it the list of this module. Null, empty and
    wordless texts have the digest of the empty text and no licence; very long texts are digested whole.
    Repeated rows get a row each; further columns don't matter; an empty table stays empty.
    """
    spark = docs.sparkSession
    known = small(known_digests(spark.createDataFrame(known_texts(), "licence string, text string") if known is None else known))
    lines = docs.select("doc_id", canonical_lines(F.col("text")).alias("lines"))
    # a line of another length than all known texts can't be one of them: its digest isn't needed
    lengths = known.select("length").distinct().limit(LENGTHS + 1).collect()
    units = F.transform(F.split("lines", "\n"), lambda x: F.trim(x))
    if len(lengths) <= LENGTHS:
        units = F.filter(units, lambda x: F.length(x).isin([r.length for r in lengths]))
    light = lines.select("doc_id", F.sha2(whole(F.col("lines")), 256).alias("digest"), F.transform(units, lambda x: F.sha2(x, 256)).alias("units"))
    light = written(light.withColumn("row", F.monotonically_increasing_id()), "licences")
    names = known.select(F.col("digest").alias("known"), "licence")
    hits = light.select("row", F.explode("units").alias("unit")).join(names, F.col("unit") == F.col("known"))
    hits = hits.groupBy("row").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("found"))
    out = light.drop("units").join(names, F.col("digest") == F.col("known"), "left").join(hits, "row", "left")
    return out.select("doc_id", "digest", "licence", F.coalesce("n", F.lit(0)).cast("long").alias("n_notices"), F.coalesce("found", F.lit("")).alias("notices"))


def oracle_sql() -> str:
    """The same scan as SQL; the known texts are values in it."""

    def canonical(text: str) -> str:
        pattern = COPYRIGHT_LINE.replace("'", "''")
        out = f"regexp_replace(coalesce({text}, ''), '{CONTINUED}', '\\1 _\\2', 'g')"
        out = f"translate(regexp_replace({out}, '{pattern}', '', 'g'), '{UPPER}', '{UPPER.lower()}')"
        out = f"regexp_replace({out}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"
        out = f"regexp_replace({out}, ' ?\\n[ \\n]*', chr(10), 'g')"
        for old, new in SPELLINGS.items():
            out = f"regexp_replace({out}, '(^|[ \\n]){old}(s?)($|[ \\n])', '\\1{new}\\2\\3', 'g')"
        return f"trim(regexp_replace({out}, '^\\n+|\\n+$', '', 'g'))"

    values = ", ".join("({}, {})".format(*("'" + x.replace("'", "''") + "'" for x in pair)) for pair in known_texts())
    return f"""
WITH texts(licence, text) AS (VALUES {values}),
known AS (SELECT sha256(trim(replace(c, chr(10), ' '))) AS digest, min(licence) AS licence FROM (SELECT licence, {canonical("text")} AS c FROM texts) WHERE trim(replace(c, chr(10), ' ')) <> '' GROUP BY 1),
d AS (SELECT row_number() OVER () AS rid, doc_id, {canonical("text")} AS c FROM documents),
u AS (SELECT rid, sha256(trim(unnest(string_split(c, chr(10))))) AS unit FROM d),
h AS (SELECT rid, count(*) AS n, array_to_string(list_sort(list(DISTINCT licence)), ',') AS found FROM u JOIN known ON unit = digest GROUP BY rid),
w AS (SELECT rid, doc_id, sha256(trim(replace(c, chr(10), ' '))) AS digest FROM d)
SELECT doc_id, w.digest, known.licence, coalesce(n, 0)::BIGINT AS n_notices, coalesce(found, '') AS notices
FROM w LEFT JOIN known ON w.digest = known.digest LEFT JOIN h ON w.rid = h.rid
"""
