"""Licence scans by canonical digest.

A text is brought to a canonical form: lower case, without copyright lines, punctuation as blanks, equivalent spellings made
one. The digest of the whole canonical text is looked up by a hash join among the digests of known licences and licence
notices. The scan looks at a document as a whole, and at each of its lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Texts of known licences, as published, and one-line notices.
LICENSES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.""",
}
NOTICES = {
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Released under the MIT License.": "MIT",
    "Licensed under the MIT License.": "MIT",
    "Released under the BSD License.": "BSD",
    "Licensed under CC BY 4.0.": "CC-BY-4.0",
    "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "This work is licensed under the Mozilla Public License, version 2.0.": "MPL-2.0",
}
#: Usual titles of the known texts; with one of them a text is known as well.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License", "The BSD 3-Clause License", "New BSD License"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "0BSD License"),
    "Unlicense": ("The Unlicense", "Unlicense"),
    "Zlib": ("zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License"),
}
NOTICES |= {f"{title}\n\n{LICENSES[name]}": name for name, titles in TITLES.items() for title in titles}
SPDX = ("0BSD", "AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense", "Zlib")
SPDX += ("CC-BY-SA-4.0", "CC-BY-NC-4.0", *(f"{x}-{y}" for x in ("AGPL-3.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0") for y in ("only", "or-later")))
#: Spellings that count as one, on words of the canonical form.
SPELLINGS = {
    "acknowledgement": "acknowledgment",
    "analyse": "analyze",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorised": "authorized",
    "copyright owner": "copyright holder",
    "copyright owners": "copyright holders",
    "favour": "favor",
    "https": "http",
    "initialise": "initialize",
    "judgement": "judgment",
    "labour": "labor",
    "licence": "license",
    "licenced": "licensed",
    "licences": "licenses",
    "merchantibility": "merchantability",
    "non commercial": "noncommercial",
    "non infringement": "noninfringement",
    "organisation": "organization",
    "per cent": "percent",
    "sub license": "sublicense",
    "utilisation": "utilization",
    "whilst": "while",
}
#: How licences go on where a wrapped line begins with "copyright"; what else follows it is a year, a sign or a holder.
BODY_WORDS = (
    "and as claim claims disclaimer disclaimers holder holders in information infringement interest interests is law laws licence licences license licenses "
    "may notice notices of on or owner owners ownership permission permissions protection right rights shall statement statements to treaties treaty"
).split()


def _other_word(words: list[str], started: bool = False) -> str:
    """Pattern of the beginning of a word that is none of these, in syntax without look-ahead."""
    follow: dict[str, list[str]] = {}
    for word in words:
        follow.setdefault(word[:1], []).append(word[1:])
    ended = follow.pop("", None)
    letters = "".join(sorted(follow))
    free = "".join(c for c in "abcdefghijklmnopqrstuvwxyz0123456789" if c not in letters)
    parts = [rf"[{free}]|[^\x00-\x7f]" if ended or not started else rf"[^{letters}\n]|$"]
    parts += [head + _other_word(rest, True) for head, rest in sorted(follow.items())]
    return f"(?:{'|'.join(parts)})"


COPYRIGHT_LINE = rf"(?m)^[^\p{{L}}\p{{N}}\n]*(?:copyright[^\p{{L}}\p{{N}}\n]+{_other_word(BODY_WORDS)}|\(c\)|©|all rights reserved)[^\n]*$"
OTHER = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    """Canonical form of a text; a null text is null."""
    words = F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), COPYRIGHT_LINE, " "), OTHER, " "))
    # two blanks between words: neighbours that are both replaced do not share one
    words = F.concat(F.lit(" "), F.replace(words, F.lit(" "), F.lit("  ")), F.lit(" "))
    for spelling, one in SPELLINGS.items():
        words = F.replace(words, *(F.lit(f" {x.replace(' ', '  ')} ") for x in (spelling, one)))
    return F.trim(F.replace(words, F.lit("  "), F.lit(" ")))


def digest(text: Column) -> Column:
    """Digest of a text's canonical form. Texts without any letter or digit have the digest of the empty text."""
    return F.sha2(F.encode(canonical(text), "utf-8"), 256)


#: Known texts at most: their digests are held by every task.
MOST_KNOWN = 20_000
#: What a line of a known text has to hold to be worth a digest.
LINE_WORDS = "licen[cs]e|software|warrant"


def known_texts(spark: SparkSession) -> DataFrame:
    """text and license of every text that this module knows: some dozens of rows."""
    texts = [*((text, name) for name, text in LICENSES.items()), *NOTICES.items(), *((f"SPDX-License-Identifier: {x}", x) for x in SPDX)]
    return spark.createDataFrame(texts, "text string, license string")


def license_files(spark: SparkSession, folder: str) -> DataFrame:
    """text and license of the files of a folder; a file's name without its ending is its licence."""
    files = spark.read.text(folder, wholetext=True).select(F.col("value").alias("text"), F.col("_metadata.file_name").alias("name"))
    return files.select("text", F.regexp_replace("name", r"\.(?i:txt|md)$", "").alias("license"))


def known_licenses(spark: SparkSession, texts: DataFrame | None = None) -> DataFrame:
    """digest and license of known texts (text, license; this module's own if None); the smallest name of texts that are alike."""
    texts = known_texts(spark) if texts is None else texts
    return texts.groupBy(digest(F.col("text")).alias("digest")).agg(F.min("license").alias("license"))


def scan(docs: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """doc_id, digest (of the whole canonical text), license (of the whole text, or null), notices (licences that whole lines
    name, each once, in order of name, joined by commas; empty if none); one row per row of docs.

    docs: doc_id, text; other columns are left aside. Null texts count as empty. Lines are what line feeds part. texts: known
    texts with their licences, as from known_texts (the default) or license_files; more than MOST_KNOWN are refused.
    """
    spark = docs.sparkSession
    given = known_texts(spark) if texts is None else texts
    names = {row["digest"]: row["license"] for row in known_licenses(spark, given).limit(MOST_KNOWN + 1).collect()}
    if len(names) > MOST_KNOWN:
        raise ValueError(f"more than {MOST_KNOWN} known texts")
    known = F.broadcast(spark.createDataFrame(sorted(names.items()), "digest string, license string"))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", digest(text).alias("digest"), text.alias("text"))
    by_digest = F.create_map(*(F.lit(x) for pair in sorted(names.items()) for x in pair)) if names else F.lit(None).cast("map<string,string>")
    # only lines with a word that all known texts have are worth a digest
    lines = F.split("text", "\n")
    if given.filter(~F.lower("text").rlike(LINE_WORDS)).isEmpty():
        lines = F.filter(lines, lambda line: F.lower(line).rlike(LINE_WORDS))
    found = F.array_sort(F.array_distinct(F.filter(F.transform(lines, lambda line: F.try_element_at(by_digest, digest(line))), lambda x: x.isNotNull())))
    return rows.join(known, "digest", "left").select("doc_id", "digest", "license", F.array_join(found, ",").alias("notices"))
