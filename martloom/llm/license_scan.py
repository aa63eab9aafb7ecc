"""License scan by canonical digests: texts are normalised as licence matching guidelines ask, and whole texts (or whole
lines of them) are hash-joined to the digests of known licences.
"""

from __future__ import annotations

import hashlib
import re
from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.shared import written

# Public licence texts and notices; longer texts are in the folder licenses.
KNOWN = {
    "MIT": """MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """ISC License

Copyright (c) <year> <owner>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Zlib": """zlib License

Copyright (c) <year> <owner>

This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.""",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT notice": "Released under the MIT License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
}

# First lines under which the short texts above are found.
TITLES = {
    "MIT": ["The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "MIT"],
    "ISC": ["The ISC License", "ISC License (ISC)", "The ISC License (ISC)", "ISC"],
    "Zlib": ["The zlib License", "The zlib/libpng License", "zlib/libpng License"],
}

# Names of licences in notices, the first being the SPDX identifier.
NAMES = {
    "AGPL-3.0": ["AGPL-3.0", "GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "GNU AGPL v3", "AGPLv3"],
    "Apache-2.0": ["Apache-2.0", "Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache 2.0 License", "Apache-2.0 License", "Apache 2.0"],
    "BSD-2-Clause": ["BSD-2-Clause", "BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD-3-Clause", "BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"],
    "BSL-1.0": ["BSL-1.0", "Boost Software License, Version 1.0", "Boost Software License 1.0"],
    "CC-BY-4.0": ["CC-BY-4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-NC-SA-4.0": ["CC-BY-NC-SA-4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
    "CC-BY-ND-4.0": ["CC-BY-ND-4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-SA-4.0": ["CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC0-1.0": ["CC0-1.0", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal"],
    "GFDL-1.3": ["GFDL-1.3", "GNU Free Documentation License, Version 1.3"],
    "GPL-2.0": ["GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL v2", "GPLv2"],
    "GPL-3.0": ["GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL v3", "GPLv3"],
    "ISC": ["ISC", "ISC License"],
    "LGPL-2.1": ["LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "GNU LGPL v2.1", "LGPLv2.1"],
    "LGPL-3.0": ["LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later", "GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "GNU LGPL v3", "LGPLv3"],
    "MIT notice": ["MIT", "MIT License"],
    "MPL-2.0": ["MPL-2.0", "Mozilla Public License, version 2.0", "Mozilla Public License, v. 2.0", "Mozilla Public License 2.0", "MPLv2"],
    "OFL-1.1": ["OFL-1.1", "SIL Open Font License, Version 1.1", "SIL Open Font License 1.1"],
    "Unlicense": ["Unlicense"],
    "Zlib": ["Zlib", "zlib License"],
}
NOTICES = [f"{start}{how} under {the}{{}}" for start in ("", "This work is ", "This project is ", "This software is ", "This program is ", "This file is ", "This code is ") for how in ("licensed", "released", "distributed") for the in ("", "the ")]
NOTICES += ["License: {}", "SPDX-License-Identifier: {}"]
#: Whole first lines of the notices that licences themselves ask for.
ASKED = {
    "Apache-2.0": ['Licensed under the Apache License, Version 2.0 (the "License")', 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}

#: Spellings of the same text: (odd, usual) as patterns; each may hold anywhere in a text.
SPELLINGS = [
    (r"https://", "http://"),
    (r"http://", "https://"),
    (r"and/or distribute this", "and distribute this"),
    (r"(?m)^.*Copyright \[yyyy\].*$", ""),
    (r"51 Franklin (?:Street|St), Fifth Floor,\s+Boston, MA\s+02110-1301,?\s+USA", "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA"),
    (r"51 Franklin (?:Street|St), Fifth Floor,\s+Boston, MA\s+02110-1301,?\s+USA", "675 Mass Ave, Cambridge, MA 02139, USA"),
]
#: Texts up to this many characters are kept without the numbers of their items too.
SHORT = 4000

# Spellings that licence matching treats as equal, after punctuation is gone.
EQUIVALENT = [
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("cancelled", "canceled"),
    ("copyright holder", "copyright owner"),
    ("favour", "favor"),
    ("fulfil ", "fulfill "),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labelled", "labeled"),
    ("licence", "license"),
    ("modelling", "modeling"),
    ("non commercial", "noncommercial"),
    ("organisation", "organization"),
    ("per cent", "percent"),
    ("practise", "practice"),
    ("recognise", "recognize"),
    ("sub license", "sublicense"),
    ("whilst", "while"),
    ("wilful", "willful"),
]

_COPYRIGHT = r"(?im)^[^\p{L}\p{N}\n]*(?:copyright\b(?:[^\p{L}\n]*\b(?:c|by)\b|[^\p{L}\n]*\d|\s*[(<©])|\(c\)\s|©|all rights reserved)[^\n]*$"


def _words(low: Column) -> Column:
    """Without copyright lines; a space for every run of other characters than letters, digits and line ends."""
    named = low.contains("copyright") | low.contains("(c)") | low.contains("\u00a9") | low.contains("all rights reserved")
    return F.regexp_replace(F.when(named, F.regexp_replace(low, _COPYRIGHT, "")).otherwise(low), r"[^\p{L}\p{N}\n]+", " ")


def _alike(plain: Column) -> Column:
    for odd, usual in EQUIVALENT:
        plain = F.replace(plain, F.lit(odd), F.lit(usual))
    return plain


def _whole(words: Column) -> Column:
    return _alike(F.trim(F.regexp_replace(words, r" ?\n[ \n]*", " ")))


def canonical(text: Column) -> Column:
    """Lower case without copyright lines and punctuation, one space between words, equivalent spellings made one."""
    return _whole(_words(F.lower(text)))


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column: a generated one is not copied into each expression that reads it."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _digest(plain: Column) -> Column:
    return F.when(plain != "", F.sha2(plain, 256))


def digest(text: Column) -> Column:
    """SHA-256 of the canonical text; null if nothing is left of it."""
    return _digest(canonical(text))


def plain(text: str) -> str:
    """`canonical` without Spark, for a text of ASCII letters whose lines end in \\n."""
    low = re.sub(_COPYRIGHT.replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9"), "", text.lower())
    words = re.sub(r"[\W_]+", " ", low).strip()
    for odd, usual in EQUIVALENT:
        words = words.replace(odd, usual)
    return words


def spellings(titles: list[str], body: str, appendix: str = "") -> set[str]:
    """Canonical texts of a licence: with each title and none, with and without appendix, in every spelling."""
    kept = {f"{head}\n\n{body}\n\n{tail}" for head in ("", *titles) for tail in ("", appendix)}
    for odd, usual in SPELLINGS:
        kept |= {re.sub(odd, usual, x) for x in kept}
    if len(body) <= SHORT:
        kept |= {re.sub(r"(?m)^\s*(?:\(?\d\)|\d\.)[ \t]", " ", x) for x in kept}
    kept |= {re.sub(r"(?<=\S)[ \t]*\n[ \t]*(?=\S)", " ", x) for x in kept}
    return {plain(x) for x in kept}


def full_texts() -> dict[str, set[str]]:
    """Canonical texts by licence: those of the folder and the longer ones of KNOWN. A file has titles (parted by %), body and appendix, parted by %%."""
    texts = {}
    for file in sorted(files(__package__).joinpath("licenses").iterdir(), key=lambda f: f.name):
        titles, body, appendix = file.read_text(encoding="utf-8").split("\n%%\n")
        texts[file.name.removesuffix(".txt")] = spellings(titles.split("\n%\n"), body, appendix)
    for name, titles in TITLES.items():
        title, body = KNOWN[name].split("\n\n", 1)
        texts[name] = spellings([title, *titles], body)
    return texts


def usual_notices() -> dict[str, set[str]]:
    return {name: {plain(n.format(x)) for n in NOTICES for x in names} | {plain(x) for x in ASKED.get(name, ())} for name, names in NAMES.items()}


def known_table(spark: SparkSession, texts: dict[str, str] = KNOWN) -> DataFrame:
    """(license, digest) of `texts` and, with the texts of KNOWN, of all full texts and usual notices."""
    rows = F.array(*[F.struct(F.lit(name).alias("license"), F.lit(text).alias("text")) for name, text in texts.items()])
    given = spark.range(1).select(F.inline(rows)).select("license", digest(F.col("text")).alias("digest"))
    if texts is not KNOWN:
        return given
    digests = sorted({(name, hashlib.sha256(x.encode()).hexdigest()) for table in (full_texts(), usual_notices()) for name, kept in table.items() for x in kept})
    listed = "\n".join(f"{name} {x}" for name, x in digests)
    line = spark.range(1).select(F.explode(F.split(F.lit(listed), "\n")).alias("line"))
    at = F.length("line") - 64
    return given.union(line.select(F.substr("line", F.lit(1), at - 1), F.substr("line", at + 1)))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, digest, license, notices) per distinct doc_id and text of `docs`.

    `license` is the known licence (`known`: license, digest; the first by name if several share a digest) that the whole text is, else
    null; `notices` are the known licences that whole lines of it are, sorted. A text without letters or digits, empty or null has a
    null digest and no licence. Rows repeated in doc_id and text come out once.
    """
    known = written(known.where("digest is not null").groupBy("digest").agg(F.min("license").alias("license")), "known")
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", F.xxhash64(text).alias("part"), (F.instr(text, "\n") > 0).alias("parted"), text.alias("text"))
    rows = _once(_once(rows, "low", F.lower("text")).drop("text"), "words", _words(F.col("low"))).drop("low")
    whole = _once(rows, "plain", _whole(F.col("words"))).select("doc_id", "part", _digest(F.col("plain")).alias("digest"))
    lines = rows.where("parted").select("doc_id", "part", F.explode(F.split("words", r"\n")).alias("line"))
    found = _once(lines, "plain", _alike(F.trim("line"))).select("doc_id", "part", _digest(F.col("plain")).alias("digest")).join(known, "digest").select("doc_id", "part", "license", F.lit(False).alias("whole"))
    every = whole.join(known, "digest", "left").select("doc_id", "part", "digest", "license").distinct()
    notices = found.groupBy("doc_id", "part").agg(F.array_sort(F.collect_set("license")).alias("notices"))
    n = notices.select(F.col("doc_id").alias("_id"), F.col("part").alias("_part"), "notices")
    at = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("part").eqNullSafe(F.col("_part"))
    return every.join(n, at, "left").select("doc_id", "digest", "license", F.coalesce("notices", F.array().cast("array<string>")).alias("notices"))
