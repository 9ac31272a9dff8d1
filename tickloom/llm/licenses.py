"""License scan by canonical digests, in DataFrame operations only."""

from __future__ import annotations

import re
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Short public license texts and one-line notices, by SPDX identifier.
KNOWN = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL "
        "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY "
        "AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "MIT",
        "MIT License\nPermission is hereby granted, free of charge, to any person obtaining a copy of "
        "this software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
        "whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS "
        "FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
        "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
        "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ),
]

TEXTS = Path(__file__).with_name("license_texts")
# Title lines that stand above a text or are left out.
TITLES = {
    "BSD-2-Clause": ["BSD 2-Clause License", "The 2-Clause BSD License", "BSD 2-Clause \"Simplified\" License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The 3-Clause BSD License", "BSD 3-Clause \"New\" or \"Revised\" License", "New BSD License"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "Unlicense": ["The Unlicense", "Unlicense"],
}
# The title of a text that has its own: everything above this.
BODY = {
    "Apache-2.0": r"TERMS AND CONDITIONS FOR USE", "Artistic-1.0": r"Preamble", "CC0-1.0": r"CREATIVE COMMONS CORPORATION IS",
    "GFDL": r"Copyright \(C\)", "GPL": r"Copyright \(C\)", "LGPL": r"Copyright \(C\)", "MPL": r"1\. Definitions",
}
# What may follow the terms: instructions how to apply them.
APPENDIX = r"(?m)^\s*(END OF TERMS AND CONDITIONS|ADDENDUM: How to use this License)"
# Names in notices, by SPDX identifier.
NAMES = {
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License"],
    "CC-BY-4.0": ["Creative Commons Attribution 4.0 International License", "CC BY 4.0"],
    "CC-BY-NC-4.0": ["Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 4.0"],
    "CC-BY-SA-4.0": ["Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 4.0"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal"],
    "GPL-1.0": ["GNU General Public License, version 1", "GPL version 1", "GPLv1"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License version 2.0", "GPL version 2", "GPLv2"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License version 3.0", "GPL version 3", "GPLv3"],
    "ISC": ["ISC License"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "LGPL version 2.1", "LGPLv2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "LGPL version 3", "LGPLv3"],
    "MIT": ["MIT License"],
    "MPL-1.1": ["Mozilla Public License, version 1.1", "MPL 1.1"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License, v. 2.0", "MPL 2.0"],
    "Unlicense": ["Unlicense"],
}
OPENINGS = [f"{who}{how} under the terms of the" for who in ("", "This work is ", "This file is ", "This software is ", "This project is ") for how in ("licensed", "released", "distributed")]
OPENINGS += [x.replace(" the terms of the", the) for x in OPENINGS for the in (" the", "")]


@cache
def known_texts() -> list[tuple[str, str]]:
    """``KNOWN``, the texts of the data folder with and without titles and appendices, notices."""
    found = list(KNOWN)
    texts = [(file.name.removesuffix(".txt").removesuffix(".regents"), file.read_text()) for file in sorted(TEXTS.glob("*.txt"))]
    for name, text in [*texts, *((name, text.removeprefix("MIT License\n")) for name, text in KNOWN if len(text) > 500)]:
        pattern = BODY.get(name) or BODY.get(name.split("-")[0])
        bodies = [text, text[re.search(pattern, text).start() :]] if pattern else [text]
        if cut := re.search(APPENDIX, text):
            ends = [cut.start(), *([cut.end()] if "END OF" in cut[0] else [])]
            bodies += [body[: len(body) - (len(text) - end)] for body in bodies for end in ends]
        if name in TITLES:  # a holder's line "All rights reserved." is no part of the terms
            body = re.sub(r"(?m)^All rights reserved\.\n", "", text)
            bodies += [f"{title}{rights}{body}" for title in ["", *(f"{x}\n" for x in TITLES[name])] for rights in ("", "All rights reserved.\n")]
        found += [(name, body) for body in bodies]
    for name, called in NAMES.items():
        gnu = re.match("L?GPL", name)
        for spdx in [name, *([f"{name}-only", f"{name}-or-later", f"{name}+"] if gnu else [])]:
            found.append((spdx.replace("-only", "").replace("+", "-or-later"), f"SPDX-License-Identifier: {spdx}"))
        for one in called:
            found += [(name, f"{opening} {one}") for opening in OPENINGS]
            if gnu:
                found += [(f"{name}-or-later", f"{opening} {one}{later}") for opening in OPENINGS for later in (" or later", ", or any later version", " or (at your option) any later version")]
    return found


# Spellings that count as equal, (pattern, replacement), on canonical words.
SPELLINGS = [
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("organisation", "organization"),
    ("authoris", "authoriz"),
    ("favour", "favor"),
    ("merchantibility", "merchantability"),
]
# A holder's line: copyright marks and a year, or both marks and a name, to the end of a short
# line, behind comment marks. Terms that start a line with "copyright" or "(c)" are none, nor are
# the marks of the known texts themselves.
_MARK = r"(?:(?:copyright|\(c\)|©|&copy;)[ \t:]*)+"
_OWN = r"(?![\d,\s-]*(?:free\b|<?year\b|19yy|\[?yyyy|the\s+regents))"
HOLDER_LINE = (
    r"(^|\n)[^a-z0-9\n(©&]*(?:" + _MARK + _OWN + r"[\[<(]?\d{4}\b"
    r"|copyright[ \t]*(?:\(c\)|©|&copy;)" + _OWN + r"[ \t]*[^\n \t])[^\n]{0,120}(?=\n|$)"
)
# The marks that are part of known texts, on canonical words: they are dropped wherever a text is
# wrapped, in the middle of a line as well.
OWN_MARKS = (
    r"copyright c (?:[0-9]{4} )+free software foundation inc(?: https? fsf org)?"
    r"|copyright c (?:year your name|(?:19yy|year) name of author|the regents of the university of california)"
    r"|copyright yyyy name of copyright owner"
)
# Words of which every known text and notice holds one; lines without are not looked up.
TELLING = r"(?i)licen|permission|redistribution|public domain|released|distributed"


def canonical(text: Column) -> Column:
    """Lower case (A-Z), without holders' lines, words of letters and digits only, in one
    spelling: the same for every wrapping, indentation and comment style of a text."""
    value = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    value = F.regexp_replace(value, HOLDER_LINE, "$1")
    value = F.replace(value, F.lit("&"), F.lit(" and "))
    value = F.regexp_replace(value, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    for spelling, chosen in SPELLINGS:
        value = F.replace(value, F.lit(spelling), F.lit(chosen))
    return F.trim(F.regexp_replace(F.regexp_replace(value, OWN_MARKS, " "), " +", " "))


def known_digests(spark: SparkSession, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """``digest, license_id`` of the known texts; one license per digest (the first id)."""
    frame = spark.createDataFrame(texts or known_texts(), "license_id string, body string")
    return frame.groupBy(F.sha2(canonical(F.col("body")), 256).alias("digest")).agg(
        F.min("license_id").alias("license_id")
    )


def scan(units: DataFrame, text: str, known: DataFrame) -> DataFrame:
    """Append ``digest`` and ``license_id`` (null where the entire text is no known license).

    Null texts have no digest and no license. Names clash with nothing else in the row:
    columns ``digest`` and ``license_id`` of the input are replaced.
    """
    digested = units.drop("license_id").withColumn("digest", F.sha2(canonical(F.col(text)), 256))
    return digested.join(known, "digest", "left")


def report(documents: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``doc_id, digest, license_id, n_notices, notices``: the license that the entire
    text is, how many of its lines are notices, and their licenses, sorted, joined by commas.

    Rows are told apart by their place in the table, so null and repeated ids keep their own
    notices. Null texts have no digest, no license and no notice. One pass: lines that hold a
    telling word leave their row as digests, meet the known ones and are counted per row.
    Further columns are not read. An empty table gives no rows.
    """
    lines = F.filter(F.split(F.col(text), "\n"), lambda line: line.rlike(TELLING))
    rows = documents.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(doc_id).alias("doc_id"),
        F.sha2(canonical(F.col(text)), 256).alias("digest"),
        F.transform(lines, lambda line: F.sha2(canonical(line), 256)).alias("_lines"),
    )
    unfolded = rows.select("_row", "doc_id", "digest", F.explode_outer("_lines").alias("_line"))
    whole = known.select("digest", "license_id")
    notices = known.select(F.col("digest").alias("_line"), F.col("license_id").alias("_notice"))
    found = unfolded.join(notices, "_line", "left").groupBy("_row", "doc_id", "digest").agg(
        F.count("_notice").alias("n_notices"), F.array_join(F.array_sort(F.collect_set("_notice")), ",").alias("notices")
    )
    return found.join(whole, "digest", "left").select("doc_id", "digest", "license_id", "n_notices", "notices")
