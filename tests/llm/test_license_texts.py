"""Whole license texts and notices beyond the given tables."""

import re
import textwrap
from pathlib import Path

from tickloom.llm import licenses

SHARED = Path("/usr/share/common-licenses")


def test_whole_texts_and_notices(spark):
    read = lambda name: (SHARED / name).read_text()
    mit = next(text for name, text in licenses.KNOWN if name == "MIT" and len(text) > 500)
    isc = next(text for name, text in licenses.KNOWN if name == "ISC" and len(text) > 500)
    bsd = (licenses.TEXTS / "BSD-3-Clause.txt").read_text()
    cases = [
        ("Apache-2.0", read("Apache-2.0")), ("GPL-2.0", read("GPL-2")), ("GPL-3.0", read("GPL-3")), ("LGPL-2.1", read("LGPL-2.1")),
        ("LGPL-3.0", read("LGPL-3")), ("MPL-2.0", read("MPL-2.0")), ("CC0-1.0", read("CC0-1.0")), ("BSD-3-Clause", read("BSD")),
        ("Apache-2.0", read("Apache-2.0").split("END OF TERMS")[0]), ("GPL-2.0", read("GPL-2").split("Version 2, June 1991")[1]),
        ("MPL-2.0", re.sub(r"^.*\n=+\n", "", read("MPL-2.0"))),
        ("MIT", mit.removeprefix("MIT License\n")), ("MIT", f"The MIT License (MIT)\n\nCopyright (c) 2020 A\n{mit.split(chr(10))[1]}"),
        ("ISC", f"ISC License\n\nCopyright (c) 2020 A\n\n{isc}"),
        ("BSD-3-Clause", f"BSD 3-Clause License\n\nCopyright (c) 2020, A\nAll rights reserved.\n\n{bsd}"),
        ("GPL-2.0-or-later", "Licensed under the GPL version 2 or later."), ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
        ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"), ("LGPL-3.0", "Released under LGPLv3"), ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
        (None, read("GPL-3") + "\nand more"), (None, read("GPL-3")[:20000]), (None, None),
    ]
    frame = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(cases)], "i int, text string")
    got = {r["i"]: r["license_id"] for r in licenses.scan(frame, "text", licenses.known_digests(spark)).collect()}
    assert got == {i: name for i, (name, _) in enumerate(cases)}


def layouts(text):
    paragraphs = [" ".join(p.split()) for p in re.split(r"\n\s*\n", text)]
    yield text
    yield "\n\n".join(paragraphs)
    yield " ".join(text.split())
    for width in (60, 77):
        yield "\n\n".join(textwrap.fill(p, width) for p in paragraphs)
    yield "".join(f"# {line}\n" for line in ["Copyright (c) 2021 Some Body and others", *text.split("\n")])
    yield "/*\n" + "".join(f" * {line}\n" for line in ["\u00a9 2019 Some Body", "", *text.split("\n")]) + " */"


def test_every_layout_is_found_and_no_altered_text(spark):
    texts = [(f.name.removesuffix(".txt").removesuffix(".regents"), f.read_text()) for f in sorted(licenses.TEXTS.glob("*.txt"))]
    texts += [(name, text) for name, text in licenses.KNOWN if len(text) > 500]
    assert len(texts) >= 19
    cases = [(name, layout) for name, text in texts for layout in layouts(text)]
    apache = dict(texts)["Apache-2.0"]
    clause = "      (c) You must retain, in the Source form of any Derivative Works\n"
    assert clause in apache
    altered = [apache.replace(clause, "      (c) You may remove, in the Source form of any Derivative Works\n"), apache.replace(clause, "")]
    for name in ("MIT", "ISC", "BSD-3-Clause", "GPL-3.0", "MPL-2.0", "LGPL-2.1", "CC0-1.0", "Artistic-1.0"):
        words = dict(texts)[name].split()
        altered.append(" ".join(words[:100] + ["never"] + words[100:]))
    altered.append(dict(texts)["Artistic-1.0"].replace("Copyright Holder, but only to the computing community at large", "Anyone"))
    cases += [(None, text) for text in altered]
    frame = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(cases)], "i int, text string")
    got = {r["i"]: r["license_id"] for r in licenses.scan(frame, "text", licenses.known_digests(spark)).collect()}
    assert [(i, n, got[i]) for i, (n, _) in enumerate(cases) if got[i] != n] == []


def test_telling_words(spark):
    assert all(re.search(licenses.TELLING, text) for _, text in licenses.known_texts())


def test_rows_keep_their_own_notices(spark):
    mit, apache = "SPDX-License-Identifier: MIT", "// SPDX-License-Identifier: Apache-2.0"
    rows = [(None, f"a\n{mit}\n"), (None, "nothing"), (None, None), (7, f"{mit}\n{apache}\n{mit}"), (7, "clean"), (7, "clean"), (8, ""), (9, "x\n" * 3 + mit + " y"), (10, mit)]
    frame = spark.createDataFrame([(i, t, "d", "l") for i, t in rows], "doc_id bigint, text string, digest string, license_id string")
    got = sorted(((r["doc_id"] or 0, r["n_notices"], r["notices"], r["license_id"] or "") for r in licenses.report(frame, licenses.known_digests(spark)).collect()))
    assert got == [(0, 0, "", ""), (0, 0, "", ""), (0, 1, "MIT", ""), (7, 0, "", ""), (7, 0, "", ""), (7, 3, "Apache-2.0,MIT", ""), (8, 0, "", ""), (9, 0, "", ""), (10, 1, "MIT", "MIT")]
    assert licenses.report(frame.limit(0), licenses.known_digests(spark)).count() == 0
