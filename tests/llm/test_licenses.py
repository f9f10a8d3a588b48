import math
import re
import sys
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
from cases import SF, by_id, docs, with_clashes

from pyspark.sql import functions as F

from marketlake.llm.licenses import (
    MIT_TEXT,
    PUBLISHED,
    TEMPLATES,
    as_files,
    blocks_of,
    license_report,
    licenses,
    own_licenses,
    template_frequencies,
)

TERM = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")


def brute(rows):
    """(key, path, text) of every row to its (own, score, license, inherited from); all sentences, all templates."""
    names = {t for text in TEMPLATES.values() for t in TERM.findall(text.lower())}
    n = len(rows)
    df = Counter(t for _, _, text in rows for t in names & set(TERM.findall((text or "").lower())))
    idf = {t: math.log((n + 1) / (df[t] + 1)) + 1 for t in names}
    other = math.log(n + 1) + 1
    vectors = {k: {t: c * idf[t] for t, c in Counter(TERM.findall(v.lower())).items()} for k, v in TEMPLATES.items()}

    def own(text):
        best = (0, "", None)
        for sentence in re.split(r"\n|(?<=[.!?])[\x20\t\r]+", text or ""):
            counts = Counter(TERM.findall(sentence.lower()))
            length = math.sqrt(sum((c * idf[t]) ** 2 if t in idf else c * other**2 for t, c in counts.items()))
            for name, vector in vectors.items():
                dot = sum(v * counts[t] * idf[t] for t, v in vector.items())
                score = round(dot / length / math.sqrt(sum(v * v for v in vector.values())), 6) if dot else 0
                if score >= 0.8 and (best[2] is None or (-score, name) < (-best[0], best[2])):
                    best = (score, "", name)
        return best[2], best[0] or None

    mine = {(path, text): own(text) for _, path, text in rows}
    given = {}
    for (path, _), (name, score) in mine.items():
        if name and path is not None and re.match(r"(?i)^(license|licence|copying)([.-].*)?$", path.split("/")[-1]):
            folder = path.rpartition("/")[0]
            given[folder] = min(given.get(folder, (0, "~")), (-score, name))
    out = {}
    for key, path, text in rows:
        name, score = mine[path, text]
        where, at = None, None if path is None else path.rpartition("/")[0]
        while name is None and at is not None and where is None:
            if at in given:
                where = at
            at = at.rpartition("/")[0] if at else None
        out.setdefault(key, []).append((name, score, name or (where is not None and given[where][1]) or None, None if where is None else where + "/"))
    return out


FILES = {
    "/LICENSE": "All rights reserved.",
    "/a/COPYING.txt": "some words\nLICENSED under the Apache License, version 2.0. More words here.",
    "/a/b/c/x.py": "no license in here",
    "/a/b/y.py": "# Released under the MIT License.",
    "/a/b/LICENSE": "Nothing that says so",
    "/d/LICENSE-1": "Licensed under CC BY-NC 4.0.",
    "/d/LICENSE-2": "Released under the MIT License.",
    "/d/e/z.py": None,
    "/d/e/licence": "",
    "/f.py": "the license of the version under which this is released. Licensed rights",
    "top.py": "All rights reserved! Yes.",
    "/g/h/i/j/k.txt": "word " * 20_000,
    "/a/big": "word " * 5_000 + ". This work is licensed under the GNU General Public License, version 3",
}


def frame(spark):
    df = docs(spark, [*FILES.values(), "Released under the MIT License.", None], ids=[*range(len(FILES)), 50, None])
    paths = spark.createDataFrame([*enumerate(FILES)], "doc_id bigint, where string")
    return with_clashes(df.join(paths, "doc_id", "left").withColumnRenamed("where", "path"))


def test_against_brute_force(spark):
    df = frame(spark)
    found = licenses(df).select("row.doc_id", "own_license", "own_score", "license", "inherited_from")
    want = brute([(r["doc_id"], r["path"], r["text"]) for r in df.collect()])
    got = {k: [tuple(r.values())[1:] for r in v] for k, v in by_id(found).items()}
    assert got == want
    assert got[2][0][2:] == ("Apache-2.0", "/a/") and got[3][0][0] == "MIT" and got[11][0][2:] == ("proprietary", "/")
    assert got[7][0][2] == "MIT" or got[7][0][2] == "CC-BY-NC-4.0"


def test_given_table(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    files = [(r["doc_id"], r["path"], r["text"]) for r in as_files(given).collect()]
    found = by_id(license_report(given).drop("path"))
    got = {k: [tuple(r.values())[1:] for r in v] for k, v in found.items()}
    assert got == brute(files)
    assert sum(v[0][0] is not None for v in got.values()) > 3


def test_repeats_null_ids_and_empty(spark):
    df = docs(spark, ["All rights reserved.", "All rights reserved.", None], ids=[11, 11, None])
    rows = license_report(df).collect()
    assert sorted((r["own_license"] or "") for r in rows) == ["", "proprietary", "proprietary"]
    assert license_report(df.limit(0)).count() == 0


def comment(text, mark="# ", width=70):
    lines, line = [], ""
    for word in text.split(" "):
        if len(line) + len(word) > width:
            lines, line = [*lines, line], ""
        line += (" " if line else "") + word
    return "\n".join(mark + x for x in [*lines, line])


CODE = "\nimport this\n\nprint('rights reserved: none')\n"
PUBLIC = {
    "/one/LICENSE": ("MIT License\n\nCopyright (c) 2020 Jo Doe\n\n" + MIT_TEXT, "MIT"),
    "/one/a.py": ("#!/usr/bin/env python\n# Copyright 2021 The Authors\n#\n" + comment(PUBLISHED["Apache-2.0/notice"]) + CODE, "Apache-2.0"),
    "/two/COPYING": ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n" + "Other words that follow. " * 900, "GPL-3.0"),
    "/two/b.c": ("/*\n" + comment(PUBLISHED["GPL-3.0/notice"], " * ") + "\n */" + CODE, "GPL-3.0"),
    "/bsd3/licence.txt": ("Copyright (c) 2019, Someone\nAll rights are with Someone.\n\n" + PUBLISHED["BSD-3-Clause/text"], "BSD-3-Clause"),
    "/bsd2/LICENSE.md": ("Copyright 2019 Someone\n\n" + PUBLISHED["BSD-2-Clause/text"], "BSD-2-Clause"),
    "/isc/c.js": (comment(PUBLISHED["ISC/text"], "// ") + CODE, "ISC"),
    "/spdx/d.rs": ("// SPDX-License-Identifier: MIT OR Apache-2.0\nfn main() {}", "MIT OR Apache-2.0"),
    "/mpl/e.h": ("/* " + PUBLISHED["MPL-2.0/notice"] + " */" + CODE, "MPL-2.0"),
    "/none/f.py": ("# A module on licenses and permission in software, without warranty talk.\n" + CODE, None),
    "/none/LICENSE": ("This file intentionally says nothing of the kind. " * 40, None),
    "/none/g.py": ("print(1)\n\n" + comment(PUBLISHED["Apache-2.0/notice"]), None),
    "/two/deep/h.c": ("int x;", None),
}


def test_headers_and_whole_license_files(spark):
    """Published texts in files as they are found, each with the license a reader would name."""
    rows = [(i, text, "en", "s", len(text)) for i, (text, _) in enumerate(PUBLIC.values())]
    paths = spark.createDataFrame([*enumerate(PUBLIC)], "doc_id bigint, path string")
    df = with_clashes(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"))
    found = licenses(df.join(paths, "doc_id")).select("row.doc_id", "own_license", "own_score", "license", "inherited_from")
    got = by_id(found)
    for i, (path, (_, want)) in enumerate(PUBLIC.items()):
        assert got[i][0]["own_license"] == want, (path, got[i][0])
    last = got[len(PUBLIC) - 1][0]
    assert (last["license"], last["inherited_from"]) == ("GPL-3.0", "/two/")
    assert all(r["own_score"] >= 0.8 for v in got.values() for r in v if r["own_license"])


def test_scores_of_blocks_against_brute_force(spark):
    """Cosines of headers and whole licence files, from plain counts over all files."""
    names = {t for text in (*TEMPLATES.values(), *PUBLISHED.values()) for t in TERM.findall(text.lower())}
    texts = [text for text, _ in PUBLIC.values()]
    n = len(texts)
    df = Counter(t for text in texts for t in names & set(TERM.findall(text.lower())))
    own = {t for text in PUBLISHED.values() for t in TERM.findall(text.lower())}
    idf = {t: math.log((n + 1) / (df[t] + 1)) + 1 for t in own}
    other = math.log(n + 1) + 1

    def cosine(piece, template):
        a, b = Counter(TERM.findall(piece.lower())), Counter(TERM.findall(template.lower()))
        length = math.sqrt(sum((c * idf[t]) ** 2 if t in idf else c * other**2 for t, c in a.items()))
        size = math.sqrt(sum((c * idf[t]) ** 2 for t, c in b.items()))
        return sum(a[t] * b[t] * idf[t] ** 2 for t in b) / length / size if length else 0

    files = spark.createDataFrame([(p, i, t) for i, (p, (t, _)) in enumerate(PUBLIC.items())], "path string, tkey long, text string")
    counts = template_frequencies(files, TEMPLATES | PUBLISHED)
    assert counts == (n, dict(df))
    pieces = {r["tkey"]: r["pieces"] for r in files.select("tkey", blocks_of(F.col("text"), F.col("path")).alias("pieces")).collect()}
    assert pieces[1][0].split()[:3] == ["Copyright", "2021", "The"] and len(pieces[0]) == 2
    got = own_licenses(files, PUBLISHED, 0.8, counts, blocks_of(F.col("text"), F.col("path")))
    best = {r["tkey"]: (r["license"], r["score"]) for r in got.collect()}
    for key, blocks in pieces.items():
        scores = [(round(cosine(p, t), 6), name) for p in blocks for name, t in PUBLISHED.items()]
        top = max(s for s, _ in scores)
        if top >= 0.8:
            assert abs(best[key][1] - top) < 2e-6 and (best[key][1], best[key][0]) in [(round(s, 6), m) for s, m in scores]
        else:
            assert key not in best


def test_copies_score_as_one(spark):
    text = "Licensed under the Apache License, Version 2.0, with wibble wobble and wubble."
    rows = [(None, text)] * 40 + [(7, text)] * 40 + [(i, "plain words") for i in range(100, 200)]
    df = docs(spark, [t for _, t in rows], ids=[i for i, _ in rows])
    files = [(r["doc_id"], r["path"], r["text"]) for r in as_files(df).collect()]
    got = {k: {tuple(r.values())[1:] for r in v} for k, v in by_id(license_report(df).drop("path")).items()}
    assert got == {k: set(v) for k, v in brute(files).items()}
    assert all(own is None for own, *_ in got[None] | got[7])
