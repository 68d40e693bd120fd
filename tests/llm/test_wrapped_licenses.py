"""Licence notices as files carry them: wrapped, and behind comment marks."""

import textwrap

import pytest

from caudal.llm import licenses

MARKS = {"plain": "", "star": " * ", "hash": "# ", "slashes": "// "}
COPYRIGHT = "Copyright (c) 2019 Some Person"


@pytest.fixture(scope="module")
def notices():
    return licenses.train()


def long_templates():
    return [(f, t) for f, ts in licenses.TEMPLATES.items() for t in ts if len(t.split()) >= 30]


def test_wrapped_notices_are_confirmed_as_whole_ones_are(spark, notices):
    rows, want = [], {}
    for family, text in long_templates():
        for width in (40, 72, 100_000):
            for mark in MARKS.values():
                lines = [COPYRIGHT, "", *textwrap.wrap(text, width), "", "import os", "x = 1"]
                want[len(rows)] = family
                rows.append((len(rows), "\n".join(f"{mark}{x}".rstrip() for x in lines)))
    got = {}
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), notices).collect():
        if r.confirmed:
            got.setdefault(r.doc_id, []).append((r.family, r.paragraph, r.similarity))
    bad = {rows[i][1]: got.get(i) for i, f in want.items() if got.get(i) != [(f, 2, 1.0)]}
    assert not bad, next(iter(bad.items()))


def test_two_wrapped_paragraphs_and_lines_between(spark, notices):
    texts = [t for f, t in long_templates() if f == "MIT"]
    text = "\n\n".join([COPYRIGHT, *(textwrap.fill(t, 60) for t in texts), "Released under the MIT License.\nReleased under the MIT License."])
    got = sorted((r.paragraph, r.confirmed) for r in licenses.scan(spark.createDataFrame([(1, text), (2, "nothing\nhere")], "doc_id long, text string"), notices).where("family = 'MIT'").collect())
    lines = text.split("\n")
    starts = [lines.index(textwrap.wrap(t, 60)[0]) for t in texts]
    assert got == sorted((k, True) for k in [*starts, len(lines) - 2, len(lines) - 1])
