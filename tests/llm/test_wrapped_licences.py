"""Notices wrapped at 76 columns are found whole, once, with or without comment signs."""

import textwrap

import pytest

from gramlark.llm import licences


@pytest.mark.parametrize("sign", ["", "# ", " * "])
def test_wrapped_notices_are_one_confirmed_row(spark, sign):
    texts, want = [], []
    for family, k in (("MIT", 2), ("BSD", 1), ("GPL-3.0", 1)):
        body = textwrap.wrap(licences.TEMPLATES[family][k], 76 - len(sign))
        texts.append("\n".join(["Some title", "", *(sign + x for x in body), "", "other words", "and more"]))
        want.append((len(want), 2, family, True))
    texts.append("plain words\nReleased under the MIT License.\nmore words")
    want.append((3, 1, "MIT", True))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = licences.scan(docs).collect()
    assert sorted((r.doc_id, r.paragraph, r.family, r.confirmed) for r in got) == want
