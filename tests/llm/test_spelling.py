"""Spelling groups against plain pairwise comparison."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from gramlark.llm import queries, spelling
from tests.compare import differences, duck


def near(a, b):
    """One edit, by the full table of edit distances."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1] == 1


def plain(counts):
    out = {}
    for w, n in counts.items():
        found = sorted((-m, v) for v, m in counts.items() if v != w and abs(len(v) - len(w)) < 2 and near(w, v))
        form = found[0][1] if found and -found[0][0] >= 2 * n else None
        out[w] = (form, n, len(found), counts[form] if form else None)

    def root(w):
        while out[w][0]:
            w = out[w][0]
        return w

    return sorted((w, f, root(w), n, k, fn) for w, (f, n, k, fn) in out.items())


def grouped(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_equals_its_sql(spark, size):
    sf_dir = f"/root/testdata/{size}"
    got = queries.op13_letter_count_trie(spark, sf_dir).toPandas()
    want = duck(sf_dir).execute(queries.OP13_SQL).df()
    assert len(got) > 100 and got.form.notna().any() and differences(got, want) is None


def test_one_edit():
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abé"), rng.integers(0, 6))) for _ in range(150)]
    for a in words:
        for b in words:
            assert spelling.one_edit(a, b) == near(a, b)


@pytest.mark.parametrize("node_words", [20_000, 40, 3])
def test_variants_at_any_depth(spark, node_words):
    rng = np.random.default_rng(7)
    words = {"".join(rng.choice(list("abcdeé"), rng.integers(5, 9))) for _ in range(500)}
    # all counts alike in one node, ties of n, chains of forms, a very long word
    words |= {"abcde", "abced", "acbde", "abcdef", "abcdefg", "abcdefgh", "aaaaa", "aaaab", "x" * 400, "x" * 399}
    counts = {w: int(rng.integers(3, 9)) * 2 ** int(rng.integers(0, 5)) for w in sorted(words)}
    vocab = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert grouped(spelling.variants(vocab, node_words=node_words)) == plain(counts)


def test_follow_long_chains(spark):
    chain = [(f"w{i:02}", f"w{i + 1:02}") for i in range(37)] + [("x", "w05"), ("y", "w37")]
    got = spelling.follow(spark.createDataFrame(chain, "word string, form string")).collect()
    assert {r.word for r in got} == {c[0] for c in chain} and {r.root for r in got} == {"w37"}


def test_words_of_odd_documents(spark):
    texts = ["", None, "!!", "Straße STRASSE Ärger ärger İstanbul Kelvin ×sign", "colour " * 30_000, "x" * 100_000, "word1word2 wordy-wordy"]
    rows = [(i % 5, t, 1, "n", "k") for i, t in enumerate(texts * 3)] + [(None, "colour color wordy", 1, "n", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, word int, n string, k string")
    want = Counter()
    for key, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            want[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    want = {w: n for w, n in want.items() if n >= 3 and len(w) >= 5}
    assert {r.word: r.n for r in spelling.vocabulary(df).collect()} == want
    assert grouped(spelling.group_spellings(df)) == plain(want)
    assert grouped(spelling.group_spellings(df.where("false"))) == []
