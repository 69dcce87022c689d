"""Spelling variants: words that differ by one letter, grouped under their commonest form.

Letters are dealt to groups.  A word's vector counts its letters per group; a
trie over the vectors has one level per group.  One inserted letter adds one to
one count, a deleted one takes one away, a replaced one does both or neither:
so a word's near words are found by a depth-first search that may spend one
surplus and one deficit on its way, and the words at the leaves are verified.
The trie is dealt out by its upper levels, so that no task holds all of it.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import compress, count
from operator import ne

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramlark.llm.common import task_rows
from gramlark.session import stage

GROUPS = 12
RUN = re.compile("[a-zÀ-ÿ]+")
SMALL = 4  # ranges of so few words are compared whole
HALVES = ["len", "mark", "head", "head_less", "tail", "tail_less"]


def spelled(key: str, text: str, every: int = 97) -> Iterator[tuple[str, int]]:
    """Words and how often they occur in a text: its letter runs, A-Z lower-cased, one in about ``every`` without a letter.

    Which runs lose a letter, and which letter, follows from the CRC32 of key and run.
    """
    start = zlib.crc32(f"{key}:".encode())
    low = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # bytes lower A-Z only
    for run, n in Counter(RUN.findall(low)).items():
        h = zlib.crc32(run.encode(), start)
        if h % every == 0:
            cut = h % len(run)
            run = run[:cut] + run[cut + 1 :]
        yield run, n


def vocabulary(docs: DataFrame, every: int = 97, letters: int = 5, times: int = 3) -> DataFrame:
    """``(word, n)`` of the distinct words of at least so many letters that occur so often in ``docs(doc_id, text)``.

    Words are counted per batch of documents before they are shuffled.
    """

    def make():
        def each(pdf: pd.DataFrame) -> pd.DataFrame:
            seen: Counter = Counter()
            for key, text in zip(pdf["k"], pdf["text"]):
                for word, n in spelled(key, text, every):
                    if len(word) >= letters:
                        seen[word] += n
            return pd.DataFrame({"word": list(seen), "n": list(seen.values())})

        return each

    docs = docs.where("text IS NOT NULL").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("k"), "text")
    counted = task_rows(docs, ["k", "text"], "word string, n long", make).groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= times)


def letter_groups(words: DataFrame) -> list[str]:
    """The letters in ``GROUPS`` groups of nearly equal weight: by frequency, dealt there and back."""
    used = words.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").groupBy("c").count()
    order = [r.c for r in used.orderBy(F.desc("count"), "c").collect()]  # bounded by the alphabet of the runs
    groups = [""] * GROUPS
    for k, c in enumerate(order):
        turn, place = divmod(k, GROUPS)
        groups[place if turn % 2 == 0 else GROUPS - 1 - place] += c
    return groups


def depth_for(vectors: DataFrame, node_words: int) -> tuple[int, int]:
    """The fewest levels at which no node holds more than ``node_words`` words, and the largest node's words."""
    nodes = vectors.groupBy("vector").count()
    levels = F.explode(F.sequence(F.lit(0), F.lit(GROUPS))).alias("depth")
    nodes = nodes.select("vector", "count", levels).groupBy("depth", F.slice("vector", 1, F.col("depth")).alias("node"))
    sizes = nodes.agg(F.sum("count").alias("n")).groupBy("depth").agg(F.max("n").alias("n")).orderBy("depth").collect()
    for r in sizes:
        if r.n <= node_words:
            return r.depth, r.n
    return (sizes[-1].depth, sizes[-1].n) if sizes else (0, 0)


def reachable(depth: int) -> list[list[int]]:
    """Changes of the first ``depth`` counts that spend at most one surplus and one deficit."""
    out = [[0] * depth]
    for up in range(-1, depth):
        for down in range(-1, depth):
            if up != down:
                change = [0] * depth
                if up >= 0:
                    change[up] += 1
                if down >= 0:
                    change[down] -= 1
                out.append(change)
    return out


def search(words: np.ndarray, asks: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(ask, word)`` numbers that meet in a leaf: a depth-first walk over the trie of ``words``.

    Rows of ``words`` are vectors in lexicographic order, so a node is a range of
    rows.  Every node is visited once, with all asks that can still reach it.
    """
    levels = words.shape[1]
    every = np.arange(len(asks))
    todo = [(0, len(words), 0, every, np.ones(len(asks), "i1"), np.ones(len(asks), "i1"))]
    while todo:
        low, high, depth, who, surplus, deficit = todo.pop()
        if not len(who) or low == high:
            continue
        if depth == levels or high - low <= SMALL:
            more = words[None, low:high, depth:] - asks[who][:, None, depth:]
            fits = (np.maximum(more, 0).sum(2) <= surplus[:, None]) & (np.maximum(-more, 0).sum(2) <= deficit[:, None])
            a, w = np.nonzero(fits)
            yield who[a], w + low
            continue
        counts, own = words[low:high, depth], asks[who, depth]
        starts = np.flatnonzero(np.concatenate([[True], counts[1:] != counts[:-1]]))
        for at, end in zip(starts, [*starts[1:], high - low]):
            change = counts[at] - own
            ok = (change == 0) | ((change == 1) & (surplus > 0)) | ((change == -1) & (deficit > 0))
            change = change[ok]
            todo.append((low + at, low + end, depth + 1, who[ok], surplus[ok] - (change == 1), deficit[ok] - (change == -1)))


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point turns ``a`` into ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next(compress(count(), map(ne, a, b)), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def halves() -> list:
    """Columns of ``word`` that sort out most pairs without looking at letters.

    One edit leaves the first or the last half of a word as it is; the longer
    word of two is halved by the shorter one's length (``_less``).  ``mark``
    puts words of one length in an order, so that each pair is judged once.
    """
    size, left, less = F.length("word"), F.floor(F.length("word") / 2).cast("int"), F.floor((F.length("word") - 1) / 2).cast("int")
    part = lambda start, many: F.xxhash64(F.substring("word", start, many))
    one = F.lit(1)
    columns = [size, F.xxhash64("word"), part(one, left), part(one, less), part(size - left + 1, left), part(size - less + 1, less)]
    return [c.alias(name) for c, name in zip(columns, HALVES)]


def _node_matches(words: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
    """The near words of asks found in one node, for both sides: how many, and the commonest.

    An ask looks for words one letter longer, and for those of its own length
    with a larger mark; the other sides of these pairs are its partners' finds.
    """
    out: dict[str, list] = {}

    def note(word: str, other: str, n: int) -> None:
        best = (-n, other)
        if word in out:
            out[word] = [out[word][0] + 1, min(out[word][1], best)]
        else:
            out[word] = [1, best]

    if len(words) and len(asks):
        table = np.stack(words["vector"].to_numpy()).astype("int16" if words["len"].max() < 30_000 else "int32")
        order = np.lexsort(table.T[::-1])
        text, often = words["word"].to_numpy()[order], words["n"].to_numpy()[order]
        own, own_often = asks["ask"].to_numpy(), asks["n"].to_numpy()
        mine = {c: words[c].to_numpy()[order] for c in HALVES}
        theirs = {c: asks[c].to_numpy() for c in HALVES}
        for a, w in search(table[order], np.stack(asks["counts"].to_numpy()).astype(table.dtype)):
            longer = mine["len"][w] - theirs["len"][a]
            head, tail = theirs["head"][a], theirs["tail"][a]
            level = (longer == 0) & (mine["mark"][w] >= theirs["mark"][a])
            level &= (mine["head"][w] == head) | (mine["tail"][w] == tail)
            above = (longer == 1) & ((mine["head_less"][w] == head) | (mine["tail_less"][w] == tail))
            for i in np.flatnonzero(level | above):
                x, y = own[a[i]], text[w[i]]
                if longer[i] == 0 and mine["mark"][w[i]] == theirs["mark"][a[i]] and x >= y:
                    continue
                if one_edit(x, y):
                    note(x, y, often[w[i]])
                    note(y, x, own_often[a[i]])
    rows = [(x, many, word, -n) for x, (many, (n, word)) in out.items()]
    return pd.DataFrame(rows, columns=["word", "n_near", "form", "form_n"])


def near_words(vocab: DataFrame, node_words: int = 60_000) -> DataFrame:
    """``(word, n_near, form, form_n)`` of the words in ``(word, n)`` that have near ones.

    ``form`` is the near word of largest ``n``, ties to the smallest in code-point
    order.  Words are filed under the counts of the upper trie levels, as many as
    needed for nodes of at most ``node_words`` words, and ask at all nodes that
    the budget reaches.  Words with all counts alike may still fill a larger
    node; then nodes are cut into slots and asks go to each.
    """
    groups = letter_groups(vocab)
    counts = F.array(*[F.regexp_count("word", F.lit(f"[{g}]")) if g else F.lit(0) for g in groups])
    vectors = stage(vocab.select("word", "n", counts.alias("vector"), *halves()), "vectors")
    depth, largest = depth_for(vectors, node_words)
    slots = max(1, math.ceil(largest / node_words))
    name = lambda v: F.array_join(F.transform(v, lambda c: c.cast("string")), ",")
    nodes = vectors.select("*", name(F.slice("vector", 1, depth)).alias("node"))
    nodes = nodes.select("*", F.pmod(F.xxhash64("word"), F.lit(slots)).cast("int").alias("slot"))
    changes = F.array(*[F.array(*map(F.lit, c)).cast("array<int>") for c in reachable(depth)])
    # new names: both sides of the grouping below come from one table
    asks = vectors.select(F.col("word").alias("ask"), F.col("vector").alias("counts"), F.explode(changes).alias("change"), "n", *HALVES)
    moved = F.zip_with(F.slice("counts", 1, depth), "change", lambda a, b: a + b)
    asks = asks.select("ask", "counts", *[F.col(c).alias(c) for c in ("n", *HALVES)], name(moved).alias("node"))
    asks = asks.select("*", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"))
    found = nodes.groupBy("node", "slot").cogroup(asks.groupBy("node", "slot"))
    found = found.applyInPandas(_node_matches, "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("n"), F.col("form").alias("form")))
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return merged.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.n")).alias("form_n"))


def follow(forms: DataFrame) -> DataFrame:
    """``(word, root)``: the end of each chain of ``(word, form)``, by doubling; chains must not close."""
    at = stage(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not at.where("moved").isEmpty():
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        at = stage(at, "roots")
    return at.select("word", "root")


def variants(vocab: DataFrame, times: int = 2, node_words: int = 60_000) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every word of ``(word, n)``.

    ``form`` is the commonest near word if it occurs at least ``times`` as often
    as the word, else null; ``root`` is where following forms ends, the word
    itself if it has none; ``n_near`` counts all near words.  Forms occur ever
    more often, so chains end.
    """
    vocab = stage(vocab, "vocabulary")
    near = stage(near_words(vocab, node_words), "near")
    joined = vocab.join(near, "word", "left")
    taken = F.col("form_n") >= times * F.col("n")
    joined = joined.select(
        "word",
        "n",
        F.when(taken, F.col("form")).alias("form"),
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(taken, F.col("form_n")).alias("form_n"),
    )
    joined = stage(joined, "forms")
    roots = follow(joined.where("form IS NOT NULL").select("word", "form"))
    out = joined.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group_spellings(docs: DataFrame, every: int = 97, letters: int = 5, least: int = 3, node_words: int = 60_000) -> DataFrame:
    """``variants`` of the words in ``docs(doc_id, text)``.

    Words are maximal runs of Latin letters with A-Z lower-cased; see ``spelled``
    and ``vocabulary``.  Null and empty texts have no words; a null ``doc_id``
    counts as an empty one; repeated rows count each; other columns are not read.
    """
    return variants(vocabulary(docs, every, letters, least), node_words=node_words)
