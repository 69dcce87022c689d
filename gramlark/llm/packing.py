"""Best-two-fit packing of tokenised documents into sequences of fixed length."""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramlark.session import stage

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
CACHED_WORDS = 800_000
CACHED_LENGTH = 48
CHUNK_CHARS = 2_000_000
BLANK = re.compile(r"[ \t\r\n]+")


class WordIds:
    """Ids of whole texts, as little-endian 32-bit bytes, through a cache of words.

    The tokenizer drops white space and never joins across it, so a text's ids
    are those of its words one after the other.  It lower-cases and parts letters
    from signs, so a plain word's ids are those of its lower-cased letters, then
    those of the signs at its end.  What is new to a chunk of texts is encoded
    together.  The cache lives as long as the Python worker and holds the first
    words it meets, which are the frequent ones; when most words of a chunk are
    missing from a full cache it starts anew.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)  # ids that end a word
        for token, i in self.tokenizer.get_vocab().items():
            self.last[i] = token.endswith("</w>")
        self.known: dict[str, bytes] = {"": b""}

    def _each(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Words of letters only, encoded as one text and parted where words end."""
        text = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0]
        ids = np.asarray(text.ids, "<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words):
            return self._each(words)
        raw, at = ids.tobytes(), (4 * np.r_[0, ends]).tolist()
        return [raw[i:j] for i, j in zip(at, at[1:])]

    def _new(self, words: list[str]) -> dict[str, bytes]:
        known, plain, other, parts = self.known, set(), set(), []
        for w in words:
            core = w.rstrip(".,;:!?#$%&*")
            if core.isalpha() and max(core) < "\u0130":
                tail = w[len(core) :]
                core = core.lower()
                parts.append((w, core, tail))
                plain.add(core)
                other.add(tail)
            else:
                other.add(w)
        ids = {}
        for pool, encode in ((plain, self._letters), (other, self._each)):
            missing = [w for w in pool if w not in known]
            for at in range(0, len(missing), 2_000):
                part = missing[at : at + 2_000]
                ids.update(zip(part, encode(part)))
        for w, core, tail in parts:
            a, b = known.get(core), known.get(tail)
            ids[w] = (ids[core] if a is None else a) + (ids[tail] if b is None else b)
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        lists = [BLANK.split(t) for t in texts]
        words = set().union(*lists)
        new = words.difference(self.known)
        if len(self.known) >= CACHED_WORDS and 2 * len(new) > len(words):
            self.known = {"": b""}
            new = words - {""}
        extra = self._new(list(new))
        if len(self.known) < CACHED_WORDS:
            self.known.update((w, i) for w, i in extra.items() if len(w) <= CACHED_LENGTH)
        known = self.known
        if not extra:
            return [b"".join(map(known.__getitem__, x)) for x in lists]
        return [b"".join([known[w] if w in known else extra[w] for w in x]) for x in lists]


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def chunks(texts: list[str]) -> Iterator[list[str]]:
    """Runs of texts of about ``CHUNK_CHARS`` characters in all."""
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= CHUNK_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def tokenised_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, with_ids: bool = False
) -> DataFrame:
    """Ids of every whole text plus ``end_id``, cut into pieces of at most ``capacity``.

    ``tokenizer`` is a path each executor can read.  A null text is an empty
    one: its only id is ``end_id``.  ``with_ids`` adds the ids as ``array<int>``.
    """
    end = np.asarray([end_id], "<u4").tobytes()
    schema = PIECES + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = word_ids(tokenizer)
        for pdf in batches:
            rows = []
            encoded = (ids for part in chunks([t or "" for t in pdf.text]) for ids in words.encode(part))
            for doc_id, ids in zip(pdf.doc_id, encoded):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    row = (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part))
                    rows.append((*row, np.frombuffer(part, "<u4").astype("int32")) if with_ids else row)
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, schema)


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length.

    A bin takes the longest document that fits until none does; if room is left,
    its smallest document is replaced by the two unpacked ones that together
    fill the widened gap best, when they fill it better.
    """
    n = len(lengths)
    order = np.argsort(lengths, kind="stable")
    first = np.searchsorted(lengths[order], np.arange(capacity + 2))
    count = np.diff(first).tolist()
    used = [0] * (capacity + 1)
    free = 0  # bit l: a document of length l is unpacked
    for length in range(1, capacity + 1):
        if count[length]:
            free |= 1 << length
    upto = [(1 << (x + 1)) - 1 for x in range(capacity + 1)]
    bins, offsets, left, at = np.empty(n, "int64"), np.empty(n, "int64"), n, 0
    while left:
        room, held = capacity, []
        while room and (length := (free & upto[room]).bit_length() - 1) > 0:
            many = min(count[length], room // length)
            held += [length] * many
            count[length] -= many
            room -= many * length
            if not count[length]:
                free ^= 1 << length
        if room:
            small = held[-1]
            gap, best, pair = room + small, small, None
            a = (free & upto[gap - 1]).bit_length() - 1
            while a > 0 and 2 * a > best:
                if count[a] == 1:
                    b = (free & upto[min(a - 1, gap - a)]).bit_length() - 1
                else:
                    b = (free & upto[min(a, gap - a)]).bit_length() - 1
                if b > 0 and a + b > best:
                    best, pair = a + b, (a, b)
                    if best == gap:
                        break
                a = (free & upto[a - 1]).bit_length() - 1
            if pair:
                held[-1:] = pair
                count[small] += 1
                free |= 1 << small
                for x in pair:
                    count[x] -= 1
                    if not count[x]:
                        free ^= 1 << x
        offset = 0
        for length in held:
            row = order[first[length] + used[length]]
            used[length] += 1
            bins[row], offsets[row] = at, offset
            offset += length
        left -= len(held)
        at += 1
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = 4096, rows_per_task: int = 100_000) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to every row of ``pieces`` (with a ``length``).

    The rows (not their ids) are written once, then neighbouring files are read
    together so that each task packs about ``rows_per_task`` pieces by itself;
    every task leaves at most a few sequences badly filled.  Nothing is shuffled
    and a lost task packs the same rows again.  Lengths must be 1 to ``capacity``.
    """
    staged = stage(pieces, "pieces")
    tasks = max(1, math.ceil(staged.count() / rows_per_task))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [pdf for pdf in batches if len(pdf)]
        if rows:
            pdf = pd.concat(rows, ignore_index=True)
            bins, offset = best_two_fit(pdf["length"].to_numpy("int64"), capacity)
            yield pdf.assign(sequence_id=bins + (TaskContext.get().partitionId() << 40), offset=offset)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in staged.schema)
    return staged.coalesce(tasks).mapInPandas(run, f"{schema}, sequence_id long, offset long")


def packed_sequences(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """One row per sequence: its id, its token ids and the documents in it, in place order."""
    plan = pack(tokenised_pieces(docs, tokenizer, capacity, end_id, with_ids=True), capacity)
    parts = plan.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("p"))
    return parts.select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"))
