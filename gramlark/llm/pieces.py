"""SentencePiece ids of whole texts by a streaming Viterbi search, and their decoding.

The lattice has a node between any two characters and an arc per piece of the
vocabulary.  Only a window of the longest piece's length is open: whatever comes
next starts in it.  Whenever the backpointer paths of all open nodes meet in one
boundary, the ids up to it are final and leave the window.

For byte-pair vocabularies an arc may follow another only if merging the two
pieces' characters by rank gives just these two pieces; so every node keeps the
one arc that ends the merged form of its prefix, and the path is what the merges
give.  For unigram vocabularies a node keeps the arc of the best total score.
"""

from __future__ import annotations

import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from gramlark.llm.common import column_map
from gramlark.llm.packing import chunks

SPACE = "▁"
CACHED_RUNS = 800_000
CACHED_LENGTH = 48
CACHED_PAIRS = 2_000_000


class Pieces:
    """A vocabulary with the identity normaliser, a dummy prefix and byte pieces."""

    def __init__(self, path: str, kind: str = "bpe"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.kind = kind
        self.unknown = model.unk_id()
        self.byte = [0] * 256
        self.bytes: list[bytes] = []
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        for i in range(size):
            p = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(p[3:5], 16)] = i
                self.bytes.append(bytes([int(p[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes.append(" ⁇ ".encode() if model.is_unknown(i) else b"")
            else:
                self.bytes.append(p.replace(SPACE, " ").encode())
                self.id[p], self.score[p] = i, model.get_score(i)
        self.longest = max(map(len, self.id))
        self.lowest = min(self.score.values(), default=0.0)
        inside = {p[k : k + 2] for p in self.id for k in range(len(p) - 1)}
        # where no piece holds two neighbouring characters, all paths meet
        self.before_space = not any(a != SPACE and b == SPACE for a, b in inside)
        self.newline_apart = not any("\n" in pair for pair in inside)
        # lengths of the pieces that end with two or three characters, the longest first
        sizes: dict[str, set[int]] = {}
        for p in self.id:
            if len(p) > 1:
                sizes.setdefault(p[-3:], set()).add(len(p))
        for end, own in sizes.items():
            if len(end) == 3 and end[1:] in self.id:
                own.add(2)
        self.sizes = {k: sorted(v, reverse=True) for k, v in sizes.items()}
        # of every piece that merging builds: whether it may follow the pieces asked for so far
        self.arcs: dict[str, dict[str, bool]] = {}
        if kind == "bpe":
            self.arcs = {p: {} for p in self.id if len(p) > 1 and self.merged(p) == [p]}
        self.pairs = 0
        self.known: dict[str, bytes] = {"": b""}

    def merged(self, text: str) -> list[str]:
        """Merges of neighbouring parts by score, the leftmost first, until none is a piece."""
        parts, get, none = list(text), self.score.get, float("-inf")
        pair = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while pair and (best := max(pair)) > none:
            k = pair.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del pair[k]
            if k:
                pair[k - 1] = get(parts[k - 1] + parts[k], none)
            if k < len(pair):
                pair[k] = get(parts[k] + parts[k + 1], none)
        return parts

    def follows(self, a: str, b: str) -> bool:
        if self.pairs >= CACHED_PAIRS:
            self.pairs = 0
            for known in self.arcs.values():
                known.clear()
        self.pairs += 1
        ok = self.arcs[b][a] = self.merged(a + b) == [a, b]
        return ok

    def segment(self, text: str, window: int = 256) -> list[str]:
        """Pieces (or single unknown characters) of ``text``, dummy prefix already in place.

        At most ``window`` characters beyond the longest piece are held between
        two looks for a common boundary (more only while paths stay apart).
        """
        out: list[str] = []
        # of the open nodes, the first of which is ``base``:
        start = [0]  # where a node's arc begins
        last = [""]  # the piece on it
        total = [0.0]
        base, looked = 0, 0
        unigram = self.kind == "unigram"
        sizes, arcs = self.sizes, self.arcs
        for j in range(1, len(text) + 1):
            chosen = j - 1
            if unigram:
                best = total[-1] + self.score.get(text[chosen:j], self.lowest - 10.0)
                for size in sizes.get(text[j - 3 : j]) or sizes.get(text[j - 2 : j], ()):
                    s = self.score.get(text[j - size : j]) if size <= j - base else None
                    if s is not None and total[j - size - base] + s >= best:
                        best, chosen = total[j - size - base] + s, j - size
                total.append(best)
            else:
                for size in sizes.get(text[j - 3 : j]) or sizes.get(text[j - 2 : j], ()):
                    i = j - size
                    known = arcs.get(text[i:j]) if i >= base else None
                    if known is None:
                        continue
                    ok = i == 0 or known.get(last[i - base])
                    if ok is None:
                        ok = self.follows(last[i - base], text[i:j])
                    if ok:
                        chosen = i
                        break
            start.append(chosen)
            last.append(text[chosen:j])
            if j - looked >= window:
                looked = j
                open_ = set(range(max(base, j - self.longest + 1), j + 1))
                while len(open_) > 1:
                    k = max(open_)
                    open_.remove(k)
                    open_.add(start[k - base])
                b = open_.pop()
                if b > base:
                    out += self._path(start, last, base, b)
                    del start[: b - base], last[: b - base], total[: b - base]
                    base = b
        return out + self._path(start, last, base, base + len(start) - 1)

    @staticmethod
    def _path(start: list[int], last: list[str], base: int, high: int) -> list[str]:
        path = []
        while high > base:
            path.append(last[high - base])
            high = start[high - base]
        return path[::-1]

    def ids(self, text: str) -> list[int]:
        """Ids of a run of text; characters without a piece become their bytes."""
        out = []
        for p in self.segment(text):
            i = self.id.get(p)
            if i is not None:
                out.append(i)
            else:
                out += [self.byte[b] for b in p.encode("utf-8", "surrogatepass")]
        return out

    @property
    def runs(self) -> re.Pattern:
        """Runs between boundaries that no piece crosses."""
        if not self.before_space:
            return re.compile(r"(?s).+")
        if not self.newline_apart:
            return re.compile(rf"{SPACE}*[^{SPACE}]+|{SPACE}+")
        return re.compile(rf"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian 32-bit bytes, through a cache of runs.

        The cache holds the first runs a worker meets; a full one starts anew
        when most runs of a call are missing from it.
        """
        find = self.runs.findall
        lists = [find(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        every = set().union(*lists)
        new = every.difference(self.known)
        if len(self.known) >= CACHED_RUNS and 2 * len(new) > len(every):
            self.known = {"": b""}
            new = every
        extra = {r: array("I", self.ids(r)).tobytes() for r in new}
        if len(self.known) < CACHED_RUNS:
            self.known.update((r, i) for r, i in extra.items() if len(r) <= CACHED_LENGTH)
        known = self.known
        return [b"".join([known[r] if r in known else extra[r] for r in x]) for x in lists]

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: bytes are put together again, the dummy prefix is dropped."""
        raw = b"".join(map(self.bytes.__getitem__, ids.tolist()))
        return raw.removeprefix(b" ").decode("utf-8", "replace")


@lru_cache(maxsize=2)
def pieces(path: str, kind: str = "bpe") -> Pieces:
    return Pieces(path, kind)


def encoded(docs: DataFrame, model: str, kind: str = "bpe", column: str = "text"):
    """Array column with the ids of every whole text (null: no ids).

    ``model`` is a path that every executor can read.
    """

    def make():
        vocabulary = pieces(model, kind)

        def each(texts: pd.Series) -> pd.DataFrame:
            raw = [b for part in chunks([t or "" for t in texts]) for b in vocabulary.encode(part)]
            return pd.DataFrame({"ids": [np.frombuffer(b, "<u4").astype("int32") for b in raw]})

        return each

    return column_map(docs, column, "ids array<int>", make)["ids"]


def decoded(docs: DataFrame, model: str, kind: str = "bpe", column: str = "ids"):
    """String column with the text of every array of ids (null: null)."""

    def make():
        vocabulary = pieces(model, kind)

        def each(ids: pd.Series) -> pd.DataFrame:
            return pd.DataFrame({"text": [None if i is None else vocabulary.decode(np.asarray(i)) for i in ids]})

        return each

    return column_map(docs, column, "text string", make)["text"]


def digests(docs: DataFrame, model: str, kind: str = "bpe", column: str = "text"):
    """Struct column of ``encoded`` and ``decoded`` in one pass: count and CRC of the ids, and
    whether they give the text back (a text with the space sign itself can't)."""

    def make():
        vocabulary = pieces(model, kind)

        def each(texts: pd.Series) -> pd.DataFrame:
            rows = []
            for part in chunks([t or "" for t in texts]):
                for t, b in zip(part, vocabulary.encode(part)):
                    ids = np.frombuffer(b, "<u4")
                    rows.append((len(ids), zlib.crc32(b), vocabulary.decode(ids) == t))
            return pd.DataFrame(rows, columns=["n_ids", "ids_crc32", "round_trip"])

        return each

    return column_map(docs, column, "n_ids long, ids_crc32 long, round_trip boolean", make)
