"""Probabilities of texts by logistic mixing of hashed-context bit predictors.

A text is a sequence of bytes and an end; every symbol is a path of bits in one
Huffman code.  Each bit is predicted in several contexts (the last bytes, the
word so far): a context's hash and the node of the code name a pair of counts,
gathered over all training texts.  A gate, how often each context was seen,
picks the weights that mix the stretched predictions; the weights are fitted to
all training texts and then refined within every text as it is read.

The counts grow with the corpus and are never in one place: a shard of some texts
brings its own counts of (context, symbol) to the sum and gets back the sums of the
contexts it has.  They travel as sorted arrays, one for each range of hashed keys,
so a frequent context is one entry of a shard and no range is hot.  Unigram counts
of whole tokens travel the same way.  What the bits of a symbol are predicted from
follows from its last five bytes: it is worked out once for each distinct case of
a shard, and only sums of logarithms are taken byte by byte.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramlark.llm.common import sigmoid, unused
from gramlark.session import stage

END = 256
ORDERS = (2, 3)  # bytes in the plain contexts
LETTERS = 5  # letters of the word so far, at most
BACK = 8  # bytes kept before a piece; contexts look back no further
ROUND = 512  # bytes between two refinements of a text's weights
SEGMENT = 1 << 19  # bytes worked on at once
PIECE = 1 << 21  # bytes cut into tokens at once
SLICE = 1 << 16  # joints or pairs whose bits are listed at once
BLOCK = 1 << 12  # joints whose losses are worked out at once
PRIME, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
LOW = np.uint64(511)  # the bits of a symbol in a pair or a joint


def symbols(text: str | bytes | None) -> bytes:
    return (text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text or b"").lower()


def tokens_of(texts: list[bytes]) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """Some texts at a time: hashes of their distinct tokens, and per token its number among them and its text's number."""
    sizes, low = np.array([len(t) for t in texts], "i8").cumsum(), 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(sizes, (sizes[low - 1] if low else 0) + PIECE)))
        lists = pc.ascii_split_whitespace(pa.array(texts[low:high], pa.large_binary()).view(pa.large_string()))
        owner = np.repeat(np.arange(high - low), pc.list_value_length(lists).to_numpy())
        tokens = lists.flatten().view(pa.large_binary())
        some = pc.greater(pc.binary_length(tokens), 0)  # white space at either end cuts an empty string off
        found = tokens.filter(some).dictionary_encode()
        words = found.dictionary.to_numpy(zero_copy_only=False)
        keys = np.fromiter(map(xxhash.xxh64_intdigest, words), "u8", len(words))
        yield slice(low, high), keys, found.indices.to_numpy(), owner[some.to_numpy(zero_copy_only=False)]
        low = high


@dataclass(frozen=True)
class Code:
    """Huffman code of the 257 symbols: the nodes and bits of a symbol's path lie at ``start[s]:start[s] + size[s]``."""

    start: np.ndarray
    size: np.ndarray
    node: np.ndarray
    bit: np.ndarray
    prior: np.ndarray  # stretched probability of a one bit at each node


def huffman(counts: np.ndarray) -> Code:
    """Code from the symbols' counts, each raised by one so that every symbol has a path."""
    heap = [(int(n) + 1, s, None) for s, n in enumerate(counts)]
    heapq.heapify(heap)
    number, parent, share = len(counts), {}, {}
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        node = number - len(counts)
        parent[a[1]], parent[b[1]] = (node, 0, number), (node, 1, number)
        share[node] = b[0] / (a[0] + b[0])
        heapq.heappush(heap, (a[0] + b[0], number, None))
        number += 1
    paths = []
    for s in range(len(counts)):
        path, at = [], s
        while at in parent:
            node, bit, at = parent[at]
            path.append((node, bit))
        paths.append(path[::-1])
    size = np.array([len(p) for p in paths])
    prior = np.array([share[k] for k in range(len(share))])
    flat = np.array([x for p in paths for x in p])
    odds = np.log(prior / (1 - prior)).astype("float32")
    return Code(size.cumsum() - size, size, flat[:, 0].astype("int32"), flat[:, 1].astype("int8"), odds)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MIX
    return h ^ (h >> np.uint64(29))


# of a joint, by the letters before that only the word's context sees: the symbol and the bytes that any context sees
SEEN = np.array([(1 << 9 + 8 * k) - 1 for k in range(max(ORDERS), max(*ORDERS, LETTERS) + 1)], "u8")
WAYS = len(ORDERS) + 1
GATES = 3**WAYS


def _letters(b: np.ndarray) -> np.ndarray:
    return ((b > 96) & (b < 123)) | (b > 127)


def pairs_of(joints: np.ndarray) -> list[np.ndarray]:
    """Per way: the context's hash (upper bits) with the symbol, a predicted symbol in its context."""
    before, symbol = joints >> np.uint64(9), joints & LOW
    keys = [before & np.uint64((1 << 8 * k) - 1) for k in ORDERS]
    word, alive = np.zeros(len(joints), "u8"), np.ones(len(joints), bool)
    for k in range(LETTERS):
        b = (before >> np.uint64(8 * k)) & np.uint64(255)
        alive &= _letters(b)
        word |= (b * alive) << np.uint64(8 * k)
    return [_mixed((c | np.uint64((way + 1) << 56)) * PRIME) & ~LOW | symbol for way, c in enumerate([*keys, word])]


class Segment:
    """Some bytes of some texts.

    A byte's ``joint`` is all that its prediction depends on but the text's own
    refinement: the bytes before it that any context sees, and the symbol.
    Runs are the bytes of one round of a text; they lie one after the other.
    """

    def __init__(self, texts: list[bytes], parts: list[tuple[int, int, int]]):
        blocks = []
        for t, start, end in parts:  # ``end`` one past the length takes the end symbol in
            head = texts[t][max(0, start - BACK) : start]
            blocks.append(b"\0" * (BACK - len(head)) + head + texts[t][start:end] + b"\0" * (end > len(texts[t])))
        buffer = np.frombuffer(b"".join(blocks), "u1")
        owner, start, end = np.array(parts).T
        size = end - start
        first = (size + BACK).cumsum() - size - BACK
        # a byte and the seven before it, as one number: the byte is the lowest, the one before it the next
        joint = np.lib.stride_tricks.sliding_window_view(buffer, 8).view(">u8")[:, 0].astype("u8")
        joint >>= np.uint64(8)
        joint <<= np.uint64(9)
        joint |= buffer[7:]
        joint[(first + BACK + size - 8)[end > np.array([len(texts[t]) for t in owner])]] |= np.uint64(END)
        letter, alive, more = _letters(buffer), np.ones(len(joint), bool), np.zeros(len(joint), "u1")
        for k in range(1, LETTERS + 1):
            alive &= letter[7 - k : len(buffer) - k]
            if k > max(ORDERS):
                more += alive
        joint &= SEEN.take(more)
        own = np.ones(len(buffer), bool)
        own[(first[:, None] + np.arange(BACK)).ravel()] = False
        self.joint = joint[own[7:]]
        many = -(-size // ROUND)
        step = np.arange(many.sum()) - np.repeat(many.cumsum() - many, many)
        self.text, self.turn = np.repeat(owner, many), np.repeat(start // ROUND, many) + step
        self.size = np.minimum(ROUND, np.repeat(size, many) - step * ROUND)

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """Per byte the number of its joint, and the distinct joints."""
        return pd.factorize(self.joint, size_hint=len(self.joint) // 8)


def segments(texts: list[bytes]) -> Iterator[Segment]:
    """All bytes and ends of ``texts``: short texts together, long ones in pieces of whole rounds."""
    parts, size = [], 0
    for t, b in enumerate(texts):
        for start in range(0, len(b) + 1, SEGMENT):
            part = (t, start, min(start + SEGMENT, len(b) + 1))
            parts.append(part)
            size += part[2] - part[1]
            if size >= SEGMENT:
                yield Segment(texts, parts)
                parts, size = [], 0
    if parts:
        yield Segment(texts, parts)


def _spread(size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For runs of ``size``: each one's first place, and per place the run and the step within it."""
    first = size.cumsum() - size
    owner = np.repeat(np.arange(len(size)), size)
    return first, owner, np.arange(len(owner)) - first[owner]


def node_keys(pairs: np.ndarray, code: Code) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per bit of every pair: the key of (context, node), the bit, the pair's number; and where each pair's bits start."""
    symbol = (pairs & LOW).astype("int64")
    first, owner, step = _spread(code.size[symbol])
    path = step + code.start[symbol[owner]]
    return _mixed((pairs[owner] & ~LOW) + code.node[path].astype("u8") * PRIME), code.bit[path], owner, first


def _summed(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in ascending order, and the sums of their counts."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
    if len(first) == 0:
        return keys, *counts
    return keys[first], *(np.add.reduceat(c[order], first) for c in counts)


def _joined(parts: list[tuple[np.ndarray, ...]], kinds: tuple[str, ...] = ("u8", "i8")) -> tuple[np.ndarray, ...]:
    return tuple(np.concatenate([np.zeros(0, k), *(t[i] for t in parts)]) for i, k in enumerate(kinds))


Sums = tuple[np.ndarray, np.ndarray]  # keys in ascending order, and their counts


def ask(texts: list[bytes], learn: np.ndarray) -> tuple[Sums, Sums, Sums]:
    """Pairs, tokens and joints of the texts, each with its occurrences in training texts (joints: if there are any)."""
    got = []
    for seg in segments(texts):
        number, distinct = seg.distinct()
        n = np.bincount(number, np.repeat(learn[seg.text], seg.size), len(distinct))
        got.append((distinct, n.astype("int64")))
        # merged as they come, so that no more than twice the distinct joints are held
        if sum(len(g[0]) for g in got[1:]) > max(SEGMENT, len(got[0][0])):
            got = [_summed(*_joined(got))]
    joints, n = _summed(*_joined(got))
    pairs = _summed(*_joined([_summed(pairs, n) for pairs in pairs_of(joints)]))
    cut = [(keys, np.bincount(token[learn[at][owner]], minlength=len(keys))) for at, keys, token, owner in tokens_of(texts)]
    return pairs, _summed(*_joined(cut)), (joints[n > 0], n[n > 0])


Tally = tuple[np.ndarray, np.ndarray, np.ndarray]  # keys in any order, zeros, ones


def nodes(pairs: np.ndarray, many: np.ndarray, code: Code) -> Tally:
    """Counts of the bits at each node from those of sorted pairs."""
    pairs, many = pairs[many > 0], many[many > 0]
    context = pairs >> np.uint64(9)
    starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(pairs)), bool), context[1:] != context[:-1]]))
    cuts = starts[np.unique(np.searchsorted(starts, np.arange(0, len(pairs), SLICE)).clip(max=len(starts) - 1))]
    got = []
    for low, high in zip(cuts, np.append(cuts[1:], len(pairs))):  # contexts are whole, so no key is in two slices
        key, bit, owner, _ = node_keys(pairs[low:high], code)
        n = many[low:high][owner]
        got.append(_summed(key, n * (1 - bit), n * bit))
    return _joined(got, ("u8", "i8", "i8"))


def gather(texts: list[bytes], learn: np.ndarray, code: Code) -> Tally:
    """Counts of the bits in training texts for all contexts of the texts."""
    return nodes(*ask(texts, learn)[0], code)


def _planes(a: np.ndarray) -> bytes:
    """The array's length and bytes, all lowest ones first: the upper ones of small numbers are zeros and compress away."""
    return len(a).to_bytes(8, "little") + pa.compress(a.view("u1").reshape(-1, 8).T.tobytes(), "zstd", asbytes=True)


def _from_planes(b: bytes, kind: str) -> np.ndarray:
    flat = pa.decompress(b[8:], 8 * int.from_bytes(b[:8], "little"), "zstd")
    return np.ascontiguousarray(np.frombuffer(flat, "u1").reshape(8, -1).T).view(kind).ravel()


PACKED = "keys binary, many binary"
PAIRS, TOKENS, JOINTS = range(3)  # kinds of rows


def packed(keys: np.ndarray, many: np.ndarray) -> list[bytes]:
    """Two columns of one row: gaps between the keys, and the counts."""
    return [_planes(a) for a in (np.diff(keys, prepend=keys.dtype.type(0)), many)]


def unpacked(row) -> Sums:
    return _from_planes(row.keys, "u8").cumsum(dtype="u8"), _from_planes(row.many, "i8")


def ranges(keys: np.ndarray, many: int) -> np.ndarray:
    """Where each of ``many`` equal ranges of the 64-bit keys starts in the sorted ``keys``, and their end; no context is cut."""
    starts = np.array([(k << 64) // many & ~int(LOW) for k in range(many)], "u8")
    return np.append(np.searchsorted(keys, starts), len(keys))


def answers(pdf: pd.DataFrame) -> Sums:
    """What a shard got back; one read by two tasks asked twice, and a key's sum is the same in both answers."""
    keys, many = _joined([unpacked(r) for r in pdf.itertuples()])
    keys, first = np.unique(keys, return_index=True)
    return keys, many[first]


class Counts:
    """The sums a shard got back, found by hash."""

    def __init__(self, tally: Tally):
        keys, zeros, ones = tally
        self.index = pd.Index(keys)
        self.both = np.zeros(len(keys) + 1, "complex128")  # one number, so that a look-up is one step
        self.both.real[:-1], self.both.imag[:-1] = zeros, ones

    def of(self, keys: np.ndarray) -> np.ndarray:
        """``zeros + 1j * ones`` of each key; none for those not seen, whose place -1 is the last."""
        return self.both.take(self.index.get_indexer(keys))


def inputs(zeros: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretched prediction of a one bit, and the class of its count for the gate."""
    total = zeros + ones
    return np.log((ones + 0.4) / (zeros + 0.4)).astype("float32"), (total > 0).astype("int16") + (total > 3)


def predictors(joints: np.ndarray, counts: Counts, code: Code, apart: bool = False):
    """Bit, inputs (one array per way and the code's own odds) and gate of all bits of the joints.

    ``apart`` leaves each bit out of its own counts, as a training text must.
    """
    symbol = (joints & LOW).astype("int64")
    _, owner, step = _spread(code.size[symbol])
    path = code.start[symbol[owner]] + step
    bit = code.bit[path]
    x, gate = [], np.zeros(len(bit), "int16")
    for pairs in pairs_of(joints):
        number, distinct = pd.factorize(pairs, size_hint=len(pairs) // 4)  # counts are looked up once per distinct pair
        key, _, _, first = node_keys(distinct, code)
        both, at = counts.of(key), first[number][owner] + step
        if apart:
            own = both.take(at)
            stretched, seen = inputs(np.maximum(own.real - (1 - bit), 0), np.maximum(own.imag - bit, 0))
        else:
            stretched, seen = (a.take(at) for a in inputs(both.real, both.imag))
        x.append(stretched)
        gate = gate * np.int16(3) + seen
    x.append(code.prior[code.node[path]])
    return bit, x, gate


STEPS, LEVELS = 2, 128  # of an input in a cell: per unit, and in all


def cells(joints: np.ndarray, many: np.ndarray, counts: Counts, code: Code) -> tuple[np.ndarray, np.ndarray]:
    """Histogram of the training bits: gate, rounded inputs and the bit in one number, and how often it occurs."""
    got = []
    for at in range(0, len(joints), SLICE):
        part = joints[at : at + SLICE]
        bit, x, cell = predictors(part, counts, code, apart=True)
        cell = cell.astype("int64")
        for one in x:
            cell = cell * LEVELS + np.clip(np.rint(one * STEPS).astype("int64") + LEVELS // 2, 0, LEVELS - 1)
        n = np.repeat(many[at : at + SLICE], code.size[(part & LOW).astype("int64")])
        got.append(_summed(cell * 2 + bit, n))
    return _summed(*_joined(got, ("i8", "i8")))


def fit_gate(cell: np.ndarray, many: np.ndarray, start: float = 0.3, turns: int = 50) -> np.ndarray:
    """Weights of the inputs of one gate's cells: likeliest ones, held at ``start`` where the cells say nothing."""
    bit, rest, x = cell & 1, cell >> 1, np.zeros((len(cell), WAYS + 1))
    for i in reversed(range(WAYS + 1)):
        x[:, i], rest = (rest % LEVELS - LEVELS // 2) / STEPS, rest // LEVELS

    def loss(w: np.ndarray) -> float:
        return float(many @ np.logaddexp(0, np.where(bit == 1, -1, 1) * (x @ w)) + ((w - start) ** 2).sum() / 2)

    w = np.full(WAYS + 1, start)
    now = loss(w)
    for _ in range(turns):  # Newton's steps, halved until they help
        p = sigmoid(x @ w)
        slope = x.T @ (many * (p - bit)) + w - start
        step = np.linalg.solve((x.T * (many * p * (1 - p))) @ x + np.eye(WAYS + 1), slope)
        while (then := loss(w - step)) > now and np.abs(step).max() > 1e-9:
            step /= 2
        if then >= now:
            break
        w, now = w - step, then
        if np.abs(step).max() < 1e-9:
            break
    return w


GRID = 2.0 ** (np.arange(-16, 17) / 8)  # of the factors that refine a text's weights


class Losses:
    """Loss of each joint's bits, and 1j times its slope, at the factors of ``GRID``; worked out when a factor is first needed.

    The joints come with the shortest paths first: those of one length are a matrix, a row per bit of the path.
    """

    def __init__(self, joints: np.ndarray, counts: Counts, code: Code, w: np.ndarray):
        columns = [c.astype("float32") for c in w.T]
        size, self.right, self.at = code.size[(joints & LOW).astype("int64")], [], {}
        for at in range(0, len(joints), SLICE):
            bit, x, gate = predictors(joints[at : at + SLICE], counts, code)
            mixed = sum(x[i] * columns[i].take(gate) for i in range(WAYS + 1))
            right = np.where(bit == 1, mixed, -mixed)
            for length, n in zip(*np.unique(size[at : at + SLICE], return_counts=True)):
                own, right = right[: length * n].reshape(n, length), right[length * n :]
                self.right += [own[k : k + BLOCK].T.copy() for k in range(0, n, BLOCK)]

    def __getitem__(self, k: int) -> np.ndarray:
        if k not in self.at:
            s, got = np.float32(GRID[k]), []
            for y in self.right:
                z = y * s
                wrong = np.exp(-np.abs(z))
                both = 1 + wrong
                loss = np.log(both.prod(axis=0)) - np.minimum(z, 0).sum(axis=0)
                got.append(loss - 1j * (y * np.where(y > 0, wrong, np.float32(1)) / both).sum(axis=0))
            self.at[k] = np.concatenate(got)
        return self.at[k]


def score(texts: list[bytes], counts: Counts, code: Code, w: np.ndarray, rate: float = 0.002) -> np.ndarray:
    """log10 probability of every text: gated weights, sharpened or flattened after each round of the text's bytes.

    Between two factors of ``GRID`` the loss is a cubic with the values and slopes of both: its error
    is under a millionth for any bit.
    """
    out, sharper = np.zeros(len(texts)), np.ones(len(texts))
    ids, found, runs, filled, places = np.empty(sum(len(t) + 1 for t in texts), "i4"), [], [], 0, 0
    for seg in segments(texts):
        number, distinct = seg.distinct()
        ids[filled : filled + len(number)] = number + places
        filled, places = filled + len(number), places + len(distinct)
        found.append(distinct)
        runs.append((seg.text, seg.turn, seg.size))
    number, joints = pd.factorize(np.concatenate([np.zeros(0, "u8"), *found]))
    shortest = np.argsort(code.size[(joints & LOW).astype("int64")], kind="stable")
    place = np.empty(len(joints), "i4")
    place[shortest] = np.arange(len(joints))
    number = place[number]
    for at in range(0, filled, SEGMENT):
        ids[at : at + SEGMENT] = number.take(ids[at : at + SEGMENT])
    losses = Losses(joints[shortest], counts, code, w)
    text, turn, size = _joined(runs, ("i8", "i8", "i8"))
    start, order = size.cumsum() - size, np.argsort(turn, kind="stable")
    cuts = np.flatnonzero(np.diff(turn[order], prepend=-1, append=-1))
    for low, high in zip(cuts[:-1], cuts[1:]):
        who = text[order[low:high]]
        cell = np.clip(np.searchsorted(GRID, sharper[who], side="right") - 1, 0, len(GRID) - 2)
        for k in np.unique(cell):
            run = order[low:high][cell == k]
            own = np.concatenate([ids[a : a + n] for a, n in zip(start[run], size[run])]).astype("int64")
            first = size[run].cumsum() - size[run]
            low_sum, high_sum = (np.add.reduceat(losses[i].take(own), first).astype("complex128") for i in (k, k + 1))
            wide, who = GRID[k + 1] - GRID[k], text[run]
            f0, d0, f1, d1 = low_sum.real, low_sum.imag, high_sum.real, high_sum.imag
            t = (sharper[who] - GRID[k]) / wide
            rise, d0, d1 = f1 - f0, d0 * wide, d1 * wide
            bend, twist = 3 * rise - 2 * d0 - d1, d0 + d1 - 2 * rise
            out[who] -= f0 + t * (d0 + t * (bend + t * twist))
            sharper[who] -= rate * (d0 + t * (2 * bend + t * 3 * twist)) / wide
            sharper[who] = np.clip(sharper[who], GRID[0], GRID[-1])
    return out / math.log(10)


def plain(texts: list[bytes], keys: np.ndarray, many: np.ndarray, ends: int, distinct: int, total: int) -> pd.DataFrame:
    """``n_tokens, n_known, base_score`` of every text, from the sorted keys of tokens that training texts have."""
    keys, many = np.append(keys, keys[-1:]), np.append(many, 0)  # a place for those beyond the last
    parts = []
    for at, own, token, owner in tokens_of(texts):
        place, size = np.searchsorted(keys[:-1], own), at.stop - at.start
        n = many[place] * (keys[place] == own) if len(keys) > 1 else np.zeros(len(own), "i8")
        known = np.bincount(owner[n[token] > 0], minlength=size)
        parts.append((np.bincount(owner, minlength=size), known, np.bincount(owner, np.log10(n + 1.0)[token], size)))
    n_tokens, n_known, logs = _joined(parts, ("i8", "i8", "f8"))
    base = logs + math.log10(ends + 1) - (n_tokens + 1) * math.log10(total + distinct + 1)
    return pd.DataFrame({"n_tokens": n_tokens + 1, "n_known": n_known + (ends > 0), "base_score": base})


def byte_counts(docs: DataFrame) -> np.ndarray:
    """Occurrences of the 257 symbols; tasks emit 257 sums a batch."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n = np.zeros(END + 1, "int64")
            for t in pdf["text"]:
                n[:END] += np.bincount(np.frombuffer(symbols(t), "u1"), minlength=END)
            n[END] = len(pdf)
            yield pd.DataFrame({"s": range(END + 1), "n": n})

    got = docs.select("text").mapInPandas(each, "s int, n long").groupBy("s").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(END + 1, "int64")
    for r in got:
        out[r.s] = r.n
    return out


def score_texts(docs: DataFrame, held_out: Column, column: str = "text", shard_bytes: int = 12 << 20) -> DataFrame:
    """``docs`` with ``held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte`` in a struct ``lm``.

    Counts come from all texts where ``held_out`` isn't true.  ``base_score`` is
    the unigram log10 probability of the tokens (words between ASCII white space,
    then one end) with one added to every count; ``score`` that of the mixed
    model for the bytes of the lower-cased text and their end.  The mixing weights
    are fitted to the bits of all training texts, each without itself in the counts,
    by a histogram of what they are predicted from.  A null text is
    an empty one; a null in ``held_out`` counts as false; repeated rows are
    scored each; other columns stay as they are.
    """
    number = unused(docs.columns, "number")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(whole.alias("doc"), F.coalesce(held_out, F.lit(False)).alias("out"))

    @F.pandas_udf("long")
    def chunk(sizes: Iterator[pd.Series]) -> Iterator[pd.Series]:
        before = 0
        for s in sizes:
            ends = before + s.cumsum()
            yield (ends - s) // shard_bytes
            before = int(ends.iloc[-1]) if len(s) else before

    # a shard is some neighbouring rows of a partition
    place = chunk(F.coalesce(F.octet_length(F.col("doc").getField(column)), F.lit(0)).cast("long"))
    shard = F.spark_partition_id().cast("long") * (1 << 33) + place
    kept = stage(rows.select("*", F.monotonically_increasing_id().alias(number), shard.alias("shard")), "numbered")
    text = F.col("doc").getField(column).cast("binary").alias("text")
    texts = kept.select(text, (~F.col("out")).alias("learn"), F.col(number).alias("number"), "shard")
    size, ends = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count_if("learn")).first()
    code = huffman(byte_counts(texts.where("learn")))  # bounded by the 257 symbols
    many = max(math.ceil(size / shard_bytes), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def asked(own: list[bytes], learn: list[bool], shard: int) -> pd.DataFrame:
        got, rows = ask(own, np.array(learn, bool)), []
        for kind in (PAIRS, TOKENS):
            cuts = ranges(got[kind][0], many)
            rows += [(*packed(*(a[cuts[k] : cuts[k + 1]] for a in got[kind])), kind, k) for k in np.flatnonzero(np.diff(cuts))]
        rows.append((*packed(*got[JOINTS]), JOINTS, shard))  # nothing to be summed, they only travel with the sums
        return pd.DataFrame(rows, columns=["keys", "many", "kind", "range"]).assign(shard=np.int64(shard))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, learn, now = [], [], None
        for pdf in batches:
            for shard, part in pdf.groupby("shard", sort=False):
                if own and shard != now:
                    yield asked(own, learn, now)
                    own, learn = [], []
                now = shard
                own += [symbols(t) for t in part["text"]]
                learn += part["learn"].tolist()
        if own:
            yield asked(own, learn, now)

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        kind = pdf["kind"].iloc[0]
        if kind == JOINTS:
            return pdf[["keys", "many", "kind", "shard"]].assign(n=0, v=0)
        asks = [unpacked(r) for r in pdf.itertuples()]
        keys, sums = _summed(*_joined(asks))
        keys, sums = keys[sums > 0], sums[sums > 0]
        part = np.uint64(9 if kind == PAIRS else 0)  # of a context a shard gets all pairs
        name, rows = keys >> part, []
        for own, _ in asks:
            wanted = np.unique(own >> part)
            low, high = (np.searchsorted(name, wanted, side=s) for s in ("left", "right"))
            _, owner, step = _spread(high - low)
            at = low[owner] + step
            rows.append(packed(keys[at], sums[at]))
        out = pd.DataFrame(rows, columns=["keys", "many"]).assign(kind=kind, shard=pdf["shard"].to_numpy())
        first = (np.arange(len(out)) == 0) & (kind == TOKENS)  # a range's words are told once
        return out.assign(n=first * int(sums.sum()), v=first * len(keys))

    parts = texts.select("text", "learn", "shard").mapInPandas(count, f"{PACKED}, kind int, range long, shard long")
    needs = parts.groupBy("kind", "range").applyInPandas(add, f"{PACKED}, kind int, shard long, n long, v long")
    needs = stage(needs, "counts")
    tokens = needs.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in "nv"]).first()
    total, distinct = tokens.n + ends, tokens.v + (ends > 0)

    def bins(pdf: pd.DataFrame) -> pd.DataFrame:
        counts = Counts(nodes(*answers(pdf[pdf["kind"] == PAIRS]), code))
        got = [cells(*unpacked(r), counts, code) for r in pdf[pdf["kind"] == JOINTS].itertuples()]
        return pd.DataFrame(dict(zip(("cell", "n"), _joined(got, ("i8", "i8")))))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("cell")
        w = fit_gate(pdf["cell"].to_numpy(), pdf["n"].to_numpy())
        return pd.DataFrame({"gate": pdf["gate"].iloc[:1], "w": [w]})

    # cells are bounded by the rounding, gates by the classes of counts
    binned = needs.where(F.col("kind") != TOKENS).groupBy("shard").applyInPandas(bins, "cell long, n long")
    summed = binned.groupBy("cell").agg(F.sum("n").alias("n"))
    gate = F.floor(F.col("cell") / F.lit(2 * LEVELS ** (WAYS + 1))).cast("int").alias("gate")
    w = np.full((GATES, WAYS + 1), 0.3)
    for r in summed.select("cell", "n", gate).groupBy("gate").applyInPandas(fit, "gate int, w array<double>").collect():
        w[r.gate] = r.w

    def judge(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        own = [symbols(t) for t in a["text"]]
        out = plain(own, *answers(b[b["kind"] == TOKENS]), ends, distinct, total)
        got = score(own, Counts(nodes(*answers(b[b["kind"] == PAIRS]), code)), code, w) if own else np.zeros(0)
        bits = -got * math.log2(10) / np.array([len(t) + 1 for t in own]) if own else got
        out.insert(0, "number", a["number"].to_numpy())
        return out.assign(score=got, bits_per_byte=bits)

    sums = needs.where(F.col("kind") != JOINTS).select("keys", "many", "kind", "shard")
    scored = texts.select("text", "number", "shard").groupBy("shard").cogroup(sums.groupBy("shard")).applyInPandas(
        judge, "number long, n_tokens long, n_known long, base_score double, score double, bits_per_byte double"
    )
    scored = stage(scored, "scored").withColumnRenamed("number", number)
    lm = F.struct(
        F.col("out").alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        "bits_per_byte",
    )
    return kept.join(scored, number).select("doc.*", lm.alias("lm"))
