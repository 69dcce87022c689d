"""Language-model scores against plain counting and a bit-by-bit model."""

import math
import time
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gramlark.llm import mixing as m
from gramlark.llm import queries

TEXTS = ["", "a", "The cat sat on the mat. " * 40, "ça va? ÇA VA " * 90, "x" * 3_000, "tab\tand\x0bline\n" * 30, "the cat", "漢字 \x1c🙂"]


def plain_bits(data, code):
    """(place, bit, node, [context per way]) of a text's bits, one after the other."""
    for i in range(len(data) + 1):
        before = [data[i - k] if i >= k else 0 for k in range(1, m.BACK + 1)]
        word = []
        for b in before[: m.LETTERS]:
            if not (96 < b < 123 or b > 127):
                break
            word.append(b)
        ways = [tuple(before[:k]) for k in m.ORDERS] + [tuple(word)]
        s = data[i] if i < len(data) else m.END
        for p in range(code.start[s], code.start[s] + code.size[s]):
            yield i, int(code.bit[p]), int(code.node[p]), ways


def plain_model(texts, learn, code, w, rate=0.002):
    seen = Counter()
    for data, own in zip(texts, learn):
        for _, bit, node, ways in plain_bits(data, code):
            for way, c in enumerate(ways):
                seen[way, c, node, bit] += int(own)
    out = []
    for data in texts:
        total, sharper, step, turn = 0.0, 1.0, 0.0, 0
        for i, bit, node, ways in plain_bits(data, code):
            if i // m.ROUND != turn:
                sharper, step, turn = min(4.0, max(0.25, sharper + rate * step)), 0.0, i // m.ROUND
            gate, z = 0, 0.0
            pairs = [(seen[way, c, node, 0], seen[way, c, node, 1]) for way, c in enumerate(ways)]
            for a, b in pairs:
                gate = gate * 3 + (a + b > 0) + (a + b > 3)
            for k, (a, b) in enumerate(pairs):
                z += w[gate, k] * math.log((b + 0.4) / (a + 0.4))
            z += w[gate, -1] * float(code.prior[node])
            p = 1 / (1 + math.exp(-z * sharper))
            step += z * (bit - p)
            total += math.log10(p if bit else 1 - p)
        out.append(total)
    return out


def code_of(texts):
    n = np.zeros(257, "int64")
    for t in texts:
        n[:256] += np.bincount(np.frombuffer(t, "u1"), minlength=256)
    n[256] = len(texts)
    return m.huffman(n)


def test_score_equals_the_plain_model():
    texts = [m.symbols(t) for t in TEXTS]
    learn = np.array([k % 3 != 1 for k in range(len(texts))])
    code = code_of(texts)
    w = np.random.default_rng(2).normal(0.4, 0.1, (m.GATES, m.WAYS + 1))
    got = m.score(texts, m.Counts(m.gather(texts, learn, code)), code, w)
    assert got == pytest.approx(plain_model(texts, learn, code, w), rel=1e-4, abs=1e-4)


def test_pieces_of_a_long_text_change_nothing(monkeypatch):
    texts = [m.symbols("some words and more of them, " * 300), m.symbols("short one"), b""]
    learn, code = np.ones(3, bool), code_of(texts)
    w = np.full((m.GATES, m.WAYS + 1), 0.4)
    whole = m.score(texts, m.Counts(m.gather(texts, learn, code)), code, w)
    monkeypatch.setattr(m, "SEGMENT", 2 * m.ROUND)
    assert m.score(texts, m.Counts(m.gather(texts, learn, code)), code, w) == pytest.approx(whole, rel=1e-5)


def test_code_is_a_full_prefix_code():
    code = code_of([b"abracadabra"])
    assert sum(2.0 ** -int(n) for n in code.size) == 1
    paths = {tuple(code.bit[a : a + n]) for a, n in zip(code.start, code.size)}
    assert len(paths) == 257 and code.size[ord("a")] < code.size[ord("z")]


def scored(spark, rows, **how):
    df = spark.createDataFrame(rows, "doc_id long, text string, number int, doc string, lm int")
    out = m.score_texts(df.drop("lm"), F.col("doc_id") % 7 == 2, **how)
    assert out.columns == ["doc_id", "text", "number", "doc", "lm"]
    return out.select("doc_id", "text", "lm.*").toPandas()


def test_columns_on_odd_rows_and_any_sharding(spark):
    rows = [(k, t, 1, "x", 2) for k, t in enumerate([*TEXTS, None, *TEXTS, "The cat sat", TEXTS[2], TEXTS[2]])]
    rows += [rows[2], rows[2], (None, "the mat", 1, "y", 3)]
    got = scored(spark, rows).sort_values(["doc_id", "text"], na_position="first").reset_index(drop=True)
    words = lambda t: (t or "").encode("utf-8").lower().split()
    seen = Counter(w for i, t, *_ in rows if i is None or i % 7 != 2 for w in words(t))
    ends = sum(i is None or i % 7 != 2 for i, *_ in rows)
    total, distinct = sum(seen.values()) + ends, len(seen) + 1
    assert len(got) == len(rows)
    for r in got.itertuples():
        c = [seen[w] for w in words(r.text)] + [ends]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(c), sum(x > 0 for x in c), total)
        assert r.base_score == pytest.approx(sum(math.log10((x + 1) / (total + 1 * (distinct + 1))) for x in c))
        assert bool(r.held_out) == (not math.isnan(r.doc_id) and r.doc_id % 7 == 2)
        assert r.score < 0 and r.bits_per_byte == pytest.approx(-r.score * math.log2(10) / (len((r.text or "").encode()) + 1))
    cut = scored(spark, rows, shard_bytes=2_000).sort_values(["doc_id", "text"], na_position="first").reset_index(drop=True)
    assert np.allclose(cut.score, got.score, rtol=1e-4) and (cut.n_known == got.n_known).all()


def sums_of_tokens(texts, learn):
    seen = Counter(w for t, own in zip(texts, learn) if own for w in t.split())
    keys = np.array([m.xxhash.xxh64_intdigest(w) for w in seen], "u8")
    order = keys.argsort()
    return seen, keys[order], np.array([*seen.values()], "i8")[order]


@pytest.mark.parametrize("piece", [1, 50, 1 << 21])
def test_tokens_are_those_of_split(monkeypatch, piece):
    monkeypatch.setattr(m, "PIECE", piece)
    odd = [" a  b ", "\n", "\x1ca\x1db", "a\0 a", "x\x85y\xa0z", " \u2003 ", "a b\x0b\x0c\r\tb"]
    texts = [m.symbols(t) for t in [*TEXTS, *odd]] + [b"\xff \xfe\xc3 a", b""]
    learn = np.array([k % 3 != 1 for k in range(len(texts))])
    seen, keys, many = sums_of_tokens(texts, learn)
    got = m.plain(texts, keys, many, 4, len(seen), 100)
    c = [[seen[w] for w in t.split()] + [4] for t in texts]
    assert got.n_tokens.tolist() == [len(x) for x in c] and got.n_known.tolist() == [sum(n > 0 for n in x) for x in c]
    want = [sum(math.log10((n + 1) / (101 + len(seen))) for n in x) for x in c]
    assert got.base_score.to_numpy() == pytest.approx(want)
    asked, n = m.ask(texts, learn)[1]
    assert (asked[n > 0] == keys).all() and (n[n > 0] == many).all()
    assert len(asked) == len({w for t in texts for w in t.split()})
    none = m.plain(texts, keys[:0], many[:0], 0, 0, 0)
    assert not none.n_known.any() and not none.base_score.any()


def cpu(work):
    """CPU seconds of the fastest of some runs."""
    took = []
    for _ in range(4):
        start = time.process_time()
        work()
        took.append(time.process_time() - start)
    return min(took)


def test_tokens_cost_less_than_counting_them_one_by_one():
    pick = np.random.default_rng(4).zipf(1.3, (1_000, 400)) % 100_000
    texts = [" ".join(f"w{k}" for k in row).encode() for row in pick.tolist()]
    seen, keys, many = sums_of_tokens(texts, [True] * len(texts))

    def one_by_one():
        n = Counter()
        for t in texts:
            n.update(t.split())
        return [sum(map(n.__getitem__, t.split())) for t in texts]

    assert cpu(lambda: m.plain(texts, keys, many, len(texts), len(seen), 400_000)) < cpu(one_by_one)


def test_losses_are_worked_out_by_the_matrix():
    """Bits of paths of one length lie in rows: as good as sums bit by bit, and few array steps a factor."""
    texts = [m.symbols(t) for t in TEXTS]
    code = code_of(texts)
    counts, w = m.Counts(m.gather(texts, np.ones(len(texts), bool), code)), np.full((m.GATES, m.WAYS + 1), 0.3)
    joints = np.unique(np.concatenate([s.joint for s in m.segments(texts)]))
    size = code.size[(joints & m.LOW).astype("int64")]
    joints, size = joints[size.argsort(kind="stable")], np.sort(size)
    bit, x, gate = m.predictors(joints, counts, code)
    z = sum(x[i].astype("f8") * w[gate, i] for i in range(m.WAYS + 1)) * np.where(bit == 1, 1, -1)
    losses, first = m.Losses(joints, counts, code, w), size.cumsum() - size
    assert len(losses.right) == len(set(size))
    for k in (0, 16, 32):
        s = m.GRID[k]
        assert losses[k].real == pytest.approx(np.add.reduceat(np.logaddexp(0, -z * s), first), rel=1e-5, abs=1e-6)
        assert losses[k].imag == pytest.approx(np.add.reduceat(-z / (1 + np.exp(z * s)), first), rel=1e-5, abs=1e-6)


def plain_weights(texts, learn, code):
    """Weights fitted to the bits of all training texts, each left out of its own counts."""
    seen, found = Counter(), Counter()
    bits = [list(plain_bits(t, code)) for t, own in zip(texts, learn) if own]
    for _, bit, node, ways in (b for text in bits for b in text):
        for way, c in enumerate(ways):
            seen[way, c, node, bit] += 1
    for _, bit, node, ways in (b for text in bits for b in text):
        gate, x = 0, []
        for way, c in enumerate(ways):
            n = [seen[way, c, node, k] - (k == bit) for k in (0, 1)]
            gate = gate * 3 + (sum(n) > 0) + (sum(n) > 3)
            x.append(np.float32(math.log((n[1] + 0.4) / (n[0] + 0.4))))
        x.append(code.prior[node])
        found[gate, *(float(np.rint(v * m.STEPS)) / m.STEPS for v in x), bit] += 1
    w = np.full((m.GATES, m.WAYS + 1), 0.3)
    for gate in {f[0] for f in found}:
        rows = np.array([(*f[1:], n) for f, n in found.items() if f[0] == gate])
        x, bit, n = rows[:, :-2], rows[:, -2], rows[:, -1]
        for _ in range(2_000):  # slow and safe: the curve is bent no more than this
            slope = x.T @ (n * (1 / (1 + np.exp(-x @ w[gate])) - bit)) + w[gate] - 0.3
            p = 1 / (1 + np.exp(-x @ w[gate]))
            w[gate] -= 0.5 * np.linalg.solve((x.T * (n * (p * (1 - p) + 1e-3))) @ x + np.eye(m.WAYS + 1), slope)
    return w


def test_weights_are_fitted_to_all_training_texts(spark):
    """More texts than any sample was once; those that are rare tell most of what the weights are."""
    texts = [f"{k % 13} to {k % 7}" if k % 10 else f"the cat sat on mat {k}" for k in range(1_300)]
    rows = [(k, t, 1, "x", 2) for k, t in enumerate(texts)]
    learn = np.array([k % 7 != 2 for k in range(len(texts))])
    data = [m.symbols(t) for t in texts]
    code = code_of([d for d, own in zip(data, learn) if own])
    got = scored(spark, rows, shard_bytes=5_000).sort_values("doc_id")
    want = plain_model(data, learn, code, plain_weights(data, learn, code))
    assert got.score.to_numpy() == pytest.approx(want, rel=1e-3)


def test_histogram_has_every_training_bit():
    texts = [m.symbols(t) for t in TEXTS]
    learn, code = np.array([k % 3 != 1 for k in range(len(texts))]), code_of(texts)
    pairs, _, joints = m.ask(texts, learn)
    _, many = m.cells(*joints, m.Counts(m.nodes(*pairs, code)), code)
    assert many.sum() == sum(len(list(plain_bits(t, code))) for t, own in zip(texts, learn) if own)


def test_pairs_of_a_context_stay_together_and_answers_count_once():
    keys = np.unique(np.random.default_rng(3).integers(0, 2**12, 5_000).astype("u8") << np.uint64(52) | np.arange(5_000, dtype="u8") % 257)
    cuts = m.ranges(keys, 7)
    ends = keys[cuts[1:-1] - 1] >> np.uint64(9)
    assert cuts[0] == 0 and cuts[-1] == len(keys) and (ends != keys[cuts[1:-1]] >> np.uint64(9)).all()
    rows = [m.packed(keys[:3_000], np.arange(3_000)), m.packed(keys[1_000:], np.arange(1_000, len(keys)))]
    got = m.answers(m.pd.DataFrame(rows, columns=["keys", "many"]))
    assert (got[0] == keys).all() and (got[1] == np.arange(len(keys))).all()


@pytest.mark.parametrize("size", [0, 1, 5_000])
def test_packed_arrays_come_back_and_are_smaller_than_deflated(size):
    keys = np.unique(np.random.default_rng(5).integers(0, 2**63, size).astype("u8"))
    many = np.random.default_rng(6).geometric(0.5, size).astype("i8")
    rows = m.pd.DataFrame([m.packed(keys, many)], columns=["keys", "many"])
    back = m.unpacked(next(rows.itertuples()))
    assert (back[0] == keys).all() and (back[1] == many).all() and back[0].dtype == "u8" and back[1].dtype == "i8"
    deflated = zlib.compress(many.view("u1").reshape(-1, 8).T.tobytes(), 1)
    assert size < 100 or len(rows["many"][0]) < len(deflated)


def test_memory_of_a_shard():
    """Counting and scoring hold a few numbers per byte of text, not a few per bit and context."""
    words = [bytes(w) for w in np.random.default_rng(1).integers(97, 123, (4_000, 7)).astype("u1")]
    pick = np.random.default_rng(2).integers(0, len(words), (800, 400))
    texts = [b" ".join(words[k] for k in row) for row in pick]
    code, learn = code_of(texts), np.ones(len(texts), bool)
    w = np.full((m.GATES, m.WAYS + 1), 0.3)
    tracemalloc.start()
    try:
        m.score(texts, m.Counts(m.gather(texts, learn, code)), code, w)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 35 * sum(map(len, texts))


def test_no_rows_and_no_training_rows(spark):
    assert scored(spark, []).empty
    got = scored(spark, [(2, "only held out", 1, "x", 2)])
    assert got.train_tokens[0] == 0 and got.n_known[0] == 0 and got.base_score[0] == 0 and got.score[0] < 0


def test_query_learns_from_the_corpus(spark, sf_dir):
    got = queries.op12_context_mixing(spark, sf_dir).toPandas()
    assert len(got) == got.doc_id.nunique() and got.held_out.any()
    long = got[got.held_out & (got.n_tokens > 20)]
    # an order-0 code needs about 4.4 bits a byte
    assert long.bits_per_byte.mean() < 3.2
