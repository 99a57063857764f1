import numpy as np
import pyarrow as pa

from roadlens.llm.prefix import PAIR, further_parity, lists, pack, parity

SIMILAR = (4, 5)


def sets(rng, sizes, shared):
    """Sorted sets of random tokens that all hold ``shared``; of each also a
    copy with one other token, of every second one a copy with a third new."""
    out = []
    for k, n in enumerate(sizes):
        x = np.unique(np.append(rng.integers(1 << 20, 1 << 63, n, dtype=np.uint64), np.uint64(shared)))
        out.append(x)
        for new in (1, n // 3)[: 1 + k % 2]:
            out.append(np.unique(np.append(x[: len(x) - new], rng.integers(1 << 20, 1 << 63, new, dtype=np.uint64))))
    return out


def cut(some):
    n = np.array([len(x) for x in some])
    return np.concatenate(some), np.cumsum(n) - n, n


def test_only_similar_long_sets_of_a_list_are_pairs(spark):
    some = sets(np.random.default_rng(5), [12, 60, 95, 101, 130, 150, 170, 199, 205, 240, 260, 380, 420, 500, 900, 2000] * 2, shared=7)
    tokens, start, n = cut(some)
    k1 = np.arange(len(some), dtype=np.int64)
    token, own = np.full(len(some), 7, np.uint64), np.arange(len(some))
    blobs = [
        pack(token[s], np.zeros(len(own[s]), np.int32), own[s], n[s], k1, n, 1, parity(tokens, start), further_parity(tokens, start, n))
        for s in (slice(0, 30), slice(30, None))
    ]
    packed = spark.createDataFrame(pa.Table.from_batches(blobs))
    got = lists(packed, SIMILAR, 256).collect()
    assert {r.salt for r in got} == {PAIR}
    of = [set(x.tolist()) for x in some]
    want = {(i, j) for i in range(len(of)) for j in range(i + 1, len(of)) if 5 * len(of[i] & of[j]) >= 4 * len(of[i] | of[j])}
    assert {(r.k1, r.lead) for r in got} == want and len(want) >= 32


def test_words_of_a_wide_map_add_up_to_the_narrow_one():
    tokens, start, n = cut(sets(np.random.default_rng(6), [3, 100, 101, 200, 201, 399, 401, 7000], shared=9))
    more = further_parity(tokens, start, n)
    words = [0 if x <= 100 else (1 << min(6, int(np.ceil(np.log2(x / 100))))) - 1 for x in n]
    assert len(more) == sum(words)
    assert len(further_parity(tokens[:0], start[:0], n[:0])) == 0
    bits = parity(tokens, start)
    at = 0
    for i, w in enumerate(words):
        whole = [bits[i] ^ np.bitwise_xor.reduce(more[at : at + w]), *more[at : at + w]] if w else [bits[i]]
        odd = sum(int(np.bitwise_count(x)) for x in whole)
        assert odd <= n[i] and odd % 2 == n[i] % 2
        at += w
