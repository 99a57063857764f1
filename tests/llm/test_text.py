import random

import numpy as np

from roadlens.llm import text as T
from roadlens.llm.prefix import Frequent

WORDS = [b"a", b"A", b"a\0", b"\0", b"x" * 8, b"X" * 8, b"x" * 9, b"y" * 16, b"y" * 17, b"z" * 64, b"z" * 65, b"Z" * 65, "日本語é".encode(), b"q" * 3000, b"1234567"]


def test_words_by_eight_bytes_are_the_words():
    rng = random.Random(1)
    name = {}
    for _ in range(200):
        texts = [
            b"".join(rng.choice(WORDS) + rng.choice([b"", b" ", b"\n", b"\t\x0b", b"\r\n"]) for _ in range(rng.randint(0, 6)))
            for _ in range(rng.randint(0, 9))
        ]
        raw, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
        hashes, starts = T.word_hashes(raw, offsets)
        assert starts.tolist() == T.space_hashes(raw, offsets)[1].tolist()
        for h, w in zip(hashes.tolist(), [w.lower() for t in texts for w in t.split()], strict=True):
            assert name.setdefault(w, h) == h
    assert len(set(name.values())) == len(name) > 50


def test_counts_of_tokens_that_share_places():
    rng = np.random.default_rng(1)
    near = [np.arange(40), np.arange((1 << 32) - 40, 1 << 32), np.arange(1 << 20, (1 << 20) + 50)]
    upper = np.unique(np.concatenate([rng.integers(0, 1 << 32, 3000), *near]))
    count = rng.integers(1, 1 << 31, len(upper))
    want = dict(zip(upper.tolist(), count.tolist(), strict=True))
    ask = np.concatenate([upper, upper + 1, rng.integers(0, 1 << 32, 5000)]) % (1 << 32)
    for k in (len(upper), 1, 0):
        some = Frequent(upper[len(upper) - k :], count[len(upper) - k :])
        held = set(some.upper.tolist())
        assert some.counts(ask.astype(np.uint64) << np.uint64(32)).tolist() == [want[x] if x in held else 0 for x in ask.tolist()]
