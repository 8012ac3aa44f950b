import math

import numpy as np
import pytest

from corpuslake.llm import golay, lattice


@pytest.fixture(scope="module")
def vocabulary():
    pieces, prior = lattice.read_vocabulary("/opt/tokenizers/piece_bpe_32k.model")
    return pieces, prior, lattice.Lattice(pieces)


def whole(word, share):
    """Log of the sum over all segmentations, without a cut, scaled as it goes."""
    word, longest = b" " + word, max(map(len, share))
    sums, log = [1.0], 0.0
    for j in range(1, len(word) + 1):
        sums.append(sum(sums[i] * share.get(word[i:j], 0.0) for i in range(max(0, j - longest), j)))
        if sums[-1] < 1e-100:
            log += math.log(1e-100)
            sums = [x * 1e100 if k + longest >= len(sums) else 0.0 for k, x in enumerate(sums)]
    return math.log(sums[-1]) + log


WORDS = [
    b"the", b"internationalisation", b"", b"q" * 60, "été".encode(), "слово".encode(), bytes([255, 0, 7]), b"ab" * 70,
    "словарьпереводчика".encode() * 9, "我们今天去学校学习中文".encode() * 8, b"https://example.com/a/very/long/path?with=many&parts=of" * 5, b"x" * 95, b"x" * 96,
]


@pytest.mark.parametrize("block", [4096, 40])
def test_marginals_sum_all_segmentations(vocabulary, monkeypatch, block):
    """Words of any length: 300 bytes of Cyrillic, text without blanks, blocks much shorter than a word."""
    pieces, prior, lat = vocabulary
    monkeypatch.setattr(lattice, "BLOCK", max(block, lat.longest + 1))
    share = dict(zip(pieces, prior, strict=True))
    got = lat.log_marginals(WORDS, np.log(prior)[:, None])[:, 0]
    assert got == pytest.approx([whole(w, share) for w in WORDS], rel=1e-9)
    two = lat.log_marginals(WORDS, np.stack([np.log(prior), np.log(prior) - 1], axis=1))
    assert two[:, 0] == pytest.approx(got) and (two[:, 1] < got).all()


@pytest.mark.parametrize("block", [4096, 40])
def test_expected_uses_are_the_gradient(vocabulary, monkeypatch, block):
    pieces, prior, lat = vocabulary
    monkeypatch.setattr(lattice, "BLOCK", max(block, lat.longest + 1))
    logp, weights = np.log(prior), np.array([2.0, 1.0, 0, 0, 3.0, 0, 0, 0, 1.0, 2.0, 1.5, 0, 1.0])
    counts = lat.expected(WORDS, weights, logp)
    for piece in (b"the", b" the", b"t", b"ation", b" ", "ов".encode(), b"com", b"x", "学".encode()):
        k = pieces.index(piece)
        shifted = logp.copy()
        shifted[k] += 1e-5
        change = (lat.log_marginals(WORDS, shifted[:, None]) - lat.log_marginals(WORDS, logp[:, None]))[:, 0] @ weights
        assert counts[k] == pytest.approx(change / 1e-5, rel=1e-3, abs=1e-6)


def test_words_of_either_way_agree(vocabulary, monkeypatch):
    _, prior, lat = vocabulary
    words = [b"antidisestablishmentarianism"[:n] for n in range(1, 28)] + ["naïveté".encode()]
    logp, weights = np.log(prior), np.arange(1.0, 29)
    many = lat.log_marginals(words, logp[:, None]), lat.expected(words, weights, logp)
    monkeypatch.setattr(lattice, "LONGEST", 0)
    single = lat.log_marginals(words, logp[:, None]), lat.expected(words, weights, logp)
    assert single[0] == pytest.approx(many[0]) and single[1] == pytest.approx(many[1])


def test_golay_words_two_bits_apart_share_an_index():
    rng = np.random.default_rng(5)
    words = rng.integers(0, 1 << 21, 3000)
    one, two = rng.integers(0, 21, (2, 3000))
    near = words ^ (1 << one) ^ np.where(one == two, 0, 1 << two)
    for a, b in zip(golay.nearby(words, 21), golay.nearby(near, 21), strict=True):
        assert set(a[a >= 0]) & set(b[b >= 0])


def test_golay_corrects_three_bits():
    rng = np.random.default_rng(6)
    for index in rng.integers(0, 1 << 12, 200):
        code = int(index) << 11
        code |= golay.remainder(code)
        for b in rng.choice(23, 3, replace=False):
            code ^= 1 << int(b)
        assert golay.decode(np.array([code]))[0] == index
