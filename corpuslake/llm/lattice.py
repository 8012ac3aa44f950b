"""All segmentations of words into the pieces of a public vocabulary, many words at a time.

A word is a blank followed by its UTF-8 bytes. Pieces that start a word start with the blank, and every single byte is
a piece, so that any word can be segmented and no piece reaches from one word into the next. The probability
of a word is the sum over its segmentations of the product of their pieces' probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

#: Words up to this many bytes are summed many at a time; longer ones one by one, block by block.
LONGEST = 96
BLOCK = 4096
_BASE = 0x9E3779B97F4A7C15
_ROWS = 1 << 15
_BITMAP = 22


def read_vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces of a sentencepiece file and their prior probabilities from the file's own scores.

    Scores of such files are either log probabilities or the negative rank in which pieces were merged; ranks are
    read by Zipf's law. Pieces with inner blanks cannot occur in a word. Bytes get a small share.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    weight: dict[bytes, float] = {bytes([i]): 1e-6 for i in range(256)}
    for i in range(model.get_piece_size()):
        if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            continue
        piece, score = model.id_to_piece(i).replace("▁", " ").encode(), model.get_score(i)
        if b" " in piece[1:]:
            continue
        weight[piece] = np.exp(score) if -30 < score < 0 and score != int(score) else 1.0 / (10.0 - score)
    pieces = sorted(weight)
    prior = np.array([weight[p] for p in pieces])
    return pieces, prior / prior.sum()


class Lattice:
    def __init__(self, pieces: Sequence[bytes]) -> None:
        self.pieces = len(pieces)
        self.longest = max(map(len, pieces))
        hashes = np.zeros(len(pieces), np.uint64)
        for i, p in enumerate(pieces):
            h = 0
            for b in p:
                h = (h * _BASE + b + 1) & 0xFFFFFFFFFFFFFFFF
            hashes[i] = h
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.seen = np.zeros(1 << _BITMAP, bool)
        self.seen[hashes >> np.uint64(64 - _BITMAP)] = True
        self.lengths = sorted({len(p) for p in pieces})

    def _edges(self, words: list[bytes], size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(end, length, rows, pieces) by rising end: where a piece ends in which words."""
        n = len(words)
        chars = np.frombuffer(b"".join(w.ljust(size, b"\0") for w in words), np.uint8).reshape(n, size).T
        lens = np.fromiter(map(len, words), np.int64, n)
        base, power = np.uint64(_BASE), {0: np.uint64(1)}
        with np.errstate(over="ignore"):
            for k in range(1, self.longest + 1):
                power[k] = power[k - 1] * base
            prefix = [np.zeros(n, np.uint64)]
            for j in range(1, size + 1):
                prefix.append(prefix[-1] * base + chars[j - 1].astype(np.uint64) + np.uint64(1))
                inside = lens >= j
                for k in self.lengths:
                    if k > j:
                        break
                    h = prefix[j] - prefix[j - k] * power[k]
                    rows = np.nonzero(self.seen[h >> np.uint64(64 - _BITMAP)] & inside)[0]
                    if len(rows):
                        at = np.searchsorted(self.hashes, h[rows])
                        at[at == self.pieces] = 0
                        same = self.hashes[at] == h[rows]
                        if same.any():
                            yield j, k, rows[same], self.order[at[same]]

    def _groups(self, words: Sequence[bytes]) -> Iterator[tuple[np.ndarray, list[bytes], int]]:
        """Words of up to LONGEST bytes (with blanks) of about the same length: their numbers, themselves, the longest length."""
        spans = [(i, b" " + w) for i, w in enumerate(words) if len(w) < LONGEST]
        spans.sort(key=lambda s: len(s[1]))
        at = 0
        while at < len(spans):
            size = len(spans[at][1])
            room = max(1, _ROWS if size <= 24 else _ROWS // 4)
            stop = at
            while stop < len(spans) and stop - at < room and len(spans[stop][1]) <= size + 1:
                stop += 1
            part = spans[at:stop]
            yield np.array([s[0] for s in part]), [s[1] for s in part], len(part[-1][1])
            at = stop

    def _block_edges(self, word: bytes, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(end, length, piece) by rising end of all pieces that end after ``low``, up to ``high``."""
        begin = max(0, low - self.longest)
        chars = np.frombuffer(word[begin:high], np.uint8).astype(np.uint64) + np.uint64(1)
        n = len(chars)
        with np.errstate(over="ignore"):
            power = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, _BASE, np.uint64))])
            inverse = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, pow(_BASE, -1, 1 << 64), np.uint64))])
            # The recurrence of the hashes as a sum, for all places at once.
            prefix = np.concatenate([[np.uint64(0)], np.cumsum(chars * inverse[1:], dtype=np.uint64)]) * power
            ends, lengths, pieces = [], [], []
            for k in self.lengths:
                if k > n:
                    break
                end = np.arange(max(low - begin + 1, k), n + 1)
                h = prefix[end] - prefix[end - k] * power[k]
                maybe = self.seen[h >> np.uint64(64 - _BITMAP)]
                end, h = end[maybe], h[maybe]
                at = np.searchsorted(self.hashes, h)
                at[at == self.pieces] = 0
                same = self.hashes[at] == h
                ends.append(end[same] + begin)
                lengths.append(np.full(int(same.sum()), k))
                pieces.append(self.order[at[same]])
        ends, lengths, pieces = (np.concatenate(x) for x in (ends, lengths, pieces))
        order = np.argsort(ends, kind="stable")
        return ends[order], lengths[order], pieces[order]

    def _forward(self, word: bytes, low: int, high: int, before: np.ndarray, logp: np.ndarray):
        """Sums over the segmentations that reach each place of a block, from those of the ``longest`` places before it and
        its first; with them the block's pieces, and where those that end at each place are."""
        ends, lengths, pieces = self._block_edges(word, low, high)
        alpha = np.full((self.longest + high - low + 1, logp.shape[1]), -np.inf)
        alpha[: self.longest + 1] = before
        cut = np.searchsorted(ends, np.arange(low + 1, high + 2))
        start = ends - lengths - low + self.longest
        for j in range(high - low):
            own = slice(cut[j], cut[j + 1])
            if cut[j + 1] > cut[j]:
                alpha[self.longest + j + 1] = np.logaddexp.reduce(alpha[start[own]] + logp[pieces[own]], axis=0)
        return alpha, (ends - low + self.longest, start, pieces, cut)

    def _begin(self, models: int) -> np.ndarray:
        before = np.full((self.longest + 1, models), -np.inf)
        before[-1] = 0
        return before

    def _long_marginal(self, word: bytes, logp: np.ndarray) -> np.ndarray:
        before = self._begin(logp.shape[1])
        for low in range(0, len(word), BLOCK):
            alpha, _ = self._forward(word, low, min(len(word), low + BLOCK), before, logp)
            before = alpha[-(self.longest + 1) :]
        return before[-1]

    def _long_expected(self, word: bytes, logp: np.ndarray) -> np.ndarray:
        """As ``expected`` for one word: forward sums are kept at the blocks' borders alone, and worked out again block by
        block on the way back."""
        columns, counts = logp[:, None], np.zeros(self.pieces)
        lows = range(0, len(word), BLOCK)
        borders = [self._begin(1)]
        for low in lows:
            alpha, _ = self._forward(word, low, min(len(word), low + BLOCK), borders[-1], columns)
            borders.append(alpha[-(self.longest + 1) :])
        total, behind = borders[-1][-1, 0], None
        for k in reversed(range(len(lows))):
            low, high = lows[k], min(len(word), lows[k] + BLOCK)
            alpha, (end, start, pieces, cut) = self._forward(word, low, high, borders[k], columns)
            beta = np.full(len(alpha), -np.inf)
            if behind is None:
                beta[-1] = 0
            else:
                beta[-(self.longest + 1) :] = behind
            for j in reversed(range(high - low)):
                own = slice(cut[j], cut[j + 1])
                at = start[own]
                beta[at] = np.logaddexp(beta[at], beta[self.longest + j + 1] + logp[pieces[own]])
            used = np.exp(alpha[start, 0] + logp[pieces] + beta[end] - total)
            counts += np.bincount(pieces, used, self.pieces)
            behind = beta[: self.longest + 1]
        return counts

    def log_marginals(self, words: Sequence[bytes], logp: np.ndarray) -> np.ndarray:
        """Natural log of the probability of each word under each column of ``logp`` (pieces x models)."""
        out = np.zeros((len(words), logp.shape[1]))
        for index, part, size in self._groups(words):
            alpha = np.full((size + 1, len(part), logp.shape[1]), -np.inf)
            alpha[0] = 0
            for j, k, rows, ids in self._edges(part, size):
                alpha[j, rows] = np.logaddexp(alpha[j, rows], alpha[j - k, rows] + logp[ids])
            ends = np.fromiter(map(len, part), np.int64, len(part))
            out[index] = alpha[ends, np.arange(len(part))]
        for i, w in enumerate(words):
            if len(w) >= LONGEST:
                out[i] = self._long_marginal(b" " + w, logp)
        return out

    def expected(self, words: Sequence[bytes], weights: np.ndarray, logp: np.ndarray) -> np.ndarray:
        """Expected number of times each piece is used in the words, each counted ``weights`` times."""
        counts = np.zeros(self.pieces)
        for index, part, size in self._groups(words):
            n = len(part)
            edges = list(self._edges(part, size))
            alpha = np.full((size + 1, n), -np.inf)
            beta = np.full((size + 1, n), -np.inf)
            alpha[0] = 0
            for j, k, rows, ids in edges:
                alpha[j, rows] = np.logaddexp(alpha[j, rows], alpha[j - k, rows] + logp[ids])
            ends = np.fromiter(map(len, part), np.int64, n)
            beta[ends, np.arange(n)] = 0
            total = alpha[ends, np.arange(n)]
            for j, k, rows, ids in reversed(edges):
                beta[j - k, rows] = np.logaddexp(beta[j - k, rows], beta[j, rows] + logp[ids])
            for j, k, rows, ids in edges:
                used = np.exp(alpha[j - k, rows] + logp[ids] + beta[j, rows] - total[rows]) * weights[index[rows]]
                counts += np.bincount(ids, used, self.pieces)
        for i, w in enumerate(words):
            if len(w) >= LONGEST and weights[i]:
                counts += weights[i] * self._long_expected(b" " + w, logp)
        return counts
