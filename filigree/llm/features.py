"""Hashed n-gram indicators of texts, for the classifiers: which n-grams a text has, never how often."""

from __future__ import annotations

import numpy as np

from filigree.llm.common import Words, mix

#: Bytes that stand between words, and bytes of words' letters (fixed values).
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
NOT_LETTER = np.array([not (chr(b).isalpha() or b >= 128) or b < 65 for b in range(256)])


def _grams(data: np.ndarray, n: int, salt: int) -> np.ndarray:
    """A hash of each n consecutive bytes."""
    with np.errstate(over="ignore"):
        h = np.full(max(len(data) - n + 1, 0), salt, np.uint64)
        for i in range(n):
            h = h * np.uint64(0x100000001B3) + data[i : i + len(h)]
        return mix(h)


_stamps: dict[int, np.ndarray] = {}


def _distinct(hashes: list[np.ndarray], bits: int) -> np.ndarray:
    """Each of the hashes' upper bits once, in no order: of equal values the last to leave its position in the table stays."""
    h = (np.concatenate(hashes) >> np.uint64(64 - bits)).astype(np.int32) if hashes else np.zeros(0, np.int32)
    stamp = _stamps.setdefault(bits, np.zeros(1 << bits, np.int32))
    at = np.arange(len(h), dtype=np.int32)
    stamp[h] = at
    return h[stamp[h] == at]


def shape_ngrams(texts: list[str | None], bits: int = 18) -> list[np.ndarray]:
    """Features of form: byte 1- to 4-grams, and 1- to 3-grams of how a word relates to the words before it (equal to the last, seen before, new)."""
    out = []
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    words = Words(raw, SPACE)
    first = 0
    for data, count in zip(raw, words.count.tolist()):
        h = words.hash[first : first + count]
        first += count
        _, at = np.unique(h, return_index=True)
        kind = np.ones(count, np.uint8)
        kind[at] = 0
        if count > 1:
            kind[1:][h[1:] == h[:-1]] = 2
        one = np.frombuffer(data, np.uint8)
        out.append(_distinct([_grams(one, n, n) for n in (1, 2, 3, 4)] + [_grams(kind, n, 10 + n) for n in (1, 2, 3)], bits))
    return out


class WordGrams:
    """The distinct words of each of some texts, and hashed n-grams of each distinct word.

    text[i] has word[i], each pair once; gram[k] is an n-gram of word owner[k]: the whole lower-cased word of letters, and
    the byte 4- and 5-grams of the word between two spaces. A word is hashed once however often the texts have it.
    """

    def __init__(self, texts: list[str | None], bits: int = 20):
        words = Words([(t or "").lower().encode("utf-8", "surrogatepass") for t in texts], NOT_LETTER)
        hashes, first, number = np.unique(words.hash, return_index=True, return_inverse=True)
        self.n_texts, self.n_words = len(texts), len(hashes)
        self.text, self.word = np.divmod(np.unique(words.text * max(self.n_words, 1) + number), max(self.n_words, 1))
        # The distinct words, a space before each and one after the last.
        start, size = words.start[first], words.end[first] - words.start[first]
        begin = np.cumsum(size + 1) - size
        flat = np.full(int((size + 1).sum()) + 1, 32, np.uint8)
        at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        flat[np.repeat(begin, size) + at] = words.data[np.repeat(start, size) + at]
        edge, of = flat == 32, np.repeat(np.arange(self.n_words), size + 1)
        grams, owners = [mix(hashes + np.uint64(77))], [np.arange(self.n_words)]
        for n in (4, 5):
            h = _grams(flat, n, n)
            inner = np.zeros(len(h), bool)
            for i in range(1, n - 1):
                inner |= edge[i : i + len(h)]
            whole = np.flatnonzero(~inner)
            grams.append(h[whole])
            owners.append(of[whole])
        self.owner = np.concatenate(owners)
        self.gram = (np.concatenate(grams) >> np.uint64(64 - bits)).astype(np.int64)

    def sums(self, weights: np.ndarray) -> np.ndarray:
        """For each text the weights of its words' n-grams, added up."""
        each = np.bincount(self.owner, weights[self.gram], self.n_words)
        return np.bincount(self.text, each[self.word], self.n_texts)

    def counts(self, texts: np.ndarray, bits: int) -> np.ndarray:
        """How often each n-gram stands in the distinct words of the chosen texts."""
        times = np.bincount(self.word[texts[self.text]], minlength=self.n_words)
        return np.bincount(self.gram, times[self.owner], 1 << bits).astype(np.int64)

    def of_texts(self) -> list[np.ndarray]:
        """The n-grams of each text's distinct words; one that stands in several words comes several times."""
        order = np.argsort(self.owner, kind="stable")
        gram = self.gram[order]
        size = np.bincount(self.owner, minlength=self.n_words)
        begin = np.cumsum(size) - size
        times = size[self.word]
        flat = gram[np.repeat(begin[self.word] - np.cumsum(times) + times, times) + np.arange(int(times.sum()))]
        ends = np.cumsum(np.bincount(self.text, times, self.n_texts).astype(np.int64))
        return np.split(flat, ends[:-1]) if self.n_texts else []
