"""Terms counted by document, many texts side by side, in numpy."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

from filigree.llm.common import Words

#: Bytes that are hashed at a time; longer texts are cut between words.
PIECE = 4 << 20


def gaps(pattern: bytes) -> np.ndarray:
    """The bytes that a pattern of one byte matches, as a table of 256 booleans."""
    one = re.compile(pattern, re.S)
    return np.array([one.fullmatch(bytes([b])) is not None for b in range(256)])


@dataclass
class Postings:
    """Terms by ascending hash: bytes end to end, and where each ends; and (code, doc, tf) by code and doc, code being a term's place."""

    hash: np.ndarray
    data: np.ndarray
    ends: np.ndarray
    code: np.ndarray
    doc: np.ndarray
    tf: np.ndarray

    def words(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets) of some terms, in the given order."""
        start = np.concatenate([np.zeros(1, np.int64), self.ends])[keep]
        return gathered(self.data, start, self.ends[keep])


def gathered(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slices of data set end to end, and their offsets."""
    offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(end - start)])
    return data[np.repeat(start - offsets[:-1], end - start) + np.arange(offsets[-1])], offsets


def _counted(texts: list[bytes], docs: np.ndarray, gap: np.ndarray) -> Postings:
    words = Words(texts, gap)
    order = np.argsort(words.hash, kind="stable")  # words stand by text already
    h, d = words.hash[order], docs[words.text[order]]
    new = np.diff(h, prepend=~h[:1]) != 0
    at = np.flatnonzero(new | (np.diff(d, prepend=-1) != 0))
    first = order[new]
    data, offsets = gathered(words.data, words.start[first], words.end[first])
    return Postings(h[new], data, offsets[1:], (np.cumsum(new) - 1)[at], d[at], np.diff(at, append=len(h)))


def merged(parts: list[Postings]) -> Postings:
    """Postings of all parts; counts of a term and document that stand in several parts are added."""
    if len(parts) == 1:
        return parts[0]
    hashes, place, back = np.unique(np.concatenate([p.hash for p in parts]), return_index=True, return_inverse=True)
    shift = np.cumsum([0, *(len(p.data) for p in parts)])
    ends = np.concatenate([p.ends + s for p, s in zip(parts, shift)])
    starts = np.concatenate([np.concatenate([np.zeros(1, np.int64), p.ends])[:-1] + s for p, s in zip(parts, shift)])
    data, offsets = gathered(np.concatenate([p.data for p in parts]), starts[place], ends[place])
    terms = np.cumsum([0, *(len(p.hash) for p in parts)])
    code = np.concatenate([back[p.code + t] for p, t in zip(parts, terms)])
    doc, tf = np.concatenate([p.doc for p in parts]), np.concatenate([p.tf for p in parts])
    order = np.lexsort((doc, code))
    code, doc = code[order], doc[order]
    at = np.flatnonzero((np.diff(code, prepend=-1) != 0) | (np.diff(doc, prepend=-1) != 0))
    return Postings(hashes, data, offsets[1:], code[at], doc[at], np.add.reduceat(tf[order], at) if len(at) else tf)


def counted(texts: list[bytes], gap: np.ndarray, first_doc: int = 0, between: Callable[[bytes, int], int] | None = None) -> Postings:
    """Postings of the terms of some UTF-8 texts, A-Z in lower case; texts count from first_doc."""
    between = between or _between(gap)
    parts: list[Postings] = []
    piece: list[bytes] = []
    docs: list[int] = []
    held = 0
    for i, text in enumerate(texts):
        start = 0
        while start < len(text) or start == 0:
            end = len(text) if len(text) - start <= PIECE else between(text, start + PIECE)
            if held and held + end - start > PIECE:
                parts.append(_counted(piece, np.array(docs), gap))
                piece, docs, held = [], [], 0
            piece.append(text[start:end].lower())
            docs.append(first_doc + i)
            held += end - start
            start = end or 1
    parts.append(_counted(piece, np.array(docs, np.int64), gap))
    return merged(parts)


def _between(gap: np.ndarray) -> Callable[[bytes, int], int]:
    """The first place from at on that stands between words; the text's end where there is none."""
    one = re.compile(b"[" + b"".join(re.escape(bytes([b])) for b in np.flatnonzero(gap)) + b"]")

    def place(text: bytes, at: int) -> int:
        found = one.search(text, at)
        return found.start() if found else len(text)

    return place
