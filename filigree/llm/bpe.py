"""Byte-level BPE encoding and decoding with a contiguous rank array per word.

A text is cut into words by the vocabulary's pattern. A word holds its parts' ids side by side and, beside
them, the rank of each adjacent pair. The smallest rank is looked for, the boundary between its two parts is
deleted, and the two neighbouring ranks are looked up again, until no adjacent pair can be merged. Words
longer than LONG bytes, which a scan would make quadratic, keep the same ranks in a heap.

Each task remembers the words of up to LONG letters that it has met (up to CACHE of them; then it starts over), since
natural text repeats most of its words. The vocabulary is read once by the driver and broadcast: its size is that of the
vocabulary file, whatever the corpus.

Cases: a null text is encoded as the empty text: no ids, and it decodes to the empty text. Added tokens of the
vocabulary that occur in a text become their own ids, as the tokenizers library does. Extra columns are kept
unless an output has their name. Duplicate rows are encoded row by row.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: The split pattern of byte-level vocabularies (fixed values).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
LONG, CACHE, NONE = 96, 400_000, 1 << 62
OUTPUTS = {"ids": pa.list_(pa.int32()), "decoded": pa.string(), "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte, to the byte: printable Latin-1 stands for itself, the rest follow from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str) -> dict:
    """What encoding needs of a tokenizer file: ids of bytes, pair -> (rank, id), id -> bytes, added tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters, vocab = byte_letters(), spec["model"]["vocab"]
    pieces = {i: bytes(letters[c] for c in s) for s, i in vocab.items()}
    pairs, made = {}, []
    for rank, pair in enumerate(spec["model"]["merges"]):
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        pairs[(vocab[a] << 20) | vocab[b]] = rank
        made.append(vocab[a + b])
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    pieces |= {i: s.encode() for s, i in added.items()}
    return {"bytes": [vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])], "pairs": pairs, "made": made, "pieces": pieces, "added": added}


class Encoder:
    """Encodes and decodes texts with one vocabulary."""

    def __init__(self, vocabulary: dict):
        self.of_byte, self.pairs, self.made, self.pieces, self.added = (vocabulary[k] for k in ("bytes", "pairs", "made", "pieces", "added"))
        self.words = regex.compile(PATTERN).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")").split if self.added else None

    def word_ids(self, word: bytes) -> list[int]:
        """The ids of one word."""
        if len(word) > LONG:
            return self._long_word_ids(word)
        of_byte, get, made = self.of_byte, self.pairs.get, self.made
        ids = [of_byte[b] for b in word]
        ranks = [get((a << 20) | b, NONE) for a, b in zip(ids, ids[1:])]
        while ranks and (least := min(ranks)) != NONE:
            i = ranks.index(least)
            ids[i] = made[least]
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get((ids[i] << 20) | ids[i + 1], NONE)
            if i:
                ranks[i - 1] = get((ids[i - 1] << 20) | ids[i], NONE)
        return ids

    def _long_word_ids(self, word: bytes) -> list[int]:
        ids: list[int | None] = [self.of_byte[b] for b in word]
        n, get = len(ids), self.pairs.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := get((ids[i] << 20) | ids[i + 1], NONE)) != NONE]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = self.made[rank], None, after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := get((ids[x] << 20) | ids[y], NONE)) != NONE:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return [i for i in ids if i is not None]

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for k, part in enumerate(self.cut(text) if self.cut else [text]):
            if k % 2:
                out.append(self.added[part])
            else:
                for word in self.words(part):
                    out += self.word_ids(word.encode())
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.pieces.__getitem__, ids)).decode("utf-8", "replace")


class _Seen(dict):
    """word -> (its ids as decimal text, the bytes that those ids decode to)."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, word: str) -> tuple[str, bytes]:
        ids = self.encoder.word_ids(word.encode())
        found = ",".join(map(str, ids)), b"".join(map(self.encoder.pieces.__getitem__, ids))
        if len(word) <= LONG:
            self[word] = found
        return found


def encode_documents(docs: DataFrame, vocabulary_path: str, outputs: tuple[str, ...] = ("ids", "decoded"), text: str = "text") -> DataFrame:
    """docs with the outputs asked for: ids, decoded, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    kept = [c for c in docs.columns if c not in outputs]
    drop_text = text not in kept
    fields = {"ids": T.ArrayType(T.IntegerType()), "decoded": T.StringType(), "n_tokens": T.LongType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()}
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(c, fields[c]) for c in outputs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        seen = _Seen(encoder)
        for batch in batches:
            made: dict[str, list] = {c: [] for c in outputs}
            for value in batch.column(text).to_pylist():
                if len(seen) > CACHE:
                    seen.clear()
                parts, raw = [], []
                for k, part in enumerate(encoder.cut(value or "") if encoder.cut else [value or ""]):
                    found = [(str(encoder.added[part]), encoder.pieces[encoder.added[part]])] if k % 2 else list(map(seen.__getitem__, encoder.words(part)))
                    parts += [x[0] for x in found]
                    raw += [x[1] for x in found]
                joined = ",".join(parts)
                decoded = b"".join(raw).decode("utf-8", "replace")
                for c in outputs:
                    if c == "n_tokens":
                        made[c].append(joined.count(",") + 1 if joined else 0)
                    elif c == "ids":
                        made[c].append(list(map(int, joined.split(","))) if joined else [])
                    elif c == "decoded":
                        made[c].append(decoded)
                    else:
                        made[c].append(hashlib.sha256((joined if c == "ids_sha256" else decoded).encode()).hexdigest())
            arrays = [batch.column(c) for c in kept] + [pa.array(made[c], OUTPUTS[c]) for c in outputs]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *outputs])

    source = docs if not drop_text else docs.select(*kept, text)
    return source.mapInArrow(run, schema)
