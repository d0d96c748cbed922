"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over labelled text. A text is parsed whole against each automaton into
phrases, each the longest match from where the last ended, across words; an unknown letter is a phrase of its own.
Phrases times the logarithm of the automaton's text length, the bits that a phrase costs to point at, are the
normalised phrases: the language that needs the fewest wins.

Texts are lower-cased; words are letters (Unicode category L) with the marks that follow them, one space stands
between words and at both ends. Parsing is a walk through the automaton, whose state says which phrase is under way.
A task remembers where a word leads from a state, so that repeated words cost one look-up for each language; it
forgets everything when it holds CACHE walks. What it remembers changes no result.

Learning reads a bounded sample: of each language max_docs labelled rows with the smallest hashes of their ids, among
those of at most max_chars characters (where a language has none, its shortest row). Whole rows go into the
language's automaton until it holds max_letters letters; the rest tell how many phrases a letter texts of the language
need. The driver holds that sample and the automata, a few hundred bytes for each letter, never more as the corpus
grows; they are broadcast. Every text is then parsed whole by its task.

Cases: a null text and a text without letters are "und" with score 0. Ties go to the language that sorts first.
Labelled rows with null language or without letters are not learned from; with no labelled row at all every text is
"und". Rows that share an id and a language are one labelled row, with the smallest of their texts. Extra columns are
kept, other than lang_pred, score, rate and accepted. Equal rows get equal predictions.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filigree.llm.common import by_size

WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*").findall
#: Match lengths are found side by side up to STEPS letters; longer matches go on one by one, at phrases only.
#: DENSE bounds the places of an automaton's table, 4 bytes each.
STEPS = 24
DENSE = 1 << 23
#: Phrases a letter that texts of any language may need.
USUAL_RATE = 0.5


def normalised(text: str | None) -> list[str]:
    return WORDS((text or "").lower())


class SuffixAutomaton:
    """The smallest automaton of a text's substrings. Its edges stand in a table of states and letters or, where that
    would have more than DENSE places, in a hash table."""

    def __init__(self, text: str):
        moves, link, length = [{}], [-1], [0]
        last = 0
        for c in map(ord, text):
            new = len(moves)
            moves.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p >= 0 and c not in moves[p]:
                moves[p][c] = new
                p = link[p]
            if p >= 0:
                q = moves[p][c]
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    twin = len(moves)
                    moves.append(dict(moves[q]))
                    link.append(link[q])
                    length.append(length[p] + 1)
                    while p >= 0 and moves[p].get(c) == q:
                        moves[p][c] = twin
                        p = link[p]
                    link[q] = link[new] = twin
            last = new
        self.bits = log2(max(len(text), 2))
        #: The letters in order; the number of a letter is its place, and that of any other letter len(letters).
        self.letters = np.unique(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32))
        self.width = len(self.letters) + 1
        number = {c: i for i, c in enumerate(self.letters.tolist())}
        keys = np.array([state * self.width + number[c] for state, own in enumerate(moves) for c in own], np.int64)
        to = np.array([t for own in moves for t in own.values()], np.int32)
        self.dense = len(moves) * self.width <= DENSE
        if self.dense:
            self.to = np.full(len(moves) * self.width, -1, np.int32)
            self.to[keys] = to
            return
        self.shift = np.uint64(64 - max(4, (4 * len(keys)).bit_length()))
        self.keys = np.full(1 << (64 - int(self.shift)), -1, np.int64)
        self.to = np.full(len(self.keys), -1, np.int32)
        slot = self.slots(keys)
        while len(keys):  # each round the first of those that want a free slot gets it, the others try the next one
            at = np.flatnonzero(self.keys[slot] < 0)
            at = at[np.unique(slot[at], return_index=True)[1]]
            self.keys[slot[at]], self.to[slot[at]] = keys[at], to[at]
            left = np.ones(len(keys), bool)
            left[at] = False
            keys, to, slot = keys[left], to[left], (slot[left] + 1) % len(self.keys)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def follow(self, keys: np.ndarray) -> np.ndarray:
        """The next states for state * width + letter number; -1 where there is no edge."""
        if self.dense:
            return self.to.take(keys)
        slot = self.slots(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.to[slot], np.int32(-1))
        again = np.flatnonzero((there != keys) & (there >= 0))
        while len(again):
            slot[again] = (slot[again] + 1) % len(self.keys)
            there = self.keys[slot[again]]
            hit = there == keys[again]
            out[again[hit]] = self.to[slot[again[hit]]]
            again = again[~hit & (there >= 0)]
        return out

    def numbers(self, points: np.ndarray) -> np.ndarray:
        """The letter numbers of code points."""
        if not len(self.letters):
            return np.zeros(len(points), np.int64)
        at = np.full(int(max(points.max(initial=0), self.letters[-1])) + 1, self.width - 1, np.int64)
        at[self.letters] = np.arange(len(self.letters))
        return at.take(points)

    def matches(self, letters: np.ndarray) -> tuple[np.ndarray, dict[int, int]]:
        """How many letters from each place on are a substring, up to STEPS; and the states where STEPS of them are.
        The last letter is one that the automaton doesn't have."""
        size = np.zeros(len(letters), np.int32)
        live, state = np.flatnonzero(letters < self.width - 1), np.zeros(len(letters), np.int64)
        state = self.follow(letters.take(live)).astype(np.int64)
        size[live] = 1
        for n in range(1, STEPS):
            to = self.follow(state * self.width + letters.take(live + n))
            on = np.flatnonzero(to >= 0)
            if not len(on):
                return size, {}
            live, state = live.take(on), to.take(on).astype(np.int64)
            size[live] = n + 1
        return size, dict(zip(live.tolist(), state.tolist()))

    def phrases(self, letters: np.ndarray, ends: list[int]) -> list[int]:
        """How many phrases each text needs; texts stand end to end, with a letter that the automaton doesn't have after each."""
        found, going = self.matches(letters)
        size, out, p = memoryview(np.maximum(found, 1)), [], 0
        for end in ends:
            n = 0
            while p < end:
                k = size[p]
                n += 1
                if k == STEPS:
                    state = going[p]
                    while (state := int(self.follow(np.array([state * self.width + letters[p + k]]))[0])) >= 0:
                        k += 1
                p += k
            out.append(n)
            p = end + 1
        return out


def counted(automata: list[SuffixAutomaton], words: list[list[str]]) -> list[list[int]]:
    """The phrases of each text's words, one list for each automaton."""
    runs = [f" {' '.join(own)} " if own else "" for own in words]
    points = np.frombuffer("".join(r + "\0" for r in runs).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    ends = (np.cumsum([len(r) + 1 for r in runs]) - 1).tolist()
    return [a.phrases(a.numbers(points), ends) for a in automata]


class Model:
    """The learned languages, their automata and the most phrases a letter that a text of each may need."""

    def __init__(self, texts: dict[str, list[str]], more: dict[str, list[str]] | None = None):
        """texts: what the automata are made of; more: other texts of the languages, which tell how well they parse."""
        self.langs = sorted(texts)
        self.automata = [SuffixAutomaton("".join(f" {' '.join(normalised(t))} " for t in texts[lang])) for lang in self.langs]
        self.most = [USUAL_RATE] * len(self.langs)
        for k, lang in enumerate(self.langs):
            words = [w for w in map(normalised, (more or {}).get(lang, ())) if w]
            for own, (n,) in zip(words, zip(*counted(self.automata[k : k + 1], words))):
                self.most[k] = max(self.most[k], 1.25 * n / sum(map(len, own)))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, float, bool]]:
        """Language, score, phrases a letter and whether the text is accepted as one of that language, for each text."""
        out, found = [], list(map(normalised, texts))
        parsed = zip(*counted(self.automata, found)) if self.langs else [()] * len(texts)
        for words, each in zip(found, parsed):
            if not words or not self.langs:
                out.append(("und", 0.0, 1.0, False))
                continue
            costs = [n * a.bits for n, a in zip(each, self.automata)]
            best = min(range(len(costs)), key=costs.__getitem__)
            second = min((c for k, c in enumerate(costs) if k != best), default=None)
            rate = each[best] / sum(map(len, words))
            out.append((self.langs[best], 1.0 if second is None else 1 - costs[best] / second, rate, rate <= self.most[best]))
        return out


def learn(labelled: DataFrame, lang: str = "lang", max_docs: int = 120, max_chars: int = 4_000, max_letters: int = 20_000) -> Model:
    """A model from (doc_id, text, lang) rows."""
    rows = labelled.select("doc_id", "text", F.col(lang).alias("lang")).where(F.col("lang").isNotNull() & (F.col("lang") != "und") & F.col("text").rlike(r"\p{L}"))
    key = F.xxhash64(F.col("doc_id").cast("string"))
    # Ids alone are ranked; each task keeps max_docs of a language at most before the shuffle.
    order = Window.partitionBy("lang").orderBy(F.greatest("n", F.lit(max_chars)), "_h", "doc_id")
    ids = rows.select("doc_id", "lang", F.length("text").alias("n"), key.alias("_h")).groupBy("lang", "_h", "doc_id").agg(F.min("n").alias("n"))
    first = ids.withColumn("_n", F.row_number().over(order)).where((F.col("_n") <= max_docs) & ((F.col("n") <= max_chars) | (F.col("_n") == 1))).select("doc_id").distinct()
    chosen = [r["doc_id"] for r in first.collect()]
    sample = rows.where(F.col("doc_id").isin(chosen)).groupBy("lang", "doc_id").agg(F.min_by("text", F.struct(F.length("text"), "text")).alias("text")) if chosen else rows.limit(0)
    texts: dict[str, list[str]] = {}
    more: dict[str, list[str]] = {}
    letters: dict[str, int] = {}
    for r in sample.select("lang", key.alias("h"), "text").orderBy("lang", F.greatest(F.length("text"), F.lit(max_chars)), "h", "text").collect():
        if letters.get(r["lang"], 0) < max_letters:
            texts.setdefault(r["lang"], []).append(r["text"])
            letters[r["lang"]] = letters.get(r["lang"], 0) + len(r["text"])
        else:
            more.setdefault(r["lang"], []).append(r["text"])
    return Model(texts, more)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with lang_pred, score (how many fewer normalised phrases than the second-best language needs, as a share),
    rate (phrases for each letter) and accepted (a language was found, and the text parses no worse than its texts do)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = {"lang_pred": T.StringType(), "score": T.DoubleType(), "rate": T.DoubleType(), "accepted": T.BooleanType()}
    kept = [c for c in docs.columns if c not in added]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(c, t) for c, t in added.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in by_size(batches, text, 1 << 19):
            found = own.predict(batch.column(text).to_pylist())
            columns = [pa.array([r[k] for r in found], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + columns, names=[*kept, *added])

    return docs.mapInArrow(run, schema)
