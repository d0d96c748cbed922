"""Main text of web pages, with a suffix array of each host's token streams.

A page is cut into blocks, each in a zone: article (inside article or main), chrome (menus, page headers and
footers, sidebars, notices, adverts, forms, comments, by element, role or class) or open (anything else that
shows). For each host the tokens of all its pages' blocks, articles included, are concatenated and sorted as a suffix
array; runs of at least min_run tokens that distinct pages share are boilerplate candidates. A check by markup
follows. Open blocks, on pages with an article too, lose the tokens that shared runs cover and keep their unique
runs. An article loses each block that as a whole is a block of another page as well (a notice, a license line); runs
within a block that is otherwise its own are common phrases and stay. An article more than half of whose tokens are in
shared runs is a copy or near copy of another and is kept whole. Chrome is dropped even where it occurs once. The text
of a page is what is left of its article and open blocks, in page order.

A host's pages are dealt to groups of about group_pages by a hash of their content, so a host with a third of
all pages is many tasks. Runs that two pages of one group share are found by its suffix array; runs that pages of
different groups share, by their hashes: each group lists those of its runs in slices, and learns of each whether
another group has it, by a few leading bits first and by all 64 for what is left. So the number of groups doesn't
change the result.

Cases: null or empty html gives the empty text. Elements whose end tags may be left out end as in HTML, other
unclosed ones with the element around them or the page. Equal pages count as one
page when runs are compared; equal rows are kept as often as they come. A url without a host is a host of its own.
Extra columns are kept, other than text and n_chars.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filigree.llm.common import INVERSE, by_size, mix, powers

#: Element names and words of class, id and role (fixed values).
BLOCKS = set("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
RAW = set("script style noscript template iframe svg math object canvas audio video textarea title noembed noframes xmp select".split())
CHROME = set("nav footer aside form menu dialog button search head".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
MARKS = set("ad ads advert adverts advertisement advertising banner sponsor sponsored promo cookie cookies consent gdpr notice notification newsletter subscribe subscription signup login popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead share sharing social related recommended comment comments commentlist disqus replies respond widget toolbar pagination pager".split())

#: Words of layout that may stand beside a mark in a class or id, and elements that hold the content whatever these say.
LAYOUT = set("area bar block box button buttons container bottom desktop first fixed footer foot global group head header holder icon icons inner item items js last left link links list main menu middle mobile module outer page panel posts primary right row secondary section site slot sticky top unit wrap wrapper zone".split())
CONTENT = set("html body main article".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
_LISTS, _TABLES = {"ul", "ol", "menu"}, {"table"}
#: Start tags that close elements whose end tags may be left out: which, and what bounds the search.
CLOSES = {
    "li": ({"li"}, _LISTS), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"optgroup"}), "optgroup": ({"option", "optgroup"}, set()),
    "td": ({"td", "th"}, _TABLES | {"tr"}), "th": ({"td", "th"}, _TABLES | {"tr"}), "tr": ({"tr", "td", "th"}, _TABLES),
} | {x: ({"tr", "td", "th", "thead", "tbody", "tfoot"}, _TABLES) for x in ("thead", "tbody", "tfoot")}

#: A comment, a tag, or another mark; each also ends with the page, so that no place is looked at from two starts. Quotes
#: hold a value only behind an equals sign.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]|=\s*+(?:\"[^\"]*+\"|'[^']*+')?)*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)", re.S)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
ARTICLE, CHROME_ZONE, OPEN = 0, 1, 2
#: So many page keys are remembered by a task that parses pages, so that equal ones are sent once.
MOST_SEEN = 100_000


def describes(name: str) -> bool:
    """True where a class or id says what an element is: of its words, one is a mark and the others are of layout."""
    words = [w for w in re.split(r"[^a-z]+", name.lower()) if w]
    return any(w in MARKS for w in words) and all(w in MARKS or w in LAYOUT for w in words)


def marked(name: str, attributes: str) -> bool:
    """True where an element's name, role, class or id says that it isn't content."""
    if name in CHROME:
        return True
    for kind, *value in _NAMES.findall(attributes) if attributes and name not in CONTENT else ():
        if kind.lower() == "id" and name in HEADINGS:  # headings have ids to be linked to
            continue
        words = "".join(value).split()
        if any(w.lower() in ROLES for w in words) if kind.lower() == "role" else any(describes(w) for w in words):
            return True
    return False


def implied_end(stack: list[str], held: dict[str, int], name: str) -> int:
    """The depth at which the start tag of a block closes an element whose end tag was left out; the stack's size where it closes none."""
    if stack and stack[-1] == "head":
        return len(stack) - 1
    if "p" in stack[-8:] and name != "button":  # a block ends the paragraph around it
        for at in range(len(stack) - 1, -1, -1):
            if stack[at] == "p":
                return at
            if stack[at] in BLOCKS or stack[at] in CHROME:
                break
    closes, bounds = CLOSES.get(name, ((), ()))
    low = len(stack)
    if not any(held.get(x) for x in closes):
        return low
    for at in range(len(stack) - 1, -1, -1):
        if stack[at] in closes:
            low = at
        elif stack[at] in bounds or low < len(stack):
            break
    return low


def blocks_of(page: str) -> list[tuple[int, str]]:
    """(zone, text) of each block in page order; character references are decoded and white space is one space."""
    out: list[tuple[int, str]] = []
    parts: list[str] = []
    stack: list[str] = []  # open blocks and marked elements
    held: dict[str, int] = {}  # how many of each name are open
    off = -1  # the depth of the outermost element that is chrome
    at, raw = 0, ""

    def flush() -> None:
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            out.append((CHROME_ZONE if off >= 0 else ARTICLE if held.get("article", 0) + held.get("main", 0) else OPEN, text))

    def cut(depth: int) -> None:
        nonlocal off
        while len(stack) > depth:
            held[stack.pop()] -= 1
        off = -1 if off >= depth else off

    while at < len(page):
        if raw:  # up to the end tag, whatever stands there
            m = re.compile(rf"</{re.escape(raw)}\b[^>]*+(?:>|\Z)", re.I).search(page, at)
            at, raw = (m.end() if m else len(page)), ""
            continue
        m = _TOKEN.search(page, at)
        if m is None:
            parts.append(entities.unescape(page[at:]))
            break
        if m.start() > at:
            parts.append(entities.unescape(page[at : m.start()]))
        at = m.end()
        closing, name, attributes = m.group(1), m.group(2), m.group(3)
        if name is None:
            continue
        name = name.lower()
        if name == "br":
            parts.append(" ")
            continue
        if not closing and name in RAW:
            raw = "" if attributes.endswith("/") else name
            continue
        block = name in BLOCKS or name in CHROME
        if block:
            flush()
        if name in VOID:
            continue
        if closing:
            if held.get(name) and name not in ("html", "body"):
                depth = next(at for at in range(len(stack) - 1, -1, -1) if stack[at] == name)
                # The end of an inline element closes no block around it.
                if block or not any(x in BLOCKS or x in CHROME for x in stack[depth + 1 :]):
                    flush()
                    cut(depth)
            continue
        if block:
            cut(implied_end(stack, held, name))
        chrome = marked(name, attributes) or name == "header" and not held.get("article", 0) + held.get("main", 0)
        if block or off < 0 and chrome or off >= 0 and held.get(name):
            if chrome and off < 0:
                if not block:
                    flush()
                off = len(stack)
            stack.append(name)
            held[name] = held.get(name, 0) + 1
    flush()
    return out


def suffix_array(tokens: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes in the order of their first tokens (2 ** k >= depth of them), and their ranks; by doubling."""
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    length = 1
    while True:
        nxt = np.concatenate([rank[length:], np.full(min(length, len(rank)), -1)])[: len(rank)]
        pair = rank * (len(rank) + 1) + nxt + 1  # one number for both, so that one sort does
        order = np.argsort(pair)
        a = pair[order]
        new = np.empty(len(rank), np.int64)
        new[order] = np.cumsum(np.concatenate([[0], a[1:] != a[:-1]]))
        rank, length = new, 2 * length
        if length >= depth or rank.max(initial=0) == len(rank) - 1:
            return order, rank


def covered(streams: list[list[str]], min_run: int, also: np.ndarray | None = None, ids: np.ndarray | None = None) -> list[np.ndarray]:
    """For each page's tokens, which of them lie in a run of min_run tokens that another page has too.

    also: places in the streams set end to end where runs begin that are known to be shared with a page elsewhere;
    ids: the tokens there as numbers, if they are known.
    """
    sizes = [len(s) for s in streams]
    total = sum(sizes)
    if not total:
        return [np.zeros(0, bool) for _ in streams]
    if ids is None:
        ids, _ = pd.factorize(np.array([t for s in streams for t in s], object))
    page = np.repeat(np.arange(len(streams)), sizes)
    # Each page ends with a separator of its own, so that no run crosses pages.
    ends = np.cumsum(sizes)
    tokens = np.insert(ids, ends, len(ids) + np.arange(len(streams)))
    owner = np.insert(page, ends, np.arange(len(streams)))
    order, _ = suffix_array(tokens, min_run)
    # Adjacent suffixes with a common prefix of min_run tokens.
    same = np.ones(len(order) - 1, bool)
    for k in range(min_run):
        x, y = order[:-1] + k, order[1:] + k
        inside = (x < len(tokens)) & (y < len(tokens))
        same &= inside & (tokens[np.minimum(x, len(tokens) - 1)] == tokens[np.minimum(y, len(tokens) - 1)])
    group = np.cumsum(np.concatenate([[0], ~same]))
    low = np.full(group[-1] + 1, len(streams))
    high = np.full(group[-1] + 1, -1)
    np.minimum.at(low, group, owner[order])
    np.maximum.at(high, group, owner[order])
    starts = order[(low < high)[group]]
    change = np.zeros(len(tokens) + min_run + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + min_run, -1)
    if also is not None and len(also):
        also = also + page[also]  # behind the separators of the pages before
        np.add.at(change, also, 1)
        np.add.at(change, also + min_run, -1)
    hit = np.cumsum(change)[: len(tokens)] > 0
    edges = ends + np.arange(len(streams)) + 1
    return [hit[e - n - 1 : e - 1] for e, n in zip(edges, sizes)]


def run_hashes(ids: np.ndarray, words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the runs from starts to ends of the tokens words[ids]; the same in every task."""
    known = pd.util.hash_array(np.asarray(words, object), categorize=False) if len(words) else np.zeros(0, np.uint64)
    up, down = powers(len(ids) + 1), powers(len(ids) + 1, INVERSE)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(known[ids] * up[: len(ids)], dtype=np.uint64)])
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, ascending; by a sort, which takes far less time here than a table of hashes."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def packed(values: np.ndarray) -> bytes:
    """Ascending 64-bit values as compressed byte planes of their differences."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    return zlib.compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def sliced(codes: np.ndarray, shift: int, groups: int) -> tuple[int, np.ndarray]:
    """Into how many slices a host's codes are dealt, and where ascending codes begin in each; 8 groups' worth a slice."""
    slices = -(-groups // 8)
    place = (((codes << np.uint64(shift)) >> np.uint64(32)) * np.uint64(slices)) >> np.uint64(32)
    return slices, np.searchsorted(place, np.arange(slices + 1).astype(np.uint64))


def meet(lists: pa.Table) -> pa.Table:
    """For each group's list of a slice, a bit for each code: whether another group of the host has it."""
    codes = [unpacked(b) for b in lists.column("_codes").to_pylist()]
    found, times = np.unique(np.concatenate(codes), return_counts=True)
    masks = [zlib.compress(np.packbits((times > 1)[np.searchsorted(found, c)]).tobytes(), 1) for c in codes]
    return lists.drop_columns(["_codes"]).append_column("_mask", pa.array(masks, pa.binary()))


def marks_of(masks: pa.Table, codes: np.ndarray, shift: int, groups: int) -> np.ndarray:
    """The bits of meet for a group's ascending codes, from its rows of all slices."""
    out = np.zeros(len(codes), bool)
    _, edges = sliced(codes, shift, groups)
    for at, mask in zip(masks.column("_slice").to_pylist(), masks.column("_mask").to_pylist()):
        n = int(edges[at + 1] - edges[at])
        out[edges[at] : edges[at + 1]] = np.unpackbits(np.frombuffer(zlib.decompress(mask), np.uint8), count=n)
    return out


def packed_rows(masks: pa.Table) -> bytes:
    """A table of masks in one value."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, masks.schema) as out:
        out.write_table(masks)
    return sink.getvalue().to_pybytes()


def rows_of(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


NO_LISTS = pa.table({"_host": pa.array([], pa.string()), "_slice": pa.array([], pa.int32()), "_group": pa.array([], pa.int32()), "_codes": pa.array([], pa.binary())})


class Host:
    """The distinct pages of a host's group: their blocks, tokens and block places."""

    def __init__(self, group: pa.Table, min_run: int):
        self.min_run = min_run
        self.keys = [(k["a"], k["b"]) for k in group.column("_key").to_pylist()]
        full: dict[tuple, str] = {}
        for key, blocks in zip(self.keys, group.column("_blocks").to_pylist()):
            if blocks is not None:
                full.setdefault(key, blocks)
        self.page = {key: n for n, key in enumerate(full)}
        own = [page.split("\n") if page else [] for page in full.values()]
        self.zones, self.blocks = [[int(b[0]) for b in page] for page in own], [[b[1:] for b in page] for page in own]
        self.words = [[b.split() for b in page] for page in self.blocks]
        self.streams = [[w for b in page for w in b] for page in self.words]
        self.sizes = np.array([len(b) for page in self.words for b in page], np.int64)
        self.owner = np.repeat(np.arange(len(self.words)), [len(page) for page in self.words])
        self.ends = np.cumsum(self.sizes)

        self.groups = group.column("_groups")[0].as_py()

    def hash(self) -> None:
        """Hashes of whole blocks and, in a host of several groups, of each run of min_run tokens within a page."""
        self.ids, words = pd.factorize(np.array([t for s in self.streams for t in s], object))
        begins, runs = self.ends - self.sizes, np.zeros(0, np.int64)
        if self.groups > 1:
            lengths = np.array([len(s) for s in self.streams], np.int64)
            room = np.repeat(np.cumsum(lengths), lengths) - np.arange(lengths.sum())  # tokens left on the page
            runs = np.flatnonzero(room >= self.min_run)
        both = run_hashes(self.ids, words, np.concatenate([begins, runs]), np.concatenate([self.ends, runs + self.min_run]))
        self.block_hash, self.runs, self.run_hash = both[: len(begins)], runs, both[len(begins) :]
        self.long = self.sizes >= self.min_run
        self.codes = distinct(np.concatenate([self.block_hash[self.long], self.run_hash])) if self.groups > 1 else self.run_hash

    def coarse(self) -> tuple[np.ndarray, int]:
        """Leading bits of the codes, some six bits more than it takes to tell a host's runs apart, and the shift to them."""
        shift = max(0, 64 - 25 - (self.groups - 1).bit_length())
        return distinct(self.codes >> np.uint64(shift)), shift

    def candidates(self, masks: pa.Table) -> np.ndarray:
        """The codes whose leading bits another group has too."""
        coarse, shift = self.coarse()
        return self.codes[marks_of(masks, coarse, shift, self.groups)[np.searchsorted(coarse, self.codes >> np.uint64(shift))]]

    def lists(self, group: pa.Table, codes: np.ndarray, shift: int) -> pa.Table:
        slices, edges = sliced(codes, shift, self.groups)
        used = [n for n in range(slices) if edges[n] < edges[n + 1]]
        first = {c: group.column(c)[0].as_py() for c in ("_host", "_group")}
        return pa.table({"_host": pa.array([first["_host"]] * len(used), pa.string()), "_slice": pa.array(used, pa.int32()), "_group": pa.array([first["_group"]] * len(used), pa.int32()), "_codes": pa.array([packed(codes[edges[n] : edges[n + 1]]) for n in used], pa.binary())})

    def repeated(self, elsewhere: np.ndarray) -> np.ndarray:
        """For each block, whether all of it, min_run tokens at least, is a run of another page too."""
        _, at = np.unique(self.block_hash, return_inverse=True)
        low, high = np.full(len(at), len(self.words)), np.full(len(at), -1)
        np.minimum.at(low, at, self.owner)
        np.maximum.at(high, at, self.owner)
        return ((low < high)[at] | np.isin(self.block_hash, elsewhere)) & self.long

    def texts(self, hits: list[np.ndarray], repeated: np.ndarray) -> list[str]:
        """The text of each page, by the runs that pages share and then by markup."""
        out, block = [], 0
        for zones, blocks, page, hit in zip(self.zones, self.blocks, self.words, hits):
            of = np.repeat(np.array(zones, np.int64), [len(w) for w in page]) == ARTICLE
            copy = 2 * np.count_nonzero(hit & of) > np.count_nonzero(of)
            lines, at = [], 0
            for zone, text, words in zip(zones, blocks, page):
                if zone == ARTICLE:
                    lines += [text] if copy or not repeated[block] else []
                elif zone == OPEN:
                    left = [w for w, h in zip(words, hit[at : at + len(words)].tolist()) if not h]
                    lines += [" ".join(left)] if left else []
                at += len(words)
                block += 1
            out.append("\n".join(lines))
        return out


def extract(pages: DataFrame, min_run: int = 5, group_pages: int = 1000, text: str = "html", keep_text: bool = True) -> DataFrame:
    """pages with text and n_chars (its code points); without keep_text, the markup isn't kept and so isn't shuffled."""
    kept = [c for c in pages.columns if c not in ("text", "n_chars") and (keep_text or c != text)]
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[^:/?#]*:?//(?:[^@/?#]*@)?([^:/?#]*)", 1))
    blank = F.coalesce(text, F.lit("")) == ""
    keyed = pages.select(*pages.columns).withColumns({"_host": host, "_key": F.struct(F.xxhash64(text).alias("a"), F.unhex(F.sha2(F.coalesce(text, F.lit("")), 224)).alias("b"))})
    # Only hosts of several groups are listed: a row for each group_pages pages at most, so that it may be broadcast.
    groups = pages.groupBy(host.alias("_host")).count().where(F.col("count") > group_pages).select("_host", F.ceil(F.col("count") / group_pages).cast("int").alias("_groups"))
    # Equal pages meet in a group; pages without markup have nothing to compare and go anywhere.
    deal = F.when(blank, F.xxhash64("url")).otherwise(F.col("_key.a"))
    dealt = keyed.join(F.broadcast(groups), "_host", "left").withColumn("_groups", F.coalesce("_groups", F.lit(1))).withColumn("_group", F.pmod(deal, F.col("_groups")).cast("int"))
    carried = [*kept, "_host", "_key", "_groups", "_group"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch in by_size(batches, text):
            found = []
            for at, key, page in zip(batch.column("_host").to_pylist(), batch.column("_key").to_pylist(), batch.column(text).to_pylist()):
                name = (at, key["a"], key["b"])
                found.append(None if name in seen else blocks_of(page or ""))
                seen.add(name)
            if len(seen) > MOST_SEEN:
                seen.clear()
            # Block texts have no line breaks.
            blocks = pa.array([None if own is None else "\n".join(f"{z}{t}" for z, t in own) for own in found], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in carried] + [blocks], names=[*carried, "_blocks"])

    fields = [dealt.schema[c] for c in carried]
    parsed = dealt.select(*dict.fromkeys([*carried, text])).mapInArrow(cut, T.StructType(fields + [T.StructField("_blocks", T.StringType())]))

    def first(group: pa.Table) -> pa.Table:
        if group.column("_groups")[0].as_py() == 1:
            return NO_LISTS
        own = Host(group, min_run)
        own.hash()
        return own.lists(group, *own.coarse())

    def second(group: pa.Table, masks: pa.Table) -> pa.Table:
        if not group.num_rows or not masks.num_rows:
            return NO_LISTS.append_column("_coarse", pa.array([], pa.binary()))
        own = Host(group, min_run)
        own.hash()
        out = own.lists(group, own.candidates(masks), 0)
        return out.append_column("_coarse", pa.array([packed_rows(masks)] + [None] * (out.num_rows - 1) if out.num_rows else [], pa.binary()))

    def strip(group: pa.Table, masks: pa.Table) -> pa.Table:
        own = Host(group, min_run)
        own.hash()
        elsewhere = np.zeros(0, np.uint64)
        if masks.num_rows:
            found = own.candidates(rows_of(next(b for b in masks.column("_coarse").to_pylist() if b is not None)))
            elsewhere = found[marks_of(masks, found, 0, own.groups)]
        hits = covered(own.streams, min_run, own.runs[np.isin(own.run_hash, elsewhere)], own.ids)
        texts = own.texts(hits, own.repeated(elsewhere))
        return group.select(kept).append_column("text", pa.array([texts[own.page[k]] for k in own.keys], pa.string()))

    # What a host's groups share: first by leading bits of hashes, then by the whole hashes of those that met.
    lists = "_host string, _slice int, _group int, _codes binary"
    pages_of = parsed.groupBy("_host", "_group")
    near = pages_of.applyInArrow(first, lists).groupBy("_host", "_slice").applyInArrow(meet, lists.replace("_codes", "_mask"))
    exact = pages_of.cogroup(near.groupBy("_host", "_group")).applyInArrow(second, lists + ", _coarse binary")
    shared = exact.groupBy("_host", "_slice").applyInArrow(meet, "_host string, _slice int, _group int, _coarse binary, _mask binary")
    out = pages_of.cogroup(shared.groupBy("_host", "_group")).applyInArrow(strip, T.StructType([pages.schema[c] for c in kept] + [T.StructField("text", T.StringType())]))
    return out.select(*kept, "text", F.length("text").cast("long").alias("n_chars"))
