"""Personal data by anchor expansion: an automaton finds anchors, and a local parser settles what stands around each.

One Aho-Corasick automaton, built once in each task, runs over a text and gives the places of at-signs, plus signs, digits,
scheme marks (://) and cue words (ssn, iban, account and so on). Each anchor has a parser that walks outwards from it, as
far as its characters go, and then validates: labels of a domain, the values of an address's parts, Luhn's and IBAN's check
digits, the number of digits. Nothing else of the text is looked at, and each parser's walk ends where the next begins, so
that the work is linear.

Kinds, leftmost and without overlap within a kind; a match that fails its check is dropped, and the search goes on behind it:
email, ip, card, phone (BASE); login: a URL with user and password; ssn, iban, account: the number after a cue word (the
span is the number alone).

Offsets count code points, ends are exclusive. Cases: a null text counts as empty; empty texts have no spans; equal rows are
kept as often as they come; an empty table gives an empty result; extra columns are kept, other than one named spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from filigree.llm.common import by_size

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "login", "ssn", "iban", "account")
RANK = {k: i for i, k in enumerate(KINDS)}
SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
#: What follows a cue word, the cue included; the last group is the number. SQL and tests read these patterns too.
CUED = {
    "ssn": r"(?i:ssn|social\x20security\x20(?:number|no\.?))[\x20:#=]*([0-9-]+)",
    "iban": r"(?i:iban)[\x20:#=]*([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4})*(?:\x20?[A-Z0-9]{1,3})?)",
    "account": r"(?i:account|acct|passport)(?i:\x20(?:number|num|no)\.?)?[\x20:#=]+([A-Z0-9-]+)",
}
LOGIN = r"[A-Za-z][A-Za-z0-9+.-]*://[^\x00-\x20/@:]+:[^\x00-\x20/@]+@[A-Za-z0-9.-]+"
#: Words of the automaton, in lower case, and the kind that each is an anchor of.
ANCHORS = {"@": "email", "+": "phone", "://": "login", "ssn": "ssn", "social security": "ssn", "iban": "iban", "account": "account", "acct": "account", "passport": "account"} | {str(d): "digit" for d in range(10)}

_LOCAL, _SCHEME = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"), frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+.-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED, _DIGITS = re.compile(r"[0-9]+(?:\.[0-9]+)*"), re.compile(r"[0-9](?:[\x20-]?[0-9])*")
_PHONE = re.compile(r"[0-9][\x20().0-9-]+")
_AFTER_SCHEME = re.compile(r"[^\x00-\x20/@:]+:[^\x00-\x20/@]+@[A-Za-z0-9.-]+")
_CUED = {k: re.compile(p) for k, p in CUED.items()}


def luhn(digits: str) -> bool:
    """Whether the last digit checks the others."""
    doubled = sum(int(d) for c in digits[-2::-2] for d in str(2 * int(c)))
    return (doubled + sum(map(int, digits[::-2]))) % 10 == 0


def iban_checks(number: str) -> bool:
    """15 to 34 characters whose remainder by 97, as letters count from 10, is 1."""
    plain = number.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def octets(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


VALID = {
    "ssn": lambda n: re.fullmatch(r"[0-9]{3}-[0-9]{2}-[0-9]{4}", n) is not None,
    "iban": iban_checks,
    "account": lambda n: 6 <= len(n) <= 20 and sum(c.isdigit() for c in n) >= 5,
}


@cache
def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word, kind in ANCHORS.items():
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def _left(text: str, at: int, least: int, chars: frozenset) -> int:
    """Where the run of chars that ends at a place starts, not before least."""
    while at > least and text[at - 1] in chars:
        at -= 1
    return at


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of a text, by start, then by kind, then by end."""
    out: list[tuple[str, int, int]] = []
    after = dict.fromkeys((*KINDS, "at"), 0)  # the end of each kind's last match, where its search goes on
    lower = text.lower()
    if len(lower) != len(text):  # a few letters grow in lower case, and places would shift
        lower = "".join(c.lower() if c.isascii() else c for c in text)
    for last, (kind, length) in automaton().iter(lower):
        start = last + 1 - length
        if kind == "digit":
            if start >= after["ip"]:
                run = _DOTTED.match(text, start)
                parts, at = run[0].split("."), start
                for i in range(0, len(parts) - 3, 4):
                    end = at + sum(map(len, parts[i : i + 4])) + 3
                    if octets(parts[i : i + 4]):
                        out.append(("ip", at, end))
                    at = end + 1
                after["ip"] = run.end()
            if start >= after["card"]:
                run = _DIGITS.match(text, start)
                digits = run[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append(("card", start, run.end()))
                after["card"] = run.end()
        elif start < after[kind]:
            continue
        elif kind == "email":
            domain = _DOMAIN.match(text, last + 1)
            if domain:
                first = _left(text, start, after["email"], _LOCAL)
                if first < start:
                    out.append(("email", first, domain.end()))
                    after["email"] = domain.end()
        elif kind == "phone":
            run = _PHONE.match(text, last + 1)
            whole = run and run[0].rstrip(" ().-")
            if whole and len(whole) > 2:
                end = last + 1 + len(whole)
                if 10 <= sum(c.isdigit() for c in whole) <= 15:
                    out.append(("phone", start, end))
                after["phone"] = end
        elif kind == "login":
            rest = _AFTER_SCHEME.match(text, last + 1)
            if rest:
                first = _left(text, start, after["login"], _SCHEME)
                while first < start and not text[first].isalpha():
                    first += 1
                if first < start:
                    out.append(("login", first, rest.end()))
                    after["login"] = rest.end()
        else:
            found = _CUED[kind].match(text, start)
            if found:
                if VALID[kind](found[1]):
                    out.append((kind, *found.span(1)))
                after[kind] = found.end()
    return sorted(out, key=lambda s: (s[1], RANK[s[0]], s[2]))


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span as [kind]; spans that overlap become one, under the first one's kind."""
    parts, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            parts += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join(parts) + text[at:]


def find(docs: DataFrame, redact: bool = False) -> DataFrame:
    """docs with spans; with redact their texts have [kind] in place of what was found (null texts stay null)."""
    docs = docs.drop("spans")
    schema = T.StructType([*docs.schema.fields, T.StructField("spans", T._parse_datatype_string(SPANS))])
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in by_size(batches, "text"):
            texts = batch.column("text").to_pylist()
            found = [spans_of(t) if t else [] for t in texts]
            columns = {n: batch.column(n) for n in names}
            if redact:
                columns["text"] = pa.array([t if not s else redacted(t, s) for t, s in zip(texts, found)], pa.string())
            columns["spans"] = pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in found], kind)
            yield pa.RecordBatch.from_pydict(columns)

    return docs.mapInArrow(run, schema)
