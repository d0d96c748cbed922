"""Personal data: anchors against a search of the whole text by the patterns."""

import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from filigree.llm import pii
from filigree.llm.queries import QUERIES

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "login": pii.LOGIN,
}
PIECES = [*"@.+- :/#09aZé\u0130\u212a()=", "12", "255.", "1.2.3.4", "4111 1111 1111 1111", "49927398716", "a@b.c", "+1 (555) 010-99", "://", "ftp://u:p@h.x", "SSN ", "social security no. ", "078-05-1120", "IBAN: ", "GB82 WEST 1234 5698 7654 32", "account no: ", "AB-12345", "passport ", "acct=", "\n"]


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def spans(text):
    """All kinds by whole-text search, with checks of its own."""
    t, out = text or "", []
    digits = lambda s: re.sub(r"\D", "", s, flags=re.A)
    good = {
        "email": lambda m: True, "login": lambda m: True, "ip": lambda m: all(int(x) <= 255 for x in m[0].split(".")), "card": lambda m: 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0])), "phone": lambda m: 10 <= len(digits(m[0])) <= 15,
        "ssn": lambda m: re.fullmatch(r"\d{3}-\d\d-\d{4}", m[1], re.A), "account": lambda m: 6 <= len(m[1]) <= 20 and len(digits(m[1])) >= 5, "iban": lambda m: pii.iban_checks(m[1]),
    }
    for rank, (kind, p) in enumerate((PATTERNS | pii.CUED).items()):
        out += [(*m.span(1 if kind in pii.CUED else 0), rank, kind) for m in re.finditer(p, t) if good[kind](m)]
    return [(k, a, b) for a, b, _, k in sorted(out, key=lambda s: (s[0], s[2], s[1]))]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=24).map("".join))
def test_anchors_find_what_patterns_find(text):
    assert pii.spans_of(text) == spans(text)


def test_checks():
    assert pii.iban_checks("GB82 WEST 1234 5698 7654 32") and not pii.iban_checks("GB82 WEST 1234 5698 7654 33") and not pii.iban_checks("GB82")
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.spans_of("x@y.zz, ssn: 078-05-1120, account #AB-12345") == [("email", 0, 6), ("ssn", 13, 24), ("account", 35, 43)]
    assert pii.redacted("to x@y.zz now", pii.spans_of("to x@y.zz now")) == "to [email] now"


def test_long_runs_are_linear():
    for text in ("9" * 1_000_000, "1." * 500_000, "a" * 500_000 + "@" + "b" * 500_000, "@" * 300_000, "+1 " * 200_000, "ssn " * 100_000, "://a:" * 100_000, "iban " + "AB12 " * 100_000):
        pii.spans_of(text)


def test_table(spark):
    rng = random.Random(5)
    texts = ["", None, "x" * 2_000 + " a@b.cc", *("".join(rng.choices(PIECES, k=30)) for _ in range(40))] * 2
    docs = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.find(docs).collect()}
    assert got == {i: spans(t) for i, t in enumerate(texts)}
    clean = {r.doc_id: r.text for r in pii.find(docs, redact=True).collect()}
    assert clean[0] == "" and clean[1] is None and clean[2].endswith("x [email]")
    assert pii.find(docs.limit(0)).count() == 0


def test_query(spark):
    rows = QUERIES["op13_pii"](spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(rows) == len(texts) and sum(r.n_email for r in rows) > 0
    for r in rows:
        want = spans(texts[r.doc_id])
        shown = lambda s: ",".join(f"{k}:{a}:{b}" for k, a, b in s)
        assert r.spans == shown(want) and r.base_sha256 == hashlib.sha256(shown([s for s in want if s[0] in pii.BASE]).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in want) for k in pii.BASE]
