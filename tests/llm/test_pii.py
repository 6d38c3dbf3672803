"""Personal data spans against plain regular expressions."""

import hashlib
import re

import pytest
from hypothesis import given, settings, strategies as st

from fleetwright.llm import pii
from fleetwright.llm.queries import QUERIES

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    doubled = [int(d) for d in digits[::-1]]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(doubled)) % 10 == 0


def plain_spans(text):
    spans = []
    for kind, pattern in PATTERNS.items():
        for match in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", match.group())
            if kind == "ip" and any(int(p) > 255 for p in match.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and _luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            spans.append((kind, *match.span()))
    return spans


def base(text):
    return [s for s in pii.spans_of(text) if s[0] in pii.BASE_KINDS]


@settings(max_examples=1000, deadline=None)
@given(st.text(alphabet="a@.-+ 1259()0_\né", max_size=40))
def test_base_spans_are_those_of_the_patterns(text):
    assert base(text) == plain_spans(text)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(
    ["a@b.c", "@", ".", "1.2.3.4", "256.1.1.1", "4929348385146306", "4929-3483 8514-6306", "+1 (487) 555-7209",
     "+", " ", "x", "-", "00", "1", "é", "acct 123456", "IBAN DE89 3704 0044 0532 0130 00"]), max_size=12))
def test_pieces_in_any_order(pieces):
    text = "".join(pieces)
    assert base(text) == plain_spans(text)


@pytest.mark.parametrize("text,kind,found", [
    ("my IBAN: DE89 3704 0044 0532 0130 00 and more", "iban", "DE89 3704 0044 0532 0130 00"),
    ("iban GB82WEST12345698765432.", "iban", "GB82WEST12345698765432"),
    ("iban GB82WEST12345698765433", "iban", None),
    ("SSN 123-45-6789.", "ssn", "123-45-6789"),
    ("ssn 000-45-6789", "ssn", None),
    ("Account no. 1234-5678 90, ok", "account", "1234-5678 90"),
    ("on account of 12 things", "account", None),
    ("Lssn 123-45-6789", "ssn", None),
])
def test_spans_behind_cues(text, kind, found):
    spans = [text[a:b] for k, a, b in pii.spans_of(text) if k == kind]
    assert spans == ([found] if found else [])


def test_long_texts_take_linear_time():
    for text in ("1" * 300_000, "1." * 200_000, "a@" * 200_000, "a." * 200_000 + "@", "+1" * 200_000, "1 " * 200_000):
        pii.spans_of(text)


def test_query_over_the_whole_table(spark, testdata):
    folder = str(testdata / "sf0.01")
    rows = {r.doc_id: r for r in QUERIES["op3_pii"](spark, folder).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert set(rows) == set(texts)
    for key, text in texts.items():
        spans = plain_spans(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert rows[key].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [rows[key][f"n_{k}"] for k in PATTERNS] == [sum(s[0] == k for s in spans) for k in PATTERNS]
        assert set(joined.split(",")) - {""} <= set(rows[key].spans.split(","))
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows.values()) > 50


def test_odd_rows(spark):
    rows = [(1, None, 5), (None, "mail a@b.co", 5), (2, "", 5), (3, "ä a@b.co", None), (3, "ä a@b.co", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_email int")
    found = sorted((r.doc_id or 0, r.spans) for r in pii.find_spans(docs).collect())
    assert found == [(0, "email:5:11"), (1, ""), (2, ""), (3, "email:2:8"), (3, "email:2:8")]
    clean = sorted((r.doc_id or 0, r.text or "-", r.n_email or 0) for r in pii.redact(docs).collect())
    assert clean == [(0, "mail [EMAIL]", 5), (1, "-", 5), (2, "-", 5), (3, "ä [EMAIL]", 0), (3, "ä [EMAIL]", 0)]
    assert pii.find_spans(docs.limit(0)).collect() == []


def test_redaction_of_overlapping_spans():
    assert pii.redacted("+12345678.1.2.3 x") == "[PHONE] x"
    assert pii.redacted("nothing here") == "nothing here"


@pytest.mark.parametrize("text,found,redacted", [
    ("see https://anna:geheim@intranet/x now", "anna:geheim@intranet", "see https://[LINK]/x now"),
    ("FTP://bob@files.example.org:21/a", "bob@files.example.org", "FTP://[EMAIL]:21/a"),
    ("ring tel:0301234567.", "0301234567", "ring tel:[LINK]."),
    ("tel:+49 (30) 1234567, ok", "+49 (30) 1234567", "tel:[PHONE], ok"),
    ("mailto:root@localhost?subject=x", "root@localhost", "mailto:[LINK]?subject=x"),
    ("SIP:anna@pbx", "anna@pbx", "SIP:[LINK]"),
    ("https://example.org/a@b", None, "https://example.org/a@b"),
    ("hotel:0301234567 tel:123 ://a@b", None, "hotel:0301234567 tel:123 ://a@b"),
])
def test_spans_behind_schemes(text, found, redacted):
    assert [text[a:b] for k, a, b in pii.spans_of(text) if k == "link"] == ([found] if found else [])
    assert pii.redacted(text) == redacted


def test_long_runs_behind_schemes_take_linear_time():
    for text in ("a://" * 100_000, "a://" + "a@" * 200_000, "tel:1" * 100_000, "mailto:" * 100_000, "a://" + "@" * 300_000,
                 "mailto:" + "a" * 300_000, "tel:" + "1 " * 200_000):
        pii.spans_of(text)
