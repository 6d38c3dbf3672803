"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the few places of a text where personal data can
lie: at-signs, plus signs, digits, schemes and identifier cues. From each anchor a
small parser reads outwards, decides where the span begins and ends, and checks
it. Nothing backtracks, and what one parser has read is not read again, so the
time grows with the length of the text.

Base kinds (leftmost, not overlapping within a kind; a match that fails its check
is dropped):

    email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+
    ip     four runs of digits joined by dots, each at most 255
    card   digits with single blanks or hyphens between, 16 to 19, passing Luhn
    phone  + and a digit, then digits and any of blank ( ) . - up to a digit; 8 to 15 digits

Further kinds, only behind a cue: `iban` (country, check digits, mod 97), `ssn`
(3-2-4 digits with hyphens after "ssn" or "social security"), `account` (6 to 17
digits after "account", "acct" or "konto"), `link` (what a scheme leads to: user and
host behind "://" where there is a user, an address behind "mailto:", "sip:", "sips:"
or "xmpp:" whose host needs no dot, 5 to 15 digits behind "tel:", "sms:" or "callto:"). Cues are matched without regard to
the case of A-Z.

Spans are in code points, the end excluded. Defined cases: a NULL text is empty
and has no spans; equal rows give equal rows, a NULL id is carried; other columns
are not read (`find_spans`) or kept as they are (`redact`).
"""

import hashlib
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetwright.llm.common import in_slices

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("iban", "ssn", "account", "link")
KINDS = BASE_KINDS + MORE_KINDS

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_LABEL = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"[0-9][ ().0-9-]+")
_IBAN = re.compile(r"[ :#]{0,4}([A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]){11,30})(?![A-Za-z0-9])")
_SSN = re.compile(r"[ :#]{0,4}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])")
_ACCOUNT = re.compile(r"(?: ?(?:number|no\.?|nr\.?))?[ :#]{1,4}([0-9](?:[ -]?[0-9]){5,16})(?![0-9])", re.IGNORECASE)

# A scheme's user and host up to the path; an address, its host of one name or more; a number.
_AUTHORITY = re.compile(r"[^\s/?#<>\"']+")
_HOST = re.compile(r"\[[0-9A-Fa-f:.]+\]|[^\W_](?:[\w-]|\.(?=\w))*")
_ADDRESS = re.compile(r" {0,2}([A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*)")
_NUMBER = re.compile(r" {0,2}([+(]?[0-9][ ().0-9-]*)")

_SCHEMES = {"://": "user", "mailto:": "address", "sip:": "address", "sips:": "address", "xmpp:": "address",
            "tel:": "number", "sms:": "number", "callto:": "number"}
_CUES = {"iban": "iban", "ssn": "ssn", "social security": "ssn", "account": "account", "acct": "account",
         "konto": "account"}


def _automaton():
    """Anchors: a digit stands for addresses and card numbers, cues and schemes for the rest."""
    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    for cue, kind in (_CUES | _SCHEMES).items():
        found.add_word(cue, (kind, len(cue)))
    found.make_automaton()
    return found


_ANCHORS = _automaton()


def lower_ascii(text: str) -> str:
    """A-Z lower-cased; every code point keeps its place."""
    return text.encode().lower().decode()


# ---- checks -----------------------------------------------------------------

def _part_ok(digits: str) -> bool:
    plain = digits.lstrip("0")
    return len(plain) < 3 or len(plain) == 3 and plain <= "255"


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def iban_ok(text: str) -> bool:
    plain = text.replace(" ", "").upper()
    if not 15 <= len(plain) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


# ---- parsers ----------------------------------------------------------------

def _email(text: str, at: int, since: int) -> tuple[int, int] | None:
    """The address around the at-sign at `at`, not reaching back beyond `since`."""
    start = at
    while start > since and text[start - 1] in _LOCAL:
        start -= 1
    domain = _LABEL.match(text, at + 1) if start < at else None
    return (start, domain.end()) if domain else None


def _addresses(text: str, start: int, spans: list) -> int:
    """IP addresses of the chain of dotted digit runs from `start`; returns its end."""
    parts, end = [], start
    while run := _DIGITS.match(text, end):
        parts.append((run.start(), run.end()))
        end = run.end()
        if not (text.startswith(".", end) and _DIGITS.match(text, end + 1)):
            break
        end += 1
    for k in range(0, len(parts) - 3, 4):
        four = parts[k:k + 4]
        if all(_part_ok(text[a:b]) for a, b in four):
            spans.append(("ip", four[0][0], four[3][1]))
    return end


def _card(text: str, start: int, spans: list) -> int:
    """A card number among the digits from `start`; returns the end of what was read."""
    run = _CHAIN.match(text, start)
    if not run:
        return start + 1
    digits = run.group().replace(" ", "").replace("-", "")
    if 16 <= len(digits) <= 19 and luhn(digits):
        spans.append(("card", start, run.end()))
    return run.end()


def _phone(text: str, plus: int, spans: list) -> int:
    """A phone number behind the plus sign; returns the end of what was read."""
    run = _PHONE.match(text, plus + 1)
    if not run:
        return plus + 1
    body = run.group().rstrip(" ().-")
    if len(body) < 3:
        return plus + 1
    if 8 <= sum(c.isdigit() for c in body) <= 15:
        spans.append(("phone", plus, plus + 1 + len(body)))
    return plus + 1 + len(body)


def _behind_cue(text: str, kind: str, end: int) -> tuple[int, int] | None:
    """What follows the cue of `kind` that ends at `end`."""
    match = {"iban": _IBAN, "ssn": _SSN, "account": _ACCOUNT}[kind].match(text, end)
    if not match:
        return None
    start, stop = match.span(1)
    if kind == "iban":
        # The longest ending that passes: a word may follow after a blank.
        while not iban_ok(text[start:stop]):
            stop = text.rfind(" ", start, stop)
            if stop < 0:
                return None
    if kind == "ssn" and (text[start:start + 3] in ("000", "666") or text[start] == "9"):
        return None
    return start, stop


def _behind_scheme(text: str, what: str, end: int) -> tuple[int, int] | None:
    """The user and host, the address or the number behind the scheme that ends at `end`."""
    if what == "user":
        run = _AUTHORITY.match(text, end)
        at = text.rfind("@", end, run.end()) if run else -1
        host = _HOST.match(text, at + 1) if at > end else None
        return (end, host.end()) if host else None
    match = (_ADDRESS if what == "address" else _NUMBER).match(text, end)
    if not match:
        return None
    start, stop = match.span(1)
    if what == "number":
        body = match.group(1).rstrip(" ().-")
        if not 5 <= sum(c.isdigit() for c in body) <= 15:
            return None
        stop = start + len(body)
    return start, stop


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) by kind as in KINDS, then start."""
    spans: list[tuple[str, int, int]] = []
    done = dict.fromkeys(KINDS, 0)
    for last, (anchor, length) in _ANCHORS.iter(lower_ascii(text)):
        start = last - length + 1
        if anchor == "digit":
            if start >= done["ip"]:
                done["ip"] = _addresses(text, start, spans)
            if start >= done["card"]:
                done["card"] = _card(text, start, spans)
        elif anchor == "at":
            if span := _email(text, start, done["email"]):
                spans.append(("email", *span))
                done["email"] = span[1]
        elif anchor == "plus":
            if start >= done["phone"]:
                done["phone"] = _phone(text, start, spans)
        elif anchor in ("user", "address", "number"):
            # "://" stands behind its scheme's name, the others are the name.
            named = start > 0 and text[start - 1].isalnum()
            if start >= done["link"] and named == (anchor == "user"):
                if span := _behind_scheme(text, anchor, last + 1):
                    spans.append(("link", *span))
                    done["link"] = span[1]
        elif start >= done[anchor] and not (start and text[start - 1].isalnum()):
            if span := _behind_cue(text, anchor, last + 1):
                spans.append((anchor, *span))
                done[anchor] = span[1]
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def _joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


# ---- operators --------------------------------------------------------------

def find_spans(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_more) per document.

    One pass in the tasks that read the texts, without a shuffle.
    """
    def found(batches):
        for batch in in_slices(batches):
            rows = [spans_of(t or "") for t in batch.column("_text").to_pylist()]
            base = [[s for s in row if s[0] in BASE_KINDS] for row in rows]
            counts = [pa.array([sum(s[0] == kind for s in row) for row in base], pa.int64()) for kind in BASE_KINDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), *counts,
                 pa.array([hashlib.sha256(_joined(row).encode()).hexdigest() for row in base], pa.string()),
                 pa.array([_joined(row) for row in rows], pa.string()),
                 pa.array([len(row) - len(b) for row, b in zip(rows, base)], pa.int64())],
                ["_key", *(f"n_{kind}" for kind in BASE_KINDS), "base_sha256", "spans", "n_more"])

    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    counts = ", ".join(f"n_{kind} bigint" for kind in BASE_KINDS)
    schema = f"_key {rows.schema['_key'].dataType.simpleString()}, {counts}, base_sha256 string, spans string, n_more bigint"
    return rows.mapInArrow(found, schema).withColumnRenamed("_key", key)


def redacted(text: str) -> str:
    """`text` with every span replaced by its kind in brackets; of overlapping spans
    the first, and of those that begin together the longest, names the place."""
    spans = sorted(spans_of(text), key=lambda s: (s[1], -s[2], KINDS.index(s[0])))
    if not spans:
        return text
    pieces, place = [], 0
    for kind, start, end in spans:
        if start >= place:
            pieces += [text[place:start], f"[{kind.upper()}]"]
        place = max(place, end)
    return "".join(pieces) + text[place:]


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with personal data in `text` replaced; NULL stays NULL, other columns as they are."""
    @F.pandas_udf("string")
    def masked(texts):
        return texts.map(redacted, na_action="ignore")

    return docs.withColumn(text, masked(F.col(text)))
