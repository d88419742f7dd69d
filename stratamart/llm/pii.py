"""Personal data by anchor expansion.

An Aho-Corasick automaton finds at-signs, schemes and identifier cues in one pass. Local parsers walk
outwards from each anchor and validate what they find, so the work is linear in the text. Addresses made
of digits only (ip, card, phone) have no cue; their patterns start at a digit or a plus sign.

Defined results: NULL and empty texts have no spans. Repeated rows give repeated results. Positions are
code points, ends exclusive. Input columns other than the id and the text are not read, whatever their names.
An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import row_mapper, slices, texts_of

#: Kinds that the base patterns define, in reporting order, then those that cues add.
BASE_KINDS = ("email", "ip", "card", "phone")
CUE_KINDS = ("email_spelled", "url_login", "iban", "ssn", "account")
KINDS = BASE_KINDS + CUE_KINDS

Span = tuple[str, int, int]

_ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
_LOCAL = frozenset(_ALNUM + "._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# No match of ip can start behind a digit: digit runs are taken whole. Saying so keeps long runs linear.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_SPELLED_AT = (" at ", " AT ", "[at]", "(at)", "{at}", "[AT]", "(AT)", "{AT}")
_SPELLED_DOMAIN = re.compile(
    r"\x20?([A-Za-z0-9-]+)((?:\x20?[\[({]\x20?(?:dot|DOT)\x20?[\])}]\x20?|\x20(?:dot|DOT)\x20)[A-Za-z0-9-]+)+"
)
_LOGIN = re.compile(r"[A-Za-z0-9._%+-]+:[^\s/@:]+@[A-Za-z0-9.-]+")
_CUES = {
    "iban": re.compile(r"[\s:=#.-]{0,4}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Za-z0-9])"),
    "ssn": re.compile(r"[\s:=#.-]{0,4}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])"),
    "account": re.compile(r"(?:\x20(?:no|number|nr)\.?)?[\s:=#.-]{1,4}([0-9]{6,17})(?![0-9])"),
}
_CUE_WORDS = {
    "iban": ("iban", "Iban", "IBAN"),
    "ssn": ("ssn", "SSN", "social security number", "Social Security Number"),
    "account": ("account", "Account", "ACCOUNT", "acct", "Acct", "passport", "Passport", "konto", "Konto"),
}


@lru_cache(1)
def _anchors() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    automaton.add_word("@", ("email", 1))
    automaton.add_word("://", ("url_login", 3))
    for word in _SPELLED_AT:
        automaton.add_word(word, ("email_spelled", len(word)))
    for kind, words in _CUE_WORDS.items():
        for word in words:
            automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    return automaton


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = value * 2 - 9 if value > 4 else value * 2
        total += value
    return total % 10 == 0


def _iban(value: str) -> int:
    """How many characters of ``value`` are a valid IBAN; words behind it are given up one by one."""
    while len(plain := value.replace(" ", "")) >= 15:
        if int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1:
            return len(value)
        value = value.rpartition(" ")[0]
    return 0


def _walk_left(text: str, at: int, floor: int) -> int:
    while at > floor and text[at - 1] in _LOCAL:
        at -= 1
    return at


def _email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The address around the at-sign at ``at``; it takes nothing before ``floor``."""
    start = _walk_left(text, at, floor)
    if start == at:
        return None
    domain = _DOMAIN.match(text, at + 1)
    return (start, domain.end()) if domain else None


def _spelled(text: str, start: int, end: int) -> tuple[int, int] | None:
    left = start - 1 if start and text[start - 1] == " " and text[start] != " " else start
    begin = _walk_left(text, left, 0)
    domain = _SPELLED_DOMAIN.match(text, end)
    return (begin, domain.end()) if begin < left and domain else None


def _digits(value: str) -> str:
    return re.sub(r"[^0-9]", "", value)


def find_spans(text: str) -> list[Span]:
    """All spans by kind as in ``KINDS``, then by start. Spans of one kind never overlap."""
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    ends = dict.fromkeys(KINDS, 0)

    def add(kind: str, span: tuple[int, int] | None) -> None:
        if span and span[0] >= ends[kind]:
            found[kind].append(span)
            ends[kind] = span[1]

    if text:
        for last, (kind, length) in _anchors().iter(text):
            end = last + 1
            if kind == "email":
                if last >= ends[kind]:
                    add(kind, _email(text, last, ends[kind]))
            elif kind == "email_spelled":
                add(kind, _spelled(text, end - length, end))
            elif kind == "url_login":
                login = _LOGIN.match(text, end)
                add(kind, login and login.span())
            else:
                value = _CUES[kind].match(text, end)
                length = value and (_iban(value[1]) if kind == "iban" else len(value[1]))
                if length:
                    add(kind, (value.start(1), value.start(1) + length))
        for match in _IP.finditer(text):
            parts = [p.lstrip("0") or "0" for p in match.groups()]
            if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                found["ip"].append(match.span())
        for match in _CARD.finditer(text):
            digits = _digits(match[0]) if match.end() - match.start() >= 13 else ""
            if 13 <= len(digits) <= 19 and luhn(digits):
                found["card"].append(match.span())
        for match in _PHONE.finditer(text):
            if 9 <= len(_digits(match[0])) <= 15:
                found["phone"].append(match.span())
    return [(kind, start, end) for kind in KINDS for start, end in found[kind]]


def redact_text(text: str) -> str:
    """Every span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    spans = sorted(find_spans(text), key=lambda s: (s[1], -s[2]))
    if not spans:
        return text
    out, at, merged = [], 0, []
    for kind, start, end in spans:
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([kind, start, end])
    for kind, start, end in merged:
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _digest(text: str) -> tuple:
    spans = find_spans(text)
    base = [s for s in spans if s[0] in BASE_KINDS]
    counts = [sum(s[0] == kind for s in base) for kind in BASE_KINDS]
    return (*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans))


def pii_digest(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: counts of the base kinds, a hash of their spans, and all spans."""
    names = [f"n_{kind}" for kind in BASE_KINDS]
    run = row_mapper(_digest, [*names, "base_sha256", "spans"], [pa.int64()] * 4 + [pa.string()] * 2)
    schema = "doc_id long, " + ", ".join(f"{n} long" for n in names) + ", base_sha256 string, spans string"
    return texts_of(docs, id_column, text_column).mapInArrow(run, schema)


def pii_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per span: doc_id, kind, start, end. Documents without spans give none."""
    schema = pa.schema([("doc_id", pa.int64()), ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column("doc_id").to_pylist()
            rows = [(d, *s) for d, t in zip(ids, batch.column("text").to_pylist(), strict=True) for s in find_spans(t)]
            columns = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return texts_of(docs, id_column, text_column).mapInArrow(run, "doc_id long, kind string, start long, end long")


def redact(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """All rows and columns, with personal data in the text replaced. NULL stays NULL."""
    clean = F.pandas_udf(lambda texts: texts.map(redact_text, na_action="ignore"), "string")
    return docs.withColumn(text_column, clean(F.col(text_column)))
