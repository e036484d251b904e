"""Personal data in texts: patterns propose spans, checksums confirm them, context words move the score.

Kinds and rules (positions are code points, the end is exclusive):

* ``email``, ``ip``, ``card``, ``phone``: the base patterns, leftmost and without overlap per kind. A card has 16 to 19
  digits and passes the Luhn check, a phone number has 8 to 15 digits, an address four parts up to 255; a proposal that fails is
  dropped and not tried again.
* ``iban``: two letters, two check digits, 11 to 30 letters or digits, in one run or in groups of four; confirmed by mod 97.
* ``card`` of 13 to 15 digits that passes Luhn, and ``phone`` in a local form: only where a context word lifts the score to
  the limit.

Every span carries a score: the base of its kind, plus :data:`CONTEXT_BONUS` if a context word of the kind stands within
:data:`CONTEXT_REACH` characters before it. Base spans stay whatever their score is.

All patterns take time linear in the text: runs start where they can start, and none is scanned twice.
Defined results: a null or empty text has no spans; rows repeat as they come; other columns pass through, and an existing
column of the output's name is replaced.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

KINDS = ("email", "ip", "card", "phone", "iban")
CONTEXT_REACH = 40
CONTEXT_BONUS = 0.35
KEEP_SCORE = 0.6

# Scores of confirmed proposals without context, and the words that speak for a kind.
BASE_SCORE = {"email": 0.9, "ip": 0.7, "card": 0.9, "phone": 0.7, "iban": 0.95, "short card": 0.4, "local phone": 0.3}
CONTEXT = {
    "email": "email e-mail mail contact write courriel correo",
    "ip": "ip host server address adresse dirección",
    "card": "card visa mastercard amex credit debit carte karte tarjeta kreditkarte",
    "phone": "phone tel call mobile fax telephone telefon telefono teléfono téléphone",
    "iban": "iban bank account konto compte cuenta",
}

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# The lookbehind is sound as a match of these two patterns never ends inside a run of digits.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+])\(?0?[0-9]{2,4}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
_WORDS = {
    kind: re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, words.split())) + r")(?!\w)", re.IGNORECASE)
    for kind, words in CONTEXT.items()
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    code = iban.replace(" ", "")
    return 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def emails(text: str):
    """Spans of the e-mail pattern. A match holds one @: walk to each, back over the local part, then match the domain."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _digits(s: str) -> str:
    return re.sub(r"[^0-9]", "", s)


def find_spans(text: str) -> list[tuple[str, int, int, float, bool]]:
    """Kind, start, end, score and whether the span is a base one, by kind as in :data:`KINDS`, then start."""
    found: dict[str, list] = {kind: [] for kind in KINDS}

    def add(kind: str, rule: str, start: int, end: int, base: bool) -> None:
        near = _WORDS[kind].search(text, max(0, start - CONTEXT_REACH), start)
        score = min(1.0, BASE_SCORE[rule] + (CONTEXT_BONUS if near else 0.0))
        if base or score >= KEEP_SCORE:
            found[kind].append((kind, start, end, score, base))

    for start, end in emails(text):
        add("email", "email", start, end, True)
    if re.search("[0-9]", text):
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") or "0" for p in m.group().split(".")]  # int() refuses thousands of digits, zeros too
            if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                add("ip", "ip", m.start(), m.end(), True)
        for m in _CARD.finditer(text):
            digits = _digits(m.group()) if m.end() - m.start() <= 40 else ""
            if 13 <= len(digits) <= 19 and luhn(digits):
                base = len(digits) >= 16
                add("card", "card" if base else "short card", m.start(), m.end(), base)
        taken = []
        for m in _PHONE.finditer(text):
            taken.append(m.span())
            if 8 <= len(_digits(m.group())) <= 15:
                add("phone", "phone", m.start(), m.end(), True)
        here = 0
        for m in _LOCAL_PHONE.finditer(text):
            while here < len(taken) and taken[here][1] <= m.start():
                here += 1
            if here == len(taken) or taken[here][0] >= m.end():
                add("phone", "local phone", m.start(), m.end(), False)
        for m in _IBAN.finditer(text):
            if mod97(m.group()):
                add("iban", "iban", m.start(), m.end(), False)
    return [s for kind in KINDS for s in sorted(found[kind], key=lambda s: (s[1], s[2]))]


SPAN_TYPE = "array<struct<kind:string,start:int,end:int,score:double,base:boolean>>"
_ARROW = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("base", pa.bool_())])
)


def _spans(texts: pa.Array) -> pa.Array:
    names = ("kind", "start", "end", "score", "base")
    rows = [[dict(zip(names, s, strict=True)) for s in find_spans(v.as_py() or "")] for v in texts]
    return pa.array(rows, type=_ARROW)


def with_spans(df: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """Add ``out``: the spans of personal data, by kind, then start."""
    return df.withColumn(out, arrow_udf(_spans, SPAN_TYPE)(F.col(text).cast("string")))


def redact(df: DataFrame, text: str = "text", out: str = "redacted", spans: str = "spans") -> DataFrame:
    """Add ``out``: the text with every span replaced by its kind in angle brackets; overlapping spans count as one."""

    @arrow_udf("string")
    def cut(texts: pa.Array, found: pa.Array) -> pa.Array:
        out_rows = []
        for text_value, row in zip(texts, found, strict=True):
            value, parts, here = text_value.as_py(), [], 0
            for s in sorted(row.as_py() or [], key=lambda s: (s["start"], -s["end"])):
                if s["start"] >= here:
                    parts += [value[here : s["start"]], f"<{s['kind']}>"]
                here = max(here, s["end"])
            out_rows.append(None if value is None else "".join(parts) + value[here:])
        return pa.array(out_rows, type=pa.string())

    return df.withColumn(out, cut(F.col(text).cast("string"), F.col(spans)))


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined in their order."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
