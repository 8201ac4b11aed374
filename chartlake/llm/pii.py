"""Personal data: patterns propose spans, checksums confirm them, and words nearby raise or lower their score.

Each proposal starts with its kind's prior. A validator (Luhn for cards, modulo 97 for bank accounts, rules of structure for the
rest) adds to the score or takes the proposal out; each different word of the kind's vocabulary within reach adds, each opposing
word takes away. A proposal counts from LEAST_SCORE on. The base kinds are settled by pattern and validator alone: they always
count, and their score is only reported.

All searches are linear in the text's length, also where a run of digits or letters goes on for megabytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartlake.llm.tables import by_text

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "short_card", "national_id", "local_phone")

# Patterns and limits of the base kinds.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS = (14, 19)
PHONE_DIGITS = (10, 15)
#: Digits with single blanks or hyphens between them lie in such a run; two of those in a row end a card.
DIGIT_RUN = re.compile(r"[0-9][0-9\x20-]{7,}[0-9]")
GAP = re.compile(r"[\x20-]{2,}")

IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
NATIONAL_ID = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![0-9+()])(?:\([0-9]{2,5}\)\x20?|[0-9]{2,5}[\x20/-])[0-9]{3,4}[\x20-]?[0-9]{3,5}(?![0-9-])")
DIGIT = re.compile("[0-9]")
WORD = re.compile(r"[^\W\d_]+")

#: Characters on either side in which words are looked for, and what one of them adds or takes away.
REACH = 48
GAIN, LOSS, MOST_GAIN = 0.2, 0.3, 0.4
LEAST_SCORE = 0.6
#: Score by kind before words are looked at: the pattern, with the validator passed.
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.7, "iban": 0.7, "short_card": 0.5, "national_id": 0.4, "local_phone": 0.4}
FOR = {
    "email": {"mail", "email", "contact", "write", "correo", "courriel", "kontakt"},
    "ip": {"ip", "address", "host", "server", "login", "adresse"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "debit", "payment", "karte", "carte", "tarjeta"},
    "phone": {"phone", "tel", "telephone", "call", "mobile", "cell", "fax", "telefon", "teléfono", "téléphone", "whatsapp"},
    "iban": {"iban", "account", "bank", "bic", "konto", "compte", "cuenta", "banque"},
    "national_id": {"ssn", "social", "security", "taxpayer", "tin"},
}
FOR |= {"short_card": FOR["card"], "local_phone": FOR["phone"]}
AGAINST = {"isbn", "issn", "version", "order", "invoice", "sku", "serial", "part", "page", "example", "build", "doi"}


class Span(NamedTuple):
    start: int
    kind: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(code: str) -> bool:
    """Whether a bank account number's check digits fit: letters count from 10, the first four characters come last."""
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    at, done = text.find("@"), 0
    while at >= 0:
        m = HOST.match(text, at)
        start = at
        while m and start > done and text[start - 1] in LOCAL:
            start -= 1
        if m and start < at:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) < 3 or len(p) == 3 and p <= "255" for p in parts):
            yield m.span()


def digit_groups(text: str) -> Iterator[tuple[int, int]]:
    """Spans of digits with at most one blank or hyphen between two of them, of nine characters or more."""
    for m in DIGIT_RUN.finditer(text):
        at = m.start()
        for gap in GAP.finditer(text, *m.span()):
            yield at, gap.start()
            at = gap.end()
        yield at, m.end()


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def short_cards(text: str) -> Iterator[tuple[int, int]]:
    """In a group of digits that is no card as a whole: the leftmost runs of whole parts with 13 to 19 digits that pass Luhn."""
    parts = [m.span() for m in re.finditer("[0-9]+", text)]
    k = 0
    while k < len(parts):
        digits, found = "", None
        for j in range(k, len(parts)):
            if len(digits) + parts[j][1] - parts[j][0] > CARD_DIGITS[1]:
                break
            digits += text[slice(*parts[j])]
            if len(digits) >= 13 and digits[0] in "3456" and luhn(digits):
                found = j
        if found is not None:
            yield parts[k][0], parts[found][1]
            k = found
        k += 1


def possible_id(area: str, group: str, serial: str) -> bool:
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def ibans(text: str) -> Iterator[tuple[int, int]]:
    for m in IBAN.finditer(text):
        # Capitals that follow belong to the number only if its check digits say so: try its whole parts, longest first.
        ends = [m.end(), *[m.start() + k for k in range(len(m[0]) - 1, 14, -1) if m[0][k] == " "]]
        for end in ends:
            code = text[m.start() : end].replace(" ", "")
            if len(code) >= 15 and mod97(code):
                yield m.start(), end
                break


def nearby(text: str, start: int, end: int) -> set[str]:
    """The words, in lower case, that lie wholly or partly within REACH of a span."""
    return set(WORD.findall(text[max(0, start - REACH) : start].lower())) | set(WORD.findall(text[end : end + REACH].lower()))


def score(kind: str, words: set[str]) -> float:
    gain = min(MOST_GAIN, GAIN * len(words & FOR[kind]))
    return round(min(1.0, max(0.0, PRIOR[kind] + gain - LOSS * len(words & AGAINST))), 2)


def scan(text: str, least: float = LEAST_SCORE) -> list[Span]:
    """All spans in order of start, then kind."""
    base: list[tuple[str, int, int]] = []
    more: list[tuple[str, int, int]] = []
    if "@" in text:
        base += [("email", a, b) for a, b in emails(text)]
    if DIGIT.search(text):
        base += [("ip", a, b) for a, b in addresses(text)]
        for a, b in digit_groups(text):
            digits = digits_of(text[a:b]) if b - a <= 2 * CARD_DIGITS[1] else ""
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                base.append(("card", a, b))
            else:
                more += [("short_card", a + x, a + y) for x, y in short_cards(text[a:b])]
        if "+" in text:
            base += [("phone", *m.span()) for m in PHONE.finditer(text) if PHONE_DIGITS[0] <= len(digits_of(m[0])) <= PHONE_DIGITS[1]]
        more += [("iban", a, b) for a, b in ibans(text)]
        more += [("national_id", *m.span()) for m in NATIONAL_ID.finditer(text) if possible_id(*m.groups())]
        more += [("local_phone", *m.span()) for m in LOCAL_PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 13]
    out = [Span(a, KINDS.index(kind), b, score(kind, nearby(text, a, b))) for kind, a, b in base]
    taken = bytearray(len(text) if more else 0)
    if more:
        for _, a, b in base:
            taken[a:b] = b"\1" * (b - a)
    for kind, a, b in more:
        value = score(kind, nearby(text, a, b))
        if value >= least and taken.find(1, a, b) < 0:
            out.append(Span(a, KINDS.index(kind), b, value))
            taken[a:b] = b"\1" * (b - a)
    return sorted(out)


SPAN = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType()),
]))


def with_personal_data(docs: DataFrame, text: str = "text", column: str = "personal", least: float = LEAST_SCORE, keep_text: bool = False) -> DataFrame:
    """docs with an array of (kind, start, end, score) of all personal data, by start, then kind; places count code points.

    Null and empty texts have an empty array. Spans of the base kinds (email, ip, card, phone) are always in; those of the other
    kinds from a score of `least` on, where they overlap no span found before. Without keep_text the text column goes; a column
    of docs with the new one's name is replaced. Rows are scanned one by one: repeated rows and ids don't matter, no row goes.
    """

    def kernel(texts: list[str]) -> list:
        return [[[{"kind": KINDS[s.kind], "start": s.start, "end": s.end, "score": s.score} for s in scan(x, least)] for x in texts]]

    return by_text(docs, text, [T.StructField(column, SPAN)], kernel, keep_text)


def personal_data(docs: DataFrame, id: str = "doc_id", text: str = "text", least: float = LEAST_SCORE) -> DataFrame:
    """(id, personal) for every row; see with_personal_data. Other columns are ignored."""
    rows = docs.select(F.col(f"`{id}`").alias("_id"), F.col(f"`{text}`").alias("_body"))
    return with_personal_data(rows, "_body", least=least).withColumnRenamed("_id", id)
