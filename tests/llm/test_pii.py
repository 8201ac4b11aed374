"""Personal data against plain regular expressions, checksums by their textbook forms, and words nearby."""

import hashlib
import random
import re
import time

from chartlake.llm import pii
from chartlake.llm.queries import QUERIES
from tests.llm.test_operators import ROWS, SCHEMA, table

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_luhn(digits):
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(c), 10)) for c in even)) % 10 == 0


def plain_base(text):
    only = lambda m: re.sub("[^0-9]", "", m[0])
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(only(m)) <= 19 and plain_luhn(only(m))]
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(only(m)) <= 15]
    return sorted(found)


def shown(spans):
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def random_texts():
    rnd = random.Random(11)
    out = []
    for letters in ("1 -", "12 .", "a@.-_b", "+1 ().-2", "0123456789- .@a+", "4111 -"):
        out += ["".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 120))) for _ in range(120)]
    cards = ["4111111111111111", "4111 1111 1111 1111", "3782-8224-6310-005", "é 4111 1111 1111 1111  5", "id 378282246310005.", "1 4111111111111111"]
    return out + cards + ["mail a.b+c@x-y.co.uk.", "a@b.c_d@e.f", "@a.b", "x@y", "1.2.3.4.5.6.7.8", "256.1.1.1 000255.1.1.1 1.1.1.1.", "漢字 +49 (30) 1234-5678 ü"]


def test_base_kinds_match_plain_patterns():
    for text in [*random_texts(), *[x or "" for _, x in ROWS]]:
        own = [(s.start, s.kind, s.end) for s in pii.scan(text) if s.kind < 4]
        assert own == plain_base(text), text


def test_words_and_checksums_decide_the_rest():
    def kinds(text):
        return [(pii.KINDS[s.kind], text[s.start : s.end]) for s in pii.scan(text)]

    iban = "DE89 3704 0044 0532 0130 00"
    assert kinds(f"Pay to {iban} now") == [("iban", iban)]
    assert kinds(f"to {iban} IS GOOD") == [("iban", iban)]
    assert kinds("GB82WEST12345698765432") == [("iban", "GB82WEST12345698765432")]
    assert kinds("GB83WEST12345698765432") == []
    # The same number counts with a word for it, not without one, and not beside one against it.
    assert kinds("my ssn is 123-45-6789.") == [("national_id", "123-45-6789")]
    assert kinds("see 123-45-6789.") == [] and kinds("my ssn, invoice 123-45-6789") == [] and kinds("ssn 000-45-6789") == []
    assert kinds("call (030) 555-01234 now") == [("local_phone", "(030) 555-01234")]
    assert kinds("row (030) 555-01234 now") == []
    # A card that the base pattern swallows together with other digits.
    assert kinds("visa card 4111 1111 1111 1111 123") == [("short_card", "4111 1111 1111 1111")]
    assert kinds("nr 4111 1111 1111 1111 123") == []
    assert all(s.score == 1.0 for s in pii.scan("credit card visa 4111111111111111"))


def test_long_texts_take_linear_time():
    started = time.time()
    n = 1 << 20
    for text in ("a" * n, "1" * n, "1 " * (n // 2), "1." * (n // 2), "+1" * (n // 2), "a@" * (n // 2), "AB12 " * (n // 5), "1-" * (n // 2), "(12) 345 " * (n // 9)):
        pii.scan(text)
    assert time.time() - started < 60


def test_tables(spark):
    rows = ROWS + [(9000 + k, x) for k, x in enumerate(random_texts()[::7])] + [(0, "a@b.co"), (0, "a@b.co"), (None, "1.2.3.4")]
    found = pii.personal_data(table(spark, rows)).collect()
    own = sorted(((r["doc_id"], shown([(s["start"], pii.KINDS.index(s["kind"]), s["end"]) for s in r["personal"]])) for r in found), key=repr)
    assert own == sorted(((k, shown([(s.start, s.kind, s.end) for s in pii.scan(x or "")])) for k, x in rows), key=repr)
    clash = pii.with_personal_data(table(spark, [(1, "a@b.co")]), column="n_words", keep_text=True)
    assert sorted(clash.columns) == sorted(["doc_id", "text", "rep", "n_words", "sequence_id", "part", "id"])
    assert pii.personal_data(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    result = QUERIES["op12_personal_data"](spark, sf).collect()
    assert len(result) == len(texts)
    for r in result:
        base = plain_base(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(s[1] == n for s in base) for n in range(4)]
        assert r["base_sha256"] == hashlib.sha256(shown(base).encode()).hexdigest()
        assert r["spans"] == shown([(s.start, s.kind, s.end) for s in pii.scan(texts[r["doc_id"]])])
