"""Secret scans: fixed patterns, and tokens that pass a battery of randomness tests.

A token of an inferred encoding (hexadecimal, base32, alphanumeric or base64) is turned into symbol numbers. Four tests ask
whether these are uniform and independent: two chi-squared tests of uniformity (quarters of the alphabet, and symbols modulo
4), a runs test about the alphabet's middle, and a test of serial correlation. Fisher's method joins them into one p-value,
which is uniform for random tokens and near 0 for names and prose.

False discoveries are controlled within each encoding and length band over the whole corpus, as short tokens tell less. Of the
tokens with a p-value over t, random ones are expected to be (1 - t) / (1 - HALF) times those over HALF; what exceeds that is
counted as false. A band's threshold is the smallest t at which that excess is within the allowed rate. A band with fewer than
FEW tokens over HALF tells too little for that; there a token is taken from a fixed p-value on, which depends on its length.
"""

from __future__ import annotations

import math
import re
from string import ascii_lowercase, ascii_uppercase, digits

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartlake.llm.tables import by_text

KINDS = ("assign", "access", "hex", "random")
# Patterns of the base kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

LEAST_TOKEN = 20
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
#: In the order in which they are tried.
ENCODINGS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": ascii_uppercase + "234567",
    "alnum": ascii_uppercase + ascii_lowercase + digits,
    "base64": ascii_uppercase + ascii_lowercase + digits + "+/",
    "base64url": ascii_uppercase + ascii_lowercase + digits + "-_",
}
NUMBERS = {name: {c: k for k, c in enumerate(letters)} for name, letters in ENCODINGS.items()}
#: Length bands begin here.
BANDS = (20, 24, 32, 48, 64, 128)
BINS = 200
HALF = 0.5
RATE = 0.05
FEW = 20
#: Fixed p-values of bands below and from 32 symbols on: of random tokens about 4 to 8 and 2 to 4 in a hundred are below.
LONE_SHORT, LONE_LONG = 0.05, 0.02


def inferred(token: str) -> str | None:
    """The first encoding whose alphabet holds the token's symbols; a token without letters is a number and has none."""
    body = token.rstrip("=")
    if not any(c.isalpha() for c in body):
        return None
    return next((name for name, letters in NUMBERS.items() if all(c in letters for c in body)), None)


def tail_normal(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def tail_chi3(x: float) -> float:
    return math.erfc(math.sqrt(x / 2)) + math.sqrt(2 * x / math.pi) * math.exp(-x / 2)


def battery(numbers: list[int], size: int) -> float:
    """One p-value for uniform, independent symbols of an alphabet of this size."""
    n = len(numbers)

    def chi(classes: list[int], parts: list[int]) -> float:
        seen = [0] * 4
        for c in classes:
            seen[c] += 1
        expected = [n * p / size for p in parts]
        return tail_chi3(sum((o - e) ** 2 / e for o, e in zip(seen, expected)))

    quarter = [4 * x // size for x in numbers]
    quarters = [sum(4 * x // size == k for x in range(size)) for k in range(4)]
    modulo = [sum(x % 4 == k for x in range(size)) for k in range(4)]
    p = [chi(quarter, quarters), chi([x % 4 for x in numbers], modulo)]
    high = [2 * x >= size for x in numbers]
    up, down = sum(high), n - sum(high)
    if up and down:
        runs, mean = 1 + sum(a != b for a, b in zip(high, high[1:])), 1 + 2 * up * down / n
        spread = (mean - 1) * (mean - 2) / (n - 1)
        p.append(tail_normal((runs - mean) / math.sqrt(spread)) if spread > 0 else 1e-12)
    else:
        p.append(1e-12)
    centre = sum(numbers) / n
    off = [x - centre for x in numbers]
    power = sum(x * x for x in off)
    p.append(tail_normal(sum(a * b for a, b in zip(off, off[1:])) / power * math.sqrt(n)) if power else 1e-12)
    half = -sum(math.log(max(x, 1e-12)) for x in p)  # half of Fisher's statistic, which has 8 degrees of freedom
    return math.exp(-half) * (1 + half + half**2 / 2 + half**3 / 6)


def band(length: int) -> int:
    return max(b for b in BANDS if b <= length)


def lone(band: int) -> float:
    return LONE_SHORT if band < 32 else LONE_LONG


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, str, int, float]]]:
    """Base spans (start, kind, end) in order, and tested tokens outside them (start, end, encoding, band, p)."""
    base: list[tuple[int, int, int]] = []
    folded = text.lower()
    if any(k in folded for k in KEYWORDS):
        base += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    tokens = []
    if any(len(w) >= LEAST_TOKEN for w in text.split()):
        if "AKIA" in text:
            base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
        base += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= LEAST_HEX]
        for m in TOKEN.finditer(text):
            if any(a < m.end() and m.start() < b for a, _, b in base):
                continue
            name = inferred(m[0])
            if name:
                numbers = NUMBERS[name]
                found = [numbers[c] for c in m[0].rstrip("=")]
                if len(found) >= LEAST_TOKEN:
                    tokens.append((m.start(), m.end(), name, band(len(found)), battery(found, len(numbers))))
    return sorted(base), tokens


def thresholds(docs: DataFrame, text: str = "text", rate: float = RATE) -> dict[tuple[str, int], float]:
    """The p-value from which on a token of an encoding and length band is taken, for bands of FEW tokens over HALF or more.

    2 where no threshold keeps the rate. Gathered as counts per encoding, band and one of BINS p-value bins, so what reaches the driver is bounded.
    """

    def kernel(texts: list[str]) -> list:
        return [[[{"encoding": e, "band": b, "bin": min(int(p * BINS), BINS - 1)} for _, _, e, b, p in scan(x)[1]] for x in texts]]

    kind = T.StructType.fromDDL("encoding string, band int, bin int")
    found = by_text(docs.select(F.col(f"`{text}`").alias("_body")), "_body", [T.StructField("tokens", T.ArrayType(kind))], kernel)
    counts = found.select(F.explode("tokens").alias("t")).select("t.*").groupBy("encoding", "band", "bin").agg(F.count("*").alias("n"))
    above = Window.partitionBy("encoding", "band").orderBy(F.desc("bin"))
    whole = Window.partitionBy("encoding", "band")
    taken = counts.withColumn("taken", F.sum("n").over(above)).withColumn(
        "random", F.sum(F.when(F.col("bin") >= HALF * BINS, F.col("n")).otherwise(0)).over(whole) / (1 - HALF)
    )
    false = F.greatest(F.col("taken") - F.col("random") * (1 - F.col("bin") / BINS), F.lit(0.0))
    fits = F.when(false <= rate * F.col("taken"), F.col("bin"))
    known = taken.where(F.col("random") * (1 - HALF) >= FEW)
    rows = known.groupBy("encoding", "band").agg(F.coalesce(F.min(fits), F.lit(2 * BINS)).alias("bin")).collect()
    return {(r["encoding"], r["band"]): r["bin"] / BINS for r in rows}


def _spans(text: str, limits: dict[tuple[str, int], float]) -> list[tuple[int, int, int]]:
    base, tokens = scan(text)
    return sorted(base + [(a, 3, b) for a, b, e, k, p in tokens if p >= limits.get((e, k), lone(k))])


SPAN = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
)


def with_secrets(docs: DataFrame, text: str = "text", column: str = "secrets", rate: float = RATE, keep_text: bool = False) -> DataFrame:
    """docs with an array of (kind, start, end) of every secret, by start and then kind; places count code points, end exclusive.

    Null texts have none. Without keep_text the text column goes; a column of docs with the new one's name is replaced.
    """
    limits = thresholds(docs, text, rate)

    def kernel(texts: list[str]) -> list:
        return [[[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in _spans(x, limits)] for x in texts]]

    return by_text(docs, text, [T.StructField(column, SPAN)], kernel, keep_text)


def secret_scan(docs: DataFrame, id: str = "doc_id", text: str = "text", rate: float = RATE) -> DataFrame:
    """(id, secrets) for every row; null and empty texts have an empty list; repeated rows are scanned one by one."""
    rows = docs.select(F.col(f"`{id}`").alias("_id"), F.col(f"`{text}`").alias("_body"))
    return with_secrets(rows, "_body", rate=rate).withColumnRenamed("_id", id)


def redacted(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", rate: float = RATE) -> DataFrame:
    """docs with every secret in the text replaced by mark, overlapping ones by one; null texts stay null; no row goes."""
    limits = thresholds(docs, text, rate)

    def kernel(texts: list[str]) -> list:
        out = []
        for x in texts:
            parts, at = [], 0
            for a, _, b in _spans(x, limits):
                if a >= at:
                    parts += [x[at:a], mark]
                at = max(at, b)
            out.append("".join(parts) + x[at:])
        return [out]

    names = docs.columns
    row = F.struct(*[F.col(f"`{c}`") for c in names if c != text]) if len(names) > 1 else F.lit(None)
    packed = docs.select(row.alias("_row"), F.col(f"`{text}`").alias("_body"), F.col(f"`{text}`").isNull().alias("_none"))
    done = by_text(packed, "_body", [T.StructField("_clean", T.StringType())], kernel)
    clean = F.when(~F.col("_none"), F.col("_clean"))
    return done.select([clean.alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in names])
