"""Personal data: patterns propose spans, checksums confirm them, words nearby move their score.

Kinds ``email``, ``ip``, ``card`` and ``phone`` follow the contract's patterns and stay whatever their score. The method
adds ``iban`` (confirmed by mod-97) and ``ssn`` (no checksum exists, so words nearby must confirm it); an added span
stays if its score reaches ``KEEP``.

Each text is a task's own work: no shuffle, and memory for one batch of texts. All scans are linear in the text, also
for long runs of one character class. Offsets are code points, ends exclusive.

Defined results: null and empty texts have no spans. Repeated rows each get their spans. Other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEEP = 0.5
NEARBY = 48

# The contract's patterns. Possessive repeats match the same and never look back over a run.
EMAIL_HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
EMAIL_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# The method's own.
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}+")
WORD_GOES_ON = re.compile(r"[A-Za-z0-9]")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
DIGIT = re.compile(r"[0-9]")

# Length of an account number by country, from the public registry of the standard.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24,
    "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SA": 24, "SE": 24, "SI": 19,
    "SK": 24, "SM": 27, "TR": 26,
}

# Kinds in the contract's order with their score before context, then the added ones.
KINDS = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.3}
BASE = ("email", "ip", "card", "phone")
FOR = {
    "email": ("mail", "contact", "write to"),
    "ip": ("address", "host", "login", "server"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "call", "tel", "mobile"),
    "iban": ("iban", "account", "bank", "konto"),
    "ssn": ("ssn", "social security", "taxpayer"),
}
AGAINST = {
    "email": ("noreply", "no-reply"),
    "ip": ("version", "release", "section"),
    "card": ("order", "invoice", "isbn", "tracking"),
    "phone": ("fax",),
    "iban": ("sample", "serial"),
    "ssn": ("serial", "part no", "version"),
}


def luhn(digits: str) -> bool:
    """Checksum of payment cards: from the right, every second digit counts twice."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Checksum of bank accounts: first four characters to the end, letters as 10 to 35."""
    return 15 <= len(account) <= 34 and int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ outwards: the same spans as matching the whole pattern from the left."""
    last, at = 0, text.find("@")
    while at >= 0:
        host = EMAIL_HOST.match(text, at)
        start = at
        while host and start > last and text[start - 1] in EMAIL_NAME:
            start -= 1
        if start < at:
            last = host.end()
            yield start, last
        at = text.find("@", max(at + 1, last))


def _only_digits(found: str) -> str:
    return "".join(c for c in found if c in "0123456789")


def _octets(found: str) -> bool:
    parts = (part.lstrip("0") for part in found.split("."))
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def _is_card(found: str) -> bool:
    digits = _only_digits(found)
    return 12 <= len(digits) <= 19 and luhn(digits)


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Accounts that end at a word's end: at the country's length, or where that is not known at the last confirmed one.

    Upper-case words may follow an account, so the longest run is only a bound.
    """
    m = IBAN.search(text)
    while m:
        found, after = m.group(), m.start() + 2
        length = IBAN_LENGTHS.get(found[:2])
        # Ends of words, the last one first; the run itself may end inside of a word.
        ends = [k for k, c in enumerate(found) if c == " "]
        if not WORD_GOES_ON.match(text, m.end()):
            ends.append(len(found))
        for end in reversed(ends):
            account = found[:end].replace(" ", "")
            if len(account) < (length or 15):
                break
            if (not length or len(account) == length) and mod97(account):
                after = m.start() + end
                yield m.start(), after
                break
        m = IBAN.search(text, after)


def _proposals(text: str) -> Iterator[tuple[str, int, int]]:
    """Confirmed spans of all kinds."""
    if "@" in text:
        for a, b in _emails(text):
            yield "email", a, b
    if not DIGIT.search(text):
        return
    checks = (
        ("ip", IP, _octets),
        ("card", CARD, _is_card),
        ("phone", PHONE, lambda s: 9 <= len(_only_digits(s)) <= 15),
        ("ssn", SSN, lambda s: s[:3] not in ("000", "666") and s[0] != "9"),
    )
    for kind, pattern, confirmed in checks:
        for m in pattern.finditer(text):
            if confirmed(m.group()):
                yield kind, m.start(), m.end()
    for a, b in _ibans(text):
        yield "iban", a, b


def score(text: str, kind: str, start: int, end: int) -> float:
    """Score of a kind, moved by the words before and after the span."""
    around = (text[max(0, start - NEARBY) : start] + " " + text[end : end + NEARBY]).lower()
    value = KINDS[kind]
    value += 0.3 * any(w in around for w in FOR[kind])
    value -= 0.3 * any(w in around for w in AGAINST[kind])
    return round(min(1.0, max(0.0, value)), 2)


def spans_of(text: str | None) -> list[dict]:
    """All spans of a text by start, then kind."""
    rank = {kind: k for k, kind in enumerate(KINDS)}
    found = []
    for kind, a, b in _proposals(text or ""):
        value = score(text, kind, a, b)
        if kind in BASE or value >= KEEP:
            found.append({"kind": kind, "start": a, "end": b, "score": value})
    return sorted(found, key=lambda s: (s["start"], rank[s["kind"]]))


SPANS = T.ArrayType(
    T.StructType(
        [T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())]
    )
)


def find_pii(docs: DataFrame, text: str = "text", spans: str = "spans", keep_text: bool = True) -> DataFrame:
    """``docs`` with an array of spans (kind, start, end, score), in place of a column of that name; with or without the text."""
    rest = [c for c in docs.columns if c != spans and (keep_text or c != text)]
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def each(batches):
        for batch in batches:
            found = [spans_of(t.as_py()) for t in batch.column(text)]
            columns = [batch.column(c) for c in rest] + [pa.array(found, pa.list_(item))]
            yield pa.RecordBatch.from_arrays(columns, names=[*rest, spans])

    schema = T.StructType([docs.schema[c] for c in rest] + [T.StructField(spans, SPANS)])
    return docs.mapInArrow(each, schema)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op2_pii(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_pii(docs, keep_text=False)
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id",
        *[of(kind) for kind in BASE],
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
        F.aggregate("spans", F.lit(0.0), lambda top, s: F.greatest(top, s["score"])).alias("top_score"),
    )
