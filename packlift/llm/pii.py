"""PII: patterns propose spans, checksums confirm them, context adjusts the score.

Base kinds, leftmost and non-overlapping per kind, always reported: ``email``,
``ip`` (parts up to 255), ``card`` (16 to 19 digits passing Luhn), ``phone``
(international, 8 to 15 digits). Added kinds are reported if their score
reaches ``THRESHOLD`` and they overlap no base span: ``iban`` (confirmed by its
mod-97 checksum), ``card_short`` (13 to 15 digits passing Luhn) and
``phone_local`` (7 to 12 digits in groups, no country code). A span's score
starts from its kind and validator; ``CONTEXT`` words in the ``WINDOW``
characters on either side raise it, ``COUNTER`` words lower it.

Every pattern takes time linear in the text: e-mail addresses are grown from
their ``@``, and digit patterns start only at the first digit of a run.

Defined cases: a null or empty text has no spans; repeated rows are each
reported; an empty table gives an empty result; other columns are ignored. In
``mask`` overlapping spans become one, named after the first; a null text stays
null; ``n_chars`` follows the masked text.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packlift.llm.common import fresh, hex_digest, rows_udf, text_of

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "card_short", "phone_local")
THRESHOLD = 0.6
WINDOW = 40
START_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.85, "card_short": 0.35, "phone_local": 0.3}
# Fixed word lists (lower case).
CONTEXT = {
    "email": {"mail", "email", "e-mail", "contact", "write", "reply"},
    "ip": {"ip", "address", "host", "server", "login", "client"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "debit", "payment", "karte", "carte", "tarjeta"},
    "card_short": {"card", "visa", "mastercard", "amex", "credit", "debit", "payment", "karte", "carte", "tarjeta"},
    "phone": {"phone", "tel", "telephone", "call", "mobile", "fax", "cell", "telefon", "teléfono", "téléphone"},
    "phone_local": {"phone", "tel", "telephone", "call", "mobile", "fax", "cell", "telefon", "teléfono", "téléphone"},
    "iban": {"iban", "account", "bank", "transfer", "konto", "compte", "cuenta"},
}
COUNTER = {
    "email": {"example", "noreply"}, "ip": {"version", "release", "section", "chapter"},
    "card": {"isbn", "order", "serial", "tracking"}, "card_short": {"isbn", "order", "serial", "tracking"},
    "phone": {"isbn", "order", "serial"}, "phone_local": {"isbn", "order", "serial", "version"}, "iban": {"serial"},
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_LOCAL_PHONE = re.compile(r"(?<![0-9A-Za-z+.-])(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20-][0-9]{3,4}[\x20-][0-9]{3,4}(?![0-9A-Za-z.-])")
_ANY_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")
_DROP = str.maketrans("", "", " -")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(text: str) -> bool:
    moved = text[4:] + text[:4]
    rest = 0
    for c in moved:
        value = int(c, 36)
        rest = (rest * (100 if value > 9 else 10) + value) % 97
    return rest == 1


def emails(text: str) -> list[tuple[int, int]]:
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    return out


def _phone_spans(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m.group()) <= 15]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by kind, then start."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if not _ANY_DIGIT.search(text):
        return out
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split("."))]
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().translate(_DROP)
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", a, b) for a, b in _phone_spans(text)]
    return out


def added_candidates(text: str) -> list[tuple[str, int, int]]:
    if not _ANY_DIGIT.search(text):
        return []
    out = [("iban", *m.span()) for m in _IBAN.finditer(text)
           if 15 <= len(m.group().replace(" ", "")) <= 34 and mod97(m.group().replace(" ", ""))]
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().translate(_DROP)
            if 13 <= len(digits) <= 15 and luhn(digits):
                out.append(("card_short", *m.span()))
    out += [("phone_local", *m.span()) for m in _LOCAL_PHONE.finditer(text)]
    return out


def context_score(text: str, kind: str, start: int, end: int) -> float:
    around = text[max(0, start - WINDOW):start] + " " + text[end:end + WINDOW]
    words = set(_WORD.findall(around.lower()))
    score = START_SCORE[kind] + 0.35 * bool(words & CONTEXT[kind]) - 0.35 * bool(words & COUNTER[kind])
    return min(max(score, 0.0), 1.0)


def spans(text: str) -> list[tuple[str, int, int, float]]:
    """All spans with scores: base ones by kind and start, then added ones."""
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    out = [(k, a, b, context_score(text, k, a, b)) for k, a, b in base]
    for kind, a, b in added_candidates(text):
        if any(x < b and a < y for x, y in taken):
            continue
        score = context_score(text, kind, a, b)
        if score >= THRESHOLD:
            out.append((kind, a, b, score))
            taken.append((a, b))
    order = {k: i for i, k in enumerate(BASE_KINDS + ADDED_KINDS)}
    return sorted(out, key=lambda s: (order[s[0]], s[1]))


def masked(text: str) -> str:
    found = sorted((a, b, k) for k, a, b, _ in spans(text))
    if not found:
        return text
    out, last = [], 0
    merged: list[list] = []
    for a, b, kind in found:
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b, kind])
    for a, b, kind in merged:
        out += [text[last:a], f"<{kind.split('_')[0].upper()}>"]
        last = b
    return "".join([*out, text[last:]])


def _report(text: str) -> tuple:
    found = spans(text)
    base = [s for s in found if s[0] in BASE_KINDS]
    counts = [sum(s[0] == k for s in base) for k in BASE_KINDS]
    text_of_spans = [f"{k}:{a}:{b}" for k, a, b, _ in found]
    return (*counts, hex_digest(",".join(f"{k}:{a}:{b}" for k, a, b, _ in base)), ",".join(text_of_spans),
            ",".join(f"{s[3]:.2f}" for s in found))


REPORT = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, scores string"


def pii(docs: DataFrame) -> DataFrame:
    """Counts, digests and spans of every row of ``docs``."""
    report = rows_udf(lambda: lambda texts: [_report(t) for t in texts], REPORT)
    return docs.select("doc_id", report(text_of()).alias("r")).select("doc_id", "r.*")


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with each span of the text replaced by its kind's tag."""
    new, = fresh(docs, "masked")
    masker = rows_udf(lambda: lambda texts: [(masked(t),) for t in texts], "text string")
    changed = docs.withColumn(new, masker(text_of())["text"])
    out = {"text": F.when(F.col("text").isNotNull(), F.col(new))}
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out["n_chars"] = F.when(F.col("text").isNotNull(), F.char_length(new).cast(kind)).otherwise(F.col("n_chars"))
    return changed.select(*[out.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
