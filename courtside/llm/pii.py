"""Personal data by anchor expansion.

One Aho-Corasick pass finds anchors in a whole text: at-signs, ``://`` of a scheme, plus signs,
digits and cue words of identifiers. A small deterministic parser at each anchor expands to the
boundaries of an email, an address or an account and validates it. No pattern is searched from
every position, so a text costs time in proportion to its length, however long its runs are.

Base kinds (leftmost non-overlapping per kind; a match that fails its test is dropped):
``email``; ``ip``, four parts of at most 255; ``card``, 16 to 19 digits passing Luhn; ``phone``, a
plus sign and 8 to 15 digits. Added kinds: ``login``, the user part before an at-sign behind a
scheme when it holds a password; ``ip6``, an IPv6 address in brackets behind a scheme; ``iban``,
cue and check digits; ``account``, a cue and 6 to 17 digits (a cue ``ssn`` needs a valid 3-2-4
number, its groups apart by a hyphen, a space or nothing). Cues match in any case of their letters. Added spans other than logins that overlap a base span are left out.

Defined results: a null text is empty and has no spans; offsets are code points, end exclusive;
repeated rows are independent; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("login", "ip6", "iban", "account")
SPAN_TYPE = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType())]))

# Cue words that announce an identifier (fixed values, lower case).
CUES = ("account", "account number", "account no", "acct", "ssn", "social security number", "iban",
        "kontonummer", "konto", "compte", "cuenta", "passport", "routing number")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_SPACED = re.compile(r"[0-9](?:[ -]?[0-9])*")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_AUTHORITY = re.compile(r"[^\s/?#\"'<>]+")
_IP6 = re.compile(r"\[([0-9A-Fa-f:]{2,39})\]")
_AFTER_CUE = re.compile(r"(?:[ \t]*(?:no\.?|number|#|is|:|=))*[ \t]*", re.I)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_SSN = re.compile(r"([0-9]{3})[- ]?([0-9]{2})[- ]?([0-9]{4})(?![0-9-])")
_ACCOUNT = re.compile(r"[A-Z]{0,3}[0-9](?:[ -]?[0-9]){5,16}(?![0-9])")


@lru_cache(maxsize=1)
def _anchors():
    import ahocorasick

    found = ahocorasick.Automaton()
    for word in ("@", "+", "://"):
        found.add_word(word, (word, len(word)))
    for digit in "0123456789":
        found.add_word(digit, ("0", 1))
    for cue in CUES:
        kind = "iban" if cue == "iban" else "ssn" if cue.startswith(("ssn", "social")) else "cue"
        found.add_word(cue, (kind, len(cue)))
    found.make_automaton()
    return found


def _lower(text: str) -> str:
    """The text with A to Z in lower case: every other character, and so every offset, stays."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _iban_ok(text: str) -> bool:
    text = text.replace(" ", "")
    return 15 <= len(text) <= 34 and int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def _ip6_ok(text: str) -> bool:
    groups = text.split(":")
    if any(len(g) > 4 for g in groups) or text.count("::") > 1 or ":::" in text:
        return False
    return len(groups) == 8 and all(groups) or "::" in text and len(groups) <= 8


def _account(text: str, at: int, kind: str) -> tuple[str, int, int] | None:
    """The identifier that follows a cue ending at ``at``."""
    if at < len(text) and text[at].isalnum():
        return None
    at = _AFTER_CUE.match(text, at).end()
    if m := _IBAN.match(text, at):
        # The country's length is unknown here: the longest valid reading wins.
        for end in range(m.end(), at + 14, -1):
            if text[end - 1] != " " and _iban_ok(text[at:end]):
                return "iban", at, end
    if kind == "iban":
        return None
    if kind == "ssn":
        m = _SSN.match(text, at)
        if m and m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000":
            return "account", at, m.end()
        return None
    if m := _ACCOUNT.match(text, at):
        return "account", at, m.end()
    return None


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of a text: by kind in the order of BASE_KINDS + ADDED_KINDS, then by start."""
    if not text:
        return []
    email, ip, card, phone, added = [], [], [], [], []
    email_end = ip_end = card_end = 0
    for last, (what, size) in _anchors().iter(_lower(text)):
        at = last - size + 1
        if what == "0":
            if at >= card_end:
                m = _SPACED.match(text, at)
                card_end = m.end()
                if card_end - at >= 16:
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        card.append(("card", at, card_end))
            if at >= ip_end:
                m = _DOTTED.match(text, at)
                ip_end = m.end()
                if ip_end - at >= 7:
                    parts, begin = m[0].split("."), at
                    for k in range(0, len(parts) - 3, 4):
                        four = parts[k:k + 4]
                        end = begin + sum(map(len, four)) + 3
                        if all(map(_small, four)):
                            ip.append(("ip", begin, end))
                        begin = end + 1
        elif what == "@":
            begin = at
            while begin > email_end and text[begin - 1] in _LOCAL:
                begin -= 1
            if begin < at and (m := _DOMAIN.match(text, at)):
                email.append(("email", begin, email_end := m.end()))
        elif what == "+":
            if m := _PHONE.match(text, at):
                if 8 <= sum(c in "0123456789" for c in m[0]) <= 15:
                    phone.append(("phone", at, m.end()))
        elif what == "://":
            if m := _AUTHORITY.match(text, last + 1):
                user, sign, _ = m[0].rpartition("@")
                if sign and ":" in user.strip(":"):
                    added.append(("login", m.start(), m.start() + len(user)))
                host = m.start() + (len(user) + 1 if sign else 0)
                if (v6 := _IP6.match(text, host)) and _ip6_ok(v6[1]):
                    added.append(("ip6", v6.start(1), v6.end(1)))
        elif at == 0 or not text[at - 1].isalnum():
            if found := _account(text, last + 1, what):
                added.append(found)
    base = email + ip + card + phone
    kept = {x for x in added if x[0] == "login" or not any(s < x[2] and x[1] < e for _, s, e in base)}
    return base + sorted(kept, key=lambda x: (ADDED_KINDS.index(x[0]), x[1], x[2]))


def redact(text: str | None, mark: str = "[{}]") -> str | None:
    """The text with each span replaced by its kind; overlapping spans give one mark, the first's."""
    if not text:
        return text
    out, at = [], 0
    for start, end, kind in sorted((s, -e, k) for k, s, e in find_spans(text)):
        if start >= at:
            out += [text[at:start], mark.format(kind)]
        at = max(at, -end)
    return "".join(out) + text[at:]


@F.pandas_udf(SPAN_TYPE)
def _spans(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: [{"kind": k, "start": s, "end": e} for k, s, e in find_spans(t)])


@F.pandas_udf(T.StringType())
def _redacted(texts: pd.Series) -> pd.Series:
    return texts.map(redact, na_action="ignore")


def spans(text: Column) -> Column:
    """The spans of a text column, an array of (kind, start, end)."""
    return _spans(text)


def find(docs: DataFrame, text_col: str = "text", out_col: str = "spans") -> DataFrame:
    """``docs`` with the spans of every whole text in ``out_col``."""
    small_batches(docs.sparkSession)
    return docs.withColumn(out_col, spans(F.col(text_col)))


def redact_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced by its kind in brackets."""
    small_batches(docs.sparkSession)
    return docs.withColumn(text_col, _redacted(F.col(text_col)))


def spans_text(found: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
