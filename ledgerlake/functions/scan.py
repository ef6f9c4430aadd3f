"""Personal-data and secret patterns as column expressions, with redacted findings.

A finding says where and what kind, never the value. All matching is in the JVM;
``(?U)`` gives digits and word boundaries their Unicode meaning.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.session import let

# fixed values: the patterns, and domains and networks that are reserved for examples
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,63}"
GOVERNMENT_ID = r"(?U)(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)"
PHONE = r"(?U)(?<!\d)(?:\+?1[\s.-]?)?(?:\(\d{3}\)|\d{3})[\s.-]\d{3}[\s.-]\d{4}(?!\d)"
IPV4 = r"(?U)(?<![\d.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?![\d.])"
CARD = r"(?U)(?<!\d)(?:\d[ -]?){13,19}(?!\d)"
PRIVATE_KEY = r"-{5}BEGIN (?:RSA |EC |DSA |OPENSSH )?PRIVATE KEY-{5}"
VCS_TOKEN = r"(?U)\b(?:gh[pousr]_[A-Za-z0-9]{36,255}|github_pat_[A-Za-z0-9_]{40,255})\b"
CLOUD_KEY = r"(?U)\b(?:AKIA|ASIA)[0-9A-Z]{16}\b"
CHAT_TOKEN = r"(?U)\bxox[baprs]-[A-Za-z0-9-]{20,}\b"
BEARER = r"(?U)(?i)\bbearer\s+[A-Za-z0-9._~+/=-]{24,}\b"
ASSIGNED = r"(?U)(?i)\b(?:api[_-]?key|access[_-]?token|client[_-]?secret|password)\s*[:=]\s*[\"']?[A-Za-z0-9._~+/=-]{16,}"
RESERVED_DOMAINS = (".example", ".invalid", ".test", "example.com", "example.net", "example.org")
DOCUMENTATION_NETWORKS = ("192.0.2.", "198.51.100.", "203.0.113.")


@dataclass(frozen=True)
class Pattern:
    """``cheap`` is a test that every text with a match passes; ``counts`` says which matches count.
    ``group`` is the part of a match that is its value; ``located`` takes patterns whose value is the whole match."""

    code: str
    regex: str
    cheap: str
    counts: str = ""
    group: int = 0


PATTERNS = (
    Pattern("PII_EMAIL", EMAIL, "@", "email"),
    Pattern("PII_GOVERNMENT_ID", GOVERNMENT_ID, "-"),
    Pattern("PII_PHONE", PHONE, ""),
    Pattern("PII_NETWORK_ADDRESS", IPV4, ".", "ip"),
    Pattern("PII_PAYMENT_CARD", CARD, "", "card"),
    Pattern("SECRET_PRIVATE_KEY", PRIVATE_KEY, "-----BEGIN "),
    Pattern("SECRET_GITHUB_TOKEN", VCS_TOKEN, "_"),
    Pattern("SECRET_AWS_ACCESS_KEY", CLOUD_KEY, "IA"),
    Pattern("SECRET_SLACK_TOKEN", CHAT_TOKEN, "xox"),
    Pattern("SECRET_BEARER_TOKEN", BEARER, ""),
    Pattern("SECRET_ASSIGNED_VALUE", ASSIGNED, ""),
)


def _counts(kind: str, match: Column) -> Column:
    if kind == "email":
        domain = F.lower(F.substring_index(match, "@", -1))
        return ~_any([domain.endswith(d) for d in RESERVED_DOMAINS])
    if kind == "ip":
        return ~_any([match.startswith(n) for n in DOCUMENTATION_NETWORKS])
    if kind == "card":
        digits = F.regexp_replace(match, r"[ -]", "")
        n = F.length(digits)
        return n.between(13, 19) & F.coalesce(F.call_function("luhn_check", digits), F.lit(False)) & ~digits.rlike(r"^(.)\1*$")
    return F.lit(True)


def _any(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def matches(text: Column, p: Pattern) -> Column:
    """array<string> of the matches of ``p`` that count; empty for null."""
    found = F.filter(F.regexp_extract_all(text, F.lit(p.regex), F.lit(p.group)), lambda m: _counts(p.counts, m))
    none = F.array().cast("array<string>")
    return F.when(F.contains(text, F.lit(p.cheap)), found).otherwise(none) if p.cheap else F.coalesce(found, none)


def has(text: Column, p: Pattern) -> Column:
    return F.size(matches(text, p)) > 0


def located(text: Column, p: Pattern) -> Column:
    """array<struct<code, line, column>> of all matches of ``p`` that count.

    The pieces between matches give the places: a match starts after the pieces and
    the matches before it.
    """
    both = F.struct(F.regexp_extract_all(text, F.lit(p.regex), F.lit(0)).alias("hits"), F.split(text, p.regex).alias("pieces"))
    return let(both, lambda b: _places(b["hits"], b["pieces"], p))


def _places(hits: Column, pieces: Column, p: Pattern) -> Column:
    def place(m: Column, i: Column) -> Column:
        part = lambda j: F.concat(F.get(pieces, j), F.when(j < i, F.get(hits, j)).otherwise(""))
        before = F.array_join(F.transform(F.sequence(F.lit(0), i), part), "")
        line = F.length(before) - F.length(F.replace(before, F.lit("\n"), F.lit(""))) + 1
        column = F.length(F.substring_index(before, "\n", -1)) + 1
        return F.struct(F.lit(p.code).alias("code"), line.alias("line"), column.alias("column"), m.alias("m"))

    placed = F.filter(F.transform(hits, place), lambda h: _counts(p.counts, h["m"]))
    return F.transform(placed, lambda h: F.struct(h["code"].alias("code"), h["line"].alias("line"), h["column"].alias("column")))


def findings(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, code, line, column of every finding: value-free, distinct.

    Rows without any cheap sign of a pattern are passed over before the regexes run;
    null texts have no findings.
    """
    hits = F.flatten(F.array(*[F.when(has(F.col(text), p), located(F.col(text), p)).otherwise(F.array().cast("array<struct<code:string,line:int,column:int>>")) for p in PATTERNS]))
    return df.select(F.col(key), F.explode(F.array_distinct(hits)).alias("h")).select(key, "h.code", "h.line", "h.column")
