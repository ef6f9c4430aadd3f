"""Predicates on paths and content addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.functions.canonical import nfc

CONTENT_ADDRESS = r"^objects/[a-z0-9-]+/sha256/([0-9a-f]{2})/([0-9a-f]{64})\.(?:json|jsonl|txt)$"
SHARD_NAME = r"^part-[0-9]{5}\.jsonl$"


def is_safe_relative(path: Column, normalised: bool = True) -> Column:
    """A relative POSIX path without empty, ``.`` or ``..`` parts, backslashes or controls, in NFC."""
    bad = path.rlike(r"^$|^/|\\|[\x00-\x1f\x7f]|(^|/)\.{0,2}(/|$)")
    ok = ~bad & (nfc(path) == path) if normalised else ~bad
    return F.coalesce(ok, F.lit(False))


def is_shard_name(name: Column) -> Column:
    return F.coalesce(name.rlike(SHARD_NAME), F.lit(False))


def is_content_address(path: Column, sha256: Column) -> Column:
    """The path's digits are those of ``sha256``, and its folder their first two."""
    folder, digest = F.regexp_extract(path, CONTENT_ADDRESS, 1), F.regexp_extract(path, CONTENT_ADDRESS, 2)
    return F.coalesce((digest == sha256) & (folder == F.substring(digest, 1, 2)), F.lit(False))


def glob_regex(pattern: str) -> str:
    """A shell pattern as a regular expression over the whole path; ``*`` also crosses ``/``."""
    out = []
    for c in pattern:
        out.append({"*": ".*", "?": "."}.get(c) or ("\\" + c if c in r"\.+()[]{}^$|" else c))
    return "^" + "".join(out) + "$"


def matches_any(path: Column, patterns: list[str]) -> Column:
    """True where any of the shell patterns matches; compiled once, tested as one regex."""
    return F.coalesce(path.rlike("|".join(f"(?:{glob_regex(p)})" for p in patterns)), F.lit(False)) if patterns else F.lit(False)
