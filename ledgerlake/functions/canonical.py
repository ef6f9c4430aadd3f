"""Strict JSON parsing and canonical JSON text, in Arrow batches.

Spark's own JSON readers accept what a verifiable lake must refuse (duplicate keys
after normalisation, trailing text, lone surrogates, deep nesting) and write numbers
and key order in their own way, so parsing and canonical text come from here; VARIANT
and ``get_json_object`` are for querying what has passed.

Modes: ``lake`` (NFC, finite floats), ``formal`` (NFC, no floats, no byte order mark,
bounded depth), ``policy`` (as parsed, finite floats, bounded depth), ``plain`` (as
parsed, no check of duplicates).
"""

from __future__ import annotations

import gzip
import io
import json
import math
import unicodedata
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_DEPTH = 64


class JsonRejected(ValueError):
    """The code of a refusal is its first argument."""


def _pairs(pairs: list[tuple[str, Any]]) -> dict[str, Any]:
    out = dict(pairs)
    if len(out) != len(pairs):
        raise JsonRejected("JSON_DUPLICATE_KEY")
    return out


def _no_constant(_: str) -> Any:
    raise JsonRejected("JSON_NON_FINITE")


def _no_float(_: str) -> Any:
    raise JsonRejected("JSON_FLOAT")


def depth(value: Any) -> int:
    """Containers on the longest way down; a scalar has none. Iterative."""
    deepest, level = 0, [value]
    while level := [x for x in level if isinstance(x, (dict, list))]:
        deepest += 1
        level = [y for x in level for y in (x.values() if isinstance(x, dict) else x)]
    return deepest


def _nfc(value: Any) -> Any:
    """Strings and keys in NFC; keys that meet there are refused."""
    if isinstance(value, str):
        return unicodedata.normalize("NFC", value)
    if isinstance(value, list):
        return [_nfc(x) for x in value]
    if isinstance(value, dict):
        out = {unicodedata.normalize("NFC", k): _nfc(v) for k, v in value.items()}
        if len(out) != len(value):
            raise JsonRejected("JSON_KEY_COLLISION")
        return out
    if isinstance(value, float) and not math.isfinite(value):
        raise JsonRejected("JSON_NON_FINITE")
    return value


def strict_parse(text: str, mode: str = "lake") -> Any:
    """The value of ``text``, or JsonRejected with a code."""
    if mode == "formal" and text.startswith("﻿"):
        raise JsonRejected("JSON_BOM")
    try:
        value = json.loads(
            text,
            parse_constant=_no_constant,
            parse_float=_no_float if mode == "formal" else None,
            object_pairs_hook=None if mode == "plain" else _pairs,
        )
        if mode in ("formal", "policy") and depth(value) > MAX_DEPTH:
            raise JsonRejected("JSON_DEPTH")
        return _nfc(value) if mode in ("lake", "formal") else value
    except RecursionError:
        raise JsonRejected("JSON_DEPTH") from None
    except JsonRejected:
        raise
    except ValueError:
        raise JsonRejected("JSON_INVALID") from None


def canonical_text(value: Any) -> str:
    """Compact JSON, keys by code point, text as it is; refused if it isn't UTF-8."""
    try:
        out = json.dumps(value, ensure_ascii=False, allow_nan=False, separators=(",", ":"), sort_keys=True)
        out.encode("utf-8")
    except UnicodeEncodeError:
        raise JsonRejected("JSON_SURROGATE") from None
    except ValueError:
        raise JsonRejected("JSON_NON_FINITE") from None
    return out


def parsed(raw: Column | str, mode: str = "lake") -> Column:
    """struct<ok, canonical, error, depth> of JSON text; null gives ok false and JSON_NULL."""

    @F.pandas_udf("ok boolean, canonical string, error string, depth int")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts:
                try:
                    if t is None:
                        raise JsonRejected("JSON_NULL")
                    value = strict_parse(t, mode)
                    rows.append((True, canonical_text(value), None, depth(value)))
                except JsonRejected as e:
                    rows.append((False, None, e.args[0], None))
            out = pd.DataFrame(rows, columns=["ok", "canonical", "error", "depth"])
            out["depth"] = out["depth"].astype("Int32")
            yield out

    return run(raw)


def canonical_json(raw: Column | str, mode: str = "lake") -> Column:
    """Canonical text of JSON text, null where it is refused."""
    return parsed(raw, mode)["canonical"]


def nfc(c: Column | str) -> Column:
    """A string in Unicode NFC."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))

    return run(c)


def deterministic_gzip(data: Column | str, level: int = 9) -> Column:
    """gzip bytes without a name and with time 0: equal input, equal output."""

    @F.pandas_udf("binary")
    def run(s: pd.Series) -> pd.Series:
        def one(b):
            if b is None:
                return None
            out = io.BytesIO()
            with gzip.GzipFile(filename="", mode="wb", compresslevel=level, fileobj=out, mtime=0) as f:
                f.write(bytes(b))
            return out.getvalue()

        return s.map(one)

    return run(data)


def leaves(value: Any, path: str = "") -> dict[str, Any]:
    """JSON Pointer: leaf. Empty containers are leaves."""
    out: dict[str, Any] = {}
    work = [(path, value)]
    while work:
        p, v = work.pop()
        if isinstance(v, dict) and v:
            work += [(f"{p}/{k.replace('~', '~0').replace('/', '~1')}", x) for k, x in v.items()]
        elif isinstance(v, list) and v:
            work += [(f"{p}/{i}", x) for i, x in enumerate(v)]
        else:
            out[p] = v
    return out


def json_leaves(raw: Column | str) -> Column:
    """map<pointer, canonical text> of a document's leaves; null for invalid text."""

    @F.pandas_udf("map<string,string>")
    def run(s: pd.Series) -> pd.Series:
        def one(t):
            try:
                return {k: canonical_text(v) for k, v in leaves(strict_parse(t, "policy")).items()} if t is not None else None
            except JsonRejected:
                return None

        return s.map(one)

    return run(raw)


def leaf_diff(control: Column | str, treatment: Column | str) -> Column:
    """array<struct<path, control_value, treatment_value, numeric_delta>> of the leaves
    that differ between two documents, by path; a missing leaf is null."""
    both = F.map_zip_with(json_leaves(control), json_leaves(treatment), lambda k, a, b: F.struct(k.alias("path"), a.alias("control_value"), b.alias("treatment_value")))
    differ = F.filter(F.map_values(both), lambda x: ~x["control_value"].eqNullSafe(x["treatment_value"]))
    with_delta = F.transform(
        differ, lambda x: x.withField("numeric_delta", x["treatment_value"].try_cast("double") - x["control_value"].try_cast("double"))
    )
    return F.array_sort(with_delta)
