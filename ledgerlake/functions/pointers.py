"""Extraction by path: dotted (``a.b.0``), ``$.a.b[0]``, or JSON Pointer (``/a/b/0``)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def parts(path: str) -> list[str]:
    if path in ("", "$"):
        return []
    if path.startswith("/"):
        return [p.replace("~1", "/").replace("~0", "~") for p in path[1:].split("/")]
    body = re.sub(r"\[(\d+)\]", r".\1", path[1:] if path.startswith("$") else path).strip(".")
    return body.split(".")


def variant_path(path: str) -> str:
    """The path as VARIANT functions take it; digits are an index. There a name can't be empty,
    nor hold a quote of either kind, or a question mark, together with a dot or bracket: ValueError."""
    return "$" + "".join(_step(p) for p in parts(path))


def _step(name: str) -> str:
    if name.isdigit():
        return f"[{name}]"
    for shape, without in (("['{}']", "'?"), ('["{}"]', '"?'), (".{}", ".[")):
        if name and not set(without) & set(name):
            return shape.format(name)
    raise ValueError(f"no VARIANT path leads to {name!r}")


def variant_step(name: Column) -> Column:
    """One step of such a path by a column's value; null where no path leads there."""
    shaped = lambda bad, a, b: F.when((name != "") & ~name.rlike(bad), F.concat(F.lit(a), name, F.lit(b)))
    number = F.when(name.rlike(r"^[0-9]+$"), F.concat(F.lit("["), name, F.lit("]")))
    return F.coalesce(number, shaped("['?]", "['", "']"), shaped('["?]', '["', '"]'), shaped(r"[.\[]", ".", ""))


def extract(raw: Column, path: str, kind: str = "string") -> Column:
    """The value at ``path`` of JSON text as ``kind``; null where it is missing, null or of another kind."""
    return F.try_variant_get(F.try_parse_json(raw), variant_path(path), kind)


def missing(raw: Column, path: str) -> Column:
    """True where the path leads nowhere; false for a JSON null, which is a value."""
    return F.try_variant_get(F.try_parse_json(raw), variant_path(path), "variant").isNull()
