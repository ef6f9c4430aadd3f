"""Recursive walk of JSON documents as a table function."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@F.udtf(returnType="path string, key string, kind string, value string")
class WalkJson:
    """One row per value below the root: its pointer, its key (null in arrays), its
    kind and the text of scalars. Invalid or null text gives no rows."""

    def eval(self, raw: str) -> Iterator[tuple]:
        try:
            root = json.loads(raw) if raw is not None else None
        except ValueError:
            return
        work = [("", root)]
        while work:
            path, v = work.pop()
            below = list(v.items()) if isinstance(v, dict) else [(str(i), x) for i, x in enumerate(v)] if isinstance(v, list) else []
            for k, x in below:
                at = f"{path}/{k.replace('~', '~0').replace('/', '~1')}"
                kind = {dict: "object", list: "array", str: "string", bool: "boolean", type(None): "null", int: "integer", float: "number"}[type(x)]
                text = None if kind in ("object", "array", "null") else x if kind == "string" else json.dumps(x)
                yield at, k if isinstance(v, dict) else None, kind, text
                work.append((at, x))


def walk(df: DataFrame, raw: str) -> DataFrame:
    """The columns of ``df`` but ``raw``, and path, key, kind, value of each nested value."""
    spark = df.sparkSession
    spark.udtf.register("ledgerlake_walk_json", WalkJson)
    keep = [c for c in df.columns if c != raw]
    view = f"ledgerlake_walk_{uuid.uuid4().hex}"
    df.createTempView(view)
    columns = ", ".join(f"t.`{c}`" for c in keep)
    return spark.sql(f"SELECT {columns}{', ' if keep else ''}w.* FROM {view} t, LATERAL ledgerlake_walk_json(t.`{raw}`) w")


def normal_key(key: Column) -> Column:
    """A field name reduced to lower-case letters and digits."""
    return F.regexp_replace(F.lower(key), "[^a-z0-9]", "")


def is_forbidden(key: Column, forbidden: list[str]) -> Column:
    """Whether a field name is one of ``forbidden``, both reduced by ``normal_key``."""
    return normal_key(key).isin([re.sub("[^a-z0-9]", "", f.lower()) for f in forbidden])


def forbidden_fields(df: DataFrame, raw: str, forbidden: list[str]) -> DataFrame:
    """Rows of ``walk`` whose normalised key is one of ``forbidden``, at any depth."""
    return walk(df, raw).filter(is_forbidden(F.col("key"), forbidden))
