"""Closed, versioned JSON contracts: a subset of JSON Schema over Arrow batches.

``compile_schema`` checks a schema and turns it into a tree of small test functions
once; documents are then judged by walking that tree. Findings carry no values.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from datetime import datetime
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.canonical import JsonRejected, canonical_text, strict_parse

Finding = tuple[str, str]
Test = Callable[[Any, str], Iterator[Finding]]

_TIME = re.compile(r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?Z", re.A)
_TYPES: dict[str, Callable[[Any], bool]] = {
    "null": lambda v: v is None,
    "boolean": lambda v: isinstance(v, bool),
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "string": lambda v: isinstance(v, str),
    "array": lambda v: isinstance(v, list),
    "object": lambda v: isinstance(v, dict),
}
_NOTES = {"$schema", "$id", "$defs", "title", "description"}


class SchemaError(ValueError):
    pass


def is_time(v: str) -> bool:
    if not _TIME.fullmatch(v):
        return False
    try:
        datetime.fromisoformat(v[:19])
    except ValueError:
        return False
    return True


def is_safe_path(v: str) -> bool:
    return bool(v) and not re.search(r"[\x00-\x1f\x7f\\]", v) and all(p not in ("", ".", "..") for p in v.split("/"))


class Compiler:
    """Tests for schemas that may refer to each other by ``$id`` and JSON Pointer."""

    def __init__(self, schemas: list[dict]):
        self.by_id = {s["$id"]: s for s in schemas if "$id" in s}
        if len(self.by_id) != sum("$id" in s for s in schemas):
            raise SchemaError("an $id is used twice")
        self.made: dict[int, Test] = {}

    def resolve(self, ref: str, root: dict) -> tuple[Any, dict]:
        base, _, pointer = ref.partition("#")
        root = self.by_id.get(base) if base else root
        if root is None:
            raise SchemaError(f"unknown $ref {ref}")
        node: Any = root
        for part in pointer.split("/")[1:] if pointer else []:
            try:
                key = part.replace("~1", "/").replace("~0", "~")
                node = node[int(key)] if isinstance(node, list) else node[key]
            except (KeyError, IndexError, ValueError):
                raise SchemaError(f"unknown $ref {ref}") from None
        return node, root

    def test(self, schema: Any, root: dict) -> Test:
        if schema is True:
            return lambda v, p: iter(())
        if schema is False:
            return lambda v, p: iter([(p, "FALSE_SCHEMA")])
        if not isinstance(schema, dict):
            raise SchemaError("a schema is an object or a boolean")
        if id(schema) in self.made:
            return self.made[id(schema)]
        parts: list[Test] = []
        # a schema may refer to itself: others get a test that looks the parts up when used
        self.made[id(schema)] = lambda v, p: (f for t in parts for f in t(v, p))
        kinds = schema.get("type")
        kinds = [kinds] if isinstance(kinds, str) else kinds
        if kinds is not None and (not kinds or any(k not in _TYPES for k in kinds)):
            raise SchemaError("unknown type")
        for keyword, arg in schema.items():
            if keyword in _NOTES or keyword in ("then", "else", "additionalProperties", "type"):
                continue
            make = getattr(self, "_" + keyword.lstrip("$"), None)
            if make is None:
                raise SchemaError(f"unknown keyword {keyword}")
            parts.append(make(arg, schema, root))
        if "additionalProperties" in schema and "properties" not in schema:
            parts.append(self._properties({}, schema, root))
        if kinds is not None:
            inner = list(parts)
            fits = [_TYPES[k] for k in kinds]
            # a value of the wrong type isn't looked into
            parts[:] = [lambda v, p: (f for t in inner for f in t(v, p)) if any(k(v) for k in fits) else iter([(p, "TYPE")])]
        return self.made[id(schema)]

    def _ref(self, arg, schema, root) -> Test:
        return self.test(*self.resolve(arg, root))

    def _allOf(self, arg, schema, root) -> Test:
        tests = [self.test(s, root) for s in arg]
        return lambda v, p: (f for t in tests for f in t(v, p))

    def _branches(self, arg, root) -> Callable[[Any, str], int]:
        tests = [self.test(s, root) for s in arg]
        return lambda v, p: sum(next(t(v, p), None) is None for t in tests)

    def _anyOf(self, arg, schema, root) -> Test:
        passed = self._branches(arg, root)
        return lambda v, p: iter(()) if passed(v, p) else iter([(p, "ANY_OF")])

    def _oneOf(self, arg, schema, root) -> Test:
        passed = self._branches(arg, root)
        return lambda v, p: iter(()) if passed(v, p) == 1 else iter([(p, "ONE_OF")])

    def _not(self, arg, schema, root) -> Test:
        passed = self._branches([arg], root)
        return lambda v, p: iter([(p, "NOT")]) if passed(v, p) else iter(())

    def _if(self, arg, schema, root) -> Test:
        passed = self._branches([arg], root)
        yes, no = (self.test(schema.get(k, True), root) for k in ("then", "else"))
        return lambda v, p: (yes if passed(v, p) else no)(v, p)

    def _const(self, arg, schema, root) -> Test:
        want = canonical_text(arg)
        return lambda v, p: iter(()) if canonical_text(v) == want else iter([(p, "CONST")])

    def _enum(self, arg, schema, root) -> Test:
        want = {canonical_text(a) for a in arg}
        return lambda v, p: iter(()) if canonical_text(v) in want else iter([(p, "ENUM")])

    def _required(self, arg, schema, root) -> Test:
        return lambda v, p: ((f"{p}/{k}", "REQUIRED") for k in arg if k not in v) if isinstance(v, dict) else iter(())

    def _properties(self, arg, schema, root) -> Test:
        tests = {k: self.test(s, root) for k, s in arg.items()}
        other = self.test(schema.get("additionalProperties", True), root)
        closed = schema.get("additionalProperties") is False

        def run(v, p):
            if isinstance(v, dict):
                for k, x in v.items():
                    if k in tests:
                        yield from tests[k](x, f"{p}/{k}")
                    elif closed:
                        yield p, "ADDITIONAL_PROPERTY"
                    else:
                        yield from other(x, f"{p}/{k}")

        return run

    def _items(self, arg, schema, root) -> Test:
        test = self.test(arg, root)
        return lambda v, p: (f for i, x in enumerate(v) for f in test(x, f"{p}/{i}")) if isinstance(v, list) else iter(())

    def _uniqueItems(self, arg, schema, root) -> Test:
        unique = lambda v: len({canonical_text(x) for x in v}) == len(v)
        return lambda v, p: iter([(p, "UNIQUE_ITEMS")]) if arg and isinstance(v, list) and not unique(v) else iter(())

    def _pattern(self, arg, schema, root) -> Test:
        try:
            regex = re.compile(arg)
        except re.error:
            raise SchemaError("bad pattern") from None
        return lambda v, p: iter([(p, "PATTERN")]) if isinstance(v, str) and not regex.search(v) else iter(())

    def _format(self, arg, schema, root) -> Test:
        tests = {"date-time": (is_time, "TIMESTAMP"), "safe-relative-path": (is_safe_path, "PATH")}
        if arg not in tests:
            raise SchemaError(f"unknown format {arg}")
        ok, code = tests[arg]
        return lambda v, p: iter([(p, code)]) if isinstance(v, str) and not ok(v) else iter(())


def _bound(kind: type | tuple, measure: Callable, wrong: Callable, code: str):
    def make(self, arg, schema, root) -> Test:
        return lambda v, p: iter([(p, code)]) if isinstance(v, kind) and not isinstance(v, bool) and wrong(measure(v), arg) else iter(())

    return make


for _name, _kind, _measure, _code in (
    ("Properties", dict, len, "PROPERTIES"),
    ("Items", list, len, "ITEMS"),
    ("Length", str, len, "LENGTH"),
    ("imum", (int, float), lambda v: v, "IMUM"),
):
    setattr(Compiler, f"_min{_name}", _bound(_kind, _measure, lambda a, b: a < b, f"MIN{'_' * (_code != 'IMUM')}{_code}"))
    setattr(Compiler, f"_max{_name}", _bound(_kind, _measure, lambda a, b: a > b, f"MAX{'_' * (_code != 'IMUM')}{_code}"))


class Registry:
    """Schemas by version: a document's ``schemaVersion`` chooses exactly one."""

    def __init__(self, schemas: dict[str, dict]):
        for version, s in schemas.items():
            if s.get("properties", {}).get("schemaVersion", {}).get("const") != version:
                raise SchemaError(f"{version}: schemaVersion isn't this constant")
        compiler = Compiler(list(schemas.values()))
        self.tests = {version: compiler.test(s, s) for version, s in schemas.items()}

    def judge(self, text: str | None, stored: bool = False, cap: int = 50) -> list[Finding]:
        """Sorted distinct findings of a document, ``cap`` at most. With ``stored`` the text
        has to be canonical and end in a line feed."""
        try:
            value = strict_parse(text if text is not None else "", "formal")
        except JsonRejected as e:
            return [("", "JSON_DEPTH" if e.args[0] == "JSON_DEPTH" else "JSON_PARSE")]
        found: set[Finding] = set()
        if stored and canonical_text(value) + "\n" != text:
            found.add(("", "CANONICAL"))
        version = value.get("schemaVersion") if isinstance(value, dict) else None
        if not isinstance(value, dict):
            found.add(("", "JSON_OBJECT"))
        elif version is None:
            found.add(("", "SCHEMA_REQUIRED"))
        elif version not in self.tests:
            found.add(("", "SCHEMA_UNKNOWN"))
        else:
            found.update(self.tests[version](value, ""))
        return sorted(found)[:cap]


def contract_findings(docs: DataFrame, key: str, column: str, schemas: dict[str, dict], stored: bool = False, cap: int = 50) -> DataFrame:
    """key, path, code of every violation; documents that keep their contract have no row."""
    Registry(schemas)  # a bad schema fails here, not in the executors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        registry = Registry(schemas)
        for b in batches:
            found = [[{"path": p, "code": c} for p, c in registry.judge(t, stored, cap)] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.struct([("path", pa.string()), ("code", pa.string())])))], ["key", "found"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(column).alias("raw")).mapInArrow(run, f"key {kind}, found array<struct<path:string,code:string>>")
    return rows.select(F.col("key").alias(key), F.inline("found"))


def trust_harness(golden: DataFrame, negatives: DataFrame, key: str, check: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Whether rules accept what is right and refuse what is not, for the right reason.

    golden: key and a document; negatives: the same and expected, the code that the fault
    planted in it must give. ``check`` makes findings (key, code) of documents. Returns
    key, expected (null for golden ones), codes, ok.
    """
    both = golden.withColumn("expected", F.lit(None).cast("string")).unionByName(negatives)
    found = check(both.drop("expected")).groupBy(key).agg(F.array_sort(F.collect_set("code")).alias("codes"))
    j = both.select(key, "expected").join(found, key, "left").withColumn("codes", F.coalesce("codes", F.array().cast("array<string>")))
    ok = F.when(F.col("expected").isNull(), F.size("codes") == 0).otherwise(F.array_contains("codes", F.col("expected")))
    return j.select(key, "expected", "codes", ok.alias("ok"))
