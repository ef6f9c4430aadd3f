"""Driver-side sources of a few small documents: change sets, policies, schemas, catalogues."""

from __future__ import annotations

import re
import subprocess
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.functions.canonical import canonical_text, strict_parse
from ledgerlake.operators.contracts import Registry, SchemaError

CHANGES = "status string, path string, old_path string"


def parse_changes(raw: bytes) -> list[tuple[str, str, str | None]]:
    """Rows of ``git diff --name-status -z``: renames and copies have an old path before the new."""
    fields = [f.decode("utf-8", "surrogateescape") for f in raw.split(b"\0") if f]
    out, i = [], 0
    while i < len(fields):
        status = fields[i]
        if status[0] in "RC":
            out.append((status[0], fields[i + 2], fields[i + 1]))
            i += 3
        else:
            out.append((status[0], fields[i + 1], None))
            i += 2
    return out


def git_changes(spark: SparkSession, repository: str, base: str, head: str = "HEAD") -> tuple[DataFrame, int]:
    """The change set between two revisions, and the bytes of the diff."""
    run = lambda *a: subprocess.run(["git", "-C", repository, "diff", *a, base, head], check=True, capture_output=True).stdout
    return spark.createDataFrame(parse_changes(run("--name-status", "-z", "-M")), CHANGES), len(run())


def git_blob(repository: str, revision: str, path: str, cap: int = 1_000_000) -> bytes | None:
    """A regular file at a revision; None if it isn't there, isn't regular, or is over the cap."""
    listed = subprocess.run(["git", "-C", repository, "ls-tree", "-z", "-l", revision, "--", path], check=True, capture_output=True).stdout
    if not listed:
        return None
    mode, kind, _, size = listed.split(b"\t")[0].split()
    if kind != b"blob" or mode not in (b"100644", b"100755") or int(size) > cap:
        return None
    return subprocess.run(["git", "-C", repository, "show", f"{revision}:{path}"], check=True, capture_output=True).stdout


def load_documents(folder: str, names: list[str], canonical: bool = False) -> dict[str, dict]:
    """The named JSON documents of a folder, of one ``policyVersion``; strict, and with
    ``canonical`` byte for byte. These are configuration: small, and read by the driver."""
    out = {}
    for name in names:
        text = (Path(folder) / name).read_text(encoding="utf-8")
        value = strict_parse(text, "policy")
        if not isinstance(value, dict):
            raise ValueError(f"{name}: not an object")
        if canonical and canonical_text(value) + "\n" != text:
            raise ValueError(f"{name}: not canonical")
        out[name] = value
    if len({v.get("policyVersion") for v in out.values()}) > 1:
        raise ValueError("policies of several versions")
    return out


def check_policy(policy: dict, default: str = "deny", caps: dict[str, int] | None = None, rosters: dict[str, set[str]] | None = None) -> list[str]:
    """What weakens a policy: another default, a cap above the hard one, a roster that lacks a member."""
    found = []
    if policy.get("default") != default:
        found.append("POLICY_DEFAULT")
    for name, most in (caps or {}).items():
        v = policy.get(name)
        if not isinstance(v, int) or isinstance(v, bool) or not 0 < v <= most:
            found.append(f"POLICY_CAP:{name}")
    for name, members in (rosters or {}).items():
        if not members <= set(policy.get(name, [])):
            found.append(f"POLICY_ROSTER:{name}")
    return found


def load_registry(folder: str, versions: dict[str, str]) -> Registry:
    """A closed registry: the folder has exactly the files of ``versions`` (version: file)."""
    have = {str(p.relative_to(folder)) for p in Path(folder).rglob("*.schema.json")}
    if have != set(versions.values()):
        raise SchemaError("the folder's files aren't those of the registry")
    return Registry({v: strict_parse((Path(folder) / f).read_text(encoding="utf-8"), "formal") for v, f in versions.items()})


def _files(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql import functions as F

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    inside = "^(?:file:)?/*" + re.escape(folder.removeprefix("file://").strip("/")) + "/(.*)$"
    return files.withColumn("path", F.regexp_extract("path", inside, 1))


def _links(folder: str) -> list[str]:
    root = Path(folder.removeprefix("file://"))
    return [str(p.relative_to(root)) for p in root.rglob("*") if p.is_symlink()] if root.is_dir() else []


def artifacts(spark: SparkSession, folder: str, cap: int = 1_000_000) -> DataFrame:
    """path (relative) and content of the regular files of a folder that are within the cap.
    ``artifact_findings`` names the others."""
    from pyspark.sql import functions as F

    return _files(spark, folder).filter((F.col("length") <= cap) & ~F.col("path").isin(_links(folder))).select("path", "content")


def artifact_findings(spark: SparkSession, folder: str, cap: int = 1_000_000) -> DataFrame:
    """(path, code) of files that ``artifacts`` leaves out: over the cap, or, in a local checkout, links."""
    from pyspark.sql import functions as F

    large = _files(spark, folder).filter(F.col("length") > cap).select("path", F.lit("FILE_SIZE_LIMIT").alias("code"))
    return large.unionByName(spark.createDataFrame([(p, "SYMLINK_FORBIDDEN") for p in _links(folder)], "path string, code string"))
