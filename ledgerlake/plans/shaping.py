"""Raw exports as records: envelopes, aliases, deliberation, references, consent, blinding, steps and ticks.

Sources are JSON text; their parts are VARIANT columns, so that all shaping stays in the
JVM. A JSON null and a part that is absent are the same here. What breaks a rule gets
a code in ``errors`` or ``error``; no row is lost.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.canonical import canonical_json
from ledgerlake.functions.ids import json_string_digest, pseudonym, stable_id, utc_seconds
from ledgerlake.functions.paths import is_safe_relative
from ledgerlake.functions.pointers import variant_path, variant_step
from ledgerlake.functions.walk import walk

# fixed values: what a record says where its source is silent, and what may not leave a blind review
NOT_RECORDED = "No explicit public rationale was recorded."
SOURCE_DEFAULT, EXPORT_TYPE = "unassigned", "legacy_action_export"
LABEL_SCOPE = "public_dataset_label"
PUBLIC_REFERENCES = "exposed_reasoning_refs"
PRIVATE = (
    "adjudication", "agreement", "consent", "gold_label", "judgment", "judgments", "label", "reviewer", "reviewer_id",
    "actor_id", "agent_id", "model", "model_id", "operator", "owner", "provider",
)

NUMBER = r"^(BIGINT|INT|SMALLINT|TINYINT|FLOAT|DOUBLE|DECIMAL)"


def part(v: Column, *names: str, kind: str = "string") -> Column:
    """The first of ``names`` that an object has, as ``kind``; null if it has none of them."""
    return F.coalesce(*[F.try_variant_get(v, variant_path("/" + n), kind) for n in names])


def _type(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v), F.lit("VOID"))


def is_object(v: Column) -> Column:
    return _type(v).startswith("OBJECT")


def is_text(v: Column) -> Column:
    return _type(v) == "STRING"


def filled(c: Column) -> Column:
    """A string that isn't empty, else null."""
    return F.nullif(c, F.lit(""))


def moment(v: Column, *names: str) -> Column:
    """A time as UTC text of second precision; null where it is none."""
    return utc_seconds(F.try_to_timestamp(part(v, *names)))


def _codes(*rules: tuple[str, Column]) -> Column:
    """The codes of the rules that don't hold; a rule that is null is broken."""
    return F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(code)) for code, ok in rules]), lambda c: c.isNotNull())


# envelopes and ledger records


def unwrap(sources: DataFrame, raw: str, default_type: str) -> DataFrame:
    """``sources`` with value (the event, VARIANT), wrapped, source_id, source_type, lineage,
    content_sha256, first_seen_commit and last_seen_commit.

    An export holds the event under ``value`` and says where it comes from beside it; a
    bare event is its own value. A digest that the export doesn't give is that of the
    value's canonical text. Text that isn't JSON gives nulls.
    """
    v = F.try_parse_json(raw)
    inner = part(v, "value", kind="variant")
    d = sources.withColumn("wrapped", is_object(inner)).withColumn("value", F.when(F.col("wrapped"), inner).otherwise(v))
    own = F.when(F.col("wrapped"), F.get_json_object(raw, "$.value")).otherwise(F.col(raw))
    given = F.when(F.col("wrapped"), part(v, "contentSha256"))
    either = lambda a, b: F.when(F.col("wrapped"), a).otherwise(b)
    return (
        d.withColumn("content_sha256", F.coalesce(given, F.sha2(canonical_json(F.when(given.isNull(), own), "plain"), 256)))
        .withColumn("source_id", either(F.coalesce(part(v, "naturalId"), part(inner, "id")), part(v, "source_id", "id")))
        .withColumn("source_type", either(F.lit(EXPORT_TYPE), F.coalesce(part(v, "source_type"), F.lit(default_type))))
        .withColumn("lineage", F.coalesce(part(v, "lineage"), either(F.lit("unknown"), F.lit(SOURCE_DEFAULT))))
        .withColumn("first_seen_commit", either(part(v, "firstSeenCommit"), part(v, "commit")))
        .withColumn("last_seen_commit", either(part(v, "lastSeenCommit"), part(v, "commit")))
    )


def ledger_records(unwrapped: DataFrame, allowed: list[str], dataset: str = "d01") -> DataFrame:
    """``unwrapped`` with the record's fields and ``errors``: aliases are read in turn, and an
    empty message falls through to the description and then to a sentence."""
    v = F.col("value")
    outcome = part(v, "outcome", kind="variant")
    d = (
        unwrapped.withColumn("actor_id", F.coalesce(part(v, "agentId", "actor_id"), F.lit("unknown-agent")))
        .withColumn("event_type", F.coalesce(part(v, "type", "event_type"), F.lit("unknown")))
        .withColumn("world", F.coalesce(part(v, "world", "world_id"), F.lit("unknown")))
        .withColumn("observed_at", moment(v, "timestamp"))
    )
    sentence = F.concat(F.col("actor_id"), F.lit(" performed "), F.col("event_type"), F.lit(" in "), F.col("world"), F.lit("."))
    d = d.withColumn("text", F.coalesce(filled(part(v, "message")), filled(part(v, "description")), sentence))
    return d.withColumn("record_id", stable_id(dataset, F.col("lineage"), F.col("source_id"), F.col("content_sha256"))).withColumn(
        "errors",
        _codes(
            ("SOURCE_ID", F.length("source_id") > 0), ("SOURCE_TYPE", F.col("source_type").isin(allowed)),
            ("TIMESTAMP", F.col("observed_at").isNotNull()), ("OUTCOME", outcome.isNull() | is_object(outcome)),
        ),
    )


# deliberation, references and consent


def deliberation(v: Column, default_decision: Column) -> Column:
    """struct<confidence, decision, options_considered, provenance, status, summary, errors>.

    What isn't an object wasn't recorded. An explicit one needs a summary (or
    rationale), options that are strings, and a confidence within 0 and 1 if any.
    """
    told = is_object(v)
    confidence, options = part(v, "confidence", kind="variant"), part(v, "options_considered", "alternatives", kind="variant")
    number = F.when(_type(confidence).rlike(NUMBER), F.try_variant_get(confidence, "$", "double"))
    items = F.try_variant_get(options, "$", "array<variant>")
    shown = lambda *names: F.coalesce(*[F.when(is_text(part(v, n, kind="variant")), filled(part(v, n))) for n in names])
    summary = filled(F.trim(shown("summary", "rationale")))
    none = F.array().cast("array<string>")
    strings = F.transform(items, lambda x: F.when(is_text(x), F.try_variant_get(x, "$", "string")))
    errors = _codes(
        ("CONFIDENCE", confidence.isNull() | (_type(confidence) == "VOID") | number.between(0, 1)),
        ("SUMMARY", summary.isNotNull()),
        ("OPTIONS", options.isNull() | (_type(options) == "VOID") | F.forall(items, is_text)),
    )
    return F.struct(
        F.when(told, number).alias("confidence"),
        F.when(told, F.coalesce(part(v, "decision"), default_decision)).otherwise(default_decision).alias("decision"),
        F.when(told, F.coalesce(strings, none)).otherwise(none).alias("options_considered"),
        F.when(told, F.lit("participant_public_statement")).otherwise(F.lit("not_available")).alias("provenance"),
        F.when(told, F.lit("explicit")).otherwise(F.lit("not_recorded")).alias("status"),
        F.when(told, summary).otherwise(F.lit(NOT_RECORDED)).alias("summary"),
        F.when(told, errors).otherwise(none).alias("errors"),
    )


def public_references(v: Column) -> Column:
    """array<struct<consent, kind, uri>> of the references whose consent is public and that have a URI."""
    uri = lambda x: part(x, "uri", kind="variant")
    public = lambda x: (part(x, "consent") == "public") & is_text(uri(x)) & (F.length(part(x, "uri")) > 0)
    row = lambda x: F.struct(F.lit("public").alias("consent"), F.coalesce(part(x, "kind"), F.lit("participant_exposed")).alias("kind"), part(x, "uri").alias("uri"))
    kept = F.filter(F.try_variant_get(v, "$", "array<variant>"), lambda x: F.coalesce(public(x), F.lit(False)))
    return F.coalesce(F.transform(kept, row), F.array().cast("array<struct<consent:string,kind:string,uri:string>>"))


def consent(v: Column) -> Column:
    """struct<evidence_ref, granted_at, scopes, status> if consent is granted, for labels, with
    evidence and a time; else null. Scopes are sorted and distinct."""
    scopes = F.try_variant_get(v, "$.scopes", "array<string>")
    given = (part(v, "status") == "granted") & F.array_contains(scopes, LABEL_SCOPE) & (F.length(part(v, "evidence_ref")) > 0) & moment(v, "granted_at").isNotNull()
    value = F.struct(
        part(v, "evidence_ref").alias("evidence_ref"), moment(v, "granted_at").alias("granted_at"),
        F.array_sort(F.array_distinct(F.filter(scopes, lambda s: s.isNotNull()))).alias("scopes"), F.lit("granted").alias("status"),
    )
    return F.when(F.coalesce(given, F.lit(False)), value)


def reviewer_ref(record_id: Column, reviewer: Column) -> Column:
    """The name of a reviewer within one record, which says nothing outside of it."""
    return pseudonym("reviewer", record_id, reviewer)


def consented_judgments(judgments: DataFrame) -> DataFrame:
    """judgments: record_id, judgment (VARIANT) → record_id, label, reviewer_ref, consent of those
    that have a label, a reviewer and consent, a row each."""
    v = F.col("judgment")
    label = F.when(is_text(part(v, "label", kind="variant")), filled(part(v, "label")))
    out = judgments.select("record_id", label.alias("label"), filled(part(v, "reviewer_id")).alias("reviewer"), consent(part(v, "consent", kind="variant")).alias("consent"))
    out = out.filter(F.col("label").isNotNull() & F.col("reviewer").isNotNull() & F.col("consent").isNotNull())
    return out.select("record_id", "label", reviewer_ref(F.col("record_id"), F.col("reviewer")).alias("reviewer_ref"), "consent")


# blinding


def blinded(raw: Column, private: tuple[str, ...] = PRIVATE) -> Column:
    """An object's JSON text without its private members; null for anything else."""
    members = F.try_variant_get(F.try_parse_json(raw), "$", "map<string,variant>")
    return F.to_json(F.map_filter(members, lambda k, x: ~k.isin(*private)))


def private_leaks(df: DataFrame, raw: str, private: tuple[str, ...] = PRIVATE, open_to: str = PUBLIC_REFERENCES) -> DataFrame:
    """The columns of ``df`` but ``raw``, and the path of each private name at any depth: the
    outermost one, and none within the public references."""
    above = F.regexp_replace("path", "/[^/]*$", "")
    closed = "/(" + "|".join([*private, open_to]) + ")(/|$)"
    return walk(df, raw).filter(F.col("key").isin(*private) & ~above.rlike(closed)).drop("key", "kind", "value")


# numbered steps of a work trajectory


def _steps(v: Column, row) -> Column:
    return F.transform(F.try_variant_get(v, "$", "array<variant>"), row)


def _text(x: Column, name: str) -> Column:
    """A member that is a string; null for any other."""
    return F.when(is_text(part(x, name, kind="variant")), part(x, name))


def _first(*rules: tuple[str, Column]) -> Column:
    return F.get(_codes(*rules), F.lit(0))


def tool_calls(v: Column) -> Column:
    """array<struct<sequence, call_id, tool_name, started_at, completed_at, status, arguments, result, error>>."""

    def row(x: Column, i: Column) -> Column:
        begun, done = moment(x, "started_at"), moment(x, "completed_at")
        error = _first(
            ("CALL_OBJECT", is_object(x)), ("CALL_ID", F.length(_text(x, "call_id")) > 0), ("CALL_TOOL", F.length(_text(x, "tool_name")) > 0),
            ("CALL_TIME", begun.isNotNull() & done.isNotNull()), ("CALL_INTERVAL", begun <= done),
        )
        json = lambda n, otherwise: F.coalesce(F.to_json(part(x, n, kind="variant")), F.lit(otherwise))
        return F.struct(
            i.alias("sequence"), _text(x, "call_id").alias("call_id"), _text(x, "tool_name").alias("tool_name"), begun.alias("started_at"), done.alias("completed_at"),
            F.coalesce(part(x, "status"), F.lit("succeeded")).alias("status"), json("arguments", "{}").alias("arguments"), json("result", "null").alias("result"), error.alias("error"),
        )

    return _steps(v, row)


def patches(items: DataFrame, v: str) -> DataFrame:
    """A row per patch of the array ``v``: the other columns, sequence, patch_id, path, applied,
    before_content, after_content, their digests, unified_diff and error."""
    keep = [c for c in items.columns if c != v]
    x = F.col("x")
    applied = part(x, "applied", kind="variant")
    rows = items.select(*keep, F.posexplode(F.try_variant_get(v, "$", "array<variant>")).alias("sequence", "x"))
    out = rows.select(
        *keep, "sequence",
        F.coalesce(part(x, "patch_id"), F.format_string("patch-%03d", F.col("sequence") + 1)).alias("patch_id"),
        _text(x, "path").alias("path"), F.coalesce(F.try_variant_get(applied, "$", "boolean"), F.lit(True)).alias("applied"),
        _text(x, "before_content").alias("before_content"), _text(x, "after_content").alias("after_content"), _text(x, "unified_diff").alias("unified_diff"),
        (applied.isNull() | _type(applied).isin("BOOLEAN", "VOID")).alias("flag"),
    )
    error = _first(
        ("PATCH_PATH", is_safe_relative(F.col("path"))),
        ("PATCH_CONTENT", F.col("before_content").isNotNull() & F.col("after_content").isNotNull() & (F.length("unified_diff") > 0)), ("PATCH_APPLIED", F.col("flag")),
    )
    digest = lambda c: F.when(F.col(c).isNotNull(), json_string_digest(F.col(c)))
    return out.withColumn("before_sha256", digest("before_content")).withColumn("after_sha256", digest("after_content")).withColumn("error", error).drop("flag")


def verifier_evidence(v: Column) -> Column:
    """array<struct<sequence, name, command, exit_code, output, output_sha256, passed, error>>."""

    def row(x: Column, i: Column) -> Column:
        code = F.when(_type(part(x, "exit_code", kind="variant")).rlike("^(BIGINT|INT|SMALLINT|TINYINT)"), part(x, "exit_code", kind="bigint"))
        output = _text(x, "output")
        error = _first(("EVIDENCE_COMMAND", F.length(_text(x, "command")) > 0), ("EVIDENCE_OUTPUT", output.isNotNull()), ("EVIDENCE_EXIT", code.isNotNull()))
        return F.struct(
            i.alias("sequence"), F.coalesce(part(x, "name"), F.format_string("verifier-%d", i + 1)).alias("name"), _text(x, "command").alias("command"), code.alias("exit_code"),
            output.alias("output"), F.when(output.isNotNull(), json_string_digest(output)).alias("output_sha256"), (code == 0).alias("passed"), error.alias("error"),
        )

    return _steps(v, row)


# ticks of a lifetime


def ticks(lives: DataFrame, raw: str, key: str = "agent_id") -> DataFrame:
    """A row per tick of the lifetimes in ``raw`` (birth_event, ticks): key, sequence, observed_at,
    kind, action, idle_reason, world, state_before and state_after with their digests, and errors.

    Digests are those of canonical text. A life is taken apart, so its length is no limit.
    """
    v = F.try_parse_json(raw)
    birth = part(v, "birth_event", kind="variant")
    state = lambda x, n: F.to_json(F.when(is_object(part(x, n, kind="variant")), part(x, n, kind="variant")))
    rows = lives.select(
        key, moment(birth, "observed_at").alias("born_at"), state(birth, "initial_state").alias("born_state"),
        F.posexplode(F.try_variant_get(v, "$.ticks", "array<variant>")).alias("sequence", "x"),
    )
    x = F.col("x")
    after = part(x, "state_after", kind="variant")
    t = rows.select(
        key, "born_at", "born_state", "sequence", (part(x, "sequence", kind="bigint") == F.col("sequence")).alias("numbered"),
        moment(x, "observed_at").alias("observed_at"), part(x, "kind").alias("kind"), part(x, "action").alias("said"), part(x, "idle_reason").alias("why"),
        state(x, "state_before").alias("state_before"), state(x, "state_after").alias("state_after"),
        F.coalesce(part(x, "world"), part(after, "world"), F.lit("unknown")).alias("world"), part(after, "world").alias("its_world"),
    )
    w = Window.partitionBy(key).orderBy("sequence")
    decides, idles = F.col("kind") == "decision", F.col("kind") == "idle"
    t = t.withColumn("last_at", F.coalesce(F.lag("observed_at").over(w), "born_at")).withColumn("last_state", F.when(F.col("sequence") == 0, F.col("born_state")).otherwise(F.lag("state_after").over(w)))
    errors = _codes(
        ("TICK_SEQUENCE", F.col("numbered")), ("TICK_TIME", F.col("observed_at") > F.col("last_at")), ("TICK_KIND", F.col("kind").isin("decision", "idle")),
        ("TICK_STATE", F.col("state_before").isNotNull() & F.col("state_after").isNotNull()), ("STATE_CONTINUITY", F.col("state_before") == F.col("last_state")),
        ("TICK_ACTION", ~decides | (F.length("said") > 0)), ("TICK_IDLE_REASON", ~idles | (F.length("why") > 0)),
        ("TICK_WORLD", F.col("its_world").isNull() | (F.col("its_world") == F.col("world"))),
    )
    digest = lambda c: F.sha2(canonical_json(F.col(c), "plain"), 256)
    return t.select(
        key, "sequence", "observed_at", "kind", F.when(decides, F.col("said")).alias("action"), F.when(idles, F.col("why")).alias("idle_reason"), "world",
        "state_before", "state_after", digest("state_before").alias("state_before_sha256"), digest("state_after").alias("state_after_sha256"), errors.alias("errors"),
    )


def updates(lives: DataFrame, raw: str, name: str, key: str = "agent_id") -> DataFrame:
    """All updates called ``name`` of a life's ticks, flattened: key, place (in tick order and then
    as listed, from 0), update (JSON text). No row is gathered: the place is a running count."""
    v = F.try_parse_json(raw)
    per = F.transform(F.try_variant_get(v, "$.ticks", "array<variant>"), lambda x: F.coalesce(F.try_variant_get(x, variant_path("/" + name), "array<variant>"), F.array().cast("array<variant>")))
    flat = lives.select(key, F.posexplode(F.flatten(per)).alias("place", "u"))
    return flat.select(key, "place", F.to_json("u").alias("update"))


# recipes: which parts of a record a projection reads


def entity_seed(record_id: Column, world: Column) -> Column:
    """A seed per record and world that is the same in every run: 64 hex digits."""
    return F.sha2(F.concat(record_id, world), 256)


def project(df: DataFrame, raw: str, recipe: dict[str, str], *keep: str) -> DataFrame:
    """The values that a recipe (name: JSON pointer) reads, as JSON text.

    ``{column}`` in a pointer is that column's value in the row. A pointer that leads
    nowhere gives null.
    """

    def read(pointer: str) -> Column:
        steps = []
        for step in pointer.lstrip("/").split("/") if pointer not in ("", "/") else []:
            name = re.fullmatch(r"\{(\w+)\}", step)
            if name:
                steps.append(variant_step(F.col(name[1]).cast("string")))
            else:
                steps.append(F.lit(variant_path("/" + step)[1:]))
        return F.to_json(F.try_variant_get(F.try_parse_json(raw), F.concat(F.lit("$"), *steps), "variant"))

    return df.select(*keep, *[read(p).alias(n) for n, p in recipe.items()])
