"""The assembly gate: records whose every build step tells how it is done."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from .normalise import let, quoted


def body(s: str) -> str:
    """The text that tells a step: summary, steps and tip of its detail (or the detail itself), and the result it expects."""
    get = lambda k: f"nullif(get_json_object({s}.detail, '$.{k}'), '')"
    lines = f"filter(from_json(get_json_object({s}.detail, '$.steps'), 'array<string>'), l -> trim(l) <> '')"
    is_object = f"coalesce({s}.detail RLIKE '^\\\\s*[{{]' AND try_parse_json({s}.detail) IS NOT NULL, FALSE)"
    told = f"IF({is_object}, concat_ws('\\n', {get('summary')}, {lines}, {get('tip')}), {s}.detail)"
    result = f"IF(lower(trim({s}.expected_result)) IN ('unknown', ''), NULL, {s}.expected_result)"
    return f"trim(BOTH ' \\n\\t\\r' FROM concat_ws('\\n', nullif({told}, ''), {result}))"


def step_fault(s: str) -> str:
    """What is wrong with a step, null if nothing is."""
    name = f"concat('step ', {quoted(f'coalesce(nullif({s}.step_id, chr(0)), chr(60))')}".replace("nullif(" + s + ".step_id, chr(0))", f"nullif({s}.step_id, '')").replace("chr(60)", "'<step>'")
    mark = "'" + vocab.PLACEHOLDER + "'"
    cases = (
        f"CASE WHEN {s} IS NULL THEN 'step is not an object' WHEN contains(t, {mark}) THEN {name}, ' title contains placeholder marker') WHEN contains(b, {mark}) THEN {name}, ' body contains placeholder marker') "
        f"WHEN b = '' THEN {name}, ' has empty/missing body') WHEN lower(b) = lower(t) THEN {name}, ' is title-only (no real detail)') WHEN length(b) < {vocab.MIN_BODY} THEN {name}, ' body too short (no real detail)') END"
    )
    return let("t", f"trim(coalesce({s}.title, ''))", let("b", body(s), cases))


def with_fault(records: DataFrame, name: str = "fault") -> DataFrame:
    """records with the reason why its instructions aren't complete: that of the first step at fault; null if they are."""
    faults = f"array_compact(transform(instructions, s -> {step_fault('s')}))"
    return records.withColumn(name, F.expr(f"IF(coalesce(size(instructions), 0) = 0, 'no instruction steps', get({faults}, 0))"))


def filter_compliant(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, skipped): complete records, and (object_id, reason) of the others. Nothing is repaired."""
    marked = with_fault(records, "__fault")
    kept = marked.where("__fault IS NULL").drop("__fault")
    return kept, marked.where("__fault IS NOT NULL").select(F.coalesce("project.project_id", F.lit("<unknown>")).alias("object_id"), F.col("__fault").alias("reason"))


def coverage(records: DataFrame) -> DataFrame:
    """(seen, emitted, skipped) of the gate."""
    return with_fault(records, "__fault").agg(F.count(F.lit(1)).alias("seen"), F.count(F.when(F.col("__fault").isNull(), 1)).alias("emitted"), F.count("__fault").alias("skipped"))


def guide_has_placeholder(text: str = "text"):
    return F.coalesce(F.contains(F.col(text), F.lit(vocab.PLACEHOLDER)), F.lit(False))
