"""Validation rules on canonical records. Each rule is an expression over one record's arrays: no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.dialect import quoted as listed
from .normalise import NO_ISSUES, issue, quoted

_NONE = "CAST(array() AS array<string>)"
_IDS = "transform(components, c -> c.component_id)"
_STEPS = "transform(instructions, s -> s.step_id)"
_SNAKE = "'^[a-z0-9_]+$'"


def _each(array: str, element: str, wrong: str, made: str) -> str:
    """An issue for every element that is wrong; element may be 'x' or '(x, i)'."""
    return f"array_compact(transform({array}, {element} -> IF({wrong}, {made}, NULL)))"


def _when(wrong: str, made: str) -> str:
    return f"IF({wrong}, array({made}), {NO_ISSUES})"


def schema_rules() -> list[str]:
    """What the fixed schema of a DataFrame doesn't already hold: names, identifiers, lengths and least values."""
    bad = lambda path, what: issue("error", "schema_violation", f"concat({path}, ': {what}')", f"array({path})")
    out = []
    for column in ("project", "requirements", "components", "relationships", "fabrication", "instructions", "sourcing", "validation"):
        out.append(_when(f"{column} IS NULL", issue("error", "schema_violation", f"'<root>: {column} is a required property'", "array('<root>')")))
    for name in ("project_id", "seed_project_id"):
        out.append(_when(f"NOT coalesce(project.{name} RLIKE {_SNAKE}, FALSE)", bad(f"'project/{name}'", "does not match ^[a-z0-9_]+$")))
    out.append(_when("coalesce(length(project.name), 0) < 2", bad("'project/name'", "is too short")))
    out.append(_each("components", "(c, i)", f"NOT coalesce(c.component_id RLIKE {_SNAKE}, FALSE)", bad("concat('components/', i, '/component_id')", "does not match ^[a-z0-9_]+$")))
    out.append(_each("components", "(c, i)", "coalesce(c.display_name, '') = ''", bad("concat('components/', i, '/display_name')", "is too short")))
    out.append(_each("components", "(c, i)", "c.quantity IS NULL OR c.quantity < 0", bad("concat('components/', i, '/quantity')", "is less than the minimum of 0")))
    for end in ("source", "target"):
        out.append(_each("relationships", "(r, i)", f"NOT coalesce(r.{end} RLIKE {_SNAKE}, FALSE)", bad(f"concat('relationships/', i, '/{end}')", "does not match ^[a-z0-9_]+$")))
    out.append(_each("instructions", "(s, i)", "coalesce(s.title, '') = ''", bad("concat('instructions/', i, '/title')", "is too short")))
    return out


def word_rules() -> list[str]:
    """Values outside their vocabularies."""
    return [
        _when(f"NOT coalesce(project.variant_type IN ({listed(vocab.VARIANT_TYPES)}), FALSE)", issue("error", "invalid_variant_type", f"concat('project.variant_type ', {quoted('project.variant_type')}, ' not in controlled vocab')", "array(project.variant_type)")),
        _when(f"NOT coalesce(requirements.skill_level IN ({listed(vocab.SKILL_LEVELS)}), FALSE)", issue("warn", "invalid_skill_level", f"concat('requirements.skill_level ', {quoted('requirements.skill_level')}, ' not in controlled vocab')", "array(requirements.skill_level)")),
        _each("components", "c", f"NOT coalesce(c.type IN ({listed(vocab.COMPONENT_TYPES)}), FALSE)", issue("error", "invalid_component_type", f"concat('component ', {quoted('c.component_id')}, ': type ', {quoted('c.type')}, ' not in controlled vocab')", "array(c.component_id)")),
        _each("components", "c", f"NOT coalesce(c.category IN ({listed(vocab.COMPONENT_CATEGORIES)}), FALSE)", issue("error", "invalid_component_category", f"concat('component ', {quoted('c.component_id')}, ': category ', {quoted('c.category')}, ' not in controlled vocab')", "array(c.component_id)")),
        _each("relationships", "(r, i)", f"NOT coalesce(r.relation IN ({listed([name for _, name in vocab.RELATIONS])}, 'attached_to'), FALSE)", issue("error", "invalid_relation", f"concat('relationships[', i, '].relation ', {quoted('r.relation')}, ' not in controlled vocab')", "array(r.source, r.target)")),
        _each("instructions", "(s, i)", f"NOT coalesce(s.phase IN ({listed(vocab.PHASES)}), FALSE)", issue("error", "invalid_phase", f"concat('instructions[', i, '].phase ', {quoted('s.phase')}, ' not in controlled vocab')", "array(s.step_id)")),
    ]


def reference_rules() -> list[str]:
    """Identifiers that stand twice, and references that lead nowhere."""
    again = lambda array, name: f"array_position(transform({array}, q -> q.{name}), x.{name}) <= i"
    out = [
        _each("components", "(x, i)", again("components", "component_id"), issue("error", "duplicate_component_id", f"concat('duplicate component_id ', {quoted('x.component_id')})", "array(x.component_id)")),
    ]
    for end in ("source", "target"):
        out.append(_each("relationships", "(r, i)", f"NOT array_contains({_IDS}, r.{end})", issue("error", "dangling_ref", f"concat('relationships[', i, '].{end} ', {quoted(f'r.{end}')}, ' not in components')", f"array(r.{end})")))
    out.append(_each("instructions", "(x, i)", again("instructions", "step_id"), issue("error", "duplicate_step_id", f"concat('duplicate step_id ', {quoted('x.step_id')})", "array(x.step_id)")))
    part = issue("error", "dangling_step_ref", f"concat('instruction ', {quoted('s.step_id')}, ' references missing component ', {quoted('c')})", "array(c)")
    out.append(f"flatten(transform(instructions, s -> transform(filter(coalesce(s.component_ids, {_NONE}), c -> NOT array_contains({_IDS}, c)), c -> {part})))")
    depends = lambda what: f"concat('step ', {quoted('s.step_id')}, ' depends on {what} step ', {quoted('d')})"
    later, absent = issue("error", "forward_dependency", depends("later"), "array(d)"), issue("error", "missing_dependency", depends("missing"), "array(d)")
    later = f"IF(array_contains({_STEPS}, d), {later}, {absent})"
    out.append(f"flatten(transform(instructions, (s, i) -> transform(filter(coalesce(s.dependencies, {_NONE}), d -> NOT array_contains(slice({_STEPS}, 1, i), d)), d -> {later})))")
    out.append(_each("sourcing.items", "(x, i)", f"NOT array_contains({_IDS}, x.component_id)", issue("error", "dangling_sourcing_ref", f"concat('sourcing.items[', i, '].component_id ', {quoted('x.component_id')}, ' not in components')", "array(x.component_id)")))
    out.append(_each("fabrication.component_settings", "x", f"NOT array_contains({_IDS}, x.component_id)", issue("error", "dangling_fabrication_ref", f"concat('fabrication.component_settings[', {quoted('x.component_id')}, '] not in components')", "array(x.component_id)")))
    return out


def sense_rules(strict: bool) -> list[str]:
    """Records that hang together but can't be built or are ambiguous."""
    hard, real = "error" if strict else "warn", "coalesce(project.variant_type, '') <> 'evaluation_negative'"
    powered = "size(filter(components, c -> c.category = 'electrical'))"
    names = "array_distinct(transform(components, c -> c.display_name))"
    count = "size(filter(components, c -> c.display_name = n))"
    twice = issue("warn", "duplicate_display_name", f"concat('display_name ', {quoted('n')}, ' used by ', {count}, ' components')", "array(n)")
    return [
        _when(f"size(instructions) = 0 AND {real}", issue(hard, "empty_instructions", "'no instruction steps; project not buildable as-is'", _NONE)),
        _when(f"{real} AND {powered} >= 2 AND NOT exists(relationships, r -> r.relation = 'connects_to')", issue(hard, "missing_electrical_connections", f"concat({powered}, ' electrical components but no connects_to relationships')", _NONE)),
        _each("components", "c", "c.type = '3d_printed' AND NOT exists(fabrication.component_settings, x -> x.component_id = c.component_id)", issue("warn", "missing_print_settings", f"concat('3d_printed component ', {quoted('c.component_id')}, ' has no fabrication settings')", "array(c.component_id)")),
        _when("coalesce(sourcing.cost_summary.total_usd, 0) < 0", issue("error", "negative_cost", "'sourcing.cost_summary.total_usd is negative'", _NONE)),
        f"transform(filter({names}, n -> {count} > 1), n -> {twice})",
    ]


def with_issues(records: DataFrame, strict: bool = True, name: str = "found") -> DataFrame:
    """records with a column of all issues of each, in the order of the rules. A record that breaks the schema gets
    those issues alone. Arrays that are null count as empty, but for the schema rule that wants them."""
    joined = lambda rules: ", ".join(f"coalesce({r}, {NO_ISSUES})" for r in rules)
    schema = records.withColumn("__schema", F.expr(f"concat({joined(schema_rules())})"))
    whole = f"IF(size(__schema) > 0, __schema, concat({joined([*word_rules(), *reference_rules(), *sense_rules(strict)])}))"
    return schema.withColumn(name, F.expr(whole)).drop("__schema")


def is_valid(name: str = "found"):
    """No issue of severity error; warnings don't count."""
    return ~F.exists(F.col(name), lambda q: q["severity"] == "error")
