"""Scoring of answers: JSON out of a reply, what is wrong with it by mode, and F1 over its structural atoms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.dialect import quoted as listed
from .normalise import let

#: What answers and inputs hold; fields of other types read as null.
ANSWER = (
    "components array<struct<component_id: string, display_name: string, category: string, type: string, material: string, quantity: string, description: string, dimensions: string, functional_role: string>>, "
    "relationships array<struct<source: string, relation: string, target: string>>, "
    "instructions array<struct<step_id: string, phase: string, component_ids: array<string>, dependencies: array<string>>>, "
    "schema_valid boolean, reference_integrity_valid boolean, manufacturability_valid boolean, naming_consistency_valid boolean, issues array<struct<code: string>>, confidence_score double"
)
FLAGS = ("schema_valid", "reference_integrity_valid", "manufacturability_valid", "naming_consistency_valid")
SECTIONS = ("project", "requirements", "components", "relationships", "fabrication", "instructions", "sourcing", "validation")


def extract_json(text: str) -> str:
    """SQL for the JSON text of a reply: that of the first fence, or the text itself if it parses, else from the
    first opening to the last closing brace; null if none of it parses."""
    fence = "r'(?s)```(?:json)?\\s*(.*?)\\s*```'"
    body = f"IF(t RLIKE {fence}, trim(regexp_extract(t, {fence}, 1)), t)"
    inner = "substr(b, instr(b, '{'), length(b) - instr(reverse(b), '}') + 2 - instr(b, '{'))"
    span = f"IF(instr(b, '{{') > 0 AND length(b) - instr(reverse(b), '}}') + 1 > instr(b, '{{') AND instr(b, '}}') > 0, {inner}, NULL)"
    pick = f"CASE WHEN try_parse_json(b) IS NOT NULL THEN b WHEN try_parse_json({span}) IS NOT NULL THEN {span} END"
    return let("t", f"trim(BOTH ' \\n\\r\\t' FROM {text})", let("b", body, pick))


def detect_mode(system: str = "system") -> F.col:
    """The mode that a system prompt names, ? if none."""
    found = F.regexp_extract(F.col(system), r"Mode\s+([A-F])\b", 1)
    return F.when(found == "", F.lit("?")).otherwise(found)


def atoms(mode: str, a: str) -> str:
    """SQL for the atoms of an answer struct by mode: component ids, edges, steps and their parts, verdicts."""
    c = f"transform(coalesce({a}.components, array()), c -> to_json(array('c', c.component_id)))"
    r = f"transform(coalesce({a}.relationships, array()), r -> to_json(array('r', r.source, r.relation, r.target)))"
    s = (
        f"concat(transform(coalesce({a}.instructions, array()), s -> to_json(array('s', s.step_id))), "
        f"flatten(transform(coalesce({a}.instructions, array()), s -> transform(coalesce(s.component_ids, array()), p -> to_json(array('sc', s.step_id, p))))))"
    )
    flags = ", ".join(f"to_json(array('v', '{k}', cast({a}.{k} as string)))" for k in FLAGS)
    v = f"concat(array({flags}), transform(coalesce({a}.issues, array()), q -> to_json(array('vi', q.code))))"
    none = "CAST(array() AS array<string>)"
    return f"array_distinct(CASE WHEN {a} IS NULL THEN {none} WHEN {mode} IN ('A', 'B') THEN concat({c}, {r}, {s}) WHEN {mode} = 'C' THEN {c} WHEN {mode} = 'D' THEN {r} WHEN {mode} = 'E' THEN {s} WHEN {mode} = 'F' THEN {v} ELSE {none} END)"


def faults(mode: str, a: str, ids: str) -> str:
    """SQL for what is wrong with an answer struct of modes C to F; ids are the components that the input names."""
    none = "CAST(array() AS array<string>)"
    each = lambda array, element, wrong, text: f"array_compact(transform({array}, {element} -> IF({wrong}, {text}, NULL)))"
    show = lambda x: f"coalesce(concat(chr(39), {x}, chr(39)), 'None')"
    fields = ("component_id", "display_name", "category", "type", "material", "quantity", "description", "dimensions", "functional_role")
    lost = "array_sort(array_compact(array(" + ", ".join(f"IF(c.{k} IS NULL, '{k}', NULL)" for k in fields) + ")))"
    c = (
        f"CASE WHEN {a}.components IS NULL THEN array('missing top-level components list') WHEN size({a}.components) = 0 THEN array('components list is empty') ELSE concat("
        + each(f"{a}.components", "(c, i)", f"size({lost}) > 0", f"concat('component[', i, '] missing ', concat_ws(', ', {lost}))") + ", "
        + each(f"{a}.components", "(c, i)", "NOT coalesce(c.component_id RLIKE '^[a-z0-9_]+$', FALSE)", f"concat('component[', i, '] id ', {show('c.component_id')}, ' not snake_case')") + ", "
        + each(f"{a}.components", "(c, i)", f"NOT coalesce(c.type IN ({listed(vocab.COMPONENT_TYPES)}), FALSE)", f"concat('component ', {show('c.component_id')}, ': bad type ', {show('c.type')})") + ", "
        + each(f"{a}.components", "(c, i)", f"NOT coalesce(c.category IN ({listed(vocab.COMPONENT_CATEGORIES)}), FALSE)", f"concat('component ', {show('c.component_id')}, ': bad category ', {show('c.category')})") + ") END"
    )
    unknown = lambda x: f"size({ids}) > 0 AND NOT coalesce(array_contains({ids}, {x}), FALSE)"
    d = f"CASE WHEN {a}.relationships IS NULL THEN array('missing top-level relationships list') ELSE concat(" + ", ".join(each(f"{a}.relationships", "(r, i)", unknown(f"r.{e}"), f"concat('relationship[', i, '].{e} ', {show(f'r.{e}')}, ' not an input component')") for e in ("source", "target"))
    d += ", " + each(f"{a}.relationships", "(r, i)", f"NOT coalesce(r.relation IN ({listed([n for _, n in vocab.RELATIONS])}), FALSE)", f"concat('relationship[', i, '] bad relation ', {show('r.relation')})") + ") END"
    before = f"slice(transform({a}.instructions, q -> q.step_id), 1, i)"
    e = (
        f"CASE WHEN {a}.instructions IS NULL THEN array('missing top-level instructions list') ELSE concat("
        + each(f"{a}.instructions", "(s, i)", f"NOT coalesce(s.phase IN ({listed(vocab.PHASES)}), FALSE)", f"concat('step[', i, '] bad phase ', {show('s.phase')})")
        + f", flatten(transform({a}.instructions, (s, i) -> transform(filter(coalesce(s.component_ids, array()), p -> {unknown('p')}), p -> concat('step[', i, '] references unknown component ', {show('p')}))))"
        + f", flatten(transform({a}.instructions, (s, i) -> transform(filter(coalesce(s.dependencies, array()), p -> NOT array_contains({before}, p)), p -> concat('step[', i, '] depends on later/missing step ', {show('p')}))))) END"
    )
    absent = ", ".join(f"IF({a}.{k} IS NULL, 'missing {k}', NULL)" for k in (*FLAGS, "issues"))
    f = f"array_compact(array({absent}, IF({a}.confidence_score BETWEEN 0 AND 1, NULL, concat('confidence_score ', coalesce(cast({a}.confidence_score as string), 'None'), ' not in [0,1]'))))"
    return f"CASE {mode} WHEN 'C' THEN {c} WHEN 'D' THEN {d} WHEN 'E' THEN {e} WHEN 'F' THEN {f} ELSE {none} END"


def score_cases(cases: DataFrame) -> DataFrame:
    """Cases (mode, user, output, gold) with parsed, valid, exact, tp, fp, fn and errors.

    An output from which no JSON object can be read counts all gold atoms as missed. Exact: the same JSON whatever
    the order of keys. Modes A and B are checked for the sections of a whole record; C to F by their own rules."""
    df = cases.withColumn("__out", F.expr(extract_json("coalesce(output, '')"))).withColumn("__in", F.expr(extract_json("coalesce(user, '')")))
    parse = lambda c: F.expr(f"IF({c} RLIKE '^\\\\s*[{{]', from_json({c}, '{ANSWER}'), NULL)")
    df = df.withColumn("__a", parse("__out")).withColumn("__g", parse("gold")).withColumn("__i", parse("__in"))
    df = df.withColumn("__ids", F.expr("transform(coalesce(__i.components, array()), c -> c.component_id)"))
    whole = "array_compact(array(" + ", ".join(f"IF(get_json_object(__out, '$.{k}') IS NULL, '<root>: {k} is a required property', NULL)" for k in SECTIONS) + "))"
    wrong = f"CASE WHEN __a IS NULL THEN array('output is not a JSON object') WHEN mode IN ('A', 'B') THEN {whole} ELSE {faults('mode', '__a', '__ids')} END"
    df = df.withColumn("errors", F.expr(wrong)).withColumn("__p", F.expr(atoms("mode", "__a"))).withColumn("__q", F.expr(atoms("mode", "__g")))
    df = df.withColumn("parsed", F.col("__a").isNotNull()).withColumn("valid", F.col("parsed") & (F.size("errors") == 0))
    canon = lambda c: f"to_json(parse_json({c}))"
    df = df.withColumn("exact", F.expr(f"coalesce(parsed AND {canon('__out')} = {canon('gold')}, FALSE)"))
    df = df.withColumn("tp", F.size(F.array_intersect("__p", "__q"))).withColumn("fp", F.size("__p") - F.col("tp")).withColumn("fn", F.size("__q") - F.col("tp"))
    return df.drop("__out", "__in", "__a", "__g", "__i", "__ids", "__p", "__q")


def f1(tp: str = "tp", fp: str = "fp", fn: str = "fn"):
    """2 tp / (2 tp + fp + fn), 0 without a hit."""
    t = F.col(tp)
    return F.when(t == 0, F.lit(0.0)).otherwise(2.0 * t / (2 * t + F.col(fp) + F.col(fn)))


def report(scored: DataFrame) -> DataFrame:
    """(mode, n, parsed_pct, valid_pct, exact_pct, tp, fp, fn, f1) by mode, and for ALL; F1 over all atoms of a mode."""
    share = lambda c: F.round(100.0 * F.count(F.when(F.col(c), 1)) / F.count(F.lit(1)), 1).alias(f"{c}_pct")
    out = scored.rollup("mode").agg(F.count(F.lit(1)).alias("n"), share("parsed"), share("valid"), share("exact"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "fp", "fn")])
    return out.withColumn("mode", F.coalesce("mode", F.lit("ALL"))).withColumn("f1", F.round(f1(), 6))


def parse_model_json(text: str) -> str:
    """SQL for (json, fenced, wrapped) of a reply: plain, fenced or within prose. Of several JSON values in prose
    the one with most sections of a record counts, then the longest."""
    fence = "r'(?is)```(?:json)?\\s*(.*?)\\s*```'"
    body = f"IF(t RLIKE {fence}, trim(regexp_extract(t, {fence}, 1)), t)"
    starts = "filter(sequence(1, greatest(length(b), 1)), i -> substr(b, i, 1) IN ('{', '['))"
    ends = "filter(sequence(1, greatest(length(b), 1)), i -> substr(b, i, 1) IN ('}', ']'))"
    longest = "get(filter(transform(array_sort(filter(es, e -> e > s), (l, r) -> r - l), e -> substr(b, s, e - s + 1)), v -> try_parse_json(v) IS NOT NULL), 0)"
    sections = "size(array_intersect(coalesce(json_object_keys(v), array()), array(" + listed(SECTIONS) + ")))"
    rank = f"IF(startswith(v, '{{'), {sections} * 10000 + coalesce(size(json_object_keys(v)), 0) * 10, 500 + coalesce(json_array_length(v), 0))"
    rated = f"transform(filter(transform(ss, s -> {longest}), v -> v IS NOT NULL), v -> named_struct('rank', {rank}, 'n', length(v), 'v', v))"
    best = let("es", ends, let("ss", starts, f"array_max({rated}).v"))
    plain = "try_parse_json(b) IS NOT NULL"
    made = f"named_struct('json', IF({plain}, b, {best}), 'fenced', t RLIKE {fence}, 'wrapped', NOT ({plain}))"
    return let("t", f"trim(BOTH ' \\n\\r\\t' FROM {text})", let("b", body, made))


def audit_replies(replies: DataFrame, text: str = "reply") -> DataFrame:
    """replies with accepted, error_count, warning_count and codes: is the reply one complete record? Own verdicts of
    the reply are ignored. The sections are looked for; the rules on a typed record are those of `rules`."""
    df = replies.withColumn("__p", F.expr(parse_model_json(f"coalesce({text}, '')")))
    absent = "array_compact(array(" + ", ".join(f"IF(get_json_object(__p.json, '$.{k}') IS NULL, 'schema_violation', NULL)" for k in SECTIONS) + "))"
    warn = "array_compact(array(IF(__p.fenced, 'json_fence_removed', NULL), IF(__p.wrapped AND __p.json IS NOT NULL, 'json_wrapper_removed', NULL)))"
    bad = f"CASE WHEN __p.json IS NULL THEN array('invalid_json') WHEN NOT __p.json RLIKE '^\\\\s*[{{]' THEN array('wrong_root_type') ELSE {absent} END"
    df = df.withColumn("__e", F.expr(bad)).withColumn("__w", F.expr(warn))
    return df.withColumn("accepted", F.size("__e") == 0).withColumn("error_count", F.size("__e")).withColumn("warning_count", F.size("__w")).withColumn("codes", F.concat("__w", "__e")).drop("__p", "__e", "__w")
