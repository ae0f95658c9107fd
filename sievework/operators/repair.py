"""Repair of records: references that lead nowhere are matched with the identifier meant, or get a placeholder.
Everything happens within a record's row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.dialect import quoted as listed
from .normalise import NO_ISSUES, let, print_settings

_ACCESSORY, _NUMBER = listed(vocab.ACCESSORIES), f"r'{vocab.NUMBERS}'"


def _compatible(a: str, b: str) -> str:
    """Two identifiers may mean one thing: their numbers don't contradict, and both or neither are accessories."""
    words = lambda x: f"array_distinct(split(lower({x}), '_'))"
    numbers = lambda x: f"filter({words(x)}, w -> w RLIKE {_NUMBER})"
    extra = lambda x: f"array_sort(array_intersect({words(x)}, array({_ACCESSORY})))"
    clash = f"size({numbers(a)}) > 0 AND size({numbers(b)}) > 0 AND NOT arrays_overlap({numbers(a)}, {numbers(b)})"
    return f"(NOT ({clash}) AND {extra(a)} = {extra(b)})"


def fuzzy_resolve(missing: str, known: str) -> str:
    """SQL for the identifier of an array that a missing one probably means, null if none is near enough: itself,
    without or with a plural s, with mcu and microcontroller swapped, without a last word that says little, else
    the one that shares most of its words (two at least, three in four of the shorter). Ties go to the first by name."""
    has = lambda x: f"(array_contains({known}, {x}) AND {_compatible(missing, x)})"
    bare, more = f"left({missing}, length({missing}) - 1)", f"concat({missing}, 's')"
    swaps = [f"replace({missing}, '{a}', '{b}')" for a, b in (("_microcontroller", "_mcu"), ("_mcu", "_microcontroller"))]
    short = f"regexp_replace({missing}, '{vocab.ENDINGS}', '')"
    cases = [f"WHEN array_contains({known}, {missing}) THEN {missing}", f"WHEN endswith({missing}, 's') AND {has(bare)} THEN {bare}", f"WHEN {has(more)} THEN {more}"]
    cases += [f"WHEN {s} <> {missing} AND {has(s)} THEN {s}" for s in swaps]
    cases.append(f"WHEN {short} <> {missing} AND {has(short)} THEN {short}")
    words = lambda x: f"array_distinct(split(lower({x}), '_'))"
    shared = f"size(array_intersect({words('e')}, {words(missing)}))"
    rated = f"transform({known}, e -> named_struct('share', CAST({shared} AS DOUBLE) / least(size({words('e')}), size({words(missing)})), 'n', {shared}, 'id', e))"
    good = f"filter({rated}, r -> r.n >= 2 AND r.share >= 0.75 AND {_compatible(missing, 'r.id')})"
    best = f"get(transform(array_sort({good}, (l, r) -> CASE WHEN l.share > r.share THEN -1 WHEN l.share < r.share THEN 1 WHEN l.id < r.id THEN -1 ELSE 1 END), r -> r.id), 0)"
    return f"CASE {' '.join(cases)} ELSE {best} END"


def dangling_refs(records: DataFrame, name: str = "missing") -> DataFrame:
    """records with the distinct references of edges, steps and issues that name no component, sorted."""
    ids = "transform(components, c -> c.component_id)"
    refs = (
        "concat(transform(relationships, r -> r.source), transform(relationships, r -> r.target), flatten(transform(instructions, s -> s.component_ids)), "
        "flatten(transform(validation.issues, q -> filter(q.refs, x -> x <> ''))))"
    )
    return records.withColumn(name, F.expr(f"array_sort(array_except(array_compact(array_distinct({refs})), {ids}))"))


def _placeholder(m: str) -> str:
    word = "split(lower(x), '_')"
    hits = " ".join(f"WHEN w IN ({listed(words)}) THEN named_struct('category', '{a}', 'type', '{b}', 'material', '{c}')" for a, b, c, words in vocab.PLACEHOLDERS)
    kind = f"coalesce(get(array_compact(transform({word}, w -> CASE {hits} END)), 0), named_struct('category', 'electrical', 'type', 'electronic', 'material', 'unknown'))"
    shown = "initcap(replace(x, '_', ' '))"
    none = lambda t: f"CAST(NULL AS {t})"
    size = "named_struct('raw', " + none("STRING") + ", " + ", ".join(f"'{k}', {none('DOUBLE')}" for k in ("length_mm", "width_mm", "height_mm", "diameter_mm", "id_mm", "od_mm")) + f", 'thread', {none('STRING')}, 'unparsed', {none('BOOLEAN')})"
    made = (
        f"named_struct('component_id', x, 'display_name', {shown}, 'category', k.category, 'type', k.type, 'material', k.material, 'quantity', 1L, "
        f"'description', concat({shown}, ' - added during seed repair to resolve a dangling reference.'), 'dimensions', {size}, 'functional_role', 'unknown', 'fabrication_ref', IF(k.type = '3d_printed', x, NULL), 'sourcing_ref', x)"
    )
    return let("x", m, let("k", kind, made))


def synthesised(components: str = "components") -> str:
    """SQL for build steps made from components: fabricate, then connect, then install, each in their order."""
    phase = "CASE WHEN c.type IN ('3d_printed', 'machined', 'laser_cut') THEN 'fabrication' WHEN c.type = 'electronic' THEN 'wiring' ELSE 'assembly' END"
    verb = {"fabrication": "Fabricate", "wiring": "Connect", "assembly": "Install"}
    part = lambda p: f"transform(filter({components}, c -> {phase} = '{p}'), (c, i) -> named_struct('id', concat('{p}_', i + 1), 'phase', '{p}', 'title', concat('{verb[p]} ', c.display_name), 'of', c.component_id))"
    steps = f"concat({', '.join(map(part, verb))})"
    made = (
        "transform(ss, (s, i) -> named_struct('step_id', s.id, 'phase', s.phase, 'title', s.title, 'component_ids', array(s.of), 'dependencies', IF(i > 0, array(ss[i - 1].id), CAST(array() AS array<string>)), "
        "'expected_result', 'unknown', 'detail', CAST(NULL AS STRING)))"
    )
    return let("ss", steps, made)


def fixup(records: DataFrame) -> DataFrame:
    """Repaired records with a column `actions`, which tells what was done, in order of names.

    References are rewritten to the identifier meant, or a placeholder component is added; a record without steps
    gets them from its components; components without an item get one at no cost; costs are added up anew and the
    issues are cleared, to be found anew."""
    df = dangling_refs(records, "__missing").withColumn("__ids", F.expr("array_sort(array_distinct(transform(components, c -> c.component_id)))"))
    df = df.withColumn("__to", F.expr(f"transform(__missing, m -> named_struct('was', m, 'is', {fuzzy_resolve('m', '__ids')}))"))
    df = df.withColumn("__new", F.expr("transform(filter(__to, t -> t.is IS NULL), t -> t.was)"))
    empty = F.expr("size(instructions) = 0")
    df = df.withColumn("components", F.expr(f"concat(components, transform(__new, m -> {_placeholder('m')}))"))
    to = lambda x: f"coalesce(get(filter(__to, t -> t.was = {x} AND t.is IS NOT NULL), 0).is, {x})"
    df = df.withColumn("relationships", F.expr(f"transform(relationships, r -> named_struct('source', {to('r.source')}, 'relation', r.relation, 'target', {to('r.target')}, 'required', r.required, 'notes', r.notes))"))
    df = df.withColumn("__empty", empty)
    steps = f"transform(instructions, s -> named_struct('step_id', s.step_id, 'phase', s.phase, 'title', s.title, 'component_ids', transform(s.component_ids, c -> {to('c')}), 'dependencies', s.dependencies, 'expected_result', s.expected_result, 'detail', s.detail))"
    df = df.withColumn("instructions", F.when(F.col("__empty"), F.expr(synthesised())).otherwise(F.expr(steps)))
    told = "concat(transform(filter(__to, t -> t.is IS NOT NULL), t -> concat('fuzzy-resolve ', chr(39), t.was, chr(39), ' -> ', chr(39), t.is, chr(39))), transform(__new, m -> concat('add placeholder component ', chr(39), m, chr(39))), IF(__empty, array(concat('synthesize ', cast(size(instructions) as string), ' instruction steps')), CAST(array() AS array<string>)))"
    df = df.withColumn("actions", F.expr(told))
    item = "named_struct('component_id', c.component_id, 'product_name', c.display_name, 'unit_cost_usd', CAST(0 AS DECIMAL(18, 4)), 'quantity', c.quantity, 'total_cost_usd', CAST(0 AS DECIMAL(18, 2)), 'vendor', CAST(NULL AS STRING), 'url', CAST(NULL AS STRING))"
    df = df.withColumn("__items", F.expr(f"concat(sourcing.items, transform(filter(components, c -> NOT exists(sourcing.items, x -> x.component_id = c.component_id)), c -> {item}))"))
    from .normalise import cost_summary

    df = df.withColumn("sourcing", F.expr(f"named_struct('items', __items, 'cost_summary', {cost_summary('__items', 'size(components)')}, 'vendors', sourcing.vendors)"))
    clean = f"named_struct('schema_valid', TRUE, 'reference_integrity_valid', TRUE, 'manufacturability_valid', TRUE, 'naming_consistency_valid', TRUE, 'issues', {NO_ISSUES}, 'confidence_score', 1.0D)"
    return df.withColumn("validation", F.expr(clean)).drop("__missing", "__ids", "__to", "__new", "__empty", "__items")


def backfill_print_settings(records: DataFrame) -> DataFrame:
    """Records whose printed parts all have settings: those that lack them get usual ones by what they bear."""
    hint = f"IF(upper(c.material) IN ({listed(vocab.PRINT_MATERIALS)}), upper(c.material), 'PLA')"
    bears = "(c.category IN ('structural', 'mounting') OR c.functional_role = 'structural')"
    raw = f"concat('0.2mm layer, ', IF({bears}, '40', '20'), '% infill, ', IF({bears}, '4', '3'), ' perimeters, ', {hint})"
    made = f"transform(filter(components, c -> c.type = '3d_printed' AND NOT exists(fabrication.component_settings, x -> x.component_id = c.component_id)), c -> {let('r', raw, 'named_struct(' + chr(39) + 'component_id' + chr(39) + ', c.component_id, ' + chr(39) + 'settings' + chr(39) + ', ' + print_settings('r') + ')')})"
    df = records.withColumn("__made", F.expr(made))
    processes = F.when(F.size("__made") > 0, F.array_sort(F.array_union("fabrication.processes", F.array(F.lit("fdm_3d_printing"))))).otherwise(F.col("fabrication.processes"))
    return df.withColumn("fabrication", F.col("fabrication").withField("component_settings", F.concat("fabrication.component_settings", "__made")).withField("processes", processes)).drop("__made")
