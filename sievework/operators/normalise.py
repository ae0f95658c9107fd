"""Raw project configurations -> canonical records. A record is one row: every step is an expression over its own
arrays, so a table of any size is normalised in its scan, without a shuffle and without Python row code.

Array position means something (the first of equal ids keeps its name, a step depends on the one before it);
higher-order functions keep it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.dialect import Spark, dimension, dimension_kind, first_match, is_fastener, map_type

_S = Spark()
_STR = "CAST(NULL AS STRING)"
_ID = "coalesce(n.id, '')"
# Texts without a digit are no amount; casting them would throw and catch.
_AMOUNT = "IF(n.quantity RLIKE '[0-9]', TRY_CAST(TRY_CAST(n.quantity AS DOUBLE) AS BIGINT), NULL)"

#: Raw configurations as read from files; numbers are read as text, since the files hold both.
RAW_SCHEMA = (
    "slug string, projectName string, projectDescription string, originalPrompt string, plan string, notes array<string>, "
    "nodes array<struct<id: string, name: string, type: string, category: string, material: string, quantity: string, description: string, dimensions: string, "
    "printSettings: string, estimatedCost: string, purchaseUrl: string, productName: string>>, "
    "electricalConnections array<struct<source: string, target: string, label: string, protocol: string, voltage: string, sourcePin: string, targetPin: string>>, "
    "mechanicalConnections array<struct<source: string, target: string, label: string>>, "
    "instructionPreamble struct<tools: array<string>, assumptions: array<string>>, "
    "instructionSteps array<struct<id: string, subSteps: array<struct<id: string, title: string, partIds: array<string>, detail: string>>>>"
)

ISSUE = "struct<severity: string, code: string, message: string, refs: array<string>>"
NO_ISSUES = f"CAST(array() AS array<{ISSUE}>)"


def issue(severity: str, code: str, message: str, refs: str) -> str:
    return f"named_struct('severity', '{severity}', 'code', '{code}', 'message', {message}, 'refs', {refs})"


def quoted(x: str) -> str:
    """A text in quotes, None if it is null, as messages show values."""
    return f"coalesce(concat(chr(39), {x}, chr(39)), 'None')"


def let(name: str, value: str, body: str) -> str:
    """body with `name` standing for value, worked out once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def bare(x: str) -> str:
    """`dialect.snake` with its text worked out once: a lambda has no common subexpressions."""
    return let("w", f"trim(BOTH '_' FROM regexp_replace(lower({x}), '[^a-z0-9]+', '_'))", "IF(w <> '', w, 'unknown')")


def clean_url(x: str) -> str:
    """A web address, or null for anything else: no scheme, 'N/A' in it, cut short."""
    t = f"trim({x})"
    return f"CASE WHEN ({t} LIKE 'http://%' OR {t} LIKE 'https://%') AND NOT contains({t}, 'N/A') AND NOT endswith({t}, '...') THEN {t} END"


def dimensions(x: str) -> str:
    """A size text as numbers in millimetres; what no pattern reads is marked."""
    flat = rf"regexp_replace(trim(regexp_replace(trim({x}), r'\s*\([^)]*\)\s*', '')), '_+', ' ')"
    fields = ", ".join(f"'{f}', {dimension(_S, 's', f)}" for f in ("length_mm", "width_mm", "height_mm", "diameter_mm", "id_mm", "od_mm"))
    thread = "CASE " + " ".join(f"WHEN s RLIKE r'{p}' THEN concat('M', regexp_extract(s, r'{p}', 1))" for k, p, _ in vocab.DIMENSIONS if k.startswith("thread")) + " END"
    known = f"s = '' OR {dimension_kind(_S, 's')} <> 'unparsed'"
    return let("s", f"coalesce({flat}, '')", f"named_struct('raw', {x}, {fields}, 'thread', {thread}, 'unparsed', CASE WHEN coalesce({x}, '') <> '' AND NOT ({known}) THEN TRUE END)")


def print_settings(x: str) -> str:
    """A print settings text as numbers."""
    num = lambda p, kind: f"TRY_CAST(nullif(regexp_extract({x}, r'{p}', 1), '') AS {kind})"
    pats = vocab.PRINT
    return (
        f"named_struct('raw', {x}, 'infill_pct', {num(pats['infill_pct'], 'INT')}, 'layer_mm', {num(pats['layer_mm'], 'DOUBLE')}, 'perimeters', {num(pats['perimeters'], 'INT')}, "
        f"'nozzle_mm', {num(pats['nozzle_mm'], 'DOUBLE')}, 'material_hint', nullif(upper(regexp_extract({x}, r'{pats['material_hint']}', 1)), ''))"
    )


def skill_level(x: str) -> str:
    low = f"lower({x})"
    has = lambda words: " OR ".join(f"contains({low}, '{w}')" for w in words)
    return f"CASE WHEN {has(vocab.ADVANCED)} THEN 'advanced' WHEN {has(vocab.BEGINNER)} THEN 'beginner' ELSE 'intermediate' END"


def _raw(n: str) -> str:
    return f"coalesce(nullif({n}.id, ''), {bare(f"coalesce({n}.name, 'unknown')")})"


def names(n: str) -> str:
    """The raw identifier of a node and its bare form."""
    return f"named_struct('raw', {_raw(n)}, 'base', {bare(_raw(n))})"


def looks(n: str) -> str:
    """What the texts of a node tell by patterns: the name it is shown by, its size, role and print settings. Like its
    names, it hangs on id, name, dimensions and printSettings alone, so a table of few different nodes can work both
    out once for each, as fields `names` and `looks` of the nodes."""
    shown = f"coalesce(nullif({n}.name, ''), {_raw(n)})"
    return (
        f"named_struct('shown', {shown}, 'dimensions', {dimensions(f'{n}.dimensions')}, 'role', {first_match(_S, shown, vocab.ROLES, _STR)}, "
        f"'fastener', {is_fastener(_S, shown)}, 'settings', IF({n}.printSettings IS NULL, NULL, {print_settings(f'{n}.printSettings')}))"
    )


def _named_nodes(df: DataFrame) -> DataFrame:
    """ids: (raw, spec, twin) of each node in order; a repeated identifier gets the first free of _2, _3, ...; ids_set
    holds them all."""
    start = "CAST(array() AS array<struct<raw: string, spec: string, twin: string>>)"
    taken = lambda x: f"exists(acc, a -> a.spec = {x})"
    later = "concat(r.base, '_', cast(k as string))"
    free = f"concat(r.base, '_', filter(sequence(2, size(acc) + 2), k -> NOT {taken(later)})[0])"
    spec = f"IF({taken('r.base')}, named_struct('raw', r.raw, 'spec', {free}, 'twin', r.base), named_struct('raw', r.raw, 'spec', r.base, 'twin', {_STR}))"
    plain = f"transform(told, r -> named_struct('raw', r.raw, 'spec', r.base, 'twin', {_STR}))"
    ids = f"IF(size(array_distinct(told.base)) = size(told), {plain}, aggregate(told, {start}, (acc, r) -> concat(acc, array({spec}))))"
    return df.withColumn("ids", F.expr(ids))


def _spec(x: str) -> str:
    """The identifier that a raw one stands for; the last node of that name wins. Null if there is none."""
    return f"try_element_at(filter(ids, q -> q.raw = {x}), -1).spec"


def _components() -> str:
    n, spec, seen = "n", "ids[i].spec", "looks[i]"
    kind = f"CASE WHEN k = 'fastener' THEN k WHEN {n}.printSettings IS NOT NULL THEN '3d_printed' ELSE k END"
    fields = {
        "component_id": spec, "display_name": f"{seen}.shown", "category": f"CASE WHEN {n}.category IN ('electrical', 'mechanical') THEN {n}.category WHEN t = 'electronic' THEN 'electrical' ELSE 'mechanical' END",
        "type": "t", "material": f"coalesce(nullif({n}.material, ''), IF(t = 'fastener', 'steel', 'unknown'))", "quantity": f"coalesce({_AMOUNT}, 1L)",
        "description": f"coalesce({n}.description, '')", "dimensions": f"{seen}.dimensions", "functional_role": f"coalesce({seen}.role, nullif({n}.type, ''), 'unknown')",
        "fabrication_ref": f"IF({n}.printSettings IS NOT NULL, {spec}, {_STR})", "sourcing_ref": spec,
    }
    body = "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"
    body = let("t", let("k", map_type(_S, f"coalesce({n}.type, '')", "", fastener=f"{seen}.fastener"), kind), body)
    return f"transform(nodes, (n, i) -> {body})"


def _edges(kind: str) -> str:
    """(edge, issue) of each connection: an edge if both ends are known, else what is wrong."""
    column = f"{kind}Connections"
    if kind == "electrical":
        notes = (
            "concat_ws('; ', IF(coalesce(c.protocol, '') <> '', concat('protocol=', c.protocol), NULL), IF(coalesce(c.voltage, '') <> '', concat('voltage=', c.voltage), NULL), "
            "IF(coalesce(c.sourcePin, '') <> '' AND coalesce(c.targetPin, '') <> '', concat('pins=', c.sourcePin, '->', c.targetPin), NULL))"
        )
        relation, notes = "'connects_to'", f"coalesce(nullif({notes}, ''), c.label, '')"
    else:
        relation, notes = first_match(_S, "coalesce(c.label, '')", vocab.RELATIONS, "'attached_to'"), "coalesce(c.label, '')"
    wrong = issue("error", "dangling_ref", f"concat('{kind} conn ', {quoted('c.source')}, '->', {quoted('c.target')}, ' references missing component')", "array(c.source, c.target)")
    edge = f"IF(a IS NULL OR b IS NULL, NULL, named_struct('source', a, 'relation', {relation}, 'target', b, 'required', TRUE, 'notes', {notes}))"
    pair = f"named_struct('edge', {edge}, 'issue', IF(a IS NULL OR b IS NULL, {wrong}, NULL))"
    return f"transform(coalesce({column}, array()), c -> {let('a', _spec('c.source'), let('b', _spec('c.target'), pair))})"


def _steps() -> str:
    """(step, wrong) of each build step, in one list: its phase, parts and the step before it."""
    phase = "CASE p.id " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in vocab.PHASE_NAMES.items()) + " ELSE coalesce(p.id, 'unknown') END"
    flat = f"flatten(transform(coalesce(instructionSteps, array()), p -> transform(coalesce(p.subSteps, array()), s -> named_struct('phase', {phase}, 's', s))))"
    name = bare("coalesce(nullif(x.s.id, ''), concat(x.phase, '_', cast(i + 1 as string)))")
    return f"transform({flat}, (x, i) -> named_struct('phase', x.phase, 's', x.s, 'step_id', {name}))"


def normalise(raw: DataFrame) -> DataFrame:
    """Canonical records of raw configurations (RAW_SCHEMA): project, requirements, components, relationships,
    fabrication, instructions, sourcing, validation.

    Nothing is made up: a connection or part reference to an unknown node is dropped and noted among the issues, as
    are repeated identifiers and amounts that are no numbers (1 is taken). Null or missing arrays are empty. Of nodes
    that share a raw identifier the last answers for it. Money is exact, in cents, halves rounded up. Other columns
    of the table are not carried over. Nodes that bring `names` or `looks` are not read again for them.
    """
    df = raw.withColumn("nodes", F.expr("filter(coalesce(nodes, array()), n -> n IS NOT NULL)"))
    brought = raw.schema["nodes"].dataType.elementType.names
    each = lambda name, made: F.expr(f"transform(nodes, n -> {f'n.{name}' if name in brought else made('n')})")
    df = _named_nodes(df.withColumn("told", each("names", names)).withColumn("looks", each("looks", looks)))
    df = df.withColumn("components", F.expr(_components())).withColumn("el", F.expr(_edges("electrical"))).withColumn("me", F.expr(_edges("mechanical"))).withColumn("st", F.expr(_steps()))
    twin = issue("warn", "duplicate_id", f"concat('duplicate component id ', {quoted('ids[i].twin')}, ', suffixing')", "array(ids[i].twin)")
    twins = f"IF(ids[i].twin IS NOT NULL, {twin}, NULL)"
    amount = issue("warn", "invalid_quantity", "concat('component ', ids[i].spec, ' quantity coerced to 1')", "array(ids[i].spec)")
    amounts = f"IF(n.quantity IS NOT NULL AND {_AMOUNT} IS NULL, {amount}, NULL)"
    node_issues = f"flatten(transform(nodes, (n, i) -> array({twins}, {amounts})))"
    lost = issue("error", "dangling_step_ref", f"concat('instruction step ', {quoted('x.step_id')}, ' references missing part ', {quoted('p')})", "array(p)")
    step_issues = f"flatten(transform(st, x -> transform(filter(coalesce(x.s.partIds, array()), p -> p IS NOT NULL AND {_spec('p')} IS NULL), p -> {lost})))"
    none = issue("error", "empty_instructions", "'no instruction steps in seed; cannot train project→instructions mode'", "CAST(array() AS array<string>)")
    listed = f"filter(concat({node_issues}, transform(el, e -> e.issue), transform(me, e -> e.issue), {step_issues}, IF(size(st) = 0, array({none}), {NO_ISSUES})), q -> q IS NOT NULL)"
    df = df.withColumn("issues", F.expr(listed)).withColumn("project_id", F.expr(bare("coalesce(slug, '')")))
    parts = f"array_compact(transform(coalesce(x.s.partIds, array()), p -> {_spec('p')}))"
    detail = "IF(trim(x.s.detail) <> '' AND NOT trim(x.s.detail) IN ('{}', 'null'), x.s.detail, NULL)"
    steps = f"transform(st, (x, i) -> named_struct('step_id', x.step_id, 'phase', x.phase, 'title', coalesce(x.s.title, ''), 'component_ids', {parts}, 'dependencies', IF(i > 0, array(st[i - 1].step_id), CAST(array() AS array<string>)), 'expected_result', 'unknown', 'detail', {detail}))"
    has = lambda c: f"exists(components, c -> c.category = '{c}')"
    category = f"CASE WHEN {has('electrical')} AND {has('mechanical')} THEN 'electromechanical' WHEN {has('electrical')} THEN 'electronics' WHEN {has('mechanical')} THEN 'mechanical' ELSE 'unknown' END"
    project = (
        f"named_struct('project_id', project_id, 'name', coalesce(projectName, slug), 'category', {category}, 'summary', coalesce(nullif(projectDescription, ''), left(plan, 300), ''), "
        "'original_prompt', coalesce(originalPrompt, ''), 'variant_type', 'seed', 'seed_project_id', project_id, 'visual_ref', concat(project_id, '_VISUAL.png'))"
    )
    texts = "concat_ws(' ', coalesce(instructionPreamble.assumptions, array()), coalesce(notes, array()))"
    requirements = (
        f"named_struct('tools', coalesce(instructionPreamble.tools, array()), 'assumptions', coalesce(instructionPreamble.assumptions, array()), 'skill_level', {skill_level(texts)}, "
        "'safety_notes', CAST(array() AS array<string>), 'constraints', coalesce(notes, array()))"
    )
    own = f"coalesce({_spec('n.id')}, {bare(_ID)})"
    process = "CASE WHEN n.printSettings IS NOT NULL THEN 'fdm_3d_printing' WHEN n.type = 'machined' THEN 'machining' WHEN n.type = 'laser_cut' THEN 'laser_cutting' END"
    settings = f"array_compact(transform(nodes, (n, i) -> IF(n.printSettings IS NULL, NULL, named_struct('component_id', {own}, 'settings', looks[i].settings))))"
    fabrication = (
        f"named_struct('processes', array_sort(array_distinct(array_compact(transform(nodes, n -> {process})))), 'component_settings', {settings}, "
        "'post_processing', CAST(array() AS array<string>), 'tolerances', CAST(map() AS map<string, string>))"
    )
    unit, count = "coalesce(TRY_CAST(n.estimatedCost AS DECIMAL(18, 4)), 0)", f"coalesce({_AMOUNT}, 1L)"
    items = (
        f"transform(nodes, n -> named_struct('component_id', {own}, 'product_name', coalesce(nullif(n.productName, ''), n.name, ''), 'unit_cost_usd', CAST({unit} AS DECIMAL(18, 4)), 'quantity', {count}, "
        f"'total_cost_usd', CAST({unit} * {count} AS DECIMAL(18, 2)), 'vendor', {_STR}, 'url', {clean_url('n.purchaseUrl')}))"
    )
    df = df.withColumn("items", F.expr(items))
    sourcing = f"named_struct('items', items, 'cost_summary', {cost_summary('items', 'size(items)')}, 'vendors', CAST(array() AS array<string>))"
    return df.select(
        F.expr(project).alias("project"), F.expr(requirements).alias("requirements"), "components", F.expr("array_compact(transform(concat(el, me), e -> e.edge))").alias("relationships"),
        F.expr(fabrication).alias("fabrication"), F.expr(steps).alias("instructions"), F.expr(sourcing).alias("sourcing"), F.expr(validation("issues")).alias("validation"),
    )


def cost_summary(items: str, total: str) -> str:
    """What items cost together, how many have a price, and `total`: the number of items, or of components."""
    return (
        f"named_struct('total_usd', aggregate({items}, CAST(0 AS DECIMAL(18, 2)), (s, x) -> CAST(s + x.total_cost_usd AS DECIMAL(18, 2))), "
        f"'components_priced', size(filter({items}, x -> x.unit_cost_usd > 0)), 'components_total', {total})"
    )


def validation(issues: str) -> str:
    """The verdict on a record from its issues: sure 1.0 without any, 0.7 with warnings, 0.4 with errors."""
    error = f"exists({issues}, q -> q.severity = 'error')"
    return (
        f"named_struct('schema_valid', TRUE, 'reference_integrity_valid', NOT {error}, 'manufacturability_valid', TRUE, 'naming_consistency_valid', NOT exists({issues}, q -> q.code = 'duplicate_id'), "
        f"'issues', {issues}, 'confidence_score', CASE WHEN size({issues}) = 0 THEN 1.0D WHEN {error} THEN 0.4D ELSE 0.7D END)"
    )
