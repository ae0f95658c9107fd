"""Variants of records: positive ones along an axis, and negative ones with one known defect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .normalise import NO_ISSUES, cost_summary, issue, quoted

# Fixed values of the variants: axes (name, title, summary, size factor, cost factor), materials and what replaces them.
AXES = (
    ("compact", "Compact", "Compact variant: dimensions reduced ~30% for portability. ", 0.7, "0.85"),
    ("standard_size", "Standard Size", "Standard-size variant: dimensions scaled ~30% larger for capacity. ", 1.3, "1.15"),
    ("low_cost", "Budget", "Budget variant: cheaper sourcing and basic materials throughout. ", None, "0.65"),
    ("premium_material", "Premium", "Premium variant: upgraded materials (ASA, stainless) and post-process finishing. ", None, "1.4"),
    ("accessory_light", "Accessory-Light", "Accessory-light variant: {n} non-essential components removed. ", None, None),
)
CHEAPER = {"asa": "pla", "petg": "pla", "pc": "pla", "stainless": "carbon_steel", "stainless_steel": "carbon_steel", "anodized_aluminum": "aluminum"}
DEARER = {
    "pla": "asa", "abs": "asa", "petg": "pc_blend", "carbon_steel": "stainless", "steel": "stainless", "mild_steel": "stainless",
    "nylon": "ptfe", "aluminum": "anodized_aluminum",
}
FINISH = ("sand_180_grit", "primer_coat")
PHANTOM, FASTENERS_KEPT = "phantom_part_xyz", 4
SIZES = ("length_mm", "width_mm", "height_mm", "diameter_mm", "id_mm", "od_mm")


def _scaled(factor: float) -> Column:
    sizes = lambda d: d.withField(SIZES[0], F.round(d[SIZES[0]] * factor, 2))

    def each(c: Column) -> Column:
        d = sizes(c["dimensions"])
        for k in SIZES[1:]:
            d = d.withField(k, F.round(c["dimensions"][k] * factor, 2))
        return c.withField("dimensions", d)

    return F.transform("components", each)


def _swapped(materials: dict[str, str]) -> Column:
    def each(c: Column) -> Column:
        to = c["material"]
        for old, new in materials.items():
            to = F.when(F.lower(c["material"]) == old, F.lit(new)).otherwise(to)
        return c.withField("material", to)

    return F.transform("components", each)


def _items(factor: str) -> str:
    return (
        f"transform(sourcing.items, x -> named_struct('component_id', x.component_id, 'product_name', x.product_name, 'unit_cost_usd', CAST(CAST(x.unit_cost_usd * {factor} AS DECIMAL(18, 2)) AS DECIMAL(18, 4)), "
        f"'quantity', x.quantity, 'total_cost_usd', CAST(CAST(x.unit_cost_usd * {factor} AS DECIMAL(18, 2)) * x.quantity AS DECIMAL(18, 2)), 'vendor', x.vendor, 'url', x.url))"
    )


def _with_items(df: DataFrame, items: Column) -> DataFrame:
    df = df.withColumn("__items", items)
    return df.withColumn("sourcing", F.expr(f"named_struct('items', __items, 'cost_summary', {cost_summary('__items', 'size(components)')}, 'vendors', sourcing.vendors)")).drop("__items")


def drop_components(df: DataFrame, dropped: str) -> DataFrame:
    """Records without some components and without all that refers to them: edges, parts of steps, steps that keep no
    part, dependencies on such steps, items, settings. Costs are added up anew. A step that depends on a later one
    keeps that dependency even if the later one goes."""
    gone = lambda x: f"array_contains({dropped}, {x})"
    df = df.withColumn("components", F.expr(f"filter(components, c -> NOT {gone('c.component_id')})"))
    df = df.withColumn("relationships", F.expr(f"filter(relationships, r -> NOT {gone('r.source')} AND NOT {gone('r.target')})"))
    lost = f"transform(instructions, s -> size(filter(s.component_ids, c -> NOT {gone('c')})) = 0)"
    names = "transform(instructions, s -> s.step_id)"
    dead = "exists(sequence(0, size(__lost) - 1), j -> j < i AND __lost[j] AND __names[j] = d)"
    kept = f"transform(instructions, (s, i) -> IF(__lost[i], NULL, named_struct('step_id', s.step_id, 'phase', s.phase, 'title', s.title, 'component_ids', filter(s.component_ids, c -> NOT {gone('c')}), 'dependencies', filter(s.dependencies, d -> NOT {dead}), 'expected_result', s.expected_result, 'detail', s.detail)))"
    df = df.withColumn("__lost", F.expr(lost)).withColumn("__names", F.expr(names)).withColumn("instructions", F.expr(f"array_compact({kept})")).drop("__lost", "__names")
    df = df.withColumn("fabrication", F.col("fabrication").withField("component_settings", F.expr(f"filter(fabrication.component_settings, x -> NOT {gone('x.component_id')})")))
    df = df.withColumn("sourcing", F.col("sourcing").withField("items", F.expr(f"filter(sourcing.items, x -> NOT {gone('x.component_id')})")))
    return _with_items(df, F.expr(_items("1")))


def _named(df: DataFrame, label: Column, title: Column, summary: Column) -> DataFrame:
    p = F.col("project")
    p = p.withField("name", F.concat(p["name"], F.lit(" ("), title, F.lit(")"))).withField("summary", F.concat(summary, F.coalesce(p["summary"], F.lit(""))))
    p = p.withField("variant_type", F.lit("positive_variant")).withField("seed_project_id", F.col("project.project_id"))
    p = p.withField("project_id", F.concat(F.col("project.project_id"), F.lit("__pos_"), label)).withField("visual_ref", F.lit(None).cast("string"))
    clean = f"named_struct('schema_valid', TRUE, 'reference_integrity_valid', TRUE, 'manufacturability_valid', TRUE, 'naming_consistency_valid', TRUE, 'issues', {NO_ISSUES}, 'confidence_score', 1.0D)"
    return df.withColumn("project", p).withColumn("validation", F.expr(clean))


def _by(column: str, values: dict[str, Column], other: Column | None = None) -> Column:
    """The value that goes with what a column says, else the other."""
    out = F.lit(None) if other is None else other
    for k, v in values.items():
        out = F.when(F.col(column) == k, v).otherwise(out)
    return out


def _along(records: DataFrame, axes: list[tuple]) -> DataFrame:
    """Variants along axes that keep all parts, in one pass: each record stands once for every axis."""
    df = records.withColumn("__axis", F.explode(F.array(*[F.lit(a[0]) for a in axes])))
    swaps = {"low_cost": CHEAPER, "premium_material": DEARER}
    changed = {label: _scaled(size) for label, _, _, size, _ in axes if size is not None} | {label: _swapped(swaps[label]) for label, *_ in axes if label in swaps}
    df = df.withColumn("components", _by("__axis", changed, F.col("components")))
    finish = F.when(F.col("__axis") == "premium_material", F.array(*map(F.lit, FINISH))).otherwise(F.col("fabrication.post_processing"))
    df = df.withColumn("fabrication", F.col("fabrication").withField("post_processing", finish))
    df = _with_items(df, _by("__axis", {label: F.expr(_items(cost)) for label, *_, cost in axes}))
    return _named(df, F.col("__axis"), _by("__axis", {a[0]: F.lit(a[1]) for a in axes}), _by("__axis", {a[0]: F.lit(a[2]) for a in axes})).drop("__axis")


def _lighter(records: DataFrame, label: str, title: str, text: str) -> DataFrame:
    screws = "slice(filter(components, c -> c.type = 'fastener'), {k} + 1, size(components) + 1)".format(k=FASTENERS_KEPT)
    df = records.withColumn("__drop", F.expr(f"array_distinct(transform(concat({screws}, filter(components, c -> c.type = 'misc')), c -> c.component_id))"))
    # exploded, as Spark would move a plain filter down and make all components a second time for it
    df = df.withColumn("__some", F.explode_outer(F.expr("IF(size(__drop) > 0, array(TRUE), NULL)"))).where("__some").drop("__some")
    before, after = text.split("{n}")
    summary = F.concat(F.lit(before), F.size("__drop").cast("string"), F.lit(after))
    return _named(drop_components(df, "__drop"), F.lit(label), F.lit(title), summary).drop("__drop")


def positive_variants(records: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """A record for each axis that applies to a seed, named <seed>__pos_<axis>; unknown axes are ignored. Accessory-light
    keeps four fasteners and drops the others and all misc parts; a seed without such parts has no such variant."""
    chosen = [a for a in AXES if labels is None or a[0] in labels]
    whole, light = [a for a in chosen if a[4] is not None], [a for a in chosen if a[4] is None]
    made = ([_along(records, whole)] if whole else []) + [_lighter(records, *a[:3]) for a in light]
    if not made:
        return records.limit(0)
    return made[0] if len(made) == 1 else made[0].unionByName(made[1])


def _defects() -> dict[str, tuple[str, str, str, bool, str]]:
    """code: (what must not be empty, column, its new value, references hold, issue)."""
    first = lambda array, change: f"transform({array}, (x, i) -> IF(i = 0, {change}, x))"
    edge = lambda relation, target: f"named_struct('source', x.source, 'relation', {relation}, 'target', {target}, 'required', x.required, 'notes', x.notes)"
    step = f"named_struct('step_id', x.step_id, 'phase', x.phase, 'title', x.title, 'component_ids', concat(x.component_ids, array('{PHANTOM}')), 'dependencies', x.dependencies, 'expected_result', x.expected_result, 'detail', x.detail)"
    at, link, does = "components[0].component_id", "relationships[0]", "instructions[0].step_id"
    return {
        "dangling_ref": ("relationships", first("relationships", edge("x.relation", f"'{PHANTOM}'")), "FALSE", issue("error", "dangling_ref", f"concat('relationships[0].target ', {quoted(f'{chr(39)}{PHANTOM}{chr(39)}')}, ' not in components')", f"array('{PHANTOM}')")),
        "invalid_component_type": ("components", "", "TRUE", issue("error", "invalid_component_type", f"concat('component ', {quoted(at)}, ': type ', chr(39), 'gadget', chr(39), ' not in controlled vocab')", f"array({at})")),
        "invalid_relation": ("relationships", first("relationships", edge("'stuck_to'", "x.target")), "TRUE", issue("error", "invalid_relation", "concat('relationships[0].relation ', chr(39), 'stuck_to', chr(39), ' not in controlled vocab')", f"array({link}.source, {link}.target)")),
        "dangling_step_ref": ("instructions", first("instructions", step), "FALSE", issue("error", "dangling_step_ref", f"concat('instruction ', {quoted(does)}, ' references missing component ', {quoted(f'{chr(39)}{PHANTOM}{chr(39)}')})", f"array('{PHANTOM}')")),
    }


def negative_variants(records: DataFrame, codes: list[str] | None = None) -> DataFrame:
    """A record for each defect that fits a seed, named <seed>__neg_<code>, its validation naming the defect. One pass:
    each record stands once for every defect."""
    chosen = {k: v for k, v in _defects().items() if codes is None or k in codes}
    if not chosen:
        return records.limit(0)
    fits = ", ".join(f"IF(size({array}) > 0, '{k}', NULL)" for k, (array, *_) in chosen.items())
    df = records.withColumn("__code", F.explode_outer(F.expr(f"array_compact(array({fits}))"))).where("__code IS NOT NULL")
    verdict = "named_struct('schema_valid', TRUE, 'reference_integrity_valid', {}, 'manufacturability_valid', TRUE, 'naming_consistency_valid', TRUE, 'issues', array({}), 'confidence_score', 0.2D)"
    df = df.withColumn("validation", _by("__code", {k: F.expr(verdict.format(holds, found)) for k, (_, _, holds, found) in chosen.items()}))
    gadget = F.transform("components", lambda c, i: c.withField("type", F.when(i == 0, F.lit("gadget")).otherwise(c["type"])))
    for column in ("components", "relationships", "instructions"):
        changed = {k: F.expr(value) if value else gadget for k, (array, value, *_) in chosen.items() if array == column}
        df = df.withColumn(column, _by("__code", changed, F.col(column)))
    p = F.col("project").withField("variant_type", F.lit("evaluation_negative")).withField("seed_project_id", F.col("project.project_id"))
    p = p.withField("project_id", F.concat(F.col("project.project_id"), F.lit("__neg_"), F.col("__code"))).withField("visual_ref", F.lit(None).cast("string"))
    return df.withColumn("project", p).drop("__code")
