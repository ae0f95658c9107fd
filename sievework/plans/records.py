"""The record operators on nested records made of orders (a project), their line items (nodes) and parts. The SQL that
checks them is written by hand over the flat tables and shares no text with the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import assembly, audit, normalise, repair, rules, scoring, variants
from ..session import table


def raw_configs(spark: SparkSession, sf_dir: str, looks: bool = True) -> DataFrame:
    """One raw configuration an order: nodes in the order of the lines, wires and joints to the node before. What hangs
    on the part alone is worked out once a part: names, and with looks what its texts tell (else it is read where it
    is wanted)."""
    prints = "IF(p_size % 9 = 0, concat(cast(p_size + 10 as string), '% infill, 0.2mm layer, PETG'), NULL)"
    text = f"named_struct('id', concat('P ', p_partkey % 12), 'name', p_name, 'dimensions', concat(p_size, 'x40x15mm'), 'printSettings', {prints})"
    part = table(spark, sf_dir, "part").repartition("p_partkey")  # its small file would be read and worked out in one task
    part = part.select("p_partkey", "p_name", "p_size", F.expr(text).alias("n"))
    part = part.select("*", F.expr(normalise.names("n")).alias("names"), *([F.expr(normalise.looks("n")).alias("looks")] if looks else []))
    lines = table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    seen = ", looks AS looks" if looks else ""
    node = F.expr(
        "struct(l_linenumber AS a, l_partkey AS b, l_suppkey AS c, l_extendedprice AS d, l_quantity AS q, l_returnflag AS flag, l_tax AS tax, l_discount AS cut, p_name AS name, p_size AS size, "
        f"n.id AS id, n.dimensions AS dims, n.printSettings AS prints, names AS names{seen})"
    )
    df = lines.select("l_orderkey", node.alias("x")).repartition("l_orderkey").groupBy("l_orderkey").agg(F.sort_array(F.collect_list("x")).alias("n"))
    made = {
        "slug": "concat('Order-', l_orderkey)", "projectName": "concat('Order ', l_orderkey)", "projectDescription": "CAST(NULL AS STRING)", "plan": "concat('plan ', l_orderkey)",
        "originalPrompt": "concat('a portable thing with ', CASE l_orderkey % 3 WHEN 0 THEN 'esp32' WHEN 1 THEN 'a motor and usb-c' ELSE 'nothing' END)", "notes": "IF(l_orderkey % 5 = 0, array('High Voltage'), CAST(array() AS array<string>))",
        "nodes": f"transform(n, x -> named_struct('id', x.id, 'name', x.name, 'type', CASE x.flag WHEN 'A' THEN 'Sensor' WHEN 'R' THEN 'misc' ELSE 'structural' END, 'category', CAST(NULL AS STRING), 'material', CAST(NULL AS STRING), 'quantity', IF(x.a = 7, 'some', cast(cast(x.q AS int) as string)), 'description', CAST(NULL AS STRING), 'dimensions', x.dims, 'printSettings', x.prints, 'estimatedCost', cast(cast(x.d AS decimal(18, 2)) as string), 'purchaseUrl', IF(x.size % 2 = 0, concat('https://x/', x.b), 'N/A'), 'productName', CAST(NULL AS STRING), 'names', x.names{', ' + chr(39) + 'looks' + chr(39) + ', x.looks' if looks else ''}))",
        "electricalConnections": "array_compact(transform(n, (x, i) -> IF(i > 0 AND x.flag = 'A', named_struct('source', n[i - 1].id, 'target', IF(x.cut >= 0.09, 'gone', x.id), 'label', 'bus', 'protocol', IF(x.tax > 0.04, 'I2C', NULL), 'voltage', CAST(NULL AS STRING), 'sourcePin', CAST(NULL AS STRING), 'targetPin', CAST(NULL AS STRING)), NULL)))".replace("n[i - 1]", "n[greatest(i - 1, 0)]"),
        "mechanicalConnections": "array_compact(transform(n, (x, i) -> IF(i > 0 AND x.flag = 'R', named_struct('source', n[greatest(i - 1, 0)].id, 'target', x.id, 'label', CASE x.size % 4 WHEN 0 THEN 'servo horn' WHEN 1 THEN 'press fit' WHEN 2 THEN 'rests on' ELSE 'glued' END), NULL)))",
        "instructionPreamble": "named_struct('tools', array('hand'), 'assumptions', IF(l_orderkey % 2 = 0, array('basic skills'), CAST(array() AS array<string>)))",
        "instructionSteps": "array(named_struct('id', 'fabricate', 'subSteps', transform(filter(n, x -> x.size % 9 = 0), x -> named_struct('id', CAST(NULL AS STRING), 'title', x.name, 'partIds', array(x.id), 'detail', CAST(NULL AS STRING)))), named_struct('id', 'assemble', 'subSteps', transform(n, x -> named_struct('id', CAST(NULL AS STRING), 'title', x.name, 'partIds', IF(x.cut >= 0.09, array(x.id, 'ghost'), array(x.id)), 'detail', IF(x.size % 2 = 0, concat(x.name, ' goes to its place'), NULL)))))",
    }
    return df.select(*[F.expr(v).alias(k) for k, v in made.items()])


def _records(spark, sf_dir, looks=True):
    return normalise.normalise(raw_configs(spark, sf_dir, looks))


def _each(records: DataFrame, array: str, name: str) -> DataFrame:
    """(project_id, pos, name): the elements of an array. Outer, and empty ones dropped after: else Spark asks for the
    size of the array in a filter before, and makes all of it twice."""
    only = records.select(_pid(), F.col(array).alias("xs"))  # before the filter, which keeps Spark from taking only these
    return only.select("project_id", F.posexplode_outer("xs").alias("pos", name)).where("pos IS NOT NULL")


def _pid():
    return F.col("project.project_id").alias("project_id")


def rec_components(spark, sf_dir):
    df = _each(_records(spark, sf_dir), "components", "c")
    return df.select("project_id", "pos", "c.component_id", "c.type", "c.category", "c.material", "c.quantity", "c.functional_role", F.col("c.dimensions.length_mm").alias("length_mm"), "c.fabrication_ref")


def rec_relationships(spark, sf_dir):
    df = _each(_records(spark, sf_dir, False), "relationships", "r")
    return df.select("project_id", "pos", "r.source", "r.relation", "r.target", "r.notes")


def rec_instructions(spark, sf_dir):
    df = _each(_records(spark, sf_dir, False), "instructions", "s")
    return df.select("project_id", "pos", "s.step_id", "s.phase", "s.title", F.concat_ws(",", "s.component_ids").alias("parts"), F.concat_ws(",", "s.dependencies").alias("after"))


def rec_projects(spark, sf_dir):
    r = _records(spark, sf_dir)
    return r.select(
        _pid(), F.col("project.category").alias("category"), F.col("project.summary").alias("summary"), F.col("requirements.skill_level").alias("skill_level"), F.concat_ws(",", "fabrication.processes").alias("processes"),
        F.size("fabrication.component_settings").alias("n_settings"), F.col("sourcing.cost_summary.total_usd").alias("total_usd"), F.col("sourcing.cost_summary.components_priced").alias("priced"),
        F.size(F.filter("sourcing.items", lambda x: x["url"].isNotNull())).alias("n_urls"), F.col("validation.confidence_score").alias("confidence"),
    )


def rec_issues(spark, sf_dir):
    df = _each(_records(spark, sf_dir, False), "validation.issues", "q")
    return df.groupBy("project_id", F.col("q.code").alias("code"), F.col("q.severity").alias("severity")).agg(F.count(F.lit(1)).alias("n"))


def rec_rules(spark, sf_dir):
    df = _each(rules.with_issues(_records(spark, sf_dir)), "found", "q")
    return df.groupBy("project_id", F.col("q.code").alias("code"), F.col("q.severity").alias("severity")).agg(F.count(F.lit(1)).alias("n"))


def rec_gate(spark, sf_dir):
    return assembly.with_fault(_records(spark, sf_dir, False)).select(_pid(), F.coalesce("fault", F.lit("ok")).alias("reason"))


def rec_variants(spark, sf_dir):
    df = variants.positive_variants(_records(spark, sf_dir))
    return df.select(_pid(), F.size("components").alias("n_components"), F.size("instructions").alias("n_steps"), F.size("relationships").alias("n_edges"), F.col("sourcing.cost_summary.total_usd").alias("total_usd"))


def rec_negatives(spark, sf_dir):
    df = variants.negative_variants(_records(spark, sf_dir))
    return df.select(_pid(), F.element_at("validation.issues", 1)["message"].alias("message"))


def rec_audit(spark, sf_dir):
    df = audit.audit_records(_records(spark, sf_dir))
    return df.select("project_id", F.concat_ws(",", "prompt_keywords").alias("asked"), F.concat_ws(",", "mismatches").alias("missed"), "coverage_ratio")


def rec_fixup(spark, sf_dir):
    df = repair.fixup(_records(spark, sf_dir))
    return df.select(_pid(), F.size("components").alias("n_components"), F.size("sourcing.items").alias("n_items"), F.concat_ws("|", "actions").alias("actions"))


def rec_scores(spark, sf_dir):
    """The edges of a record as the answer for those of the next order's, as mode D."""
    r = _records(spark, sf_dir, False).select(_pid(), F.to_json(F.struct("relationships")).alias("output"), F.concat(F.lit('{"relationships": ['), F.lit("]}")).alias("none"))
    cases = r.select("project_id", F.lit("D").alias("mode"), F.lit("").alias("user"), F.concat(F.lit("Sure:\n```json\n"), "output", F.lit("\n```")).alias("output"), F.when(F.length("output") % 2 == 0, F.col("output")).otherwise(F.col("none")).alias("gold"), F.col("output").alias("was"))
    scored = scoring.score_cases(cases)
    return scored.select("project_id", "parsed", "valid", (F.col("tp") + F.col("fp")).alias("n_atoms"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (rec_components, rec_relationships, rec_instructions, rec_projects, rec_issues, rec_rules, rec_gate, rec_variants, rec_negatives, rec_audit, rec_fixup, rec_scores)
}

_BASE = """
WITH l AS (
  SELECT 'order_' || l_orderkey AS project_id, l_orderkey AS o, l_linenumber AS a, l_extendedprice AS d, l_quantity AS q, l_returnflag AS flag, l_tax AS tax, l_discount AS cut, p_name AS name, p_size AS size, l_partkey AS part,
         'p_' || (l_partkey % 12) AS base,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_returnflag, l_tax, l_discount, p_name, p_size) - 1 AS pos
  FROM lineitem JOIN part ON l_partkey = p_partkey),
n AS (
  SELECT *, row_number() OVER (PARTITION BY o, base ORDER BY pos) AS k, count(*) OVER (PARTITION BY o, base) AS copies,
         CASE WHEN flag = 'R' AND regexp_matches(name, 'screw|nut|bolt|washer|standoff|spacer|rivet') THEN 'fastener' WHEN size % 9 = 0 THEN '3d_printed' WHEN flag = 'A' THEN 'electronic' WHEN flag = 'R' THEN 'misc' ELSE 'mechanical' END AS type
  FROM l),
c AS (
  SELECT *, base || CASE WHEN k > 1 THEN '_' || k ELSE '' END AS spec, base || CASE WHEN copies > 1 THEN '_' || copies ELSE '' END AS known,
         CASE WHEN type = 'electronic' THEN 'electrical' ELSE 'mechanical' END AS category
  FROM n),
w AS (SELECT *, lag(known) OVER (PARTITION BY o ORDER BY pos) AS before FROM c),
e AS (
  SELECT project_id, o, before AS source, known AS target, CASE WHEN flag = 'A' THEN 'connects_to' WHEN size % 4 = 0 THEN 'rotates_on' WHEN size % 4 = 1 THEN 'fastens_into' WHEN size % 4 = 2 THEN 'supported_by' ELSE 'attached_to' END AS relation,
         CASE WHEN flag = 'A' THEN CASE WHEN tax > 0.04 THEN 'protocol=I2C' ELSE 'bus' END WHEN size % 4 = 0 THEN 'servo horn' WHEN size % 4 = 1 THEN 'press fit' WHEN size % 4 = 2 THEN 'rests on' ELSE 'glued' END AS notes,
         row_number() OVER (PARTITION BY o ORDER BY flag, pos) - 1 AS pos
  FROM w WHERE pos > 0 AND (flag = 'R' OR (flag = 'A' AND cut < 0.09))),
s0 AS (
  SELECT project_id, o, 1 AS part_no, pos, 'fabrication' AS phase, name, known, FALSE AS ghost, '' AS detail FROM c WHERE size % 9 = 0
  UNION ALL SELECT project_id, o, 2, pos, 'assembly', name, known, cut >= 0.09, CASE WHEN size % 2 = 0 THEN name || ' goes to its place' ELSE '' END FROM c),
s1 AS (SELECT *, row_number() OVER (PARTITION BY o ORDER BY part_no, pos) AS no FROM s0),
s AS (SELECT *, phase || '_' || no AS step_id, lag(phase || '_' || no) OVER (PARTITION BY o ORDER BY no) AS after FROM s1),
issues AS (
  SELECT project_id, 'duplicate_id' AS code, 'warn' AS severity, count(*) AS n FROM c WHERE k > 1 GROUP BY 1
  UNION ALL SELECT project_id, 'invalid_quantity', 'warn', count(*) FROM c WHERE a = 7 GROUP BY 1
  UNION ALL SELECT project_id, 'dangling_ref', 'error', count(*) FROM c WHERE pos > 0 AND flag = 'A' AND cut >= 0.09 GROUP BY 1
  UNION ALL SELECT project_id, 'dangling_step_ref', 'error', count(*) FROM s WHERE ghost GROUP BY 1)
"""

_ROLE = (
    "CASE WHEN regexp_matches(name, 'mcu|controller|esp32|raspberry|stm32|arduino|teensy') THEN 'main_controller' WHEN regexp_matches(name, 'screw|nut|bolt|washer') THEN 'fastener' "
    "WHEN flag = 'A' THEN 'Sensor' WHEN flag = 'R' THEN 'misc' ELSE 'structural' END"
)

_MONEY = "CAST(round(CAST(d AS DECIMAL(18, 2)) * {f}, 2) AS DECIMAL(18, 2)) * CASE WHEN a = 7 THEN 1 ELSE CAST(q AS BIGINT) END"

ORACLES: dict[str, str] = {
    "rec_components": _BASE + f"SELECT project_id, pos, spec AS component_id, type, category, CASE WHEN type = 'fastener' THEN 'steel' ELSE 'unknown' END AS material, CASE WHEN a = 7 THEN 1 ELSE CAST(q AS BIGINT) END AS quantity, {_ROLE} AS functional_role, CAST(size AS DOUBLE) AS length_mm, CASE WHEN size % 9 = 0 THEN spec END AS fabrication_ref FROM c",
    "rec_relationships": _BASE + "SELECT project_id, pos, source, relation, target, notes FROM e",
    "rec_instructions": _BASE + "SELECT project_id, no - 1 AS pos, step_id, phase, name AS title, known AS parts, coalesce(after, '') AS after FROM s",
    "rec_issues": _BASE + "SELECT * FROM issues",
    "rec_projects": _BASE + """SELECT project_id, CASE WHEN bool_or(category = 'electrical') AND bool_or(category = 'mechanical') THEN 'electromechanical' WHEN bool_or(category = 'electrical') THEN 'electronics' ELSE 'mechanical' END AS category,
        'plan ' || any_value(o) AS summary, CASE WHEN any_value(o) % 5 = 0 THEN 'advanced' WHEN any_value(o) % 2 = 0 THEN 'beginner' ELSE 'intermediate' END AS skill_level, CASE WHEN bool_or(size % 9 = 0) THEN 'fdm_3d_printing' ELSE '' END AS processes,
        count(CASE WHEN size % 9 = 0 THEN 1 END) AS n_settings, sum(""" + _MONEY.format(f=1) + """) AS total_usd, count(CASE WHEN d > 0 THEN 1 END) AS priced, count(CASE WHEN size % 2 = 0 THEN 1 END) AS n_urls,
        CASE WHEN project_id IN (SELECT project_id FROM issues WHERE severity = 'error') THEN 0.4 WHEN project_id IN (SELECT project_id FROM issues) THEN 0.7 ELSE 1.0 END::DOUBLE AS confidence FROM c GROUP BY project_id""",
    "rec_rules": _BASE + """SELECT project_id, 'missing_electrical_connections' AS code, 'error' AS severity, 1 AS n FROM c GROUP BY project_id HAVING count(CASE WHEN category = 'electrical' THEN 1 END) >= 2 AND project_id NOT IN (SELECT project_id FROM e WHERE relation = 'connects_to')
        UNION ALL SELECT project_id, 'missing_print_settings', 'warn', count(*) FROM c WHERE type = '3d_printed' AND NOT EXISTS (SELECT 1 FROM c y WHERE y.size % 9 = 0 AND y.project_id = c.project_id AND y.known = c.spec) GROUP BY 1
        UNION ALL SELECT project_id, 'duplicate_display_name', 'warn', count(*) FROM (SELECT project_id, name FROM c GROUP BY 1, 2 HAVING count(*) > 1) x GROUP BY 1""",
    "rec_gate": _BASE + "SELECT project_id, coalesce(min_by('step ''' || step_id || ''' has empty/missing body', no) FILTER (WHERE detail = ''), 'ok') AS reason FROM s GROUP BY project_id",
    "rec_variants": _BASE + """, drops AS (SELECT *, (type = 'misc' OR (type = 'fastener' AND row_number() OVER (PARTITION BY o, type ORDER BY pos) > 4)) AS gone FROM c),
        dead AS (SELECT DISTINCT project_id, spec FROM drops WHERE gone),
        axes AS (SELECT 'compact' AS axis, 0.85 AS f UNION ALL SELECT 'standard_size', 1.15 UNION ALL SELECT 'low_cost', 0.65 UNION ALL SELECT 'premium_material', 1.4),
        steps AS (SELECT project_id, count(*) AS n_steps FROM s GROUP BY 1), edges AS (SELECT project_id, count(*) AS n_edges FROM e GROUP BY 1),
        steps2 AS (SELECT project_id, count(*) AS n_steps FROM s WHERE NOT EXISTS (SELECT 1 FROM dead x WHERE x.project_id = s.project_id AND x.spec = s.known) GROUP BY 1),
        edges2 AS (SELECT project_id, count(*) AS n_edges FROM e WHERE NOT EXISTS (SELECT 1 FROM dead x WHERE x.project_id = e.project_id AND x.spec = e.source) AND NOT EXISTS (SELECT 1 FROM dead x WHERE x.project_id = e.project_id AND x.spec = e.target) GROUP BY 1)
        SELECT project_id || '__pos_' || axis AS project_id, count(*) AS n_components, any_value(n_steps) AS n_steps, coalesce(any_value(n_edges), 0) AS n_edges,
               sum(CASE axis WHEN 'compact' THEN """ + _MONEY.format(f=0.85) + " WHEN 'standard_size' THEN " + _MONEY.format(f=1.15) + " WHEN 'low_cost' THEN " + _MONEY.format(f=0.65) + " ELSE " + _MONEY.format(f=1.4) + """ END) AS total_usd
        FROM c JOIN steps USING (project_id) LEFT JOIN edges USING (project_id), axes GROUP BY project_id, axis
        UNION ALL SELECT x.project_id || '__pos_accessory_light', count(CASE WHEN NOT gone THEN 1 END), coalesce(any_value(n_steps), 0), coalesce(any_value(n_edges), 0),
               coalesce(sum(CASE WHEN y.spec IS NULL THEN """ + _MONEY.format(f=1) + """ END), 0)
        FROM drops x LEFT JOIN dead y ON y.project_id = x.project_id AND y.spec = x.known LEFT JOIN steps2 ON steps2.project_id = x.project_id LEFT JOIN edges2 ON edges2.project_id = x.project_id GROUP BY x.project_id HAVING bool_or(gone)""",
    "rec_negatives": _BASE + """SELECT project_id || '__neg_dangling_ref' AS project_id, 'relationships[0].target ''phantom_part_xyz'' not in components' AS message FROM e GROUP BY project_id
        UNION ALL SELECT project_id || '__neg_invalid_relation', 'relationships[0].relation ''stuck_to'' not in controlled vocab' FROM e GROUP BY project_id
        UNION ALL SELECT project_id || '__neg_invalid_component_type', 'component ''' || spec || ''': type ''gadget'' not in controlled vocab' FROM c WHERE pos = 0
        UNION ALL SELECT project_id || '__neg_dangling_step_ref', 'instruction ''' || step_id || ''' references missing component ''phantom_part_xyz''' FROM s WHERE no = 1""",
    "rec_audit": _BASE + """, p AS (SELECT DISTINCT project_id, o FROM c)
        SELECT project_id, CASE o % 3 WHEN 0 THEN 'esp32,compact' WHEN 1 THEN 'usb_c,motor,compact' ELSE 'compact' END AS asked, CASE o % 3 WHEN 0 THEN 'esp32' WHEN 1 THEN 'usb_c,motor' ELSE '' END AS missed,
               CASE o % 3 WHEN 0 THEN 0.5 WHEN 1 THEN 0.333 ELSE 1.0 END::DOUBLE AS coverage_ratio FROM p""",
    "rec_fixup": _BASE + """, lost AS (
          SELECT project_id, 'gone' AS m FROM c WHERE pos > 0 AND flag = 'A' AND cut >= 0.09
          UNION SELECT project_id, 'ghost' FROM s WHERE ghost
          UNION SELECT project_id, upper(before[1]) || ' ' || split_part(before, '_', 2) FROM w WHERE pos > 0 AND flag = 'A' AND cut >= 0.09),
        plain AS (SELECT project_id, list_sort(list(m)) AS ms FROM lost GROUP BY 1)
        SELECT c.project_id, count(*) + coalesce(len(any_value(ms)), 0) AS n_components, count(*) + coalesce(len(any_value(ms)), 0) + count(DISTINCT spec) - count(DISTINCT CASE WHEN spec = known THEN spec END) AS n_items,
               coalesce(array_to_string(list_transform(any_value(ms), lambda x: 'add placeholder component ''' || x || ''''), '|'), '') AS actions
        FROM c LEFT JOIN plain ON plain.project_id = c.project_id GROUP BY c.project_id""",
    "rec_scores": _BASE + "SELECT p.project_id, TRUE AS parsed, TRUE AS valid, coalesce(k.n, 0) AS n_atoms FROM (SELECT DISTINCT project_id FROM c) p LEFT JOIN (SELECT project_id, count(DISTINCT (source, relation, target)) AS n FROM e GROUP BY 1) k ON k.project_id = p.project_id",
}
