"""Record operators on nested fixtures."""

import json

import pytest

from sievework.operators import assembly, normalise, rules, variants

from records import RAW


@pytest.fixture(scope="module")
def records(spark):
    rows = [json.dumps(r) for r in RAW]
    raw = spark.createDataFrame([(r,) for r in rows], "v string").selectExpr(f"from_json(v, '{normalise.RAW_SCHEMA}') AS r").select("r.*")
    return normalise.normalise(raw).cache()


def by_id(df):
    return {r.project.project_id: r.asDict(True) for r in df.collect()}


def test_components(records):
    got = by_id(records)
    clock = got["desk_clock_v2"]["components"]
    assert [c["component_id"] for c in clock] == ["mcu_1", "disp", "disp_2", "case", "m3_screw", "s2", "plate"]
    assert [c["type"] for c in clock] == ["electronic", "electronic", "misc", "3d_printed", "fastener", "fastener", "misc"]
    assert [c["category"] for c in clock] == ["electrical", "electrical", "mechanical", "mechanical", "mechanical", "mechanical", "mechanical"]
    assert [c["quantity"] for c in clock] == [1, 1, 2, 1, 4, 1, 1]
    assert [c["material"] for c in clock] == ["unknown", "unknown", "unknown", "unknown", "steel", "steel", "unknown"]
    assert [c["functional_role"] for c in clock] == ["main_controller", "display", "other", "enclosure", "fastener", "fastener", "machined"]
    assert [c["fabrication_ref"] for c in clock] == [None, None, None, "case", None, None, None]
    sizes = [{k: v for k, v in c["dimensions"].items() if v is not None and k != "raw"} for c in clock]
    assert sizes == [{}, {"length_mm": 27.0, "width_mm": 27.0}, {"id_mm": 6.0, "od_mm": 9.0, "length_mm": 5000.0}, {"length_mm": 400.0, "width_mm": 40.0, "height_mm": 15.0}, {"thread": "M3", "length_mm": 12.0}, {"diameter_mm": 110.0, "length_mm": 30.0}, {"unparsed": True}]
    assert [c["component_id"] for c in got["unknown"]["components"]] == ["a_b", "a_b_2", "a_b_3", "a_b_2_2", "lamp"]
    assert got["bare"]["components"] == []


@pytest.mark.parametrize("text", ["Desk--Clock _ v2", "__a__", "!!", "", "Ünit-2", "a_b", None])
def test_bare_is_snake(spark, text):
    from sievework.functions.dialect import Spark, snake

    row = spark.createDataFrame([(text,)], "x string").selectExpr(f"{normalise.bare('x')} AS a", f"{snake(Spark(), 'x')} AS b").first()
    assert row.a == row.b


@pytest.mark.parametrize("array", ["components", "relationships", "instructions"])
def test_rows_of_records_are_made_once(spark, array):
    from sievework.plans import records as plans

    plan = plans.QUERIES[f"rec_{array}"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Generate") :]
    assert "Filter (size(" not in below  # else all of it is made again for the filter
    assert plan.count("functional_role") == 0 or array == "components"


def test_brought_looks_are_those_of_the_nodes(spark):
    from sievework.plans import records as plans

    raws = [plans.raw_configs(spark, "/root/testdata/sf0.001", looks) for looks in (True, False)]
    with_looks, without = [normalise.normalise(r.where("slug < 'Order-2'")) for r in raws]
    assert with_looks.count() > 100
    text = lambda df: sorted(r.v for r in df.selectExpr("to_json(struct(*)) AS v").collect())
    assert text(with_looks) == text(without)


def test_edges_steps_and_issues(records):
    got = by_id(records)
    clock = got["desk_clock_v2"]
    assert [(r["source"], r["relation"], r["target"], r["notes"]) for r in clock["relationships"]] == [
        ("mcu_1", "connects_to", "disp", "protocol=I2C; voltage=3.3V; pins=21->SDA"), ("disp", "connects_to", "mcu_1", "only label"),
        ("case", "fastens_into", "plate", "M3 bolts"), ("case", "attached_to", "disp", ""),
    ]
    assert [(s["step_id"], s["phase"], s["component_ids"], s["dependencies"]) for s in clock["instructions"]] == [
        ("fabrication_1", "fabrication", ["case"], []), ("wire_up", "wiring", ["mcu_1", "disp"], ["fabrication_1"]), ("wiring_3", "wiring", [], ["wire_up"]),
    ]
    assert [(i["severity"], i["code"], i["refs"]) for i in clock["validation"]["issues"]] == [
        ("warn", "invalid_quantity", ["disp"]), ("warn", "duplicate_id", ["disp"]), ("error", "dangling_ref", ["MCU-1", "nowhere"]), ("error", "dangling_step_ref", ["ghost"]),
    ]
    assert clock["validation"]["issues"][2]["message"] == "electrical conn 'MCU-1'->'nowhere' references missing component"
    assert (clock["validation"]["confidence_score"], clock["validation"]["naming_consistency_valid"], clock["validation"]["reference_integrity_valid"]) == (0.4, False, False)
    assert [i["code"] for i in got["bare"]["validation"]["issues"]] == ["empty_instructions"]


def test_project_requirements_sourcing_fabrication(records):
    got = by_id(records)
    clock = got["desk_clock_v2"]
    assert clock["project"]["category"] == "electromechanical" and clock["project"]["summary"] == "p" * 300 and clock["project"]["visual_ref"] == "desk_clock_v2_VISUAL.png"
    assert got["bare"]["project"]["category"] == "unknown" and got["bare"]["project"]["name"] == "bare"
    assert clock["requirements"] == {"tools": ["iron"], "assumptions": ["basic soldering"], "skill_level": "advanced", "safety_notes": [], "constraints": ["RTOS based"]}
    items = clock["sourcing"]["items"]
    assert [x["url"] for x in items] == ["https://shop.example/x", None, None, None, None, None, None]
    assert [x["component_id"] for x in items][4] == "unknown"  # a node without an id answers for none
    assert str(clock["sourcing"]["cost_summary"]["total_usd"]) == "10.51" and clock["sourcing"]["cost_summary"]["components_priced"] == 2
    fab = clock["fabrication"]
    assert fab["processes"] == ["fdm_3d_printing", "machining"]
    assert fab["component_settings"][0]["settings"] == {"raw": RAW[0]["nodes"][3]["printSettings"], "infill_pct": 20, "layer_mm": 0.2, "perimeters": 3, "nozzle_mm": 0.4, "material_hint": "NYLON"}


def test_rules(records, spark):
    found = {r.project.project_id: [(i.severity, i.code, list(i.refs)) for i in r.found] for r in rules.with_issues(records).collect()}
    assert found["desk_clock_v2"] == [("error", "dangling_sourcing_ref", ["unknown"]), ("warn", "duplicate_display_name", ["M3 Screw"])]
    assert ("error", "empty_instructions", []) in found["bare"]
    assert found["unknown"][0][:2] == ("error", "schema_violation")
    broken = records.where("project.project_id = 'desk_clock_v2'")
    broken = broken.withColumn("instructions", rules.F.expr("transform(instructions, (s, i) -> named_struct('step_id', IF(i = 2, 'wire_up', s.step_id), 'phase', IF(i = 0, 'dream', s.phase), 'title', s.title, 'component_ids', IF(i = 1, array('ghost'), s.component_ids), 'dependencies', IF(i = 0, array('wire_up', 'never'), s.dependencies), 'expected_result', s.expected_result, 'detail', s.detail))"))
    broken = broken.withColumn("relationships", rules.F.expr("filter(relationships, r -> r.relation <> 'connects_to')"))
    codes = [i.code for i in rules.with_issues(broken).first().found]
    assert codes == ["invalid_phase", "duplicate_step_id", "dangling_step_ref", "forward_dependency", "missing_dependency", "dangling_sourcing_ref", "missing_electrical_connections", "duplicate_display_name"]
    soft = rules.with_issues(broken, strict=False).first().found
    assert [i.severity for i in soft if i.code == "missing_electrical_connections"] == ["warn"]
    assert rules.with_issues(records).where(~rules.is_valid()).count() == 3


def test_gate(records):
    faults = {r.project.project_id: r.fault for r in assembly.with_fault(records).collect()}
    assert faults == {"desk_clock_v2": "step 'wire_up' has empty/missing body", "bare": "no instruction steps", "unknown": "step 'later_1' has empty/missing body"}
    told = records.withColumn("instructions", assembly.F.expr("transform(instructions, s -> named_struct('step_id', s.step_id, 'phase', s.phase, 'title', s.title, 'component_ids', s.component_ids, 'dependencies', s.dependencies, 'expected_result', s.expected_result, 'detail', coalesce(s.detail, 'Join the wires and solder.')))"))
    kept, skipped = assembly.filter_compliant(told)
    assert kept.columns == records.columns and {r.object_id for r in skipped.collect()} == {"bare"}
    assert tuple(assembly.coverage(told).first()) == (3, 2, 1)


def test_variants(records):
    seed = records.where("project.project_id = 'desk_clock_v2'")
    made = {r.project.project_id.split("__")[1]: r.asDict(True) for r in variants.positive_variants(seed).collect()}
    assert set(made) == {"pos_compact", "pos_standard_size", "pos_low_cost", "pos_premium_material", "pos_accessory_light"}
    assert made["pos_compact"]["components"][3]["dimensions"]["length_mm"] == 280.0 and str(made["pos_compact"]["sourcing"]["items"][0]["unit_cost_usd"]) == "5.5300"
    assert made["pos_premium_material"]["components"][4]["material"] == "stainless" and made["pos_premium_material"]["fabrication"]["post_processing"] == ["sand_180_grit", "primer_coat"]
    light = made["pos_accessory_light"]
    assert [c["component_id"] for c in light["components"]] == ["mcu_1", "disp", "case", "m3_screw", "s2"] and light["project"]["summary"].startswith("Accessory-light variant: 2 ")
    assert [s["step_id"] for s in light["instructions"]] == ["fabrication_1", "wire_up"] and len(light["relationships"]) == 3
    bad = {r.project.project_id.split("__neg_")[1]: r for r in rules.with_issues(variants.negative_variants(seed)).collect()}
    assert set(bad) == {"dangling_ref", "invalid_component_type", "invalid_relation", "dangling_step_ref"}
    for code, r in bad.items():
        assert code in {i.code for i in r.found} and [i.code for i in r.validation.issues] == [code]
        assert r.validation.issues[0].message in {i.message for i in r.found}


def test_variants_in_one_pass(spark):
    from sievework.plans import records as plans

    for name, passes in (("rec_variants", 2), ("rec_negatives", 1)):
        plan = plans.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "InMemoryRelation" not in plan and plan.count("RepartitionByExpression [l_orderkey") == passes


def test_variants_by_label(records):
    seed = records.where("project.project_id = 'desk_clock_v2'")
    every = {r.project.project_id: r for r in variants.positive_variants(seed).collect()}
    for label, *_ in variants.AXES:
        (one,) = variants.positive_variants(seed, [label, "none such"]).collect()
        assert one == every[f"desk_clock_v2__pos_{label}"]
    assert variants.positive_variants(seed, []).count() == 0 and variants.negative_variants(seed, []).count() == 0
    assert [r.project.project_id for r in variants.negative_variants(seed, ["invalid_relation"]).collect()] == ["desk_clock_v2__neg_invalid_relation"]


def test_audit(records):
    from sievework.operators import audit

    got = {r.project_id: (list(r.prompt_keywords), list(r.mismatches), r.coverage_ratio) for r in audit.audit_records(records).collect()}
    assert got["desk_clock_v2"] == (["wifi", "display"], [], 1.0) and got["bare"] == ([], [], 1.0)
    asked = records.withColumn("project", audit.F.col("project").withField("original_prompt", audit.F.lit("A portable mic with LoRa; ammic no")))
    rows = audit.audit_records(asked)
    assert {r.project_id: (list(r.prompt_keywords), list(r.mismatches)) for r in rows.collect()}["desk_clock_v2"] == (["lora", "microphone", "compact"], ["lora", "microphone"])
    total = {r.variant_type: tuple(r)[1:] for r in audit.audit_summary(rows).collect()}
    assert total["ALL"] == (3, 3, 3, 6) and {r.keyword: r.n for r in audit.missed_keywords(rows).collect()} == {"lora": 3, "microphone": 3}


def test_fuzzy_resolve(spark):
    from sievework.operators import repair

    known = ["esp32_mcu", "m3_screw", "m4_bolt_set", "lidar_sensor", "display_mount", "oled_display_main"]
    want = {"esp32_mcu": "esp32_mcu", "m3_screws": "m3_screw", "esp32_microcontroller": "esp32_mcu", "lidar_sensor_module": "lidar_sensor", "m5_bolt_set": None, "display": None,
            "main_oled_display": "oled_display_main", "oled_display_mount": "display_mount", "nothing": None}
    df = spark.createDataFrame([(k, known) for k in want], "m string, known array<string>").selectExpr("m", f"{repair.fuzzy_resolve('m', 'known')} AS to")
    assert {r.m: r.to for r in df.collect()} == want


def test_fixup(records):
    from sievework.operators import repair

    hurt = records.withColumn("relationships", rules.F.expr("transform(relationships, (r, i) -> named_struct('source', r.source, 'relation', r.relation, 'target', CASE i WHEN 0 THEN 'disps' WHEN 1 THEN 'wall_bracket' ELSE r.target END, 'required', r.required, 'notes', r.notes))"))
    got = by_id(repair.fixup(hurt))
    clock = got["desk_clock_v2"]
    assert clock["actions"] == ["fuzzy-resolve 'MCU-1' -> None"] or any(a == "fuzzy-resolve 'disps' -> 'disp'" for a in clock["actions"])
    assert clock["relationships"][0]["target"] == "disp" and clock["relationships"][1]["target"] == "wall_bracket"
    made = {c["component_id"]: c for c in clock["components"]}["wall_bracket"]
    assert (made["type"], made["material"], made["display_name"], made["fabrication_ref"]) == ("3d_printed", "PLA", "Wall Bracket", "wall_bracket")
    assert {x["component_id"] for x in clock["sourcing"]["items"]} >= {"wall_bracket", "m3_screw"}
    assert clock["validation"]["issues"] == [] and got["bare"]["instructions"] == [] and got["bare"]["actions"] == ["synthesize 0 instruction steps"]
    filled = by_id(repair.backfill_print_settings(repair.fixup(hurt)))["desk_clock_v2"]["fabrication"]["component_settings"]
    assert [x["component_id"] for x in filled] == ["case", "wall_bracket"] and filled[1]["settings"]["infill_pct"] == 20
    steps = records.where("project.project_id = 'desk_clock_v2'").selectExpr(f"{repair.synthesised()} AS s").first().s
    assert [(s.step_id, s.dependencies) for s in steps][:3] == [("fabrication_1", []), ("wiring_1", ["fabrication_1"]), ("wiring_2", ["wiring_1"])]


def test_scoring(spark):
    from sievework.operators import scoring

    gold = '{"relationships": [{"source": "a", "relation": "contains", "target": "b"}, {"source": "b", "relation": "connects_to", "target": "a"}]}'
    user = 'Components: {"components": [{"component_id": "a"}, {"component_id": "b"}]} please'
    cases = [
        ("D", user, "Sure:\n```json\n" + gold + "\n```", gold),
        ("D", user, 'x {"relationships": [{"source": "a", "relation": "glued", "target": "z"}, {"relation": "contains", "target": "b", "source": "a"}]} y', gold),
        ("D", user, "no json", gold),
        ("C", "", '{"components": [{"component_id": "Bad Id", "type": "misc", "category": "power"}]}', '{"components": []}'),
        ("E", user, '{"instructions": [{"step_id": "s1", "phase": "wiring", "component_ids": ["a", "q"], "dependencies": ["s2"]}, {"step_id": "s2", "phase": "nap", "component_ids": [], "dependencies": ["s1"]}]}', '{"instructions": [{"step_id": "s1", "phase": "wiring", "component_ids": ["a"]}]}'),
        ("F", "", '{"schema_valid": true, "reference_integrity_valid": true, "manufacturability_valid": false, "naming_consistency_valid": true, "issues": [{"code": "x"}], "confidence_score": 1.5}', '{"schema_valid": true, "reference_integrity_valid": true, "manufacturability_valid": true, "naming_consistency_valid": true, "issues": [], "confidence_score": 1.0}'),
    ]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, mode string, user string, output string, gold string")
    got = {r.i: r for r in scoring.score_cases(df).collect()}
    assert [(got[i].parsed, got[i].valid, got[i].exact, got[i].tp, got[i].fp, got[i].fn) for i in range(6)] == [
        (True, True, True, 2, 0, 0), (True, False, False, 1, 1, 1), (False, False, False, 0, 0, 2), (True, False, False, 0, 1, 0), (True, False, False, 2, 2, 0), (True, False, False, 3, 2, 1),
    ]
    assert list(got[1].errors) == ["relationship[0].target 'z' not an input component", "relationship[0] bad relation 'glued'"]
    assert list(got[4].errors) == ["step[1] bad phase 'nap'", "step[0] references unknown component 'q'", "step[0] depends on later/missing step 's2'"]
    assert got[3].errors[0].startswith("component[0] missing description, dimensions")
    table = {r["mode"]: r for r in scoring.report(scoring.score_cases(df)).collect()}
    assert table["D"].n == 3 and table["D"].f1 == round(6 / (6 + 1 + 3), 6) and table["ALL"].n == 6


def test_replies(spark):
    from sievework.operators import scoring

    whole = "{" + ", ".join(f'"{k}": {{}}' for k in scoring.SECTIONS) + "}"
    rows = [whole, f"```JSON\n{whole}\n```", f'text {{"a": 1}} and {whole} end', "[1, 2]", "nothing", '{"project": {}}', None]
    got = [(r.accepted, r.error_count, r.warning_count, r.codes[:1]) for r in scoring.audit_replies(spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, reply string")).orderBy("i").collect()]
    assert got == [(True, 0, 0, []), (True, 0, 1, ["json_fence_removed"]), (True, 0, 1, ["json_wrapper_removed"]), (False, 1, 0, ["wrong_root_type"]), (False, 1, 0, ["invalid_json"]), (False, 7, 0, ["schema_violation"]), (False, 1, 0, ["invalid_json"])]
    modes = spark.createDataFrame([("You are in Mode D now",), ("mode x",)], "system string").select(scoring.detect_mode().alias("m")).collect()
    assert [r.m for r in modes] == ["D", "?"]


@pytest.mark.parametrize("name", sorted(__import__("sievework.plans.records", fromlist=["x"]).QUERIES))
def test_queries_match_hand_written_sql(spark, name):
    import duckdb

    from sievework.plans import records as plans

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("lineitem", "part"):
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    df = plans.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    want = con.sql(f"select {', '.join(chr(34) + c + chr(34) for c in columns)} from ({plans.ORACLES[name]})").fetchall()
    plain = lambda rows: sorted((tuple(float(v) if type(v).__name__ in ("Decimal", "float") else v for v in r) for r in rows), key=repr)
    got, want = plain(map(tuple, df.select(*columns).collect())), plain(want)
    assert got == want, [x for x in zip(got, want, strict=False) if x[0] != x[1]][:3]
