"""The query catalogue: each operator on the table that comes closest to its records.

A query is one function of a dialect. Spark runs its text through Catalyst, with the tables as DataFrames;
the checking engine runs the same text in its own spelling. No query holds Python row code."""

from __future__ import annotations

import re

from ..functions import vocab
from ..functions.dialect import Duck, Spark, dimension, dimension_kind, fingerprint, first_match, map_type, quoted, snake
from ..session import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
_S, _D = Spark(), Duck()


def query(make):
    """Register make(dialect) under its name."""
    names = sorted(set(re.findall(r"\{(\w+)\}", make(_S))))
    ORACLES[make.__name__] = make(_D)

    def run(spark, sf_dir):
        return spark.sql(make(_S), **{n: table(spark, sf_dir, n) for n in names})

    QUERIES[make.__name__] = run
    return make


def _chat(d):
    """Conversations with the first text of each role; '' without a system turn."""
    pick = lambda r: f"min_by(text, turn) FILTER (WHERE role = '{r}')"
    return f"SELECT conv_id, coalesce({pick('system')}, '') AS sys, {pick('user')} AS usr, {pick('assistant')} AS ans FROM {d.col('conversations')} GROUP BY conv_id"


def _rows(d):
    """Complete chat rows, the first of each (system, user) fingerprint."""
    fp = fingerprint(d, "sys || ' ' || usr")
    return f"SELECT *, row_number() OVER (PARTITION BY {fp} ORDER BY conv_id) AS rn FROM ({_chat(d)}) c WHERE usr IS NOT NULL AND ans IS NOT NULL AND trim(usr) <> ''"


@query
def dedup_fingerprint(d):
    return f"SELECT doc_id, fp FROM (SELECT doc_id, {fingerprint(d, 'text')} AS fp, row_number() OVER (PARTITION BY {fingerprint(d, 'text')} ORDER BY doc_id) AS rn FROM {d.col('documents')}) t WHERE rn = 1"


@query
def dedup_stats(d):
    return f"SELECT lang, sum(n) AS n_rows, count(*) AS n_kept, sum(n) - count(*) AS n_dropped FROM (SELECT lang, {fingerprint(d, 'text')} AS fp, count(*) AS n FROM {d.col('documents')} GROUP BY 1, 2) t GROUP BY lang"


@query
def chatml_messages(d):
    parts = " || ".join(["'system: '", "sys", "' | user: '", "trim(usr)", "' | assistant: '", "ans"])
    return f"SELECT conv_id, {parts} AS messages FROM ({_rows(d)}) t WHERE rn = 1"


@query
def alpaca_pivot(d):
    last = lambda r: f"max_by(text, turn) FILTER (WHERE role = '{r}')"
    return f"SELECT conv_id, coalesce({last('system')}, '') AS instruction, coalesce({last('user')}, '') AS input, coalesce({last('assistant')}, '') AS output FROM {d.col('conversations')} GROUP BY conv_id"


def _modes(d):
    base = f"SELECT t.doc_id, t.text, t.source, l.quality, t.n_chars FROM {d.col('documents')} t LEFT JOIN {d.col('labels')} l ON t.doc_id = l.doc_id"
    made = [
        ("A", "'Design: ' || text", "text", "trim(text) <> ''"),
        ("B", "text", "text", "trim(text) <> ''"),
        ("C", "text", "source", "source IS NOT NULL"),
        ("D", "source", "CAST(n_chars AS STRING)", "n_chars > 0"),
        ("E", "source || '/' || CAST(doc_id AS STRING)", "text", "n_chars > 0"),
        ("F", "source || '/' || CAST(doc_id AS STRING)", "CAST(quality AS STRING)", "quality IS NOT NULL"),
    ]
    each = d.array(d.record(mode=f"'{m}'", usr=u, ans=a, ok=w) for m, u, a, w in made)
    return f"SELECT doc_id, r.mode AS mode, r.usr AS usr, r.ans AS ans FROM (SELECT doc_id, {d.explode(each, 'r')} FROM ({base}) b) x WHERE r.ok"


@query
def mode_rows(d):
    return f"SELECT doc_id, mode, md5(usr) AS user_md5, md5(ans) AS answer_md5 FROM ({_modes(d)}) t"


@query
def mode_mix_rollup(d):
    once = f"SELECT mode, {fingerprint(d, 'mode || usr')} AS fp, count(*) AS n FROM ({_modes(d)}) t GROUP BY 1, 2"
    return f"SELECT coalesce(mode, 'ALL') AS mode, sum(n) AS projected, count(*) AS written, sum(n) - count(*) AS duplicates FROM ({once}) t GROUP BY ROLLUP (mode)"


def _split(d):
    ranked = f"SELECT source, row_number() OVER (ORDER BY md5('42' || source)) AS r, count(*) OVER () AS n FROM (SELECT DISTINCT source FROM {d.col('documents')}) g"
    part = f"greatest(1, {d.div('n', '10')})"
    return f"SELECT source, CASE WHEN r <= {part} THEN 'test' WHEN r <= 2 * {part} THEN 'val' ELSE 'train' END AS split FROM ({ranked}) q"


@query
def group_split(d):
    return f"SELECT t.doc_id, s.split FROM {d.col('documents')} t JOIN ({_split(d)}) s ON t.source = s.source"


@query
def split_sizes(d):
    return f"SELECT s.split, count(*) AS n_rows, count(DISTINCT t.source) AS n_groups, sum(CASE WHEN t.lang = 'en' THEN 1 ELSE 0 END) AS n_en FROM {d.col('documents')} t JOIN ({_split(d)}) s ON t.source = s.source GROUP BY s.split"


@query
def split_leakage(d):
    return f"SELECT count(*) AS leaked FROM (SELECT t.source FROM {d.col('documents')} t JOIN ({_split(d)}) s ON t.source = s.source GROUP BY t.source HAVING count(DISTINCT s.split) > 1) q"


@query
def length_report(d):
    lengths = f"SELECT {d.div('n_chars', '4')} AS n, count(*) AS m FROM {d.col('documents')} WHERE n_chars IS NOT NULL GROUP BY 1"
    ranked = f"SELECT n, sum(m) OVER (ORDER BY n) AS upto, sum(m) OVER () AS c FROM ({lengths}) t"
    at = lambda p: f"min(CASE WHEN upto > least(c - 1, CAST(floor(c * {p}) AS BIGINT)) THEN n END)"
    top = at("0.99")
    return f"SELECT min(n) AS shortest, {at('0.50')} AS p50, {at('0.90')} AS p90, {at('0.95')} AS p95, {top} AS p99, max(n) AS longest, CAST(power(2, greatest(9, {d.bits(top)})) AS BIGINT) AS suggested FROM ({ranked}) q"


@query
def stratified_sample(d):
    return f"SELECT doc_id, lang, r FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('7' || CAST(doc_id AS STRING)), doc_id) AS r FROM {d.col('documents')}) t WHERE r <= 25"


@query
def json_props(d):
    return f"SELECT event_type, CAST({d.field('props', 'k')} AS INT) AS k, count(*) AS n FROM {d.col('events')} GROUP BY 1, 2"


@query
def fenced_json_extract(d):
    fence = "'Sure: ```json' || chr(10) || props || chr(10) || '``` done'"
    body = d.ext("reply", r"(?s)```(?:json)?[ \t\n]*(.*?)```", 1)
    return f"SELECT event_id, CAST({d.field(f'trim({body})', 'k')} AS INT) AS k FROM (SELECT event_id, {fence} AS reply FROM {d.col('events')}) t"


@query
def vocab_violations(d):
    return f"SELECT 'invalid_component_type' AS code, event_type AS value, count(*) AS n FROM {d.col('events')} WHERE event_type NOT IN ('click', 'view', 'purchase') GROUP BY event_type UNION ALL SELECT 'invalid_component_category', p_type, count(*) FROM {d.col('part')} WHERE lower(p_type) NOT IN ({quoted(vocab.COMPONENT_CATEGORIES)}) GROUP BY p_type"


@query
def dangling_refs(d):
    some = f"SELECT o_orderkey FROM {d.col('orders')} WHERE o_orderstatus <> 'F'"
    return f"SELECT l.l_orderkey, count(*) AS n, 'dangling_ref' AS code FROM {d.col('lineitem')} l LEFT ANTI JOIN ({some}) o ON l.l_orderkey = o.o_orderkey GROUP BY l.l_orderkey" if d is _S else f"SELECT l.l_orderkey, count(*) AS n, 'dangling_ref' AS code FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM ({some}) o WHERE l.l_orderkey = o.o_orderkey) GROUP BY l.l_orderkey"


@query
def duplicate_keys(d):
    return f"SELECT l_orderkey, l_linenumber, count(*) - 1 AS n_duplicates FROM {d.col('lineitem')} GROUP BY 1, 2 HAVING count(*) > 1"


@query
def duplicate_names(d):
    return f"SELECT p_name, count(*) AS n, min(p_partkey) AS first_part FROM {d.col('part')} GROUP BY p_name HAVING count(*) > 1"


@query
def dependency_chain(d):
    step = "role || '_' || CAST(turn AS STRING)"
    return f"SELECT conv_id, turn, {step} AS step_id, coalesce(lag({step}) OVER (PARTITION BY conv_id ORDER BY turn), '') AS depends_on, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS role_no FROM {d.col('conversations')}"


@query
def forward_deps(d):
    ev = f"SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos, CAST({d.field('props', 'k')} AS BIGINT) % 12 AS dep FROM {d.col('events')}"
    last = f"SELECT user_id AS u, max(pos) AS top FROM ({ev}) a GROUP BY user_id"
    return f"SELECT e.event_id, CASE WHEN e.dep = 0 OR e.dep > l.top THEN 'missing_dependency' WHEN e.dep >= e.pos THEN 'forward_dependency' ELSE 'ok' END AS code FROM ({ev}) e JOIN ({last}) l ON e.user_id = l.u"


@query
def role_infer(d):
    return f"SELECT p_partkey, {first_match(d, 'p_name', vocab.ROLES, "coalesce(nullif(p_type, ''), 'unknown')")} AS role FROM {d.col('part')}"


_LABELS = ("servo horn", "cable routed", "housing", "press fit", "press-fit", "M3 bolts", "secures", "rests on", "aligned", "mounts_via_m2_5_screws", "glued", "")


@query
def relation_map(d):
    label = "CASE p_partkey % 12 " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(_LABELS)) + " END"
    relation = first_match(d, "label", vocab.RELATIONS, "'attached_to'")
    if d is _S:
        relation = relation.replace("{", "{{").replace("}", "}}")
    return f"SELECT label, {relation} AS relation, count(*) AS n FROM (SELECT {label} AS label FROM {d.col('part')}) t GROUP BY 1, 2"


@query
def type_map(d):
    raw = "CASE p_partkey % 5 WHEN 0 THEN 'Sensor' WHEN 1 THEN 'misc' WHEN 2 THEN 'structural' WHEN 3 THEN 'machined' END"
    name = "CASE p_size % 3 WHEN 0 THEN 'M3 Screw' WHEN 1 THEN 'Donut Ring' ELSE p_name END"
    kind = map_type(d, "coalesce(raw, '')", "name", "p_size % 11 = 0")
    return f"SELECT p_partkey, {kind} AS type, CASE WHEN {kind} = 'electronic' THEN 'electrical' ELSE 'mechanical' END AS category FROM (SELECT p_partkey, p_size, {raw} AS raw, {name} AS name FROM {d.col('part')}) t"


@query
def snake_id(d):
    return f"SELECT page_id AS id, {snake(d, 'url')} AS snake FROM {d.col('pages')} UNION ALL SELECT p_partkey, {snake(d, 'p_name')} FROM {d.col('part')}"


def _sizes(d):
    s = "CAST(p_size AS STRING)"
    forms = (f"{s} || 'x40x15mm'", f"{s} || ' × 40mm'", f"'m' || {s} || 'x12mm'", f"'M' || {s}", f"{s} || 'mm dia'", f"'6mm ID x ' || {s} || 'mm OD x 5m L'", f"{s} || 'mm diameter x 80mm length'", f"{s} || 'mm length, 1.5mm diameter'", f"'~' || {s} || 'cm length'", f"{s} || ' palms'")
    return "SELECT p_partkey, CASE p_partkey % 10 " + " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(forms)) + f" END AS raw FROM {d.col('part')}"


@query
def dims_parse(d):
    fields = ("length_mm", "width_mm", "height_mm", "diameter_mm", "id_mm", "od_mm")
    return f"SELECT p_partkey, {dimension_kind(d, 'raw')} AS kind, " + ", ".join(f"{dimension(d, 'raw', f)} AS {f}" for f in fields) + f" FROM ({_sizes(d)}) t"


@query
def print_parse(d):
    hint = "CASE p_size % 4 WHEN 0 THEN 'PETG' WHEN 1 THEN 'ASA' WHEN 2 THEN 'pc' ELSE 'wood' END"
    raw = f"CAST(p_size AS STRING) || '% infill, 0.2mm layer, ' || CAST(p_size % 7 AS STRING) || ' perimeters, 0.4 mm nozzle, ' || {hint}"
    num = lambda k, kind: f"TRY_CAST(nullif({d.ext('raw', vocab.PRINT[k], 1)}, '') AS {kind})"
    return f"SELECT p_partkey, {num('infill_pct', 'INT')} AS infill_pct, {num('layer_mm', 'DOUBLE')} AS layer_mm, {num('perimeters', 'INT')} AS perimeters, {num('nozzle_mm', 'DOUBLE')} AS nozzle_mm, upper({d.ext('raw', vocab.PRINT['material_hint'], 1)}) AS material FROM (SELECT p_partkey, {raw} AS raw FROM {d.col('part')}) t"


@query
def cost_summary(d):
    cost = f"{d.money('l_extendedprice')}"
    return f"SELECT l_orderkey, sum({cost}) AS total_usd, count(CASE WHEN l_extendedprice > 0 THEN 1 END) AS priced, count(*) AS n_items FROM {d.col('lineitem')} GROUP BY l_orderkey"


@query
def variants_positive(d):
    axes = "SELECT 'compact' AS axis, 70 AS dim, 85 AS cost UNION ALL SELECT 'standard_size', 130, 115 UNION ALL SELECT 'low_cost', 100, 65 UNION ALL SELECT 'premium_material', 100, 140"
    return f"SELECT p_partkey, axis, CAST(p_partkey AS STRING) || '__pos_' || axis AS variant_id, CAST(p_size * dim AS DOUBLE) / 100 AS size_mm, CAST({d.money('p_retailprice')} * cost AS DECIMAL(20, 2)) AS cost_hundredths FROM {d.col('part')} CROSS JOIN ({axes}) a"


@query
def accessory_light(d):
    ranked = f"SELECT l_orderkey, l_partkey, l_linenumber, l_returnflag, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn FROM {d.col('lineitem')}"
    return f"SELECT l_orderkey, count(*) AS n, sum(CASE WHEN l_returnflag = 'A' OR (l_returnflag = 'R' AND rn > 4) THEN 1 ELSE 0 END) AS dropped FROM ({ranked}) t GROUP BY l_orderkey HAVING sum(CASE WHEN l_returnflag = 'A' OR (l_returnflag = 'R' AND rn > 4) THEN 1 ELSE 0 END) > 0"


@query
def variants_negative_codes(d):
    defects = "SELECT 'dangling_ref' AS code UNION ALL SELECT 'invalid_component_type' UNION ALL SELECT 'invalid_relation' UNION ALL SELECT 'dangling_step_ref'"
    made = f"SELECT o_orderkey, code, CASE WHEN code = 'invalid_component_type' THEN 'gadget' ELSE 'misc' END AS type, CASE WHEN code = 'invalid_relation' THEN 'stuck_to' ELSE 'attached_to' END AS relation, CASE WHEN code = 'dangling_ref' THEN -1 ELSE o_custkey END AS target, CASE WHEN code = 'dangling_step_ref' THEN -2 ELSE o_custkey END AS step FROM {d.col('orders')} CROSS JOIN ({defects}) x"
    found = f"CASE WHEN type NOT IN ({quoted(vocab.COMPONENT_TYPES)}) THEN 'invalid_component_type' WHEN relation = 'stuck_to' THEN 'invalid_relation' WHEN c.c_custkey IS NULL AND step <> -2 THEN 'dangling_ref' WHEN s.c_custkey IS NULL THEN 'dangling_step_ref' ELSE 'valid' END"
    return f"SELECT code, found, count(*) AS n FROM (SELECT code, {found} AS found FROM ({made}) m LEFT JOIN {d.col('customer')} c ON m.target = c.c_custkey LEFT JOIN {d.col('customer')} s ON m.step = s.c_custkey) t GROUP BY 1, 2"


@query
def drop_cascade(d):
    drop = f"SELECT p_partkey FROM {d.col('part')} WHERE p_size < 5"
    left = f"SELECT l_orderkey, count(*) AS n FROM {d.col('lineitem')} l LEFT JOIN ({drop}) x ON l.l_partkey = x.p_partkey WHERE x.p_partkey IS NULL GROUP BY l_orderkey"
    return f"SELECT o.o_orderkey, coalesce(k.n, 0) AS kept_items, k.n IS NULL AS dropped FROM {d.col('orders')} o LEFT JOIN ({left}) k ON o.o_orderkey = k.l_orderkey JOIN (SELECT DISTINCT l_orderkey FROM {d.col('lineitem')}) i ON o.o_orderkey = i.l_orderkey"


def _keywords(d):
    hit = lambda a: d.word("t", a) if len(a) <= 6 else d.contains("t", f"'{a}'")
    cases = d.array(f"CASE WHEN {' OR '.join(map(hit, v))} THEN '{k}' END" for k, v in vocab.KEYWORDS.items())
    salted = "CASE doc_id % 7 WHEN 0 THEN ' esp32 lcd panel' WHEN 1 THEN ' a pirate ship, portable' WHEN 2 THEN ' usb-c battery with wifi' ELSE '' END"
    low = f"SELECT doc_id, {d.lower('text')} || {salted} AS t FROM {d.col('documents')}"
    return f"SELECT DISTINCT doc_id, keyword FROM (SELECT doc_id, {d.explode(cases, 'keyword')} FROM ({low}) l) k WHERE keyword IS NOT NULL"


@query
def keyword_audit(d):
    return _keywords(d)


@query
def audit_summary(d):
    return f"SELECT keyword, count(*) AS n FROM ({_keywords(d)}) t GROUP BY keyword"


def _jaccard_of_sets(words):
    """Pairs of equal sets count by number, not one by one: similar sets are found among different ones. A part's similar
    ones of larger id are then those before it in its bucket of 65,536 ids, and all of later buckets."""
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return f"""WITH s AS ({words}), m AS (SELECT id, shiftright(id, 16) AS bucket, array_join(array_sort(w), ' ') AS k, size(w) AS n FROM s WHERE id IS NOT NULL AND size(w) > 0),
        e AS (SELECT k, n, explode(split(k, ' ')) AS token FROM (SELECT DISTINCT k, n FROM m) x),
        p AS (SELECT a.k, b.k AS o, CAST(count(*) AS DOUBLE) / (a.n + b.n - count(*)) AS j FROM e a JOIN e b ON a.token = b.token AND 100 * least(a.n, b.n) >= 55 * greatest(a.n, b.n) GROUP BY a.k, b.k, a.n, b.n HAVING count(*) * 100 >= 55 * (a.n + b.n - count(*))),
        near AS (SELECT p.k, m.bucket, m.id, p.j, p.k = m.k AS own FROM m JOIN p ON m.k = p.o),
        sums AS (SELECT k, bucket, count(*) AS c, max(j) AS j FROM near GROUP BY k, bucket),
        later AS (SELECT k, bucket, coalesce(sum(c) OVER w, 0) AS c, max(j) OVER w AS j FROM sums WINDOW w AS (PARTITION BY k ORDER BY bucket DESC {before})),
        here AS (SELECT k, bucket, id, own, count(*) OVER w AS c, max(j) OVER w AS j FROM near WINDOW w AS (PARTITION BY k, bucket ORDER BY id DESC {before}))
        SELECT h.id AS a, h.c + l.c AS n_similar, greatest(h.j, l.j) AS best FROM here h JOIN later l ON h.k = l.k AND h.bucket = l.bucket WHERE h.own AND h.c + l.c > 0"""


@query
def jaccard_pairs(d):
    words = f"SELECT p_partkey AS id, {d.distinct(d.keep(d.words('lower(p_name)'), f'length(q) > 2 AND q NOT IN ({quoted(vocab.STOPWORDS)})'))} AS w FROM {d.col('part')}"
    if d is _S:
        return _jaccard_of_sets(words)
    return f"WITH s AS ({words}), e AS (SELECT id, {d.size('w')} AS n, {d.explode('w', 'token')} FROM s), p AS (SELECT a.id AS a, b.id AS b, a.n AS n, b.n AS m, count(*) AS c FROM e a JOIN e b ON a.token = b.token AND a.id < b.id AND 100 * least(a.n, b.n) >= 55 * greatest(a.n, b.n) GROUP BY 1, 2, 3, 4) SELECT a, count(*) AS n_similar, max(CAST(c AS DOUBLE) / (n + m - c)) AS best FROM p WHERE c * 100 >= 55 * (n + m - c) GROUP BY a"


@query
def compliance_gate(d):
    title = d.ext("text", r"^([^\n]*)", 1)
    body = f"trim(substr(text, length({title}) + 2))"
    reason = f"CASE WHEN {d.contains('text', chr(39) + vocab.PLACEHOLDER + chr(39))} THEN 'placeholder' WHEN {body} = '' THEN 'empty' WHEN lower({body}) = lower(trim({title})) THEN 'title-only' WHEN length({body}) < {vocab.MIN_BODY} THEN 'too short' ELSE 'complete' END"
    return f"SELECT doc_id, {reason} AS reason FROM {d.col('documents')}"


@query
def coverage_summary(d):
    inner = compliance_gate(d)
    return f"SELECT count(*) AS seen, count(CASE WHEN reason = 'complete' THEN 1 END) AS emitted, count(CASE WHEN reason <> 'complete' THEN 1 END) AS skipped, min(CASE WHEN reason <> 'complete' THEN doc_id END) AS first_skipped FROM ({inner}) t"


@query
def prf_rollup(d):
    pred = f"SELECT l.doc_id, t.lang, l.quality AS gold, CASE WHEN t.n_chars > 1000 THEN 1 ELSE 0 END AS pred FROM {d.col('labels')} l JOIN {d.col('documents')} t ON l.doc_id = t.doc_id"
    tot = f"SELECT coalesce(lang, 'ALL') AS lang, count(*) AS n, sum(gold * pred) AS tp, sum((1 - gold) * pred) AS fp, sum(gold * (1 - pred)) AS fn FROM ({pred}) p GROUP BY ROLLUP (lang)"
    return f"SELECT lang, n, tp, fp, fn, CASE WHEN tp = 0 THEN 0.0 ELSE round(CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn), 9) END AS f1 FROM ({tot}) t"


@query
def token_acc_ppl(d):
    token = f"SELECT event_type, CASE WHEN CAST({d.field('props', 'k')} AS BIGINT) % 3 = user_id % 3 THEN 1 ELSE 0 END AS hit, CAST(value / 100 AS DECIMAL(18, 6)) AS loss FROM {d.col('events')}"
    return f"SELECT event_type, count(*) AS n_tokens, round(CAST(sum(hit) AS DOUBLE) / count(*), 6) AS accuracy, round(exp(CAST(sum(loss) AS DOUBLE) / count(*)), 6) AS perplexity FROM ({token}) t GROUP BY event_type"


@query
def bundle_steps(d):
    line = "CAST(turn AS STRING) || '. ' || coalesce(text, '')"
    return f"SELECT conv_id, role, min(turn) AS first_turn, count(*) AS n_steps, md5({d.listagg(line, 'turn', chr(39) + ' / ' + chr(39))}) AS body_md5 FROM {d.col('conversations')} GROUP BY conv_id, role"


@query
def guide_numbering(d):
    first = f"SELECT conv_id, role, turn, min(turn) OVER (PARTITION BY conv_id, role) AS f FROM {d.col('conversations')}"
    return f"SELECT conv_id, turn, dense_rank() OVER (PARTITION BY conv_id ORDER BY f) AS section, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS step FROM ({first}) t"


@query
def parts_csv(d):
    return f"SELECT p_partkey, '\"' || replace(p_name, '\"', '\"\"') || '\",\"' || p_brand || '\",' || CAST(p_size AS STRING) || ',\"' || CAST({d.money('p_retailprice')} AS STRING) || '\"' AS line FROM {d.col('part')}"


@query
def case_manifest(d):
    kinds = (("text", "'doc/' || CAST(t.doc_id AS STRING)", "TRUE"), ("image", "p.url", "p.url IS NOT NULL"), ("label", "'label/' || CAST(t.doc_id AS STRING)", "l.doc_id IS NOT NULL"))
    one = lambda k, path, w: f"SELECT CAST(t.doc_id AS STRING) || '__{k}' AS case_id, '{k}' AS input_type, {path} AS input_path FROM {d.col('documents')} t LEFT JOIN {d.col('pages')} p ON t.doc_id = p.page_id LEFT JOIN (SELECT DISTINCT doc_id FROM {d.col('labels')}) l ON t.doc_id = l.doc_id WHERE {w}"
    return " UNION ALL ".join(one(*k) for k in kinds)


@query
def data_uri(d):
    return f"SELECT page_id, md5('data:text/html;base64,' || {d.b64('html')}) AS uri_md5 FROM {d.col('pages')}"


@query
def latin1_safe(d):
    return f"SELECT doc_id, md5({d.rep('text', '[^' + chr(92) + 'x00-' + chr(92) + 'xFF]', '?')}) AS safe_md5 FROM {d.col('documents')}" if d is _S else "SELECT doc_id, md5(regexp_replace(text, '[^\\x{00}-\\x{FF}]', '?', 'g')) AS safe_md5 FROM documents"


@query
def issue_frequency(d):
    dup = f"SELECT 'duplicate_id' AS code, 'error' AS severity FROM {d.col('lineitem')} GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"
    name = f"SELECT 'duplicate_display_name', 'warn' FROM {d.col('part')} GROUP BY p_name HAVING count(*) > 1"
    neg = f"SELECT 'negative_cost', 'error' FROM {d.col('customer')} WHERE c_acctbal < 0"
    return f"SELECT code, severity, count(*) AS n, CASE WHEN severity = 'error' THEN CAST(0.4 AS DOUBLE) ELSE CAST(0.7 AS DOUBLE) END AS confidence FROM ({dup} UNION ALL {name} UNION ALL {neg}) t GROUP BY 1, 2"
