"""Benchmark decontamination by templates: numbers, names and units become typed placeholders, windows of
templates are joined by hash, and slots must be filled consistently. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import stage, text_of

# Placeholders (private code points), white space and units.
NAME, NUMBER, UNIT = "\ue001", "\ue002", "\ue003"
SPACE = r"[ \t\n\r\f\x0B]+"
UNITS = (
    "percent|per cent|km/h|mph|kph|kilometers|kilometres|kilometer|kilometre|km|centimeters|centimetres|cm|millimeters|millimetres|mm|meters|metres|meter|metre|"
    "miles|mile|yards|yard|feet|foot|inches|inch|kilograms|kilogram|kg|grams|gram|mg|pounds|pound|lbs|lb|ounces|ounce|oz|tons|ton|liters|litres|liter|litre|ml|gallons|gallon|"
    "seconds|second|minutes|minute|min|hours|hour|days|day|weeks|week|months|month|years|year|dollars|dollar|cents|cent|euros|euro|usd|eur|degrees|degree|watts|watt|kw|kwh|volts|volt|m|g|l|h|s|%"
)
_NAMES = rf"([\p{{Ll}}{NAME},;] )\p{{Lu}}\p{{Ll}}+"
_NUMBERS = r"[0-9]+(?:[.,:/][0-9]+)*"
_UNITS = rf"({NUMBER} ?)(?:{UNITS})( |$|[.,;:!?])"
_EDGE = r'[.,;:!?"()]+( |$)'
_HEAD = r'(^| )["(]+'


def flat(text: Column) -> Column:
    """White space folded to one space and trimmed: words and templates split alike at each space."""
    return F.trim(F.regexp_replace(text, SPACE, " "))


def template(flat_text: Column) -> Column:
    """Template of a folded text, word for word: a capitalised word inside a sentence is a name, a run of
    digits a number, a unit after a number a unit; punctuation at word ends goes, case too."""
    t = F.regexp_replace(flat_text, _NAMES, f"$1{NAME}")
    t = F.regexp_replace(t, _NAMES, f"$1{NAME}")  # names that follow names
    t = F.regexp_replace(t, _NUMBERS, NUMBER)
    t = F.regexp_replace(t, _UNITS, f"$1{UNIT}$2")
    t = F.regexp_replace(t, _EDGE, "$1")
    return F.lower(F.regexp_replace(t, _HEAD, "$1"))


def plain(flat_text: Column) -> Column:
    """The words of a folded text as they are, but for case and punctuation at word ends."""
    return F.lower(F.regexp_replace(F.regexp_replace(flat_text, _EDGE, "$1"), _HEAD, "$1"))


def _windows(words: str, width: int, exact: bool) -> Column:
    """One hash for each window of `width` words; exact ones differ from those of templates."""
    parts = ", ".join(f"{words}[i + {k}]" if k else f"{words}[i]" for k in range(width))
    tag = -width if exact else width
    return F.expr(f"CASE WHEN size({words}) >= {width} THEN transform(sequence(0, size({words}) - {width}), i -> xxhash64({tag}, {parts})) END")


def benchmark_windows(benchmark: DataFrame, width: int = 8, shortest: int = 5, literal: int = 3) -> DataFrame:
    """(item_id, ipos, width, exact, key, n_windows, n_slots) of the items: template windows of `width` words, of the
    whole item where it is shorter. Windows of fewer than `literal` words besides placeholders say nothing and make no
    key. Items of under `shortest` words, and those of which no template window says anything, are looked for word
    for word instead."""
    words = lambda kind: F.split(kind(flat(text_of())), " ")
    items = benchmark.where("item_id is not null").select("item_id", words(template).alias("t"), words(plain).alias("r")).where("array_join(r, '') <> ''")
    items = items.withColumn("n", F.size("t")).withColumn("width", F.least(F.col("n"), F.lit(width)))
    slot = F.expr(f"transform(t, w -> CASE WHEN w rlike '[{NAME}{NUMBER}{UNIT}]' THEN 1 ELSE 0 END)")
    items = items.withColumn("slot", slot).withColumn("n_slots", F.expr("cast(aggregate(slot, 0, (a, x) -> a + x) as long)"))
    # all windows of an item in one array: a plan with a branch for each width took over 1 GB of the driver's memory
    at = "sequence(0, n - width)"
    key = lambda h, w: f"xxhash64({w}, slice({h}, i + 1, width))"
    said = f"filter({at}, i -> n >= {shortest} AND width - aggregate(slice(slot, i + 1, width), 0, (a, x) -> a + x) >= {literal})"
    items = items.withColumn("h", F.transform("t", lambda w: F.xxhash64(w))).withColumn("rh", F.transform("r", lambda w: F.xxhash64(w)))
    items = items.withColumn("said", F.expr(said)).withColumn("exact", F.max(F.size("said")).over(Window.partitionBy("item_id")) == 0)
    made = f"CASE WHEN exact THEN transform({at}, i -> struct(i AS ipos, {key('rh', '-width')} AS key)) ELSE transform(said, i -> struct(i AS ipos, {key('h', 'width')} AS key)) END"
    items = items.withColumn("made", F.expr(made)).withColumn("n_windows", F.sum(F.size("made")).over(Window.partitionBy("item_id")))
    items = items.withColumn("n_slots", F.when(F.col("exact"), F.lit(0).cast("long")).otherwise(F.col("n_slots")))
    out = items.select("item_id", "width", "exact", "n_windows", "n_slots", F.explode("made").alias("w"))
    return out.select("item_id", "w.ipos", "width", "exact", "w.key", "n_slots", "n_windows")


def matches(docs: DataFrame, benchmark: DataFrame, width: int = 8, share: float = 0.5, few: int = 1_000_000) -> DataFrame:
    """(doc_id, item_id, hits): items of which a document holds at least `share` of the windows, each counted once
    however often the document repeats it.

    Windows join by hash. What matches is grouped by document, item and offset between the two; where the
    item has slots, each of its values must stand for one value only in the document at that offset, or
    the offset does not count. Every row of docs is read whole; only hits leave the join. The ids of up to `few`
    documents with slots to compare are sent to where texts are read, so that other texts are not shuffled.
    """
    keys = stage(benchmark_windows(benchmark, width), "benchmark-windows")
    sorts = sorted(tuple(r) for r in keys.select("exact", "width").distinct().collect()) or [(False, width)]  # at most 2 * width values
    words = {exact: F.split((plain if exact else template)(flat(text_of())), " ") for exact in {e for e, _ in sorts}}
    hashed = {exact: docs.select("doc_id", F.transform(w, lambda x: F.xxhash64(x)).alias("h")) for exact, w in words.items()}
    pieces = None
    for exact, k in sorts:
        part = hashed[exact].select("doc_id", F.posexplode(_windows("h", k, exact)).alias("dpos", "w_key"))
        pieces = part if pieces is None else pieces.unionByName(part)
    hits = pieces.join(keys, pieces.w_key == keys.key).select("doc_id", "item_id", "width", "n_windows", "n_slots", "ipos", (F.col("dpos") - F.col("ipos")).alias("shift"))
    hits = stage(hits.groupBy("doc_id", "item_id", "shift", "ipos").agg(*[F.first(c).alias(c) for c in ("width", "n_windows", "n_slots")]), "template-hits")
    slotted = hits.where("n_slots > 0").groupBy("doc_id", "item_id", "shift").agg(F.min("ipos").alias("lo"), F.max(F.col("ipos") + F.col("width")).alias("hi"))
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    held = stage(slotted.select(F.col("doc_id").alias("k_id")).distinct(), "template-documents")
    if held.count() <= few:
        held = F.broadcast(held)
    texts = docs.select("doc_id", "text").join(held, same("doc_id", "k_id"), "left_semi")
    raw = lambda df, key, a, b: df.select(F.col(key).alias(a), F.split(F.lower(flat(text_of())), " ").alias(b))
    near = slotted.join(raw(texts, "doc_id", "d_id", "dw"), same("doc_id", "d_id"))
    items = raw(benchmark, "item_id", "i_id", "iw").join(
        benchmark.select(F.col("item_id").alias("t_id"), F.split(template(flat(text_of())), " ").alias("it")), F.col("i_id") == F.col("t_id")
    )
    near = near.join(items, near.item_id == items.i_id)
    pairs = near.select("doc_id", "item_id", "shift", "it", "iw", "dw", F.explode(F.expr("sequence(lo, hi - 1)")).alias("p"))
    pairs = pairs.where(F.expr(f"get(it, p) rlike '[{NAME}{NUMBER}{UNIT}]'"))
    bare = lambda e: F.regexp_replace(F.expr(e), r'^["(]+|[.,;:!?"()]+$', "")
    pairs = pairs.select("doc_id", "item_id", "shift", bare("get(iw, p)").alias("iv"), bare("get(dw, p + shift)").alias("dv"))
    wrong = pairs.groupBy("doc_id", "item_id", "shift", "iv").agg(F.countDistinct("dv").alias("n")).where("n > 1")
    wrong = wrong.select(F.col("doc_id").alias("x_id"), F.col("item_id").alias("x_item"), F.col("shift").alias("x_shift")).distinct()
    good = hits.join(wrong, hits.doc_id.eqNullSafe(wrong.x_id) & (hits.item_id == wrong.x_item) & (hits["shift"] == wrong.x_shift), "left_anti")
    total = good.groupBy("doc_id", "item_id").agg(F.countDistinct("ipos").alias("hits"), F.max("n_windows").alias("n_windows"))
    return total.where(F.col("hits") >= share * F.col("n_windows")).select("doc_id", "item_id", "hits")


def flag_documents(docs: DataFrame, benchmark: DataFrame, width: int = 8, share: float = 0.5) -> DataFrame:
    """(doc_id, contaminated, n_items, first_item) of every document.

    Null or empty text: not contaminated. Rows that repeat a doc_id share their verdict, as do those without one.
    Items under five words are found word for word; null or empty items and those without an id never. No rows on
    either side: none, or all clean. Columns besides doc_id and text may have any name.
    """
    found = matches(docs, benchmark, width, share).groupBy(F.col("doc_id").alias("f_id")).agg(F.count(F.lit(1)).alias("n"), F.min("item_id").alias("item"))
    every = docs.select("doc_id")
    out = every.join(found, every.doc_id.eqNullSafe(found.f_id), "left")
    return out.select("doc_id", F.col("n").isNotNull().alias("contaminated"), F.coalesce("n", F.lit(0)).cast("long").alias("n_items"), F.col("item").cast("long").alias("first_item"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 8, share: float = 0.5) -> DataFrame:
    """docs without the contaminated ones; columns stay."""
    found = stage(matches(docs.select("doc_id", "text"), benchmark, width, share).select(F.col("doc_id").alias("f_id")).distinct(), "contaminated")
    return docs.join(found, docs["doc_id"].eqNullSafe(found["f_id"]), "left_anti")


def _sql_template(text: str) -> str:
    sub = lambda t, pat, to: f"regexp_replace({t}, '{pat}', '{to}', 'g')"
    t = f"trim({sub(text, SPACE, ' ')}, ' ')"
    for _ in range(2):
        t = sub(t, _NAMES, rf"\1{NAME}")
    t = sub(t, _NUMBERS, NUMBER)
    t = sub(t, _UNITS, rf"\1{UNIT}\2")
    t = sub(t, _EDGE, r"\1")
    return f"string_split(lower({sub(t, _HEAD, r'\1')}), ' ')"


def _sql_plain(text: str) -> str:
    t = f"trim(regexp_replace({text}, '{SPACE}', ' ', 'g'), ' ')"
    return f"string_split(lower(regexp_replace(regexp_replace({t}, '{_EDGE}', '\\1', 'g'), '{_HEAD}', '\\1', 'g')), ' ')"


_RAW = f"string_split(lower(trim(regexp_replace(coalesce(text, ''), '{SPACE}', ' ', 'g'), ' ')), ' ')"
_SLOT = f"'[{NAME}{NUMBER}{UNIT}]'"

#: The same verdicts by comparing windows as strings.
ORACLE = f"""
WITH it AS (
  SELECT item_id, {_sql_template("coalesce(text, '')")} AS t, {_sql_plain("coalesce(text, '')")} AS r, {_RAW} AS raw
  FROM benchmark WHERE item_id IS NOT NULL),
iw0 AS (
  SELECT item_id, least(len(t), 8) AS w, unnest(range(0, len(t) - least(len(t), 8) + 1)) AS ipos, t,
         len(list_filter(t, lambda x: regexp_matches(x, {_SLOT}))) AS n_slots
  FROM it WHERE len(t) >= 5 AND array_to_string(r, '') <> ''),
iw1 AS (
  SELECT item_id, w, ipos, n_slots, 't ' || array_to_string(list_slice(t, ipos + 1, ipos + w), ' ') AS k
  FROM iw0 WHERE len(list_filter(list_slice(t, ipos + 1, ipos + w), lambda x: NOT regexp_matches(x, {_SLOT}))) >= 3),
iw2 AS (
  SELECT item_id, least(len(r), 8) AS w, unnest(range(0, len(r) - least(len(r), 8) + 1)) AS ipos, r
  FROM it WHERE array_to_string(r, '') <> '' AND item_id NOT IN (SELECT item_id FROM iw1)),
iw AS (
  SELECT * FROM iw1 UNION ALL
  SELECT item_id, w, ipos, 0, 'r ' || array_to_string(list_slice(r, ipos + 1, ipos + w), ' ') FROM iw2),
nw AS (SELECT item_id, count(*) AS n_windows FROM iw GROUP BY 1),
dt AS (
  SELECT doc_id, {_sql_template("coalesce(text, '')")} AS t, {_sql_plain("coalesce(text, '')")} AS r, {_RAW} AS raw FROM documents),
ws AS (SELECT DISTINCT w, k[1] AS kind FROM iw),
dw AS (
  SELECT doc_id, ws.w, kind, unnest(range(0, len(t) - ws.w + 1)) AS dpos, CASE kind WHEN 't' THEN t ELSE r END AS x FROM dt, ws WHERE len(t) >= ws.w),
hit AS (
  SELECT DISTINCT doc_id, iw.item_id, iw.w, ipos, dpos - ipos AS shift, n_slots
  FROM (SELECT doc_id, w, dpos, kind || ' ' || array_to_string(list_slice(x, dpos + 1, dpos + w), ' ') AS k FROM dw) d JOIN iw ON iw.k = d.k AND iw.w = d.w),
run AS (SELECT doc_id, item_id, shift, min(ipos) AS lo, max(ipos + w) AS hi FROM hit WHERE n_slots > 0 GROUP BY ALL),
pr AS (
  SELECT r.doc_id, r.item_id, r.shift, unnest(range(r.lo, r.hi)) AS p, it.t AS tt, it.raw AS ir, dt.raw AS dr
  FROM run r JOIN it ON it.item_id = r.item_id JOIN dt ON dt.doc_id IS NOT DISTINCT FROM r.doc_id),
bad AS (
  SELECT DISTINCT doc_id, item_id, shift FROM (
    SELECT doc_id, item_id, shift, regexp_replace(ir[p + 1], '^["(]+|[.,;:!?"()]+$', '', 'g') AS iv,
           count(DISTINCT regexp_replace(dr[p + shift + 1], '^["(]+|[.,;:!?"()]+$', '', 'g')) AS n
    FROM pr WHERE regexp_matches(tt[p + 1], {_SLOT}) GROUP BY ALL) WHERE n > 1),
f AS (
  SELECT h.doc_id, h.item_id FROM hit h LEFT JOIN bad b ON b.doc_id IS NOT DISTINCT FROM h.doc_id AND b.item_id = h.item_id AND b.shift = h.shift
  JOIN nw ON nw.item_id = h.item_id WHERE b.item_id IS NULL
  GROUP BY h.doc_id, h.item_id HAVING count(DISTINCT ipos) >= 0.5 * max(n_windows)),
g AS (SELECT doc_id, count(*) AS n, min(item_id) AS item FROM f GROUP BY 1)
SELECT d.doc_id, g.n IS NOT NULL AS contaminated, coalesce(g.n, 0) AS n_items, g.item AS first_item
FROM documents d LEFT JOIN g ON d.doc_id IS NOT DISTINCT FROM g.doc_id
"""
