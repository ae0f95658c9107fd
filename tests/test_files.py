"""Readers and writers on real files."""

import base64
import json

from pyspark.sql import functions as F

from records import RAW
from sievework.operators import normalise
from sievework.sources import readers, writers


def folders(tmp_path):
    for r in RAW:
        home = tmp_path / f"{r['slug'].replace('!!', 'odd')}_files"
        home.mkdir()
        (home / "b_CONFIG.json").write_text("{}")
        (home / "a_CONFIG.json").write_text(json.dumps({k: v for k, v in r.items() if k != "slug"}))
    (tmp_path / "empty_files").mkdir()
    (tmp_path / "bad_files").mkdir()
    (tmp_path / "bad_files" / "x_CONFIG.json").write_text("no json")
    return str(tmp_path)


def test_configs_to_records_and_back(spark, tmp_path):
    root = folders(tmp_path)
    raw = readers.read_configs(spark, root)
    got = {r.slug: r for r in raw.collect()}
    assert set(got) == {"Desk-Clock v2", "bare", "odd", "bad"} and got["bad"].nodes is None
    assert got["Desk-Clock v2"].nodes[0].purchaseUrl and readers.read_configs(spark, root, prune=True).where("slug = 'Desk-Clock v2'").first().nodes[0].purchaseUrl is None
    assert {(r.slug, r.folder_id) for r in readers.project_slugs(spark, root).collect()} >= {("Desk-Clock v2", "desk_clock_v2"), ("bad", "bad")}
    records = normalise.normalise(raw.where("slug <> 'bad'"))
    out = f"{tmp_path}/out"
    writers.write_records(records, out)
    writers.write_records(records, out)  # what is there stays
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in records.schema)
    back = spark.read.schema(schema).option("recursiveFileLookup", "true").json(out)
    assert back.count() == 3 and sorted(r.project.project_id for r in back.collect()) == ["bare", "desk_clock_v2", "odd"]
    guide = {r.project_id: r.value for r in writers.guides(records).collect()}["desk_clock_v2"]
    assert "## 2. wiring" in guide and "### 2.1 Wire\nParts: mcu_1, disp\n*(not yet generated)*" in guide and "Look at every joint twice." in guide
    csv = {r.project_id: r.value for r in writers.parts_csv(records).collect()}["desk_clock_v2"].split("\n")
    assert csv[1] == '"mcu_1","ESP32 Board",1,"6.50","6.50"' and len(csv) == 8
    writers.write_texts(writers.guides(records), f"{tmp_path}/guides")


def test_record_files_tolerant(spark, tmp_path):
    (tmp_path / "seeds").mkdir()
    (tmp_path / "seeds" / "a.json").write_text('{"project": {"project_id": "a"}}')
    (tmp_path / "seeds" / "b.json").write_text("{broken")
    (tmp_path / "more").mkdir()
    (tmp_path / "more" / "c.json").write_text('{"project":\n {"project_id": "c"}}')
    df = readers.read_records(spark, "project struct<project_id: string>", f"{tmp_path}/seeds", f"{tmp_path}/more", tolerant=True)
    assert [(r.src, r.file, r.project.project_id) for r in df.orderBy("src", "file").collect()] == [(0, "a.json", "a"), (1, "c.json", "c")]


def test_chat_rows(spark, tmp_path):
    rows = spark.createDataFrame([(0, "S", " Hi  there ", "x", "A"), (1, "s", " hi \n there ", "y", "A"), (2, "S", "other", "z", "B"), (3, "S", " HI there", "w", None)], "pos int, system string, user string, assistant string, tag string")
    chat, stats = writers.chat_rows(rows, seed=3)
    got = {r.messages[1].content: (r.messages[2].content, r.tag) for r in chat.collect()}
    assert got == {"Hi  there": ("x", "A"), "other": ("z", "B")}
    assert {r.tag: (r.written, r.duplicates_dropped) for r in stats.collect()} == {"A": (1, 1), "B": (1, 0), None: (0, 1)}
    writers.write_chat(chat, f"{tmp_path}/chat")
    back = readers.read_jsonl(spark, f"{tmp_path}/chat", "messages array<struct<role: string, content: string>>")
    assert back.count() == chat.count()
    split = chat.withColumn("split", F.lit("train"))
    writers.write_splits(split, f"{tmp_path}/splits", alpaca=True)
    assert {"instruction", "input", "output", "split"} <= set(spark.read.json(f"{tmp_path}/splits").columns)


def test_images_and_texts(spark, tmp_path):
    for name, body in (("clock.jpg", b"jpg"), ("clock.png", b"png"), ("lamp.webp", b"w" * 100), ("note.md", b"# text")):
        (tmp_path / name).write_bytes(body)
    uris = {r.path.rsplit("/", 1)[1]: r.uri for r in readers.read_data_uris(spark, str(tmp_path)).collect()}
    assert uris["clock.jpg"] == "data:image/jpeg;base64," + base64.b64encode(b"jpg").decode() and uris["lamp.webp"].endswith(base64.b64encode(b"w" * 100).decode())
    assert {r.slug: r.path.rsplit("/", 1)[1] for r in readers.find_sketches(spark, str(tmp_path)).collect()} == {"clock": "clock.png", "lamp": "lamp.webp"}
    assert [tuple(r) for r in readers.read_texts(spark, str(tmp_path), "*.md").collect()] == [("note.md", "# text")]
