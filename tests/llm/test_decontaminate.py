"""Repeated phrases, short items, null ids."""

import duckdb

from sievework.llm import decontaminate

from .test_operators import docs_of


def check(spark, rows, items):
    """The operator's rows, which must be those of its SQL."""
    docs, bench = docs_of(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(tuple, decontaminate.flag_documents(docs, bench).collect()), key=str)
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    con.register("benchmark", bench.toPandas())
    assert got == sorted(((None if r[0] != r[0] or r[0] is None else int(r[0]), *r[1:]) for r in con.sql(decontaminate.ORACLE).fetchall()), key=str)
    return {r[0]: r[1:] for r in got}


def test_a_repeated_phrase_counts_once(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda omicron sigma tau upsilon phi chi psi omega end"
    phrase = " ".join(item.split()[:8])
    got = check(spark, [(1, " and ".join([phrase] * 7)), (2, item), (3, f"{' '.join(item.split()[:11])} or {' '.join(item.split()[9:])}")], [(1, item)])
    assert got == {1: (False, 0, None), 2: (True, 1, 1), 3: (True, 1, 1)}


def test_short_items_are_found_word_for_word(spark):
    items = [(1, "What is the capital?"), (2, "12 34 56 78 90 12"), (3, ""), (4, None), (5, " . ")]
    rows = [(1, "he asked what is the capital of it"), (2, "what is a capital"), (3, "codes 12 34 56 78 90 12 follow"), (4, "codes 11 34 56 78 90 12 follow"), (5, ""), (6, None)]
    got = check(spark, rows, items)
    assert {i for i, r in got.items() if r[0]} == {1, 3}


def test_documents_without_an_id_share_a_verdict(spark):
    item = "name the river that runs through the old town of the north and its length in miles"
    rows = [(None, f"so {item} then"), (1, item), (2, "none of it here at all")]
    docs, bench = docs_of(spark, rows), spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: r.contaminated for r in decontaminate.flag_documents(docs, bench).collect()}
    assert got == {None: True, 1: True, 2: False}
    assert [r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()] == [2]
    assert not any(r.contaminated for r in decontaminate.flag_documents(docs, bench.limit(0)).collect())
    assert decontaminate.flag_documents(docs.limit(0), bench).count() == 0


def test_benchmark_windows_make_a_small_plan(spark):
    """One branch for all widths, with the windows of items that repeat an id counted together."""
    item = "name the river that runs through the old town of the north and its length in miles"
    bench = spark.createDataFrame([(1, item), (1, "what is the capital?"), (2, "what is the capital?")], "item_id long, text string")
    made = decontaminate.benchmark_windows(bench)
    assert made._jdf.queryExecution().optimizedPlan().toString().count("Generate") == 1
    assert sorted({(r.item_id, r.exact, r.n_windows) for r in made.collect()}) == [(1, False, 10), (2, True, 1)]
    check(spark, [(1, item), (2, "he asked what is the capital of it"), (3, None)], [(1, item), (1, "what is the capital?"), (2, "what is the capital?")])


def test_texts_are_compared_whether_ids_are_sent_or_shuffled(spark):
    item = "On Monday Anna paid 30 dollars for 4 books in the small shop behind the station"
    rows = [(1, item), (2, item.replace("30", "75")), (3, "Anna " * 40), (None, item)]
    docs, bench = docs_of(spark, rows), spark.createDataFrame([(1, item)], "item_id long, text string")
    sent, shuffled = (sorted(map(tuple, decontaminate.matches(docs, bench, few=n).collect()), key=str) for n in (10, 0))
    assert sent == shuffled and len(sent) == 3
