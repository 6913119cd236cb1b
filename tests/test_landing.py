"""Grids with spans, runs, reloads, markers, encodings, ordered tables and rules, on small rows and in their plans."""

import json
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from quillon import landing_queries
from quillon.operators import inventory, quality, quarantine
from quillon.plans import silver
from quillon.sources import landing, readers, scratch, sinks

CONTEXT = silver.Context("2026-06-15", "test-run", "2026-06-16 00:00:00")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _grid(rows):
    """Cells taken one by one into the next free columns of a table of pending columns."""
    pending, out = {}, []
    for cells in rows:
        line = []

        def waiting(line=line):
            while len(line) in pending:
                text, left = pending.pop(at := len(line))
                line.append(text)
                if left > 1:
                    pending[at] = (text, left - 1)

        for text, across, down in cells:
            waiting()
            at = len(line)
            for c in range(at, at + across):
                line.append(text)
                if down > 1:
                    pending[c] = (text, down - 1)
        waiting()
        out.append(line)
    return out


def test_spans_equal_brute_force(spark):
    """Random tables with spans that meet, overlap, run over the end and span nothing."""
    r = random.Random(1)
    tables = [[[(f"c{t}.{i}.{j}", r.choice([1, 1, 1, 2, 3, 0]), r.choice([1, 1, 2, 3, 9, 0])) for j in range(r.randrange(1, 5))] for i in range(r.randrange(1, 8))] for t in range(120)]
    html = lambda rows: "<p><TABLE id=x>" + "".join("<tr >" + "".join(f"<td class='rowspanner' colspan={a} rowspan=\"{d}\"> {t}&nbsp;</td>" for t, a, d in row) + "</tr><tr></tr>" for row in rows) + "</TABLE>"
    pages = spark.createDataFrame([(i, html(t)) for i, t in enumerate(tables)] + [(900, None), (901, "no table"), (902, "<table></table>")], "page long, html string")
    got = {}
    for x in readers.table_grid(pages).collect():
        got.setdefault(x["page"], {})[x["row_no"]] = x["cells"]
    assert {p: [rows[i] for i in range(len(rows))] for p, rows in got.items()} == {i: _grid(t) for i, t in enumerate(tables)}


def _poverty(spark, n=200):
    rows = [(("x" if i % 7 == 0 else "2025"), f"region {i}", "101" if i % 5 == 0 else "42,5") for i in range(n)]
    return spark.createDataFrame(rows, "anio string, region string, pobreza_monetaria_pct string").repartition(3)


def test_a_run_counts_while_it_writes(spark):
    folder = scratch.new_folder(spark, "raw")
    _poverty(spark).write.parquet(folder)
    raw = spark.read.parquet(folder)
    done = silver.run(raw, "inei_reports", "inei_pobreza_departamental", CONTEXT, scratch.new_folder(spark, "run"))
    bad = sum(i % 7 == 0 or i % 5 == 0 for i in range(200))
    assert done.counts == {"records_read": 200, "records_valid": 200 - bad, "records_rejected": bad}
    assert done.valid.count() == 200 - bad and done.rejects.count() == bad
    valid, rejects = silver.process(raw, "inei_reports", "inei_pobreza_departamental", CONTEXT)
    key = lambda df: sorted(json.dumps(r.asDict(), default=str, sort_keys=True) for r in df.collect())
    assert key(valid) == key(done.valid) and key(rejects) == key(done.rejects) and valid.schema.names == done.valid.schema.names
    assert _plan(silver.judge(raw, "inei_reports", "inei_pobreza_departamental", CONTEXT)).count("FileScan") == 1
    # what is read back is pruned by its kind
    assert "PartitionFilters: [isnotnull(kind" in _plan(done.rejects)
    (s,) = done.summary().collect()
    assert (s["status"], s["records_dropped"]) == ("COMPLETED_WITH_REJECTIONS", 0)


def test_runs_of_unknown_systems_and_of_nothing(spark):
    raw = spark.createDataFrame([("1",), (None,)], "a string")
    done = silver.run(raw, "elsewhere", "anything", CONTEXT, scratch.new_folder(spark, "run"))
    assert done.counts == {"records_read": 2, "records_valid": 2, "records_rejected": 0} and done.rejects.count() == 0
    none = silver.run(_poverty(spark).limit(0), "inei_reports", "inei_pobreza_departamental", CONTEXT, scratch.new_folder(spark, "run"))
    assert none.counts == {"records_read": 0, "records_valid": 0, "records_rejected": 0} and none.valid.count() == 0 and none.summary().first()["status"] == "COMPLETED"


def test_reloads_and_rejects_replace_their_slices(spark):
    path = scratch.new_folder(spark, "slices")
    rows = lambda *x: spark.createDataFrame(list(x), "v int, extraction_date string, source_system string, source_dataset string")
    sinks.overwrite_slices(rows((1, "d1", "s", "a"), (2, "d1", "s", "b"), (3, "d2", "s", "a")), path)
    sinks.overwrite_slices(rows((9, "d1", "s", "a")), path)
    sinks.overwrite_slices(rows(), path)
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [2, 3, 9]
    sinks.replace_slice(rows(), path, extraction_date="d2", source_system="s", source_dataset="a")
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [2, 9]
    root = scratch.new_folder(spark, "rejects")
    bad = spark.createDataFrame([("c1", None, "s", "a", "d1"), ("c2", "x", "s", "b", "d1")], "error_code string, note string, source_system string, source_dataset string, extraction_date string")
    for _ in range(2):
        sinks.write_rejects(bad, root)
    lines = sorted(r["value"] for r in spark.read.text(root).collect())
    assert lines == ['{"error_code":"c1"}', '{"error_code":"c2","note":"x"}']
    assert sorted(tuple(r) for r in sinks.read_rejects(spark, root, ["error_code", "note"]).collect()) == [("c1", None, "s", "a", "d1"), ("c2", "x", "s", "b", "d1")]


def test_unknown_keys_of_each_record(spark):
    lines = ['{"a": 1, "b": {"x": 2}}', '{"a": 1, "z": null, "c": 3}', '{"a": 2, "zz": "v", "aa": [1]}', "{broken", "{}", "  "]
    path = scratch.new_folder(spark, "lines")
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    rows, bad = quarantine.unknown_keys(readers.json_records(spark, path).select("line", "record"), ["a", "b"])
    assert sorted(r["line"] for r in rows.collect()) == sorted([lines[0], lines[3], lines[4]])
    got = sorted((r["failed_field"], r["failed_value"], r["error_message"].rpartition(": ")[2], json.loads(r["raw_record"]).keys()) for r in bad.collect())
    assert [(f, v, m) for f, v, m, _ in got] == [("aa", "[1]", "aa, zz"), ("c", "3", "c, z")]
    assert {(r["stage"], r["error_code"]) for r in bad.collect()} == {("validation", "SCHEMA_MISMATCH")}


def test_markers_are_part_of_the_gate(spark):
    kind = "dataset string, system string, extraction_date string, status string"
    good = lambda d: (d, "mef", "2026-06-15", "SUCCESS")
    expected = spark.createDataFrame([good(d) for d in "abcde"], kind)
    manifests = spark.createDataFrame([good("a"), good("b"), ("c", "mef", "2026-06-14", "SUCCESS"), good("e")], kind)
    markers = spark.createDataFrame([good("a"), ("c", "mef", None, "FAILED"), good("d"), good("e"), good("unknown")], kind)
    got = {r["dataset"]: r["faults"] for r in landing.manifest_faults(expected, manifests, markers=markers).collect()}
    assert got == {"b": ["MARKER_MISSING"], "c": ["EXTRACTION_DATE_MISMATCH", "MARKER_EXTRACTION_DATE_MISMATCH", "MARKER_STATUS_MISMATCH"], "d": ["MISSING"]}


def test_one_byte_late_in_a_file_decides_its_encoding(spark, tmp_path):
    """Files over several splits: the lines of all splits are read as what the whole file is."""
    (tmp_path / "latin.csv").write_bytes(b"k,v\n" + "".join(f"{i},Perú {i}\n" for i in range(3000)).encode() + "9999,Año\n".encode("latin-1"))
    (tmp_path / "utf8.csv").write_bytes(b"\xef\xbb\xbfk,v\n" + "".join(f'{i},"Perú, {i}"\n' for i in range(3000)).encode() + b"\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10k")
    try:
        lines = readers.decoded_lines(spark, str(tmp_path))
        assert lines.select("path", F.spark_partition_id()).distinct().count() > 2
        rows = readers.read_csv_decoded(spark, str(tmp_path), ["k", "v"])
        got = {(r["path"].rpartition("/")[2], r["k"]): r["v"] for r in rows.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 6001 and got["latin.csv", "9999"] == "Año" and got["utf8.csv", "77"] == "Perú, 77"
    assert got["latin.csv", "5"] == "Perú 5".encode().decode("latin-1")


def test_ordered_tables(spark):
    """Null placement, ties by the last key, more files than rows need, one file, no rows."""
    r = random.Random(3)
    rows = [(i, r.choice([None, "a", "b", "é"]), r.choice([None, 1.5, -2.0])) for i in range(500)]
    df = spark.createDataFrame(rows, "i int, s string, x double").repartition(5)
    order = sorted(rows, key=lambda t: (t[1] is None, (t[1] or "").encode(), t[2] is not None, -(t[2] or 0), t[0]))
    for files in (1, 4, 40):
        path = scratch.new_folder(spark, "ordered")
        sinks.write_ordered(df, path, F.asc_nulls_last("s"), F.desc_nulls_first("x"), F.asc("i"), files=files)
        got = sorted((x["row_no"], x["i"]) for x in sinks.read_ordered(spark, path).collect())
        assert got == [(n, t[0]) for n, t in enumerate(order, 1)]
    path = scratch.new_folder(spark, "ordered")
    sinks.write_ordered(df.limit(0), path, F.asc("i"))
    assert sinks.read_ordered(spark, path).count() == 0


def test_scope_prunes_partitions(spark, sf):
    out = landing_queries.current_run(spark, sf)
    plan = _plan(out)
    scans = [x for x in plan.split("\n") if "FileScan" in x]
    assert scans and all("(extraction_date" in x.partition("PartitionFilters: [")[2].partition("]")[0] for x in scans)


def test_rules_report_what_is_not_there_and_let_other_errors_out(spark):
    t = spark.createDataFrame([(1, "a"), (1, " ")], "k int, s string")
    rule = quality.Rule
    rules = [rule("a", "t", "nulls", {"fields": ["s"]}), rule("b", "t", "where", {"condition": "nothing = 1"}), rule("c", "t", "unique", {"keys": ["k"]}), rule("d", "t", "unique", {"keys": ["gone"]}), rule("e", "t", "where", {"condition": "k = 1"})]
    got = {r["check_id"]: (r["failed_rows"], r["passed"]) for r in quality.run_rules(spark, {"t": t}, rules).collect()}
    assert got == {"a": (1, False), "b": (1, False), "c": (1, False), "d": (1, False), "e": (2, False)}
    with pytest.raises(ValueError, match="unknown kind"):
        quality.run_rules(spark, {"t": t}, [rule("x", "t", "odd")])
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|Division by zero") as e:
        quality.run_rules(spark, {"t": t}, [rule("x", "t", "where", {"condition": "1 / (k - 1) > 0"})]).collect()
    assert not isinstance(e.value, AnalysisException)


def test_inventory_of_nothing_and_of_blank_files(spark):
    root = scratch.new_folder(spark, "bronze")
    spark.createDataFrame([(" ",)], "value string").coalesce(1).write.text(f"{root}/sys/blank/extraction_date=2026-01-01")
    spark.createDataFrame([('{"a":1,"ano":"2020"}',), ("{broken",), ('{"b":null}',)], "value string").coalesce(1).write.text(f"{root}/MEF/some/extraction_date=2026-01-02/year=2019")
    got = {r["dataset"]: tuple(r)[2:] for r in inventory.dataset_summary(spark, root, "*.txt").collect()}
    assert got == {"blank": (1, 0, 0, "2026-01-01", ""), "some": (1, 2, 3, "2026-01-02", "2019|2020")}
    total = {r["source_system"]: tuple(r)[1:] for r in inventory.summary_totals(inventory.dataset_summary(spark, root, "*.txt")).collect()}
    assert total == {None: (2, 2, 2), "sys": (1, 1, 0), "MEF": (1, 1, 2)}


def test_analytic_tables_are_read_from_their_files(spark, sf):
    from quillon import table_queries

    plan = _plan(table_queries.gold_allocation(spark, sf))
    assert plan.count("FileScan") < 12 and plan.count("Exchange ") < 20


def test_regional_clusters_are_those_of_the_nearest_mean(spark, sf):
    """In numpy: every region is nearest to the mean of its own cluster, and clusters are numbered by their means."""
    import numpy as np

    from quillon import queries

    names = ["poverty", "demand", "youth", "digital", "rurality"]
    rows = queries.queries()["regional_clusters"](spark, sf).collect()
    x = np.array([[r[n] or 0.0 for n in names] for r in rows], float)
    x = (x - x.mean(0)) / np.where(x.std(0, ddof=1) > 0, x.std(0, ddof=1), 1)
    own = np.array([r["cluster"] for r in rows])
    labels = sorted(set(own))
    means = np.array([x[own == k].mean(0) for k in labels])
    far = ((x[:, None] - means[None]) ** 2).sum(-1)
    assert labels == list(range(1, len(labels) + 1)) and (far[np.arange(len(x)), own - 1] <= far.min(1) + 1e-9).all()
    assert [tuple(m) for m in means.round(9)] == sorted(tuple(m) for m in means.round(9))


def test_top_values_are_cut_before_they_meet(spark):
    """The rank's limit stands below the shuffle, so a task sends so many rows of each column at most."""
    from quillon.operators import profile

    df = spark.range(1000).selectExpr("cast(id % 37 as string) AS a", "cast(id as string) AS b")
    plan = _plan(profile.top_values(df, ["a", "b"], 3))
    above, _, below = plan.partition("Window [")
    assert below.count("WindowGroupLimit") == 2 and below.index("WindowGroupLimit") < below.index("Exchange hashpartitioning(column") < below.rindex("WindowGroupLimit")
    counts = {str(v): sum(i % 37 == v for i in range(1000)) for v in range(37)}
    want = sorted(counts, key=lambda v: (-counts[v], v))[:3]
    got = sorted((r["column"], r["place"], r["value"], r["times"]) for r in profile.top_values(df, ["a", "b"], 3).collect())
    assert got == [("a", i, v, counts[v]) for i, v in enumerate(want, 1)] + [("b", i, v, 1) for i, v in enumerate(("0", "1", "10"), 1)]


def test_warnings_sort_no_cells(spark):
    """The fold of a column's least and most text keeps one row a task; a table without rows warns of nothing."""
    from quillon.operators import profile

    df = spark.createDataFrame([(str(i), f"{i},5", " \u00a0", "same", "x" if i % 2 else str(i)) for i in range(40)], "ruc string, nota string, empty string, one string, mixed string").repartition(3)
    plan = _plan(profile.warnings(df))
    assert "Sort [" not in plan and "SortAggregate(key=[column" not in plan
    got = sorted(map(tuple, profile.warnings(df).collect()))
    assert got == [("empty", "ALL_EMPTY"), ("empty", "HIGH_NULL_PERCENTAGE"), ("mixed", "MIXED_TYPE_VALUES"), ("nota", "POSSIBLE_DECIMAL_COMMA"), ("one", "LOW_DISTINCT"), ("ruc", "POSSIBLE_IDENTIFIER_AS_NUMBER")]
    assert profile.warnings(df.limit(0)).collect() == []


def test_tables_without_spans_need_no_fold(spark, sf):
    """Plain tables are told by one pattern; those of cells to clean and those with spans go their own ways to the same grid."""
    pages = [
        ("<table class=x>\n<thead><TR id='a'><th scope=col>año</th><TD></TD></TR></thead><tr></tr> <tr><td>b c</td><td>1,5%</td></tr>\n</table>", [["año", ""], ["b c", "1,5%"]]),
        ("<table><tr><td> b  c</td><td>d&nbsp;&amp;lt;</td><td>x<b>y</b></td><td>1 < 2</td></tr></table>", [["b c", "d &lt;", "x y", "1 < 2"]]),
        ("<table><tr><td>b c </td><td title='a>b'>e</td><td</td><td>日本 x</td></tr></table>", [["b c", "b'>e", "", "日本 x"]]),
        ("<table><tr><td data-span=1>a</td><td>colspan=3</td></tr></table>", [["a", "colspan=3"]]),
        ("<table><tr><td COLSPAN = 2>a</td></tr><tr><td rowspan='2'>b</td><td>c</td></tr><tr><td>d</td></tr></table>", [["a", "a"], ["b", "c"], ["b", "d"]]),
        ("<table><tr><td>one</td></tr></table> <table><tr><td>two</td></tr></TABLE><table><tr><td>open", [["one"], ["two"]]),
        ("<table>" + "<tr><td>r</td><td>s</td></tr>" * 3000 + "<tr><td>" + "w " * 5000 + "w</td></tr></table>", [["r", "s"]] * 3000 + [["w " * 5000 + "w"]]),
    ]
    grid = readers.table_grid(spark.createDataFrame([(i, html) for i, (html, _) in enumerate(pages)], "page int, html string"))
    got = [[] for _ in pages]
    for x in sorted(grid.collect(), key=lambda x: (x["page"], x["table_no"], x["row_no"])):
        got[x["page"]].append(list(x["cells"]))
    assert got == [want for _, want in pages]
    assert "CASE WHEN RLIKE(_t" in _plan(grid)
    shuffled = next(line for line in _plan(landing_queries.html_budget_rows(spark, sf)).splitlines() if "partial_collect_list" in line)
    assert "<td" not in shuffled
