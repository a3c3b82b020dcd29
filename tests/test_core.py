import ast
import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from capsweep import cli
from capsweep.functions import codecs
from capsweep.functions import scalars as S
from capsweep.operators import coverage, queues
from capsweep.plans.sweep import Traversal, bisected, day_cells, sweep
from capsweep.sources import html, records
from capsweep.sources.capped import RangeSource, TableSource
from capsweep.sources.jsonl import read_jsonl

ROOT = Path(__file__).resolve().parent.parent


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def observed(spark, rows):
    schema = "unit_key string, window_key string, facet_value string, result_count long, observed_at string, ordinal int, dimensions map<string,string>"
    return spark.createDataFrame([(f"{w}|{f}|{i}", w, f, n, at, i, d) for i, (w, f, n, at, d) in enumerate(rows)], schema)


@pytest.mark.parametrize(("rows", "want"), [
    ([(None, 30), ("A", 20), ("B", 25)], (30, 45, True)),
    ([(None, 30), ("A", 10)], (30, 10, False)),
])
def test_partition_invariant(spark, rows, want):
    r = observed(spark, [("w", f, n, "t", {"date": "d"} | ({"class": f} if f else {})) for f, n in rows])
    got = coverage.partition_invariant(r).collect()
    assert [(x.parent_count, x.child_sum, x.holds) for x in got] == [want]


def test_repeated_children_count_unless_deduped(spark):
    r = observed(spark, [("w", None, 30, "t", {"date": "d"}), ("w", "A", 16, "t1", {"date": "d", "class": "A"}), ("w", "A", 16, "t2", {"date": "d", "class": "A"})]).withColumn("unit_key", F.concat_ws("|", "window_key", "facet_value"))
    assert coverage.partition_invariant(r).first().child_sum == 32
    assert coverage.partition_invariant(r, dedupe=True).first().child_sum == 16


def test_latest_ties_go_to_the_later_row(spark):
    df = spark.createDataFrame([("a", "t", 1, "x"), ("a", "t", 2, "y"), ("b", "t", 1, "z")], "unit_key string, observed_at string, ordinal int, state string")
    assert {r.unit_key: r.state for r in coverage.latest(df, "unit_key").collect()} == {"a": "y", "b": "z"}


def test_failures_without_resolution(spark):
    df = spark.createDataFrame([("i", "1", False), ("i", "1", True), ("i", "2", False), ("i", None, False)], "item_id string, document_id string, resolved boolean")
    assert [r.document_id for r in coverage.unresolved_failures(df).collect()] == ["2"]


def test_probe_queue(spark):
    names = spark.createDataFrame([(0, "REGIONAL DE SEGURO"), (1, "REGIONAL DE SEGURO")], "o int, name string")
    d = spark.createDataFrame([("DA SILVA", 0), ("DOS SANTOS", 1)], "probe string, position int")
    assert [r.probe for r in queues.probe_queue(queues.bigram_frequency(names, "name", "o"), d).collect()] == ["REGIONAL DE", "DE SEGURO", "DA SILVA", "DOS SANTOS"]


def test_scalars(spark):
    lit = F.lit
    assert one(spark, S.set_hash(F.array().cast("array<string>"))) == "sha1:da39a3ee5e6b4b0d3255bfef95601890afd80709"
    assert one(spark, S.local_timestamp(lit("01/02/2024 14:20:07"))) == "2024-02-01T17:20:07.000Z"
    assert one(spark, S.local_timestamp(lit("31/02/2024 14:20:07"))) is None
    assert one(spark, S.labelled_code(lit("Procedimento (123)"))) == ("Procedimento", "123")
    assert one(spark, S.labelled_code(lit("Procedimento (123"))).code == "123"
    p = one(spark, S.party(lit("Ana - CPF: 1 (AUTOR)")))
    assert (p.name, p.cpf, p.cnpj, p.role) == ("Ana", "1", None, "AUTOR")
    assert one(spark, S.party_names(lit("A X B e outros (3)"))) == ["A", "B"]
    assert one(spark, S.text_or_null(lit("  ﻿ "))) is None
    assert one(spark, S.decision(lit("transient"), lit(429), lit(1), lit(1000.0), lit(None).cast("bigint"))) == ("requeue", 1000)
    assert one(spark, S.decision(lit("transient"), lit(503), lit(6), lit(1000.0), lit(None).cast("bigint"))).action == "stop"
    assert one(spark, S.redacted(F.create_map(lit("cpf"), lit("1"), lit("CPF"), lit("2")))) == {"cpf": "[REDACTED]", "CPF": "2"}
    assert one(spark, S.retry_after_ms(lit("7"))) == 7000 and one(spark, S.retry_after_ms(lit("soon"))) is None
    assert one(spark, S.field_named(F.array(lit("a:nameX"), lit("b:name")), "name")) == "a:nameX"


def test_codecs():
    assert codecs.encode_component("a b\xe3–") == "a+b%E3%26%238211%3B"
    assert codecs.decode_component("Decis%E3o+x%zz") == "Decisão x%zz"
    assert codecs.slug("Petição Inicial (Outros)") == "peticao-inicial"
    assert codecs.slug("(só)") == "so" and codecs.slug("..") is None and len(codecs.slug("x" * 99)) == 60


@pytest.mark.parametrize("cap", [1, 2, None])
def test_sweep_finds_what_plain_filters_find(spark, cap):
    rows = [(f"i{k}", dt.date(2024, 1, 1 + k % 3), "AB"[k % 2], ["DA SILVA", "DOS REIS"][k % 2]) for k in range(12)]
    source = TableSource(spark.createDataFrame(rows, "item_id string, day date, facet string, name string"), cap)
    facets = spark.createDataFrame([("A", 0), ("B", 1)], "facet string, position int")
    probes = spark.createDataFrame([("da silva", 0)], "probe string, position int")
    cells, items = sweep(source, Traversal(facets, probes), day_cells(spark, "2024-01-01", "2024-01-04"))
    state = {r.unit_key: (r.state, r.result_count) for r in cells.collect()}
    assert state["2024-01-04..2024-01-04"] == ("complete", 0)
    assert state["2024-01-01..2024-01-01"][0] == ("complete" if cap is None else "subdivided")
    assert items.count() == items.distinct().count() and (cap is not None or items.count() == 12)


def test_bisection_covers_the_span(spark):
    c = spark.sql("select 'k' unit_key, 'k' window_key, cast(null as string) facet_value, cast(null as string) probe, date'2024-01-01' date_from, date'2024-01-05' date_to, 0 depth")
    assert sorted((str(r.date_from), str(r.date_to)) for r in bisected(c).collect()) == [("2024-01-01", "2024-01-03"), ("2024-01-04", "2024-01-05")]


def test_range_source(spark):
    s = RangeSource(spark.createDataFrame([("a", 1), ("b", 2), ("c", 2)], "item_id string, region int"), 1)
    cells = spark.createDataFrame([("k", 1, 1), ("l", 2, 3)], "unit_key string, low int, high int")
    assert sorted((r.unit_key, r.item_id) for r in s.discover(cells).collect()) == [("k", "a"), ("l", "b")]


def test_jsonl_torn_line(spark, tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text('{"a":1}\n\n{"a":2}\n{"a":')
    assert [r.a for r in read_jsonl(spark, str(p), "a int").orderBy("line_no").collect()] == [1, 2]
    p.write_text('{"a":1}\n{"a":\n{"a":2}\n')
    with pytest.raises(ValueError, match="line 2"):
        read_jsonl(spark, str(p), "a int")
    assert read_jsonl(spark, str(tmp_path / "none.jsonl"), "a int").count() == 0


def test_html():
    page = "<table><tr class='rich-table-row'><td><a onclick=\"go('?ca=ab12')\">0000001-02.2024.4.05.8300</a></td><td>no cell</td><td class='rich-table-cell'>x</td><td class='rich-table-cell'>before <a>Classe</a><br>A X B </td></tr><tr class='rich-table-row'><td>none</td></tr></table>"
    assert html.result_rows(page) == [{"process_number": "0000001-02.2024.4.05.8300", "token": "ab12", "parties": "A X B"}]
    moves = "<table id='x:processoEvento'><tbody id='x:processoEvento:tb'><tr><td>01/02/2024 10:00:00 - Autuado</td></tr><tr><td>no date</td><td>2</td></tr></tbody></table>"
    assert [(m["sequence"], m["raw_date"], m["description"], len(m["raw_cells"])) for m in records.movements(html.parse(moves))] == [(1, "01/02/2024 10:00:00", "Autuado", 1), (2, None, "no date", 2)]
    with pytest.raises(ValueError):
        html.form_state("<form action='/x'></form>")
    assert html.visible_text("<i>" * 20_000 + "deep<script>x</script>" + "</i>" * 20_000) == "deep"
    assert html.form_state("<form action='/x'><input name='javax.faces.ViewState' value='j1'><input name='f:n'></form><script>s({'f:go':'f:go'})</script>") == {"action": "/x", "view_state": "j1", "fields": ["javax.faces.ViewState", "f:n"], "trigger": "f:go"}


def test_cli():
    assert cli.forecast(dt.date(2024, 1, 1), dt.date(2024, 1, 1), 30, cli.Bounds())["requests"] == 41
    assert cli.max_split_depth(dt.date(2024, 1, 1), dt.date(2024, 1, 2)) == 20
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["scrape", "--from", "2024-01-01", "--to", "2024-01-02", "--max-items", "-1"])


def test_seam():
    """Operators and plans know no concrete page format, and nothing outside llm imports it."""
    for p in (ROOT / "capsweep").rglob("*.py"):
        if "llm" in p.parts:
            continue
        names = {n.module or "" for n in ast.walk(ast.parse(p.read_text())) if isinstance(n, ast.ImportFrom)}
        assert not any("llm" in n for n in names), p
        if p.parent.name in ("operators", "plans"):
            assert not any(n.endswith("html") for n in names), p


def test_every_name_is_a_probe(spark):
    names = ["Ana", "ana bob", "ANA BOB", "bob", None, *(f"n{k:02d} x" for k in range(30))]  # far more than 20 rows, prefixes alike
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(names)], "k long, name string")
    low = [v.lower() for v in names if v is not None]
    assert {r.probe: r.hits for r in queues.name_probe_hits(rows, "name").collect()} == {p: sum(p in v for v in low) for p in low}
