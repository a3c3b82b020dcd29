"""Probes that a sweep harvests: against a plain count, cell by cell, level by level."""

import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from capsweep.plans import run as runs
from capsweep.plans.harvest import HarvestedTraversal
from capsweep.plans.sweep import day_cells, sweep
from capsweep.sources.capped import TableSource
from capsweep.stores import Stores

NAMES = ["ANA DA SILVA", "RUI DA SILVA", "CAIXA ECONOMICA FEDERAL", "EVA LIMA", "X", None, "BIA  DOS SANTOS", "ANA LIMA"]


def rows(n=60):
    return [(f"i{k:03d}", f"2024-01-0{k % 2 + 1}", "AB"[k % 3 > 0], NAMES[(k * 5 + k // 7) % len(NAMES)]) for k in range(n)]


def source(spark, cap=3):
    df = spark.createDataFrame(rows(), "item_id string, day string, facet string, name string").withColumn("day", F.col("day").cast("date"))
    return TableSource(df, cap)


def facets(spark):
    return spark.createDataFrame([("A", 0), ("B", 1)], "facet string, position int")


def plain(most, dictionary, cap=3):
    """{unit_key: rows asked} of a sweep that counts in a dictionary, level by level."""
    data = sorted(rows())
    count, first, asked = Counter(), {}, {}
    level = [(f"{d}..{d}", d, None, None) for d in ("2024-01-01", "2024-01-02")]
    depth = 0
    while level:
        full, pairs = [], []
        for key, d, f, p in sorted(level, key=lambda c: c[0]):
            got = [r for r in data if r[1] == d and f in (None, r[2]) and (p is None or (r[3] and p.lower() in r[3].lower()))][:cap]
            asked[key] = len(got)
            if len(got) >= cap:
                full.append((key, d, f, p))
            for r in got:
                words = (r[3] or "").split()
                pairs += [(f"{a} {b}", (depth, key, r[0], i)) for i, (a, b) in enumerate(zip(words, words[1:]))]
        for w, seen in pairs:
            count[w] += 1
            first[w] = min(first.get(w, seen), seen)
        ranked = sorted(count, key=lambda w: (-count[w], first[w]))
        queue = (ranked + [w for w in dictionary if w not in count])[:most]
        level, depth = [], depth + 1
        for key, d, f, p in full:
            if f is None:
                level += [(f"{d}..{d}|{x}", d, x, None) for x in "AB"]
            elif p is None:
                level += [(f"{key}|{q}", d, f, q) for q in queue]
    return asked


@pytest.mark.parametrize("most", [0, 3, 12])
def test_probes_are_what_was_seen(spark, most):
    dictionary = ["DOS REIS", "DA SILVA", "A B", "C D", "E F", "G H", "I J"]
    common = spark.createDataFrame(list(zip(dictionary, range(9))), "probe string, position int")
    cells, _ = sweep(source(spark), HarvestedTraversal(facets(spark), common, max_probes=most), day_cells(spark, "2024-01-01", "2024-01-02"))
    assert {r.unit_key: r.result_count for r in cells.collect()} == plain(most, dictionary)


def test_a_cell_is_never_offered_a_probe_twice(spark):
    t = HarvestedTraversal(facets(spark), spark.createDataFrame([("P Q", 0), ("R S", 1)], "probe string, position int"), max_probes=2)
    hit = lambda *names: spark.createDataFrame([("c", f"{i}", n) for i, n in enumerate(names)], "unit_key string, item_id string, name string")
    ask = lambda *keys: {k: [r.probe for r in got if r.unit_key == k] for got in [t.further(spark.createDataFrame([(k,) for k in keys], "unit_key string")).collect()] for k in keys}
    t.observed(hit("A B", "C D", "A B", "E F"), "000")
    assert {k: sorted(v) for k, v in ask("x").items()} == {"x": ["A B", "C D"]}
    t.observed(hit("G H", "G H", "G H", None, "ONE"), "001")
    assert {k: sorted(v) for k, v in ask("x", "y").items()} == {"x": ["E F", "G H"], "y": ["A B", "G H"]}
    assert {k: sorted(v) for k, v in ask("x").items()} == {"x": ["P Q", "R S"]} and ask("x") == {"x": []}
    split = t.offered_probes(spark.createDataFrame([("y", 1)], "unit_key string, depth int"))
    assert sorted(r.probe for r in split.collect()) == ["A B", "G H"]


def test_a_resumed_run_asks_what_was_offered(spark, tmp_path):
    seeds = day_cells(spark, "2024-01-01", "2024-01-02")
    whole, parts = Stores(spark, str(tmp_path / "whole")), Stores(spark, str(tmp_path / "parts"))
    runs.run(source(spark), HarvestedTraversal(facets(spark), max_probes=4, stores=whole), seeds, whole, "a", clock=runs.FixedClock())
    for k in range(2):
        # budgets that stop it amid a level
        limits = runs.Limits(max_requests=[6, None][k])
        runs.run(source(spark), HarvestedTraversal(facets(spark), max_probes=4, stores=parts), seeds, parts, f"r{k}", limits, runs.FixedClock())
    read = lambda s: sorted((r.unit_key, r.state, r.result_count) for r in s.checkpoints().collect())
    assert read(whole) == read(parts) and any(k.count("|") == 2 for k, _, _ in read(whole))
    again = HarvestedTraversal(facets(spark), max_probes=4, stores=parts)
    live = sorted((r.probe, r.n) for r in again._counts.collect())
    assert live == sorted((r.probe, r.n) for r in HarvestedTraversal(facets(spark), max_probes=4, stores=whole)._counts.collect())
    parts.append("probes", parts.read("probes"), f"z-{uuid.uuid4().hex}")  # what a crash had a run write twice
    assert live == sorted((r.probe, r.n) for r in HarvestedTraversal(facets(spark), max_probes=4, stores=parts)._counts.collect())


def test_payloads_hold_anything(spark, tmp_path):
    stores = Stores(spark, str(tmp_path / "s"))
    assert stores.payload_schema() in (None, "VOID") and stores.fields({"a": ("$.a", "int")}).count() == 0
    bags = ['{"a":1,"b":{"c":["x","y"]}}', '{"a":"no number"}', "[3]", "broken {", None, '{"b":{"c":[]}}', '{"a":null}']
    none = F.lit(None).cast("array<struct<document_id:string,status:string,bytes:bigint>>")
    df = spark.createDataFrame([(str(i), b) for i, b in enumerate(bags)], "item_id string, payload string")
    stores.append("items", df.withColumns({"unit_key": F.lit("u"), "run_id": F.lit("r"), "observed_at": F.lit("t"), "documents": none}), "0")
    got = {r.item_id: (r.a, r.c, r.first) for r in stores.fields({"a": ("$.a", "int"), "c": ("$.b.c[1]", "string"), "first": ("$[0]", "int")}).collect()}
    assert got == {"0": (1, "y", None), "2": (None, None, 3)} | {k: (None, None, None) for k in "13456"}
    assert "c" in spark.createDataFrame(bags[:1], "string").agg(F.schema_of_variant_agg(F.parse_json("value"))).first()[0] and stores.payload_schema()
