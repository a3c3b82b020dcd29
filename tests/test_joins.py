import random

from pyspark.sql import functions as F

from capsweep.operators.intervals import LEVELS, blocks, within
from capsweep.operators.substrings import contained


def test_contained_is_every_name_against_every_probe(spark):
    draw = random.Random(5)
    words = ["ana", "an", "a", "da silva", "dos reis", "ção", "日本語", "x", "", "ab", "abab", "aba"]
    names = sorted({" ".join(draw.choice(words) for _ in range(draw.randint(0, 4))) for _ in range(150)})
    probes = sorted({*words, *names[:40], "silva dos", "zzz", "aaz", "ba", "本"})
    got = contained(spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame([(p,) for p in probes], "probe string"))
    assert sorted(map(tuple, got.collect())) == sorted((n, p) for n in names for p in probes if p in n)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    none = spark.createDataFrame([], "probe string")
    assert contained(spark.createDataFrame([("abc",)], "name string"), none).count() == 0


def test_blocks_cover_a_span_once(spark):
    draw = random.Random(7)
    spans = [(a, a + draw.choice([0, 1, 2, 3, 7, 40, 1000]) - 1) for a in (draw.randint(-500, 500) for _ in range(120))] + [(None, 3), (3, None), (0, 1023), (-1, 0), (1, (1 << 39) + 5)]
    rows = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(spans)], "k int, a long, b long").select("k", blocks(F.col("a"), F.col("b")).alias("x")).collect()
    for r in rows:
        a, b = spans[r.k]
        if a is None or b is None or b < a:
            assert not r.x
            continue
        parts = sorted((x.block << x.level, (x.block + 1) << x.level) for x in r.x)
        assert parts[0][0] == a and parts[-1][1] == b + 1 and all(p[1] == q[0] for p, q in zip(parts, parts[1:], strict=False))
        assert len(parts) <= 2 * LEVELS and all(sum(x.level == k for x in r.x) <= 2 for k in range(LEVELS + 1))


def test_within_is_a_range_join(spark):
    draw = random.Random(9)
    spans = [(k, draw.choice("xy"), a := draw.randint(-50, 50), a + draw.choice([-1, 0, 5, 60])) for k in range(60)]
    points = [(f"p{k}", draw.choice("xyz"), draw.randint(-60, 110)) for k in range(80)] + [("null", "x", None)]
    s, p = spark.createDataFrame(spans, "k int, key string, low int, high int"), spark.createDataFrame(points, "id string, key string, at int")
    got = within(s, "low", "high", p.withColumnRenamed("key", "other"), "at")
    want = sorted((k, i) for k, _, a, b in spans for i, _, x in points if x is not None and a <= x <= b)
    assert sorted((r.k, r.id) for r in got.collect()) == want and "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.k, r.id) for r in within(s, "low", "high", p, "at", ["key"]).collect()) == sorted((k, i) for k, c, a, b in spans for i, d, x in points if x is not None and a <= x <= b and c == d)
    assert within(s.where("false"), "low", "high", p.drop("key"), "at").count() == 0
