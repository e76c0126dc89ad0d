import random
from collections import Counter

from pyspark.sql import functions as F

from cladeworks.operators import heavy_keys as hk
from cladeworks.operators.heavy_keys import Measure, per_key


def table(spark, n=3000, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        k = "Hot" if r.random() < 0.4 else r.choice(["a", "B", " a ", "c%d" % r.randrange(40), None, ""])
        rows.append((k, "s", r.choice([None, 5, -7, i]), i))
    return rows, spark.createDataFrame(rows, "genus string, species string, v bigint, n_rows int").repartition(5)


def brute(rows):
    out = {}
    for k, s, v, _ in rows:
        key = (k or "").strip().lower() or None
        o = out.setdefault(key, [0, 0, None, None])
        o[0] += 1
        if v is not None:
            o[1] += v
            o[2] = v if o[2] is None else min(o[2], v)
            o[3] = v if o[3] is None else max(o[3], v)
    return {(k, *v) for k, v in out.items()}


def run(df, **how):
    v = F.col("v")
    out = per_key(df, ["genus"], {"k": F.nullif(F.lower(F.trim("genus")), F.lit(""))}, [Measure("total", v), Measure("lo", v, "min"), Measure("hi", v, "max")], **how)
    return {tuple(r) for r in out.select("k", "n_rows", "total", "lo", "hi").collect()}


def test_matches_brute_force(spark):
    rows, df = table(spark)
    want = brute(rows)
    assert run(df) == want
    assert run(df, held=3) == want  # arrays handed on in between


def test_blocks_and_fan_in(spark, monkeypatch):
    monkeypatch.setattr(hk, "BLOCK", 3)
    monkeypatch.setattr(hk, "FAN_IN", 2)
    rows, df = table(spark, 500, 2)
    assert run(df) == brute(rows)


def test_empty_and_repeats(spark):
    empty = spark.createDataFrame([], "genus string, species string, v bigint")
    assert run(empty) == set()
    twice = spark.createDataFrame([("x", "y"), ("x", "y"), ("X", "y"), ("x", None)], "genus string, species string")
    got = Counter({(r["genus"], r["species"]): r["n_rows"] for r in hk.taxa(twice).collect()})
    assert got == {("x", "y"): 3, (None, None): 1}
