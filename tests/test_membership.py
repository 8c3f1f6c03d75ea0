import random

import pytest

from ledgerline.operators.membership import bitmap_candidates, key_bitmap, maybe_in


def test_candidates_equal_brute_force(spark):
    rng = random.Random(4)
    source = [(f"k{rng.randrange(4000)}",) for _ in range(1500)] + [(None,), ("",)]
    rows = [(None if i % 50 == 0 else f"k{rng.randrange(9000)}", i, "x") for i in range(5000)] + [("", -1, "y")] * 2
    src = spark.createDataFrame(source, "IMSI string")
    cnt = spark.createDataFrame(rows, "IMSI string, `my col` long, _bitmap2 string")
    keys = {k for (k,) in source if k is not None}
    want = sorted(r for r in rows if r[0] in keys)
    for bits in (15, 20, 27):
        out = bitmap_candidates(cnt, src, bits=bits)
        assert out.columns == cnt.columns
        assert sorted(tuple(r) for r in out.collect()) == want
    # what the shuffle gets: the candidates and false hits of the order of keys / positions
    near = maybe_in(cnt, key_bitmap(src, "IMSI", 20), "IMSI", 20).count()
    assert len(want) <= near <= len(want) + 40
    assert bitmap_candidates(cnt, src.where("false")).count() == 0
    with pytest.raises(ValueError):
        key_bitmap(src, "IMSI", 40)


def test_filter_is_below_the_shuffle_and_bounded(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        src, cnt = spark.range(50_000).selectExpr("cast(id AS string) AS IMSI"), spark.range(90_000).selectExpr("cast(id AS string) AS IMSI", "id")
        p = bitmap_candidates(cnt, src, bits=18)._jdf.queryExecution().executedPlan().toString()
        counterpart = p[p.index("SortMergeJoin"):].split("BroadcastExchange")[0]
        assert counterpart.index("Exchange hashpartitioning") < counterpart.index("BroadcastHashJoin")
        maps = key_bitmap(src, "IMSI", 18)
        assert maps.selectExpr("sum(octet_length(bitmap)) AS n").first().n <= 2 ** 18 // 8
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
