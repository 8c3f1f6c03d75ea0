"""Reconciliation semantics on hand-made frames, plus brute-force checks of the bucketed match."""

import datetime as dt
import random

from ledgerline.operators.recon import (HOUR_SHIFT, SAME_SECOND, Tolerance, matched_left,
                                        matched_pairs, unmatched_by_key, unmatched_by_second)

SRC = ("record_id long, IMSI string, origToNumber string, service string, recType string, "
       "duration int, dateTime string, timeKey long")
RND = ("IMSI string, origToNumber string, service string, recType string, duration int, "
       "dateTime string, timeKey long")
T0 = 1_705_314_030  # 2024-01-15 10:20:30


def _text(t):
    return (dt.datetime(1970, 1, 1) + dt.timedelta(seconds=t)).strftime("%Y-%m-%d %H:%M:%S")


def src(spark, rows):
    """rows: (record_id, key tuple, duration, seconds)"""
    return spark.createDataFrame([(rid, *k, d, _text(t), t) for rid, k, d, t in rows], SRC)


def rnd(spark, rows):
    return spark.createDataFrame([(*k, d, _text(t), t) for k, d, t in rows], RND)


K = ("250990001", "79180001", "voice", "1")
K2 = ("250990002", "79180002", "voice", "1")


def ids(df):
    return sorted(r.record_id for r in df.select("record_id").collect())


def test_duration_and_time_bounds_are_strict(spark):
    s = src(spark, [(1, K, 10, T0), (2, K2, 10, T0)])
    r = rnd(spark, [(K, 12, T0 + 2), (K2, 13, T0)])          # K: both diffs 2 -> match; K2: dur 3
    assert ids(unmatched_by_second(s, r)) == [2]
    r = rnd(spark, [(K, 10, T0 + 3), (K2, 10, T0 - 2)])      # K: time 3 -> no; K2: time -2 -> match
    assert ids(unmatched_by_second(s, r)) == [1]


def test_hour_shift_key_level_only(spark):
    s = src(spark, [(1, K, 10, T0)])
    for delta, key_level_matches in [(3600, True), (3602, True), (3603, False), (-3600, True),
                                     (-3602, True), (-3603, False)]:
        r = rnd(spark, [(K, 10, T0 + delta)])
        assert (ids(unmatched_by_key(s, r, tol=HOUR_SHIFT)) == []) == key_level_matches, delta
        assert ids(unmatched_by_second(s, r)) == [1], delta      # first level: no shift allowed


def test_twin_removed_with_matched_record_first_level(spark):
    # same key and second, other duration: goes with its matched twin (unit is key + second)
    s = src(spark, [(1, K, 10, T0), (2, K, 60, T0), (3, K, 60, T0 + 100)])
    r = rnd(spark, [(K, 10, T0)])
    assert ids(unmatched_by_second(s, r)) == [3]


def test_key_level_clears_whole_key(spark):
    s = src(spark, [(1, K, 10, T0), (2, K, 10, T0 + 7200), (3, K2, 10, T0)])
    r = rnd(spark, [(K, 10, T0)])
    assert ids(unmatched_by_key(s, r)) == [3]
    assert ids(unmatched_by_second(s, r)) == [2, 3]


def test_concat_key_collision(spark):
    a = ("1", "23", "voice", "1")
    b = ("12", "3", "voice", "1")
    s = src(spark, [(1, a, 10, T0), (2, b, 10, T0 + 5000)])
    r = rnd(spark, [(b, 10, T0 + 5000)])
    assert ids(unmatched_by_key(s, r)) == [1]
    assert ids(unmatched_by_key(s, r, concat_key=True)) == []


def test_null_key_reported(spark):
    s = spark.createDataFrame([(1, None, "79", "voice", "1", 10, _text(T0), T0)], SRC)
    r = spark.createDataFrame([(None, "79", "voice", "1", 10, _text(T0), T0)], RND)
    assert ids(unmatched_by_second(s, r)) == [1]
    assert ids(unmatched_by_key(s, r)) == [1]


def test_broken_datetimes_match_each_other(spark):
    s = spark.createDataFrame([(1, *K, 10, "bad", T0), (2, *K2, 10, "bad", T0)], SRC)
    r = spark.createDataFrame([(*K, 10, "also bad", T0), (*K2, 10, _text(T0), T0)], RND)
    # K: both unparseable -> both epoch -> match; K2: epoch vs a real time -> no match
    assert ids(unmatched_by_second(s, r)) == [2]


def _brute(left, right, tol, keys):
    out = set()
    for l in left:
        for r in right:
            if l[:keys] == r[:keys] and abs(l[keys] - r[keys]) < tol.duration and any(
                    abs(l[keys + 1] + k - r[keys + 1]) < tol.seconds for k in tol.shifts):
                out.add(l[-1])
    return out


def test_bucketed_semi_join_equals_brute_force(spark):
    rng = random.Random(7)
    for tol in [SAME_SECOND, HOUR_SHIFT, Tolerance(1, 1, (0,)), Tolerance(5, 10, (0, 60, -60))]:
        left = [(rng.choice("ab"), rng.randint(0, 5), rng.randint(-200, 200), i) for i in range(300)]
        right = [(rng.choice("ab"), rng.randint(0, 5), rng.randint(-200, 200) + rng.choice([0, 60, -60, 3600]))
                 for _ in range(300)]
        ldf = spark.createDataFrame(left, "k string, duration int, t long, id long")
        rdf = spark.createDataFrame(right, "k string, duration int, t long")
        want = _brute([(k, d, t, i) for k, d, t, i in left], [(k, d, t, None) for k, d, t in right],
                      tol, 1)
        for side in ("left", "right"):
            for bc in (False, True):
                got = {r.id for r in matched_left(ldf, rdf, tol=tol, keys=["k"], left_time="t",
                                                  right_time="t", carry=["id"], shift_on=side,
                                                  broadcast_left=bc).collect()}
                assert got == want, (tol, side, bc)


def test_matched_pairs_equals_brute_force(spark):
    rng = random.Random(11)
    left = [(rng.choice("abc"), rng.randint(0, 4), rng.randint(0, 40), i) for i in range(150)]
    right = [(rng.choice("abc"), rng.randint(0, 4), rng.randint(0, 40), 1000 + j) for j in range(150)]
    ldf = spark.createDataFrame(left, "k string, duration int, t long, id long")
    rdf = spark.createDataFrame(right, "k string, duration int, t long, rid long")
    got = {(r.id, r.r_rid) for r in matched_pairs(ldf, rdf, tol=SAME_SECOND, keys=["k"], left_time="t",
                                                   right_time="t", left_cols=("id",),
                                                   right_cols=("rid",)).collect()}
    want = {(l[3], r[3]) for l in left for r in right
            if l[0] == r[0] and abs(l[1] - r[1]) < 3 and abs(l[2] - r[2]) < 3}
    assert got == want


def test_result_is_subset_and_key_level_within_record_level(spark):
    rng = random.Random(3)
    keys = [("i%d" % rng.randint(0, 9), "o", "s", str(rng.randint(0, 1))) for _ in range(200)]
    rows = [(i, keys[i], rng.randint(0, 6), T0 + rng.randint(0, 20)) for i in range(200)]
    s = src(spark, rows)
    r = rnd(spark, [(keys[i], rng.randint(0, 6), T0 + rng.randint(0, 20)) for i in range(0, 200, 3)])
    first = set(ids(unmatched_by_second(s, r)))
    key_level = set(ids(unmatched_by_key(s, r, tol=SAME_SECOND)))
    assert first <= set(range(200))
    assert key_level <= first


def test_hot_subscriber_matches_brute_force(spark):
    # one key holds most records, many within the same few seconds: the bucketed join and the
    # removals must stay exact
    rng = random.Random(17)
    hot = ("25099000001", "79180000001", "voice", "1")
    rows, rrows = [], []
    for i in range(3000):
        k = hot if i % 4 else ("2509900%04d" % rng.randint(0, 50), "7918", "sms", "0")
        rows.append((i, k, rng.randint(0, 8), T0 + rng.randint(0, 600)))
    for j in range(1500):
        k = hot if j % 3 else ("2509900%04d" % rng.randint(0, 50), "7918", "sms", "0")
        rrows.append((k, rng.randint(0, 8), T0 + rng.randint(-5, 605)))
    s, r = src(spark, rows), rnd(spark, rrows)

    def match(l, rr, shifts):
        return (l[1] == rr[0] and abs(l[2] - rr[1]) < 3
                and any(abs(l[3] + k - rr[2]) < 3 for k in shifts))

    by_key = {}
    for rr in rrows:
        by_key.setdefault(rr[0], []).append(rr)
    matched = [l for l in rows if any(match(l, rr, (0,)) for rr in by_key.get(l[1], []))]
    units = {(l[1], l[3]) for l in matched}
    want_second = sorted(l[0] for l in rows if (l[1], l[3]) not in units)
    keys = {l[1] for l in rows if any(match(l, rr, (0, 3600, -3600)) for rr in by_key.get(l[1], []))}
    want_key = sorted(l[0] for l in rows if l[1] not in keys)
    assert ids(unmatched_by_second(s, r)) == want_second
    assert ids(unmatched_by_key(s, r)) == want_key
    assert ids(unmatched_by_key(s, r, shift_on="right")) == want_key


def test_counterpart_candidates_null_safe(spark):
    from ledgerline.operators.recon import counterpart_candidates
    s = spark.createDataFrame([("a",), (None,)], "IMSI string")
    r = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "IMSI string, v int")
    assert sorted(x.v for x in counterpart_candidates(r, s).collect()) == [1]


def test_result_columns_keep_their_order(spark):
    from ledgerline.constants import FIRST_LEVEL_COLUMNS, KEY_LEVEL_COLUMNS
    from ledgerline.operators import checks
    from ledgerline.sources import fixtures as fx
    ev = fx.load_events(spark, "/root/testdata/sf0.001")
    start, rnd = fx.cdr_start(ev), fx.cdr_rnd(ev)
    for glued in (False, True):
        assert checks.key_level_unmatched(start, rnd, "2024-01-18", concat_key=glued).columns == KEY_LEVEL_COLUMNS
    assert checks.first_level_unmatched(start, rnd, "2024-01-18", days_back=3).columns == FIRST_LEVEL_COLUMNS
