import itertools
import random
import re

from ledgerline.llm import decontamination as dc

KIND = "doc_id long, text string, words string, seed int, item_id int"


def tokens(text):
    return [t for t in re.split(dc.SEPARATORS, (text or "").lower()) if t]


def brute(text, item):
    d, t = tokens(text), tokens(item)
    if len(t) < dc.SPAN or len(d) < dc.SPAN:
        return False
    w = min(dc.WINDOW, len(t))
    for o in range(-len(t), len(d)):
        same = [0 <= o + x < len(d) and d[o + x] == t[x] for x in range(len(t))]
        if any(sum(same[s:s + w]) * dc.WINDOW >= dc.NEED * w for s in range(len(t) - w + 1)):
            return True
    return False


def test_masks_find_every_window_with_three_substitutions():
    for lost in itertools.combinations(range(dc.WINDOW), dc.WINDOW - dc.NEED):
        assert any(not {p + x for x in mask} & set(lost)
                   for mask in dc.MASKS for p in range(dc.WINDOW - dc.SPAN + 1)), lost


def test_masks_find_every_item_shorter_than_a_window():
    for size in range(dc.SPAN, dc.WINDOW + 1):
        most = size - -(-dc.NEED * size // dc.WINDOW)
        for lost in itertools.combinations(range(size), most):
            assert any(not {p + x for x in mask} & set(lost)
                       for mask in dc.masks(size) for p in range(size - mask[-1])), (size, lost)


def test_short_items_equal_brute_force(spark, monkeypatch):
    items, docs = [[f"i{n}t{x}" for x in range(n)] for n in range(dc.SPAN, dc.WINDOW)], []
    for item in items:
        for k in (1, 2, 3):
            for lost in itertools.combinations(range(len(item)), k):
                leak = ["zz" if x in lost else w for x, w in enumerate(item)]
                docs.append(" ".join(["aa", "bb", *leak, "cc"]))
        docs += [" ".join([*item[1:], "cc", "dd"]), " ".join(["cc", "dd", *item[:-1]]), " ".join(item[1:-1]),
                 " ".join(item[2:] + ["ee", "ff"])]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(item)) for k, item in enumerate(items)], "item_id long, text string")
    want = {i: [k for k, item in enumerate(items) if brute(t, " ".join(item))] for i, t in enumerate(docs)}
    for bound in (dc.BROADCAST_ROWS, -1):
        monkeypatch.setattr(dc, "BROADCAST_ROWS", bound)
        assert {r.doc_id: r["items"] for r in dc.contaminated(frame, bench).collect()} == want


def data(seed=1):
    rng = random.Random(seed)
    common = ["the", "of", "and", "to"] + [f"v{i}" for i in range(60)]
    items = [" ".join(rng.choice(common) for _ in range(rng.randint(7, 40))) for _ in range(25)]
    docs = []
    for i in range(150):
        words = [rng.choice(common) for _ in range(rng.randint(0, 80))]
        if rng.random() < 0.6:
            leak = rng.choice(items).split()
            a = rng.randint(0, max(0, len(leak) - 13))
            leak = leak[a:a + rng.randint(13, 40)]
            for _ in range(rng.randint(0, 5)):
                leak[rng.randrange(len(leak))] = "zz"
            leak = [x.title() + rng.choice(["", ",", "."]) for x in leak]
            at = rng.randint(0, len(words))
            words[at:at] = leak
        docs.append((i, " ".join(words)))
    return docs, items


def test_overlaps_equal_brute_force(spark, monkeypatch):
    docs, items = data()
    frame = spark.createDataFrame([(i, t, "w", 1, 2) for i, t in docs], KIND)
    bench = spark.createDataFrame(list(enumerate(items)) + [(90, None), (91, ""), (92, "too short")],
                                  "item_id long, text string")
    want = {i: [k for k, item in enumerate(items) if len(tokens(item)) >= dc.WINDOW and brute(t, item)]
            for i, t in docs}
    long = [k for k, item in enumerate(items) if len(tokens(item)) >= dc.WINDOW]
    for bound in (dc.BROADCAST_ROWS, -1):
        monkeypatch.setattr(dc, "BROADCAST_ROWS", bound)
        got = {r.doc_id: r for r in dc.contaminated(frame, bench).collect()}
        assert len(got) == len(docs)
        for i, _ in docs:
            assert [k for k in got[i]["items"] if k in long] == want[i], i
            assert got[i].contaminated == (got[i].n_items > 0) and got[i].n_items == len(got[i]["items"])
            # items shorter than a window: what is found is there
            assert all(brute(dict(docs)[i], items[k]) for k in got[i]["items"])
    assert sum(map(bool, want.values())) > 30


def test_edges(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"
    rows = [(1, item, "w", 1, 1), (1, item, "w", 1, 1), (1, "clean text", "w", 2, 2), (None, item.upper(), "w", 3, 3),
            (None, "clean", "w", 4, 4), (4, None, "w", 5, 5), (5, "", "w", 6, 6), (6, "alpha beta", "w", 7, 7)]
    docs = spark.createDataFrame(rows, KIND)
    bench = spark.createDataFrame([(0, item)], "item_id long, text string")
    assert sorted((r.doc_id or 0, r.contaminated) for r in dc.contaminated(docs, bench).collect()) == [
        (0, False), (0, True), (1, False), (1, True), (1, True), (4, False), (5, False), (6, False)]
    left = dc.decontaminated(docs, bench)
    assert left.columns == docs.columns and sorted(r.seed for r in left.collect()) == [2, 4, 5, 6, 7]
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.decontaminated(docs, none).count() == 8
    assert dc.contaminated(spark.createDataFrame([], KIND), bench).count() == 0


def test_main_path_is_native(spark):
    docs, items = data(2)
    df = dc.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                         spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
