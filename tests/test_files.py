import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import files


def _tree(root, n=60, seed=2):
    rng = random.Random(seed)
    want, dirs = {}, set()
    for i in range(n):
        parts = [rng.choice(["a b", "c%20d", "é", "x"]) + str(rng.randrange(3)) for _ in range(rng.randrange(6))]
        d = os.path.join(root, *parts)
        os.makedirs(d, exist_ok=True)
        path = os.path.join(d, f"f {i}.csv")
        text = "".join(rng.choice(["a", "\n", "\r\n", "\r", "é"]) for _ in range(rng.randrange(200)))
        with open(path, "wb") as f:
            f.write(text.encode())
        want[path] = text
        for k in range(1, len(parts) + 1):
            dirs.add(os.path.join(root, *parts[:k]))
    os.makedirs(os.path.join(root, "empty", "deep"))
    return want, dirs | {os.path.join(root, "empty"), os.path.join(root, "empty", "deep")}


def _lines(text):
    return len([x for x in text.replace("\r\n", "\n").replace("\r", "\n").split("\n")[:-1]]) + (not text.endswith(("\n", "\r")) and text != "")


@pytest.mark.parametrize("wanted, wide", [(1, 1000), (3, 1000), (64, 1000), (64, 1)])
def test_every_entry_is_in_one_subtree(tmp_path, monkeypatch, wanted, wide):
    monkeypatch.setattr(files, "WIDE", wide)
    root = str(tmp_path)
    want, dirs = _tree(root)
    reader = files.LandedReader("file://" + root + "/", wanted)
    parts = reader.partitions()
    assert wide > 1 and wanted == 1 or len(parts) > 1
    rows = [r for p in parts for r in reader.read(p)]
    assert sorted(r[0] for r in rows if not r[5]) == sorted(want) and sorted(r[0] for r in rows if r[5]) == sorted(dirs)
    assert all(r[6] == len(os.path.relpath(r[0], root).split("/")) and r[1] == os.path.dirname(r[0]) for r in rows)


def test_data_source_lists_a_tree_and_counts_lines(spark, tmp_path):
    root = str(tmp_path / "t")
    want, dirs = _tree(root)
    found, folders = files.list_tree(spark, root)
    assert {r.path: r.length for r in found.collect()} == {p: len(t.encode()) for p, t in want.items()}
    assert {r.dir for r in folders.collect()} == dirs
    assert {r.path: r.lines for r in files.line_counts(found).collect()} == {p: _lines(t) for p, t in want.items()}
    assert {r.path: r.lines for r in files.lines_up_to(found, 2).collect()} == {p: min(2, _lines(t)) for p, t in want.items()}
    missing, none = files.list_tree(spark, root + "/nowhere")
    assert missing.collect() == [] == none.collect()
    gone = spark.createDataFrame([(root + "/gone.csv",)], "path string")
    assert [tuple(r) for r in files.lines_up_to(gone, 2).collect()] == [(root + "/gone.csv", 0)]


def test_lines_of_chunks_of_any_size():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("ab\n\r") for _ in range(rng.randrange(12))).encode()
        for size in (1, 2, 5):
            chunks = [text[i:i + size] for i in range(0, len(text), size)]
            want = _lines(text.decode())
            assert files.lines_of(chunks) == want, (text, size)
            assert files.lines_of(chunks, 2) == min(want, 2), (text, size)


def test_large_files_are_counted_in_ranges_and_decided_early(spark, tmp_path):
    path = str(tmp_path / "large.csv")
    with open(path, "wb") as f:
        f.write(b"h1;h2\r\n1;2\r\n")
        f.seek(files.RANGE - 1)
        f.write(b"\r\n")                                   # one end, split by two ranges
        f.seek(2 * files.RANGE - 1)
        f.write(b"\nlast")
        f.truncate(1 << 30)
    read = []
    assert files.lines_of(files._chunks(path, read.append), 2) == 2 and sum(read) <= files.CHUNK
    facts = spark.createDataFrame([(path, 1 << 30)], "path string, length long")
    assert files.line_counts(facts).first().lines == 5
    assert files.lines_up_to(facts, 2).first().lines == 2


def test_paths_stay_off_the_driver(spark, tmp_path):
    from ledgerline.operators import control
    facts = spark.createDataFrame([], "path string, dir string, name string, length long, mtime timestamp")
    dirs = spark.createDataFrame([("p", "/x", "CH01")], "pass string, dir string, channel string")
    seen = []

    def counter(paths):
        seen.append(paths.columns)
        return paths.withColumn("lines", F.lit(0).cast("long"))

    control.file_reports(facts, dirs, "2024-01-15", suffix=".csv", excludes=[], not_empty_checked=[], line_counter=counter)
    assert seen == [["path"]]
