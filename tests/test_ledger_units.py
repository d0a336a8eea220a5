"""Change ledger and packed work units."""

import random
from collections import Counter

from pyspark.sql import functions as F

from cellmend.operators.ledger import new_lines, split_ledger
from cellmend.operators.work_units import CLASSES, best_fit, pack_files
from cellmend.sources.text import read_lines


def test_only_the_tail_of_a_grown_file_is_new(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.minPartitionNum", "32")
    try:
        write = lambda name, n, first="row 0": (tmp_path / name).write_text(
            "".join(f"{first if i == 0 else f'row {i}'}\n" for i in range(n)))
        for name, n in (("same.csv", 40), ("grown.csv", 40), ("changed.csv", 40), ("cut.csv", 40)):
            write(name, n)
        ledger = split_ledger(read_lines(spark, str(tmp_path))).cache()
        assert ledger.groupBy("file_path").count().filter("count > 3").count() == 4
        write("grown.csv", 70)
        write("changed.csv", 40, "other")
        write("cut.csv", 20)
        write("new.csv", 3)
        rows, files = new_lines(read_lines(spark, str(tmp_path)), ledger)
        name = lambda r: r.file_path.split("/")[-1]
        assert {name(r): r.state for r in files.collect()} == {
            "same.csv": "same", "grown.csv": "grown", "changed.csv": "rewritten", "cut.csv": "rewritten", "new.csv": "new"}
        got = Counter(name(r) for r in rows.collect())
        assert got == {"grown.csv": 30, "changed.csv": 40, "cut.csv": 20, "new.csv": 3}
        assert sorted(r.line for r in rows.filter("file_path LIKE '%grown.csv'").collect()) == sorted(
            f"row {i}" for i in range(40, 70))
        ledger.unpersist()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_best_fit_holds_every_item_once():
    rnd = random.Random(3)
    for _ in range(40):
        counts = {rnd.randint(1, 64): rnd.randint(1, 50) for _ in range(rnd.randint(1, 30))}
        units = best_fit(dict(counts), 64)
        assert Counter({k: v for k, v in counts.items()}) == sum(
            (Counter({c: k * n for c, k in Counter(held).items()}) for held, n in units), Counter())
        assert all(sum(held) <= 64 for held, _ in units)
        plain = []  # best fit, one item at a time
        for item in sorted((k for k, n in counts.items() for _ in range(n)), reverse=True):
            at = min((i for i, room in enumerate(plain) if room >= item), key=lambda i: plain[i], default=None)
            if at is None:
                plain.append(64 - item)
            else:
                plain[at] -= item
        assert sum(n for _, n in units) <= 1.02 * len(plain) + 1


def test_units_stay_below_the_limit(spark):
    rnd = random.Random(4)
    files = [(rnd.choice(["csv", "json", None]), f"p{i}", rnd.choice([None, 0, 5, 100, 999, 1000, 1001, 3500, rnd.randint(1, 1000)]))
             for i in range(600)]
    got = pack_files(spark.createDataFrame(files, "file_type string, path string, length long"), 1000).collect()
    sizes, whole = Counter(), Counter()
    for r in got:
        assert 0 <= r.length <= 1000 and r.start % 1000 == 0
        sizes[r.file_type, r.unit] += r.length
        whole[r.path] += r.length
    assert max(sizes.values()) <= 1000
    assert {p: n or 0 for _, p, n in files} == {p: whole[p] for _, p, _ in files}
    for kind in ("csv", "json", None):
        total = sum(n or 0 for k, _, n in files if k == kind)
        units = {u for k, u in sizes if k == kind}
        assert units == set(range(len(units))) and len(units) <= 1.1 * total / 1000 + 600 / CLASSES + 3
    assert pack_files(spark.createDataFrame([], "file_type string, path string, length long")).count() == 0
