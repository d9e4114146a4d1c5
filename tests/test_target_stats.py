"""Ordered target statistics against a plain loop, with a hot and a missing category."""

import hashlib
import random
from collections import defaultdict

from shopflow.operators import target_stats


def test_running_sums_equal_a_loop(spark):
    rnd = random.Random(8)
    rows = [(i, rnd.choice(["hot"] * 6 + [None, "a", "b", ""]), rnd.randint(0, 1), "x") for i in range(1500)]
    df = spark.createDataFrame(rows, "row_id long, cat string, target int, _order string").repartition(5)
    got = {r.row_id: (r.sum_before, r.rows_before) for r in
           target_stats.running_target_sums(df.drop("_order"), "cat").collect()}
    seen = defaultdict(lambda: [0, 0])
    for i, cat, y, _ in sorted(rows, key=lambda r: (hashlib.md5(f"42:{r[0]}".encode()).hexdigest(), r[0])):
        assert got[i] == (seen[cat][0], seen[cat][1])
        seen[cat][0] += y
        seen[cat][1] += 1
    other = spark.createDataFrame([(1, "hot"), (2, None), (3, "new")], "row_id long, cat string")
    train, rest = target_stats.encode_ordered(df.drop("_order"), [other], ["cat"])
    prior = sum(r[2] for r in rows) / len(rows)
    values = {r.row_id: r.cat_target for r in rest.collect()}
    assert abs(values[3] - prior) < 1e-12 and abs(values[1] - (seen["hot"][0] + prior) / (seen["hot"][1] + 1)) < 1e-12
    assert abs(values[2] - (seen[None][0] + prior) / (seen[None][1] + 1)) < 1e-12
    assert train.count() == 1500 and train.columns[-1] == "cat_target"
    assert target_stats.running_target_sums(df.drop("_order").limit(0), "cat").count() == 0
