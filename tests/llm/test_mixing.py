import random

from catalog_engine.llm import mixing as M
from tests.llm.conftest import frame, prose


def test_highest_quotients():
    for s in range(500):
        r = random.Random(s)
        v = [r.choice([0, 1, 5, 10, r.random() * 100]) for _ in range(r.randint(0, 8))]
        cap = [r.randint(0, 30) for _ in v]
        n, out = r.randint(0, 60), [0] * len(v)
        for _ in range(n):
            free = [k for k in range(len(v)) if out[k] < cap[k] and v[k] > 0]
            if free:
                out[max(free, key=lambda k: (v[k] / (2 * out[k] + 1), -k))] += 1
        assert M.apportion(v, n, cap) == out


def test_targets_stop_at_three_times_the_size():
    assert M.targets([10, 10, 1000], [5, 2, 1]) == [30.0, 30.0, 960.0]
    assert M.targets([0, 0], [5, 2]) == [0.0, 0.0] and M.targets([], []) == []
    assert M.targets([100, 100, 100], [5, 2, 1]) == [187.5, 75.0, 37.5]


def rows_():
    r = random.Random(4)
    rows = [(k, prose(k, r.randint(0, 300)), r.choice(["b", "b", "b", "a", "é", "", None])) for k in range(3000)]
    return rows + [(None, "x y z", "a"), (1, None, "a"), (2, "dup dup", "zz"), (2, "dup dup", "zz"), (3, "", "only-empty")]


def test_mix(spark):
    rows = rows_()
    out = M.mix(frame(spark, rows)).collect()
    again = M.mix(frame(spark, rows, parts=7)).collect()
    assert sorted(map(repr, out)) == sorted(map(repr, again)) and len(out) == len(rows)
    names = sorted({r[2] for r in rows if r[2] is not None}, key=str.encode) + [None]
    sizes = {n: sum(len((t or "").split()) for _, t, s in rows if s == n) for n in names}
    want = dict(zip(names, M.targets([sizes[n] for n in names], [M.WEIGHTS[k % 3] for k in range(len(names))])))
    for n in names:
        mine = [r for r in out if r.source == n]
        assert {r.source_size for r in mine} == {sizes[n]} and abs(mine[0].target - want[n]) < 1e-6
        assert abs(sum(r.taken for r in mine) - want[n]) <= max(0.02 * want[n], 40)
    assert all(0 <= r.taken <= 3 * r.size and 0 <= r.copies <= 3 for r in out)
    assert M.mix(frame(spark, [])).count() == 0


def test_mixed_documents_repeat_whole_rows(spark):
    rows = rows_()
    docs = frame(spark, rows)
    mixed = M.mixed_documents(docs)
    assert mixed.columns == docs.columns
    got = mixed.groupBy("doc_id", "text").count().collect()
    want = {(r.doc_id, r.text_md5): r.copies for r in M.mix(docs).filter("doc_id not in (1, 2, 3)").collect()}
    import hashlib
    assert {(r.doc_id, hashlib.md5((r.text or "").encode()).hexdigest()): r["count"] for r in got
            if r.doc_id is not None and r.doc_id > 3} == {k: v for k, v in want.items() if v}


def test_a_source_is_spread_over_tasks(spark):
    """Neither the join with the targets nor the running sums are dealt by source alone."""
    import re
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
           if spark.conf.get(k, None) is not None}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = M.mix(frame(spark, rows_()))._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    dealt = [re.findall("([a-z]+)#", x) for x in re.findall(r"hashpartitioning\(([^)]*)\)", plan)]
    wide = [x for x in dealt if x[:2] == ["missing", "name"]]
    assert wide and ["missing", "name", "shard"] in wide and ["missing", "name", "salt"] in wide
    assert sum(x == ["missing", "name"] for x in wide) <= 1  # the shards of a source, counted already


def test_taken_words_by_hand(spark):
    """`taken` of every document from the shards' quotas, block by block."""
    import hashlib
    rows = [(k, prose(k, 3 + 7 * (k % 11)), "ab"[k % 3 == 0]) for k in range(60)]
    out = M.mix(frame(spark, rows)).collect()
    sizes = {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in "ab"}
    goal = M.targets([sizes["a"], sizes["b"]], [5, 2])
    blocks = [-(-sizes[s] // M.BLOCK) for s in "ab"]
    seats = M.apportion(goal, round(sum(goal) / M.BLOCK), [M.MAX_PASSES * b for b in blocks])
    key = spark.createDataFrame([(k, hashlib.md5(t.encode()).hexdigest(), s) for k, t, s in rows], "k long, m string, s string")
    order = {r.k: (r.o, r.k) for r in key.selectExpr("k", f"xxhash64({M.SEED}, k, m) AS o").collect()}
    first = {r.s: r.f for r in spark.createDataFrame([("a",), ("b",)], "s string").selectExpr(
        "s", f"xxhash64({M.SEED + 2}, false, s, 0L) AS f").collect()}
    want = {}
    for n, s in enumerate("ab"):
        passes, rest = divmod(seats[n], blocks[n])
        words = [k for k in sorted((k for k, _, x in rows if x == s), key=order.get) for _ in rows[k][1].split()]
        start = first[s] % blocks[n]
        chosen = {(start + i) % blocks[n] for i in range(rest)}
        for i, k in enumerate(words):
            want[k] = want.get(k, 0) + passes + (i // M.BLOCK in chosen)
    assert {r.doc_id: r.taken for r in out} == want
