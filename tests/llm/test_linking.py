import random

import pytest

from catalog_engine.llm import common as C
from catalog_engine.llm import linking as L


def by_hand(pairs):
    label = {x: x for p in pairs for x in p}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def links_of(seed, nodes, n):
    r = random.Random(seed)
    names = [bytes([k >> 8, k & 255, 200]) for k in r.sample(range(60_000), nodes)]
    return [tuple(sorted(r.sample(names, 2))) for _ in range(n)] + [(a, b) for a, b in zip(names[:40], names[1:41])]


def frame(spark, pairs, parts=7):
    return spark.createDataFrame(pairs, "a binary, b binary").repartition(parts)


def jobs(spark, make):
    """What `make` returns, and how many jobs it took."""
    count = lambda: spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
    before = count()
    return make(), count() - before


@pytest.fixture(params=["one partition", "several", "more nodes than a task holds"])
def bounds(request, monkeypatch):
    if request.param != "one partition":
        for module in (C, L):
            monkeypatch.setattr(module, "ROWS_PER_PARTITION", 30)
    if request.param == "more nodes than a task holds":
        monkeypatch.setattr(L, "HELD_NODES", 10)


def test_components_and_merges(spark, bounds):
    for seed in range(2):
        first, second = links_of(seed, 150, 60), links_of(seed + 100, 150, 60)
        second += [(first[0][0], second[0][0]), (first[5][1], second[9][1])]
        labels = L._merge(None, L.cut(frame(spark, first)), len(first))
        assert {bytes(r.node): bytes(r.label) for r in labels.collect()} == by_hand(first)
        labels = L._merge(labels, L.cut(frame(spark, second)), len(second))
        assert {bytes(r.node): bytes(r.label) for r in labels.collect()} == by_hand(first + second)


def test_few_links_take_few_jobs(spark):
    """Every job leaves its stages and tasks in the driver's memory: a chain of
    links, which needs many contractions, takes as many jobs as one link."""
    names = [bytes([k >> 8, k & 255]) for k in range(600)]
    random.Random(1).shuffle(names)
    chain = L.cut(frame(spark, list(zip(names, names[1:]))))
    labels, made = jobs(spark, lambda: L._merge(None, chain, 599))
    assert {bytes(r.label) for r in labels.collect()} == {min(names)} and labels.count() == 600
    assert made <= 3
    more = L.cut(frame(spark, [(b"a", names[9])]))
    labels, made = jobs(spark, lambda: L._merge(labels, more, 1))
    assert {bytes(r.label) for r in labels.collect()} == {min(names)} and labels.count() == 601
    assert made <= 6
