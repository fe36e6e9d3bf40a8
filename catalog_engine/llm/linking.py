"""From shared keys to classes, for operators that compare texts in pairs.

An operator emits (key, id) rows, id being a 64-bit hash of a text, such that
two texts that could be alike share a key. This module finds the keys with
several ids, fetches those texts, compares the members of each key, and returns
the classes: the connected components of all links between texts that share a
key.

The members of a key meet in a task, block by block where they are many, and
every pair of them is compared there by something cheap; no key's pairs become
rows. What leaves a task are verified links that join its members, a spanning
forest, so at most one per member. `classes_in_place` needs one round of that.
Where verifying is dear (`classes_by_sketch`), each member's best partner of
another class in its own blocks comes first, twice, which joins what belongs
together; then every remaining pair between different classes meets, where
members of a key's largest class need not meet each other. No link between
different classes is lost.

Ids that collide only add members: texts are told apart by a 128-bit digest,
and every link is verified on the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROWS_PER_PARTITION, Numbers, cut, forget, packed, release, shuffle_partitions

#: Bits of the filter that spares the texts nobody asks for: a fixed 4 MB,
#: whatever the input; when it fills up, only the sparing suffers.
FILTER_BITS = 1 << 25
#: Members of a key that meet at once in a task; larger groups meet block by block.
BLOCK = 1024
#: Nodes that a task holds while it contracts its links; what one partition's links have at most, if `packed`.
HELD_NODES = 2 * ROWS_PER_PARTITION
#: Narrow rows that a pair of texts to verify counts for.
PAIR_WEIGHT = 100


def digest(text: str) -> bytes:
    return hashlib.md5(text.encode()).digest()


def shared_keys(rows: DataFrame) -> DataFrame:
    """The distinct (key, id) rows of keys that have at least two ids."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if not held:
            return
        key, ids = (np.concatenate(x) for x in zip(*held))
        held.clear()
        order = np.lexsort((ids, key))
        key, ids = key[order], ids[order]
        new_key = np.concatenate([[True], key[1:] != key[:-1]])
        new = new_key.copy()
        new[1:] |= ids[1:] != ids[:-1]
        key, ids, new_key = key[new], ids[new], new_key[new]
        heads = np.flatnonzero(new_key)
        sizes = np.diff(np.append(heads, len(key)))
        several = np.repeat(sizes > 1, sizes)
        yield pa.RecordBatch.from_arrays([pa.array(key[several]), pa.array(ids[several])], ["key", "id"])
        release()

    n = shuffle_partitions(rows.sparkSession)
    return rows.repartition(n, "key").mapInArrow(keep, "key long, id long")


def id_filter(ids: DataFrame) -> np.ndarray:
    """A bitmap of the ids' hashes (FILTER_BITS, so at most 2^19 rows of 64 bits reach the driver)."""
    bit = F.pmod(F.col("id"), F.lit(FILTER_BITS))
    words = (ids.select(F.shiftright(bit, 6).alias("word"), F.expr(f"shiftleft(1L, cast(pmod(id, {FILTER_BITS}) & 63 as int))").alias("bits"))
             .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow())
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out


def asked(bitmap: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which ids may be in the bitmap."""
    bit = ids.astype(np.int64) % FILTER_BITS
    return (bitmap[bit >> 6] >> (bit & 63)) & 1 == 1


def wanted_texts(found: DataFrame, members: DataFrame) -> DataFrame:
    """(id, node, text, ...), one row per text, of the `found` rows whose id is a member."""
    ids = members.select("id").distinct()
    rest = [F.first(c).alias(c) for c in found.columns if c not in ("id", "node")]
    return cut(found.join(ids, "id", "left_semi").groupBy("id", "node").agg(*rest))


def _contracted(links: DataFrame) -> DataFrame:
    """(node, label): each partition's links as stars, every node with the least
    one that it reaches there. A partition's nodes are held up to a bound; then
    its stars so far are sent on, which joins the same nodes as its links do."""
    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near: dict[bytes, bytes] = {}

        def least(x: bytes) -> bytes:
            while near[x] != x:
                near[x] = x = near[near[x]]
            return x

        def stars() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(near), pa.binary()), pa.array(list(map(least, near)), pa.binary())],
                                              ["node", "label"])

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = least(near.setdefault(a, a)), least(near.setdefault(b, b))
                near[max(a, b)] = min(a, b)
            if len(near) > HELD_NODES:
                yield stars()
                near.clear()
        if near:
            yield stars()
        near.clear()
        release()

    return links.mapInArrow(contract, "node binary, label binary")


def _components(links: DataFrame, rows: int) -> DataFrame:
    """(node, label): the least node of each component. Links are contracted
    within their partitions first, which is all where they fill no more than
    one. Then each step names every node after its least neighbour and contracts
    the graph to the names, which at least halves its nodes. `rows` bounds the
    links."""
    stars = cut(_contracted(packed(links.select("a", "b"), rows)))
    if rows <= ROWS_PER_PARTITION:
        return stars
    # a node that is a star's centre only has a row that links it to itself
    edges, names = stars.select(F.col("node").alias("a"), F.col("label").alias("b")), None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = cut(packed(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
                          .select("node", F.least("node", "near").alias("label")), 2 * rows))
        if names is None:
            names = step
        else:
            old = names
            names = cut(packed(old.join(step.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left")
                               .select("node", F.coalesce("to", "label").alias("label")), 2 * rows))
            forget(old)
        ends = step.select(F.col("node").alias("a"), F.col("label").alias("x"))
        rest = cut(packed(edges.join(ends, "a").join(ends.select(F.col("a").alias("b"), F.col("x").alias("y")), "b")
                          .filter("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), rows))
        forget(*([edges] if stars is None else [stars]), *([step] if step is not names else []))
        edges, stars = rest, None
        if edges.isEmpty():
            forget(edges)
            return names


def _merge(labels: DataFrame | None, links: DataFrame, rows: int) -> DataFrame:
    """Labels after more links, of which there are `rows`. Labels are links, too:
    where all of them fill no more than a partition, they are contracted anew."""
    if labels is None:
        return _components(links, rows)
    known = labels.count()
    if known + rows <= ROWS_PER_PARTITION:
        out = _components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionAll(links.select("a", "b")),
                          known + rows)
        forget(labels)
        return out
    a, b = (labels.select(F.col("node").alias(c), F.col("label").alias(f"{c}l")) for c in "ab")
    named = cut(packed(links.join(a, "a", "left").join(b, "b", "left").select(
        F.coalesce("al", "a").alias("a"), F.coalesce("bl", "b").alias("b")).filter("a != b").distinct(), rows))
    if named.isEmpty():
        return labels
    more = _components(named, rows)
    moved = labels.join(more.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left").select(
        "node", F.coalesce("to", "label").alias("label"))
    fresh = more.join(labels.select("node"), "node", "left_anti")
    out = cut(packed(moved.unionAll(fresh), known + 2 * rows))
    forget(labels, named, more)
    return out


def _verified(pairs: DataFrame, texts: DataFrame, alike: Callable[[list[str], list[str]], list[bool]]) -> DataFrame:
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yes = alike(b.column(2).to_pylist(), b.column(3).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(yes, pa.bool_()))

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInArrow(check, "a binary, b binary")


def _groups(members: DataFrame, texts: DataFrame) -> DataFrame:
    """(key, node) of the groups with several nodes; groups of the same nodes are one."""
    rows = members.join(texts.select("id", "node"), "id").select("key", "node").distinct()
    same = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"),
                                   F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y"), F.min("node").alias("m"))
    return cut(rows.join(same.filter("n > 1").groupBy("n", "x", "y", "m").agg(F.min("key").alias("key")).select("key"),
                         "key", "left_semi"))


def _one_row_each(texts: DataFrame) -> DataFrame:
    return cut(texts.drop("id").groupBy("node").agg(*[F.first(c).alias(c) for c in texts.columns if c not in ("id", "node")]))


def _labelled(groups: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return groups.withColumn("label", F.col("node"))
    return groups.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _everywhere(groups: DataFrame, sizes: DataFrame, columns: list[str]) -> DataFrame:
    """Cells in which every two members of a key in `sizes` (key, n) meet."""
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    return (groups.join(sizes.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "key")
            .withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                    "block", "node", *columns))


def _at_home(groups: DataFrame, sizes: DataFrame, columns: list[str]) -> DataFrame:
    """Cells of one block each: a row per member."""
    own = F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / BLOCK)).cast("int")
    return (groups.join(sizes.select("key", "n"), "key").withColumn("block", own)
            .select("key", F.col("block").alias("i"), F.col("block").alias("j"), "block", "node", *columns))


def _across(groups: DataFrame, sizes: DataFrame, columns: list[str]) -> DataFrame:
    """Cells in which every two members of a key with different labels meet.
    Members with the key's most common label have blocks of their own, which
    meet the other blocks and not each other."""
    known = sizes.select("key", F.col("top.label").alias("top"), F.ceil(F.col("top.n") / BLOCK).cast("int").alias("a"),
                         F.ceil((F.col("n") - F.col("top.n")) / BLOCK).cast("int").alias("m"))
    common, spot = F.col("label") == F.col("top"), F.xxhash64("node")
    return (groups.join(known, "key")
            .withColumn("block", F.when(common, F.pmod(spot, F.col("a"))).otherwise(F.col("a") + F.pmod(spot, F.col("m"))).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.when(common, F.col("a")).otherwise(0), F.col("a") + F.col("m") - 1)))
            .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                    "block", "node", *columns))


def _meet(cells: DataFrame, pairs_of: Callable[[int, list[tuple], bool], list[tuple]], *more: tuple[str, str]) -> DataFrame:
    """(a, b) rows, with `more` columns (name, type), that `pairs_of` finds among
    the members that meet in a cell. It gets the key, rows (in first block, node,
    ...) of one block, or of two different ones, and whether they are two."""
    names = ["a", "b", *[n for n, _ in more]]
    kinds = [pa.binary(), pa.binary(), *[pa.type_for_alias({"int": "int32"}.get(t, t)) for _, t in more]]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at, done = [], None, []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in done], t) for k, t in enumerate(kinds)], names)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:3] != at:
                    if len(held) > 1:
                        done += pairs_of(at[0], held, at[1] != at[2])
                        if len(done) > 50_000:
                            yield out()
                            done.clear()
                    held, at = [], row[:3]
                held.append((row[3] == row[1], *row[4:]))
        if len(held) > 1:
            done += pairs_of(at[0], held, at[1] != at[2])
        if done:
            yield out()
        release()

    n = shuffle_partitions(cells.sparkSession)
    return (cells.repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j")
            .mapInArrow(find, ", ".join(["a binary", "b binary", *[f"{n} {t}" for n, t in more]])))


def _ordered(a: bytes, b: bytes) -> tuple[bytes, bytes]:
    return (a, b) if a < b else (b, a)


def _table(sketches: tuple) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), -1)


def _numbered(labels: tuple) -> np.ndarray:
    names = Numbers()
    return np.fromiter(map(names.__getitem__, labels), np.int64, len(labels))


def _sizes(at: DataFrame) -> DataFrame:
    """(key, n, top) of the keys that different labels share; top has the most common label."""
    counts = at.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("key").agg(F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("top"),
                                     F.count(F.lit(1)).alias("labels")).filter("labels > 1")


def _best_pairs(at: DataFrame, texts: DataFrame, least: int) -> DataFrame:
    """(a, b): for each node, of the members with other labels that it meets in
    its blocks, one whose sketch agrees most, in at least `least` places."""
    def pairs_of(key: int, rows: list[tuple], two: bool) -> list[tuple]:
        _, node, label, sketch = zip(*rows)
        table, labels, every, out = _table(sketch), _numbered(label), np.arange(len(rows)), []
        for r in range(len(rows)):
            others = every[labels != labels[r]]
            if len(others):
                agree = (table[others] == table[r]).sum(axis=1)
                k = int(agree.argmax())
                if agree[k] >= least:
                    out.append((node[r], node[others[k]], int(agree[k])))
        return out

    rows = at.join(texts.select("node", "sketch"), "node")
    found = _meet(_at_home(rows, _sizes(at), ["label", "sketch"]), pairs_of, ("agree", "int"))
    best = found.groupBy("a").agg(F.max(F.struct("agree", "b"))["b"].alias("b"))
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _links_across(at: DataFrame, texts: DataFrame, least: int,
                  alike: Callable[[list[str], list[str]], list[bool]]) -> DataFrame:
    """(a, b): links that join all members of a key that are alike and have
    different labels. Every such pair whose sketches agree in at least `least`
    places and that nothing in its cell joins yet is verified there; one that
    shares several keys in the cell of the least of them (`texts` has each
    node's keys; a key that two labels share is compared)."""
    def pairs_of(key: int, rows: list[tuple], two: bool) -> list[tuple]:
        first, node, label, sketch, keys, text = zip(*rows)
        held = [set(np.frombuffer(x, np.int64).tolist()) for x in keys]
        table, root, side, out = _table(sketch), _numbered(label), np.array(first), []
        for r in range(len(rows) - 1):
            apart = root[r + 1:] != root[r]
            if two:
                apart &= side[r + 1:] != side[r]
            others = r + 1 + np.flatnonzero(apart)
            if len(others):
                others = others[(table[others] == table[r]).sum(axis=1) >= least]
            for k in others.tolist():
                if root[k] != root[r] and min(held[r] & held[k]) == key and alike([text[r]], [text[k]])[0]:
                    root[root == root[k]] = root[r]
                    out.append(_ordered(node[r], node[k]))
        return out

    rows = at.join(texts.select("node", "sketch", "keys", "text"), "node")
    return _meet(_across(rows, _sizes(at), ["label", "sketch", "keys", "text"]), pairs_of).distinct()


def classes_by_sketch(members: DataFrame, texts: DataFrame, least: int,
                      alike: Callable[[list[str], list[str]], list[bool]]) -> DataFrame | None:
    """(node, label) of the texts that are linked to another; None if none is.
    `members` are (key, id), `texts` (id, node, text, sketch); sketches, arrays
    of 8-bit numbers as bytes, agree in at least `least` places wherever the
    texts are alike."""
    groups = _groups(members, texts)

    def as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(
                [np.array(x, np.int64).tobytes() for x in b.column(1).to_pylist()], pa.binary())], ["node", "keys"])

    # a node has at most one key per band
    own = groups.groupBy("node").agg(F.collect_set("key").alias("keys")).mapInArrow(as_bytes, "node binary, keys binary")
    each = _one_row_each(texts)
    texts, labels = cut(each.join(own, "node")), None
    forget(each)
    for last in (False, False, True):
        at = _labelled(groups, labels)
        if last:
            links = cut(_links_across(at, texts, least, alike))
        else:
            pairs = cut(_best_pairs(at, texts, least))
            links = cut(_verified(packed(pairs, pairs.count() * PAIR_WEIGHT), texts.select("node", "text"), alike))
            forget(pairs)
        if rows := links.count():
            labels = _merge(labels, links, rows)
        forget(links)
    forget(groups, texts)
    return labels


def classes_in_place(members: DataFrame, texts: DataFrame,
                     linker: Callable[[list[str]], Callable[[int], Iterator[int]]]) -> DataFrame | None:
    """(node, label) of the texts that are linked to another; None if none is.
    `members` are (key, id), `texts` (id, node, text). linker(texts) gives a
    function of a text's number r that yields the numbers it links to among
    those it is asked about: it is called as find(r, numbers)."""
    def pairs_of(key: int, rows: list[tuple], two: bool) -> list[tuple[bytes, bytes]]:
        first, node, text = zip(*rows)
        find, side = linker(list(text)), np.array(first)
        root, out = np.arange(len(rows)), []
        for r in range(len(rows) - 1):
            # only members that are not joined to this one yet
            others = r + 1 + np.flatnonzero(root[r + 1:] != root[r])
            if two:
                others = others[side[others] != side[r]]
            for k in find(r, others) if len(others) else ():
                if root[k] != root[r]:
                    root[root == root[k]] = root[r]
                    out.append(_ordered(node[r], node[k]))
        return out

    groups = _groups(members, texts)
    sizes = groups.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    rows = groups.join(_one_row_each(texts).select("node", "text"), "node")
    links = cut(_meet(_everywhere(rows, sizes, ["text"]), pairs_of).distinct())
    n = links.count()
    return _components(links, n) if n else None
