"""Mixing sources to target weights by Sainte-Laguë apportionment.

Sources in code point order (null last) weigh 5, 2, 1, 5, 2, 1, ... and share
all words; no source gets more than three times its own, what it cannot take
goes to the others by weight. The targets are cut into blocks of equal numbers
of words, which go to the sources by the highest quotients target / (2 s + 1),
s being the blocks a source has already; each source's blocks go to its shards
the same way by the shards' sizes. So each shard has a whole quota of blocks:
full passes over the shard, and for the rest a run of its blocks (cyclic, from
a seeded start) in a seeded order of its documents. Only documents at the ends
of that run are taken in part.

A source has a shard for each `SHARD_DOCS` documents, so that a source with a
third of all rows is spread over many shards. The sizes are counted once and
kept as a narrow table; the apportionment sees one row per source, then one
row per shard of a source.

Defined cases: a null text has size 0; documents without words take nothing; a
null source is a source of its own; equal rows are taken alike up to the block
ends; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut, shuffle_partitions

WEIGHTS = (5, 2, 1)
#: Times a source or a document may be taken.
MAX_PASSES = 3
#: Words in a block.
BLOCK = 16
#: Documents in a shard, about.
SHARD_DOCS = 2048
SEED = 20
#: Parts of a source that learn its target apart.
SALTS = 16


def apportion(votes: Sequence[float], seats: int, most: Sequence[int]) -> list[int]:
    """Sainte-Laguë: `seats` to the highest quotients votes / (2 s + 1), at most
    `most` each; equal quotients go to the earlier. A divisor found by bisection
    places all but the last few, which go one by one."""
    v, cap = np.asarray(votes, float), np.asarray(most, np.int64)
    seats = min(int(seats), int(cap[v > 0].sum()) if len(v) else 0)
    if seats <= 0:
        return [0] * len(v)

    def below(divisor: float) -> np.ndarray:  # seats whose quotient is above 2 * divisor
        return np.minimum(np.ceil(v / (2 * divisor) - 0.5).clip(0), cap).astype(np.int64)

    low, high = 0.0, float(v.max()) + 1.0  # too many or enough, too few
    for _ in range(200):
        mid = (low + high) / 2
        if mid in (low, high):
            break
        if below(mid).sum() > seats:
            low = mid
        else:
            high = mid
    given = below(high * (1 + 1e-9))  # equal quotients stay together for the heap
    heap = [(-x / (2 * s + 1), k) for k, (x, s, c) in enumerate(zip(v.tolist(), given.tolist(), cap.tolist()))
            if s < c and x > 0]
    heapq.heapify(heap)
    out = given.tolist()
    for _ in range(seats - int(given.sum())):
        _, k = heapq.heappop(heap)
        out[k] += 1
        if out[k] < cap[k]:
            heapq.heappush(heap, (-v[k] / (2 * out[k] + 1), k))
    return out


def targets(sizes: Sequence[int], weights: Sequence[float], most: int = MAX_PASSES) -> list[float]:
    """Shares of the sum of `sizes` by weight, none above `most` times its size."""
    total, open_ones, out = float(sum(sizes)), set(range(len(sizes))), [0.0] * len(sizes)
    while open_ones:
        share = total / sum(weights[k] for k in open_ones)
        full = [k for k in open_ones if share * weights[k] > most * sizes[k]]
        if not full:
            for k in open_ones:
                out[k] = share * weights[k]
            break
        for k in full:
            out[k] = float(most * sizes[k])
            total -= out[k]
            open_ones.remove(k)
    return out


def _apportion_sources(sources: pd.DataFrame) -> pd.DataFrame:
    s = sources.sort_values(["missing", "name"], key=lambda c: c.map(str.encode) if c.name == "name" else c)
    sizes = [int(x) for x in s["source_size"]]
    goal = targets(sizes, [WEIGHTS[k % len(WEIGHTS)] for k in range(len(s))])
    most = [MAX_PASSES * -(-x // BLOCK) for x in sizes]
    return s.assign(target=goal, blocks=apportion(goal, round(sum(goal) / BLOCK), most))


def _apportion_shards(shards: pd.DataFrame) -> pd.DataFrame:
    s = shards.sort_values("shard")
    most = [MAX_PASSES * -(-int(x) // BLOCK) for x in s["shard_size"]]
    return s.assign(quota=apportion(s["shard_size"].tolist(), int(s["blocks"].iloc[0]), most))[
        ["missing", "name", "shard", "shard_size", "quota"]]


def _overlap(lo, hi) -> F.Column:
    """Words of the document's range [start, start + size) in [lo, hi)."""
    return F.greatest(F.lit(0), F.least(hi, F.col("start") + F.col("size")) - F.greatest(lo, F.col("start")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, text_md5 (identity of its text), source,
    size, source_size, target, passes (whole copies by full passes), part (words
    of the last, partial pass), taken (all words taken) and copies (taken as
    whole documents: the last pass counts if it has half of the words)."""
    sized = cut(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.md5(F.col(text_col).cast("binary")).alias("text_md5"),
        F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    ).withColumns({"missing": F.col("source").isNull(), "name": F.coalesce("source", F.lit(""))}))
    sources = cut(sized.groupBy("missing", "name").agg(F.sum("size").alias("source_size"),
                                                      F.count(F.lit(1)).alias("n_docs"))
                  .groupBy().applyInPandas(
        _apportion_sources, "missing boolean, name string, source_size long, n_docs long, target double, blocks long"))
    order = F.xxhash64(F.lit(seed), "doc_id", "text_md5")
    # a row per source, SALTS times, so that no source's documents are one key
    salted = sources.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    placed = sized.withColumn("salt", F.pmod(F.xxhash64("doc_id", "text_md5"), F.lit(SALTS)).cast("int")).join(
        salted, ["missing", "name", "salt"]).drop("salt").withColumns({
        "order": order, "shard": F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "text_md5"),
                                        F.ceil(F.col("n_docs") / SHARD_DOCS)).cast("long")})
    quotas = (placed.groupBy("missing", "name", "shard").agg(F.sum("size").alias("shard_size"),
                                                             F.first("blocks").alias("blocks"))
              .groupBy("missing", "name").applyInPandas(
        _apportion_shards, "missing boolean, name string, shard long, shard_size long, quota long"))
    w = (Window.partitionBy("missing", "name", "shard").orderBy("order", "doc_id", "text_md5")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    n = F.ceil(F.col("shard_size") / BLOCK)
    placed = placed.repartition(shuffle_partitions(docs.sparkSession), "missing", "name", "shard")  # not by source
    known = placed.withColumn("start", F.sum("size").over(w) - F.col("size")).join(quotas, ["missing", "name", "shard"])
    known = known.withColumns({
        "passes": F.when(n > 0, F.floor(F.col("quota") / n)).otherwise(0),
        "rest": F.when(n > 0, F.col("quota") % n).otherwise(0),
        "from": F.when(n > 0, F.pmod(F.xxhash64(F.lit(seed + 2), "missing", "name", "shard"), n)).otherwise(0)})
    end = F.col("from") + F.col("rest")
    part = (_overlap(F.col("from") * BLOCK, F.least(end, n) * BLOCK)
            + _overlap(F.lit(0), F.greatest(F.lit(0), end - n) * BLOCK))
    return (known.withColumn("part", part.cast("long"))
            .select("doc_id", "text_md5", "source", "size", "source_size", "target",
                    F.col("passes").cast("long").alias("passes"), "part",
                    (F.col("passes") * F.col("size") + F.col("part")).cast("long").alias("taken"),
                    F.when(F.col("size") > 0, F.col("passes") + (F.col("part") * 2 >= F.col("size")).cast("long"))
                     .otherwise(0).cast("long").alias("copies")))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source") -> DataFrame:
    """The documents of the mix, whole, each as often as it is taken. Rows that
    are alike in id and text share their copies evenly, rounded up."""
    taken = (mix(docs, id_col, text_col, source_col).groupBy("doc_id", "text_md5")
             .agg(F.ceil(F.sum("copies") / F.count(F.lit(1))).cast("int").alias("copies")).filter("copies > 0"))
    # a row with all its columns is one value, so no name clashes
    rows = docs.select(F.col(id_col).cast("long").alias("i"), F.md5(F.col(text_col).cast("binary")).alias("m"),
                       F.struct("*").alias("row"))
    joined = rows.join(taken, F.col("i").eqNullSafe(F.col("doc_id")) & F.col("m").eqNullSafe(F.col("text_md5")))
    return joined.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
        *[F.col("row")[c].alias(c) for c in docs.columns])
