"""Near-duplicate documents by ProbMinHash.

A document is a weighted set: its shingles of five consecutive words with their
counts. Each shingle starts a Poisson process of arrivals, seeded by the
shingle's hash, with its count as rate; an arrival picks a register at random
and the earliest arrival of each register leaves the shingle's name there. Two
documents agree in a register with probability J_P, the probability Jaccard
similarity of their normalised weights. A process stops at the first arrival
that is later than every register of its document, so a document costs about
(shingles + registers * ln(registers)) arrivals.

Registers are banded; documents that share a band are candidates. Candidates
whose registers agree as those of a pair at the threshold would, but for four
standard deviations, are verified by their exact J_P on all shingles, and the
classes are the connected components of the verified links (see linking.py). With 45 bands of 7
registers a pair at 0.8 is a candidate with probability 1 - (1 - 0.8^7)^45 =
0.99997 and passes the register test with as much; long bands keep texts that
are merely related (below 0.6) apart, of which a large group of edited copies
holds many.

Copies of a text are one node throughout, so a group of copies costs one row
per task. Defined cases: equal texts share a class, empty ones too; a null text
is a class of its own; fewer than five words are one shingle of all words;
without words there is no link but equality; the class id is the least doc_id
of the class (null if it has none).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Numbers, chunks, cut, forget
from .linking import asked, classes_by_sketch, digest, id_filter, shared_keys, wanted_texts

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 45, 7
REGISTERS = BANDS * ROWS
#: How far below the threshold the registers of a pair that is verified may agree.
DEVIATIONS = 4
#: Parts of a class that are named apart (see near_dedup).
SALTS = 8
_G = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle hash, count) of the different shingles."""
    numbers = Numbers()
    words = [t.encode().split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    ids = np.concatenate([np.fromiter(map(numbers.__getitem__, w), np.int64, len(w)) for w in words]
                         or [np.empty(0, np.int64)])
    if not len(ids):
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, numbers), np.uint64, len(numbers))[ids]
    # short texts are filled up with a word that no text has
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(ids)) - np.repeat(ends - sizes, sizes)
    count = np.where(sizes > 0, np.maximum(1, sizes - SHINGLE + 1), 0)
    first = np.flatnonzero(place < count[owner])
    value = np.zeros(len(first), np.uint64)
    left = sizes[owner[first]] - place[first]
    for k in range(SHINGLE):
        at = np.minimum(first + k, len(hashes) - 1)
        value = value * _G + np.where(k < left, hashes[at], np.uint64(1))
    value, owner = _mixed(value), owner[first]
    _, index, counts = np.unique(value + _mixed(owner.astype(np.uint64) * _G), return_index=True, return_counts=True)
    return owner[index], value[index], counts


def signatures(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Registers (texts x REGISTERS) and whether a text has words."""
    text, name, count = shingles(texts)
    best = np.full(len(texts) * REGISTERS, np.inf)
    left = np.zeros(len(texts) * REGISTERS, np.uint64)
    table, limit = best.reshape(len(texts), REGISTERS), np.full(len(texts), np.inf)
    has = np.zeros(len(texts), bool)
    has[text] = True
    waited, step = np.zeros(len(text)), 0
    while len(text):
        step += 1
        draw = _mixed(name + np.uint64(int(_G) * 2 * step & (1 << 64) - 1))
        waited = waited - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53)
        arrival = waited / count
        slot = text * REGISTERS + (_mixed(draw + _G) % np.uint64(REGISTERS)).astype(np.int64)
        np.minimum.at(best, slot, arrival)
        won = best[slot] == arrival
        left[slot[won]] = name[won]
        live = np.unique(text)
        limit[live] = table[live].max(axis=1)
        more = arrival < limit[text]
        text, name, count, waited = text[more], name[more], count[more], waited[more]
    return left.reshape(len(texts), REGISTERS), has


def band_keys(registers: np.ndarray) -> np.ndarray:
    """A key per text and band."""
    rows = registers.reshape(len(registers), BANDS, ROWS)
    key = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(registers), 1))
    for k in range(ROWS):
        key = _mixed(key * _G + rows[:, :, k])
    return key.view(np.int64)


def probability_jaccard(x: np.ndarray, y: np.ndarray) -> float:
    """J_P of two weight vectors over the same elements: the sum, over elements
    that both have, of 1 / sum(max(x' / x, y' / y)). Elements in order of
    x / y make the inner sums two prefix sums."""
    if not len(x):
        return 0.0
    with np.errstate(divide="ignore"):
        ratio = np.where(y > 0, x / np.where(y > 0, y, 1), np.inf)
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    from_x = np.concatenate([np.cumsum(x[::-1])[::-1], [0.0]])  # x over this and later
    before_y = np.concatenate([[0.0], np.cumsum(y)])
    at = np.searchsorted(ratio, ratio, "left")  # equal ratios fall to x
    both = np.flatnonzero((x > 0) & (y > 0))
    return float(sum(1 / (from_x[at[both]] / x[both] + before_y[at[both]] / y[both]))) if len(both) else 0.0


Weights = tuple[np.ndarray, np.ndarray]


def similarity(a: Weights, b: Weights) -> float:
    """J_P of two (sorted shingle hashes, counts)."""
    at = np.searchsorted(a[0], b[0])
    at[at == len(a[0])] = 0
    shared = np.flatnonzero(a[0][at] == b[0]) if len(a[0]) else np.empty(0, np.int64)
    x, y = a[1][at[shared]], b[1][shared]
    if len(shared) == 0:
        return 0.0
    # elements that one side lacks have no term of their own and add up in the others' sums
    only_a, only_b = a[1].sum() - x.sum(), b[1].sum() - y.sum()
    return probability_jaccard(np.concatenate([x, [only_a, 0.0]]), np.concatenate([y, [0.0, only_b]]))


class _Held(dict):
    """Weights of recent texts, bounded by their total size."""

    def __init__(self, limit: int = 4_000_000):
        super().__init__()
        self.limit, self.size = limit, 0

    def __missing__(self, text: str) -> Weights:
        _, name, count = shingles([text])
        order = np.argsort(name)
        if self.size + len(name) > self.limit:
            self.clear()
            self.size = 0
        self.size += len(name)
        found = self[text] = name[order], count[order].astype(float)
        return found


def _alike(least: float):
    held = _Held()

    def alike(left: list[str], right: list[str]) -> list[bool]:
        return [similarity(held[a], held[b]) >= least for a, b in zip(left, right)]
    return alike


def near_classes(docs: DataFrame, text_col: str = "text", least: float = SIMILARITY) -> DataFrame | None:
    """(node, label): texts, by digest, that are linked to a different text."""
    texts = docs.select(F.col(text_col).cast("string").alias("text")).filter("text is not null")

    def ids_of(found: list[str]) -> np.ndarray:
        return np.fromiter((xxhash.xxh3_64_intdigest(x.encode()) for x in found), np.uint64, len(found)).view(np.int64)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in chunks(batches):
            found = list(dict.fromkeys(cols["text"]))
            registers, has = signatures(found)
            yield pa.RecordBatch.from_arrays([pa.array(band_keys(registers[has]).ravel()),
                                              pa.array(np.repeat(ids_of(found)[has], BANDS))], ["key", "id"])

    members = cut(shared_keys(texts.mapInArrow(keys, "key long, id long")))
    bitmap = id_filter(members.select("id").distinct())

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in chunks(batches):
            found = list(dict.fromkeys(cols["text"]))
            ids = ids_of(found)
            hit = np.flatnonzero(asked(bitmap, ids)).tolist()
            found = [found[k] for k in hit]
            sketches = (signatures(found)[0] & np.uint64(0xFF)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([
                pa.array(ids[hit]), pa.array(list(map(digest, found)), pa.binary()), pa.array(found, pa.string()),
                pa.array([x.tobytes() for x in sketches], pa.binary())], ["id", "node", "text", "sketch"])

    found = wanted_texts(texts.mapInArrow(find, "id long, node binary, text string, sketch binary"), members)
    agreeing = int(REGISTERS * least - DEVIATIONS * (REGISTERS * least * (1 - least)) ** 0.5)
    labels = classes_by_sketch(members, found, agreeing, _alike(least))
    forget(members, found)
    return labels


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               least: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, node (digest of its text), class_id and
    first: whether it is the first document of its class."""
    labels = near_classes(docs, text_col, least)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.unhex(F.md5(F.col(text_col).cast("string").cast("binary"))).alias("node"))
    if labels is not None:
        rows = rows.join(labels, "node", "left").select("doc_id", "node", F.coalesce("label", "node").alias("label"))
    else:
        rows = rows.withColumn("label", F.col("node"))
    # the first: least doc_id (null last), then least digest
    first = (rows.filter("label is not null").groupBy("label")
             .agg(F.min("doc_id").alias("class_id"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node")).alias("f")))
    # one row per class, SALTS times, so that no class's documents are one key
    first = first.select("label", "class_id", F.col("f")["node"].alias("first_node"),
                         F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "node"), F.lit(SALTS)).cast("int"))
    return rows.join(first, ["label", "salt"], "left").select(
        "doc_id", "node",
        F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        (F.col("label").isNull() | (F.col("doc_id").eqNullSafe(F.col("class_id"))
                                    & (F.col("node") == F.col("first_node")))).alias("first"))


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                            least: float = SIMILARITY) -> DataFrame:
    """The first document of each class; of rows that are alike in id and text,
    one. A row with all its columns travels as one value, so no name clashes."""
    stay = near_dedup(docs, id_col, text_col, least).filter("first").select("doc_id", "node").distinct()
    text = F.col(text_col).cast("string")
    found = docs.select(F.col(id_col).cast("long").alias("i"), F.unhex(F.md5(text.cast("binary"))).alias("n"),
                        F.struct("*").alias("row"))
    found = found.join(stay, F.col("i").eqNullSafe(F.col("doc_id")) & F.col("n").eqNullSafe(F.col("node")), "left_semi")
    by = Window.partitionBy("i", "n").orderBy(F.lit(0))
    return (found.withColumn("r", F.row_number().over(by)).filter("r = 1 or n is null")
            .select(*[F.col("row")[c].alias(c) for c in docs.columns]))
