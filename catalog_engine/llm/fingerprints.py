"""Document fingerprints: invertible Bloom lookup sketches of paragraphs.

A document is its set of paragraph digests (lines that hold a word; the n-th
repeat of a line has a digest of its own, so repeats count). Each digest is
added to one cell in each of three parts of a small table; a cell holds a
count, the XOR of its digests and the XOR of their check values. Subtracting the sketches of
two versions cancels what they share, and peeling cells of one digest recovers
the digests that differ. Where peeling gets stuck, both sketches are made again
twice as large with other cell hashes. The likeness of two documents is the
share of common digests: |A and B| / |A or B|, from the two sizes and the
recovered difference.

The query that compares a document with an edited version of itself needs the
next document in descending order of ids. Cut points taken from the ids deal
the rows into ranges; the document at each cut also goes to the range above, so
one shuffle of the texts brings every document beside its successor, and no
range needs another.

Defined cases: a null text counts as empty; documents without paragraphs are
alike (1.0) among themselves and 0.0 to any other; null ids come last, rows
with equal ids are ordered by text; a single row is its own successor.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, INT64_MAX, shuffle_partitions

#: Cells of a fingerprint; three parts of equal size.
CELLS = 18
#: Sketches are made larger at most so often before the sets themselves are compared.
RETRIES = 24
PARTS = 3
MASK = (1 << 64) - 1


def digests(text: str | None) -> list[int]:
    """64-bit digests of the paragraphs, one per occurrence."""
    seen: dict[str, int] = {}
    out = []
    for line in (text or "").split("\n"):
        if line.strip(BLANKS):
            n = seen[line] = seen.get(line, -1) + 1
            out.append(xxhash.xxh3_64_intdigest(line.encode(), n))
    return out


def _check(digest: int) -> int:
    return ((digest ^ (digest >> 31)) * 0x9FB21C651E98DF25 & MASK) >> 32


def _places(digest: int, width: int, salt: int) -> tuple[int, int, int]:
    """A cell in each part. Different salts give independent cells."""
    h = ((digest + salt * 0x9E3779B97F4A7C15) * 0xBF58476D1CE4E5B9) & MASK
    h = ((h ^ (h >> 29)) * 0x94D049BB133111EB) & MASK
    return (h >> 43) % width, width + (h >> 22 & 0x1FFFFF) % width, 2 * width + (h & 0x1FFFFF) % width


class Sketch:
    """Cells of (count, XOR of digests, XOR of checks)."""

    def __init__(self, cells: int, salt: int = 0):
        self.width, self.salt = max(1, cells // PARTS), salt
        n = PARTS * self.width
        self.count, self.keys, self.checks = [0] * n, [0] * n, [0] * n

    def add(self, items: list[int], sign: int = 1) -> "Sketch":
        count, keys, checks, width, salt = self.count, self.keys, self.checks, self.width, self.salt
        for d in items:
            c = _check(d)
            for p in _places(d, width, salt):
                count[p] += sign
                keys[p] ^= d
                checks[p] ^= c
        return self

    def minus(self, other: "Sketch") -> "Sketch":
        out = Sketch(PARTS * self.width, self.salt)
        out.count = [a - b for a, b in zip(self.count, other.count)]
        out.keys = [a ^ b for a, b in zip(self.keys, other.keys)]
        out.checks = [a ^ b for a, b in zip(self.checks, other.checks)]
        return out

    def peel(self) -> tuple[list[int], list[int]] | None:
        """Digests only on the left and only on the right; None if some cells
        hold several and no cell holds a single one."""
        count, keys, checks = self.count, self.keys, self.checks
        left, right = [], []
        ready = [p for p, n in enumerate(count) if n in (1, -1)]
        while ready:
            p = ready.pop()
            n, d = count[p], keys[p]
            if n not in (1, -1) or checks[p] != _check(d):
                continue
            where = _places(d, self.width, self.salt)
            if p not in where:
                continue
            (left if n == 1 else right).append(d)
            c = checks[p]
            for q in where:
                count[q] -= n
                keys[q] ^= d
                checks[q] ^= c
                if count[q] in (1, -1):
                    ready.append(q)
        return None if any(count) or any(keys) else (left, right)

    def text(self) -> str:
        return base64.b64encode(b"".join(
            (n & 0xFFFFFFFF).to_bytes(4, "big") + k.to_bytes(8, "big") + c.to_bytes(4, "big")
            for n, k, c in zip(self.count, self.keys, self.checks))).decode()


def from_text(fingerprint: str) -> Sketch:
    raw = base64.b64decode(fingerprint)
    out = Sketch(len(raw) // 16)
    for p in range(len(raw) // 16):
        n = int.from_bytes(raw[16 * p:16 * p + 4], "big")
        out.count[p] = n - (1 << 32) if n >> 31 else n
        out.keys[p] = int.from_bytes(raw[16 * p + 4:16 * p + 12], "big")
        out.checks[p] = int.from_bytes(raw[16 * p + 12:16 * p + 16], "big")
    return out


def difference(a: list[int], b: list[int], left: Sketch, right: Sketch) -> tuple[list[int], list[int]]:
    """The digests that only a and only b have, by subtracting and peeling,
    with larger sketches on failure."""
    found = left.minus(right).peel()
    cells = PARTS * left.width
    if found is None:
        # the part of the cells that did not cancel tells a first larger size
        cells = max(2 * cells, 2 * abs(len(a) - len(b)))
    for salt in range(1, RETRIES + 1):
        if found is not None:
            return found
        found = Sketch(cells, salt).add(a).add(b, -1).peel()
        cells *= 2 if cells < 8 * (len(a) + len(b) + 1) else 1
    if found is None:  # digests that fall together in every size
        return list(set(a) - set(b)), list(set(b) - set(a))
    return found


def likeness(a: list[int], b: list[int], left: Sketch, right: Sketch) -> float:
    if not a and not b:
        return 1.0
    only_a, only_b = difference(a, b, left, right)
    common = len(a) - len(only_a)
    return common / (common + len(only_a) + len(only_b))


def edited(text: str, following: str) -> str:
    """`text` with its last half of code points replaced by the first as many
    of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cells: int = CELLS) -> DataFrame:
    """One row per document: its paragraph digests and its fingerprint."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [digests(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([[d - (1 << 63) for d in x] for x in found], pa.list_(pa.int64())),
                pa.array([Sketch(cells).add(x).text() for x in found])], ["doc_id", "digests", "fingerprint"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
                       ).mapInArrow(rows, "doc_id long, digests array<long>, fingerprint string")


EDITS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
         "near_edited double, near_next double")


_EDITS = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                    ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _cut_points(ids: DataFrame, parts: int) -> list[int]:
    """Ids that occur and split the column into about `parts` ranges, rising;
    bounded by the number of shuffle partitions."""
    rough = sorted({int(q) for q in ids.approxQuantile("doc_id", [k / parts for k in range(1, parts)], 0.2 / parts)})
    if not rough:
        return []
    # quantiles are doubles: take the largest id that occurs up to each
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(np.searchsorted(rough, found)), batch.column(0)],
                                             ["part", "doc_id"])
    tops = ids.mapInArrow(place, "part long, doc_id long").groupBy("part").agg(F.max("doc_id").alias("top")).collect()
    return sorted(r["top"] for r in tops)[:-1]


def _deal(cuts: list[int], top: int | None):
    """Adds part (0 has the largest ids) and helper: copies of the first
    document of a range for the range above, and of the very first for the last."""
    last = len(cuts)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = np.array(cuts, np.int64)
        for batch in batches:
            known = np.array(batch.column(0).is_valid())
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            at = np.searchsorted(bounds, ids)
            part = np.where(known, last - at, last)
            first = known & (at < last) & (bounds[np.minimum(at, last - 1)] == ids) if last else np.zeros(len(ids), bool)
            rows = [(np.arange(len(ids)), part, 0), (np.flatnonzero(first), part[first] - 1, 1)]
            if top is not None:
                rows.append((np.flatnonzero(known & (ids == top)), None, 2))
            for which, parts, helper in rows:
                if len(which):
                    parts = np.full(len(which), last) if parts is None else parts
                    yield pa.RecordBatch.from_arrays([
                        pa.array(parts, pa.int32()), pa.array(np.full(len(which), helper), pa.int32()),
                        *(batch.column(k).take(pa.array(which)) for k in (0, 1))],
                        ["part", "helper", "doc_id", "text"])
    return deal


def _compare(cells: int):
    def compare(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["helper"].to_pylist(), (INT64_MAX if i is None else -i for i in table["doc_id"].to_pylist()),
                          (t or "" for t in table["text"].to_pylist()), table["doc_id"].to_pylist()),
                      key=lambda r: r[:3] + (r[3] is None,))
        own = [r for r in rows if r[0] == 0]
        if not own:
            return _EDITS.empty_table()
        after = next((r for r in rows if r[0]), own[0])
        out: list[tuple] = []
        items = digests(own[0][2])
        sketch = Sketch(cells).add(items)
        for k, (_, _, text, doc_id) in enumerate(own):
            following = (own[k + 1] if k + 1 < len(own) else after)[2]
            next_items = digests(following)
            next_sketch = Sketch(cells).add(next_items)
            new = edited(text, following)
            new_items = digests(new)
            new_sketch = Sketch(cells).add(new_items)
            out.append((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), sketch.text(), new_sketch.text(),
                        likeness(items, new_items, sketch, new_sketch), likeness(items, next_items, sketch, next_sketch)))
            items, sketch = next_items, next_sketch
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _EDITS)], schema=_EDITS)
    return compare


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        cells: int = CELLS) -> DataFrame:
    """One row per document: fingerprints of its text and of its edited text,
    and the likeness of the first to the second and to the next document's."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ids = docs.select("doc_id").na.drop()
    cuts = _cut_points(ids, 4 * shuffle_partitions(docs.sparkSession))
    top = ids.agg(F.max("doc_id")).first()[0]
    dealt = docs.mapInArrow(_deal(cuts, top), "part int, helper int, doc_id long, text string")
    return dealt.groupBy("part").applyInArrow(_compare(cells), EDITS)
