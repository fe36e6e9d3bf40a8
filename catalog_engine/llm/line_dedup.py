"""Line dedup by a segment-partition edit join.

Two lines within `tau` edits (insertions, deletions, substitutions of code
points): when the shorter is cut into tau + 1 segments, one of them occurs
unchanged in the other, at a place that the segment's number and the two
lengths bound to a few positions. Every line gives a key for each of its
segments (length, number, content) and for each substring that could match a
segment of a line up to tau shorter; lines that share a key are compared by a
banded bit-parallel edit distance after their common ends are trimmed.

Lines that are linked, directly or by others, form a class (exact repeats are
the simplest case). The first line of a class, by doc_id and place, stays; the
others go. Lines of fewer than `min_chars` code points take no part in the edit
join; with `every_repeat`, exact repeats of those that hold a word go as well,
else they always stay.

Where a key has many lines, each meets the others in blocks; the counts of code
points, which an edit changes by two at most, leave few pairs to the distance.

Each distinct line of a chunk of documents gives its keys once, so a line that
millions of documents share is a handful of rows per task. The rows (key, line
hash) are the only large shuffle besides the documents' own. Lines are counted
before they meet the first of their class; the few too common for one task (at
most two per task, whatever the data) are salted.

Defined cases: a null text has no lines and stays null; text without line
breaks is one line; rows alike in id and text count as one document; a null
doc_id comes after every other; when all lines go the text is ''. Other
columns pass through `deduplicated` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, INT64_MAX, chunks, cut, forget, shuffle_partitions
from .linking import asked, classes_in_place, digest, id_filter, shared_keys, wanted_texts

TAU = 2
MIN_CHARS = 24
#: Bins of code points by which lines are compared first.
BINS = 61
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _segment(length: np.ndarray, i: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of segment i (0-based) of lines of this length: the last
    `length % parts` segments have a character more."""
    size, longer = length // parts, length % parts
    extra = np.maximum(0, i - (parts - longer))
    return i * size + extra, size + (i >= parts - longer)


def line_keys(lines: list[str], tau: int) -> tuple[np.ndarray, np.ndarray]:
    """(line number, key) rows: a line's segments and the substrings that may
    equal a segment of a line of the same length or up to tau shorter."""
    parts = tau + 1
    sizes = np.array([len(x) for x in lines], np.int64)
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(points)) - np.repeat(starts, sizes)
    longest = int(sizes.max()) + 1
    up, down = _powers(_BASE, longest), _powers(_INVERSE, longest)
    sums = np.concatenate([np.zeros(1, np.uint64),
                           np.cumsum(_mixed(points.astype(np.uint64) + np.uint64(1)) * up[place], dtype=np.uint64)])
    numbers, keys = [], []
    for less in range(tau + 1):
        length = sizes - less
        for i in range(parts):
            begin, size = _segment(length, i, parts)
            # edits before the segment, and after it, bound how far it may shift
            low, high = max(-i, less - (tau - i)), min(i, less + (tau - i))
            for shift in range(low, high + 1):
                at = begin + shift
                ok = np.flatnonzero((size > 0) & (at >= 0) & (at + size <= sizes))
                a, s, n = at[ok], starts[ok], size[ok]
                content = (sums[s + a + n] - sums[s + a]) * down[a]
                keys.append(_mixed(content + _mixed(length[ok].astype(np.uint64) * np.uint64(64) + np.uint64(i))))
                numbers.append(ok)
    return np.concatenate(numbers), np.concatenate(keys).view(np.int64)


def line_links(tau: int):
    """For linking.classes_in_place: which lines are within tau of a line."""
    def linker(lines: list[str]):
        bags = np.zeros((len(lines), BINS), np.int32)
        if len(lines) > 8:
            for k, x in enumerate(lines):
                bags[k] = np.bincount(np.frombuffer(x.encode("utf-32-le", "surrogatepass"), np.uint32) % BINS,
                                      minlength=BINS)

        def find(r: int, others: np.ndarray) -> Iterator[int]:
            near = others[np.abs(bags[others] - bags[r]).sum(axis=1) <= 2 * tau]
            return (k for k in near.tolist() if within(lines[r], lines[k], tau))
        return find
    return linker


def within(a: str, b: str, tau: int) -> bool:
    """Whether the edit distance is at most tau: common ends are trimmed, then
    the columns of the dynamic programme advance as bit vectors over the band of
    2 tau + 1 diagonals; the cell on the last diagonal only ever grows."""
    if a == b:
        return True
    if len(a) < len(b):
        a, b = b, a
    more = len(a) - len(b)
    if more > tau:
        return False
    lo, hi = 0, len(b)
    while lo < hi:  # longest common prefix, by halves
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    a, b = a[lo:], b[lo:]
    lo, hi = 0, len(b)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[len(a) - mid:len(a) - lo] == b[len(b) - mid:len(b) - lo]:
            lo = mid
        else:
            hi = mid - 1
    a, b = a[:len(a) - lo], b[:len(b) - lo]
    if not b:
        return len(a) <= tau
    where: dict[str, int] = {}
    for k, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << k
    band = (1 << 2 * tau + 1) - 1
    # bit k of a column j stands for row j - tau + k; rows below 1 hold no step
    up, down = band >> tau << tau, 0
    score = more
    for j, c in enumerate(b, 1):
        first = j - tau - 1
        match = where.get(c, 0)
        match = (match >> first if first >= 0 else match << -first) & band
        level = ((((match & up) + up) ^ up) | match | down) & band
        right_up, right_down = (down | ~(level | up)) & band, level & up
        score += 1 - (level >> more + tau & 1)
        if score > tau:
            return False
        up = (right_down << 1 | ~(level | right_up << 1)) & band
        down = level & right_up << 1 & band
        up, down = up >> 1 | 1 << 2 * tau, down >> 1
    return True


def _lines(text: str | None) -> list[str]:
    return text.split("\n") if text is not None else []


def _row_key(id_col: str, text_col: str) -> Column:
    return F.unhex(F.md5(F.concat_ws(" ", F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("-")),
                                     F.col(text_col).cast("string")).cast("binary")))


def _ids(lines: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(x.encode()) for x in lines), np.uint64, len(lines)).view(np.int64)


def line_classes(docs: DataFrame, text_col: str = "text", tau: int = TAU, min_chars: int = MIN_CHARS) -> DataFrame | None:
    """(node, label) of the distinct lines that are linked to a different line."""
    if min_chars <= tau:
        raise ValueError("min_chars must exceed tau: shorter lines cannot be cut into tau + 1 segments")
    texts = docs.select(F.col(text_col).cast("string").alias("text")).filter("text is not null")

    def different(cols: dict[str, list]) -> list[str]:
        return list({x for t in cols["text"] for x in t.split("\n") if len(x) >= min_chars})

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in chunks(batches):
            lines = different(cols)
            if lines:
                number, key = line_keys(lines, tau)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(_ids(lines)[number])], ["key", "id"])

    members = shared_keys(texts.mapInArrow(keys, "key long, id long"))
    members = cut(members)
    bitmap = id_filter(members.select("id").distinct())

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in chunks(batches):
            lines = different(cols)
            ids = _ids(lines)
            hit = np.flatnonzero(asked(bitmap, ids)).tolist()
            yield pa.RecordBatch.from_arrays([
                pa.array(ids[hit]), pa.array([digest(lines[k]) for k in hit], pa.binary()),
                pa.array([lines[k] for k in hit], pa.string())], ["id", "node", "text"])

    found = wanted_texts(texts.mapInArrow(find, "id long, node binary, text string"), members)
    return classes_in_place(members, found, line_links(tau))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, tau: int = TAU,
               min_chars: int = MIN_CHARS, every_repeat: bool = False) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, dropped (numbers of the
    lines that go, from 0) and kept_text."""
    return _cleaned(docs, id_col, text_col, tau, min_chars, every_repeat, [])


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, tau: int = TAU,
                 min_chars: int = MIN_CHARS, every_repeat: bool = False) -> DataFrame:
    """The documents with the dropped lines taken out of the text."""
    keep = [c for c in docs.columns if c != text_col]
    out = _cleaned(docs, id_col, text_col, tau, min_chars, every_repeat, keep)
    return out.select(*[F.col("row")[c].alias(c) if c != text_col else F.col("kept_text").alias(c) for c in docs.columns])


def _firsts(lines: DataFrame, labels: DataFrame | None, place: Column) -> DataFrame:
    """(node, first, n) of the lines whose class has more than one occurrence:
    where the class comes first and how often the line itself occurs. Lines are
    grouped by themselves before their classes are looked up, so a common line
    is one row in every join here."""
    nodes = lines.groupBy("node").agg(F.min(place).alias("first"), F.max(place).alias("last"),
                                      F.count(F.lit(1)).alias("n"))
    if labels is None:
        return cut(nodes.filter("first != last").select("node", "first", "n"))
    linked = cut(nodes.join(labels, "node"))  # a class has two different lines at least
    alone = nodes.join(labels, "node", "left_anti").filter("first != last").select("node", "first", "n")
    of_class = _meeting(linked.drop("first", "last"), linked.groupBy("label").agg(
        F.min("first").alias("first"), F.count(F.lit(1)).alias("rows")), "label", linked.count())
    firsts = cut(alone.unionByName(of_class.select("node", "first", "n")))
    forget(linked)
    return firsts


def _meeting(rows: DataFrame, values: DataFrame, key: str, total: int) -> DataFrame:
    """rows with the `first` of their key, from values (key, first, rows: how
    many of the `total` rows have it). A key with more rows than half a task's
    share is dealt over as many salts as it has such halves (in powers of two);
    there are at most two such keys a task, and only their names reach the driver."""
    share = max(1, total // (2 * shuffle_partitions(rows.sparkSession)))
    salts: dict[int, list] = {}
    for name, n in values.filter(F.col("rows") > share).select(key, "rows").collect():
        salts.setdefault(1 << (-(-n // share) - 1).bit_length(), []).append(name)
    dealt, copies = F.lit(0), F.array(F.lit(0))
    for n, names in salts.items():
        hot = F.col(key).isin(names)
        dealt = F.when(hot, F.pmod(F.xxhash64(*rows.columns), F.lit(n)).cast("int")).otherwise(dealt)
        copies = F.when(hot, F.sequence(F.lit(0), F.lit(n - 1))).otherwise(copies)
    return rows.withColumn("salt", dealt).join(
        values.select(key, "first", F.explode(copies).alias("salt")), [key, "salt"]).drop("salt")


def _dropped(lines: DataFrame, firsts: DataFrame, place: Column) -> DataFrame:
    """doc and the numbers of its lines that are not the first of their class."""
    met = _meeting(lines, firsts.withColumnRenamed("n", "rows"), "node", lines.count())
    return met.filter(place != F.col("first")).groupBy("doc").agg(F.sort_array(F.collect_set("n")).alias("dropped"))


def _cleaned(docs: DataFrame, id_col: str, text_col: str, tau: int, min_chars: int, every_repeat: bool,
             carry: list[str]) -> DataFrame:
    labels = line_classes(docs, text_col, tau, min_chars)
    base = docs.select(_row_key(id_col, text_col).alias("doc"), F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"),
                       (F.struct(*carry) if carry else F.lit(None).cast("string")).alias("row"))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in chunks(batches):
            rows = [(doc, INT64_MAX if i is None else i, n, digest(x))
                    for doc, i, t in zip(cols["doc"], cols["doc_id"], cols["text"])
                    for n, x in enumerate(_lines(t)) if len(x) >= min_chars or every_repeat and x.strip(BLANKS)]
            doc, doc_id, n, node = zip(*rows) if rows else ([], [], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.binary()), pa.array(doc_id, pa.int64()),
                                              pa.array(n, pa.int32()), pa.array(node, pa.binary())],
                                             ["doc", "doc_id", "n", "node"])

    lines = cut(base.select("doc", "doc_id", "text").mapInArrow(spread, "doc binary, doc_id long, n int, node binary"))
    place = F.struct("doc_id", "doc", "n")  # rows that share a doc_id follow by their text's key
    dropped = _dropped(lines, _firsts(lines, labels, place), place)

    def take_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, drops = b.column(1).to_pylist(), b.column(2).to_pylist()
            kept, n_lines = [], []
            for t, d in zip(texts, drops):
                split = _lines(t)
                n_lines.append(len(split))
                gone = set(d or ())
                kept.append(t if not gone else "\n".join(x for k, x in enumerate(split) if k not in gone))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_lines, pa.int64()), pa.array([len(d or ()) for d in drops], pa.int64()),
                 pa.array([d or [] for d in drops], pa.list_(pa.int32())), pa.array(kept, pa.string()), b.column(3)],
                ["doc_id", "n_lines", "n_dropped", "dropped", "kept_text", "row"])

    row = base.schema["row"].dataType.simpleString()
    return (base.join(dropped, "doc", "left").select("doc_id", "text", "dropped", "row")
            .mapInArrow(take_out, "doc_id long, n_lines long, n_dropped long, dropped array<int>, kept_text string, "
                        f"row {row}"))
