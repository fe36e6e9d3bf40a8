"""Substring dedup by super-k-mer partitioning.

A window is k consecutive words of one document. The minimiser of a window is
the least hash of its m-word pieces; consecutive windows with the same
minimiser form a super-k-mer, whose words travel once, as one packed string, to
the bucket that the minimiser names. Equal windows have equal minimisers, so a
bucket sees every occurrence of its windows. There the windows are sorted (by a
64-bit hash; neighbours in that order are then compared by their words, and a
bucket in which two different windows share a hash is sorted by the words
themselves), and each run of equal windows yields the smallest document
that has it.

Documents are dealt over units by the hash of the row. A unit sends each
different super-k-mer once, with the smallest and largest document in it, so a
passage that a third of all documents share costs a bucket one string per unit.
The answers (smallest document per window, only for super-k-mers in which some
occurrence must go) return to the units, which find their super-k-mers again
and drop the covered words. Windows are judged on the input, not on what is
left.

Defined cases: a null text has no words; documents of fewer than k words keep
all; rows with the same doc_id do not remove each other's words; a null doc_id
counts as larger than every other. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import INT64_MAX, UNITS, in_units, shuffle_partitions

WINDOW = 13
#: Words of the pieces among which a window's minimiser is chosen.
PIECE = 3
#: Longest super-k-mer, in windows (a longer run is cut).
MAX_RUN = 4096

SENT = "bucket int, unit int, packed binary"
ANSWER = "unit int, answers binary"
RESULT = ("doc_id long, n_words long, n_removed long, removed array<struct<start:int,end:int>>, kept_text string")
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                     ("removed", _SPANS), ("kept_text", pa.string())])


#: Bytes of text that are hashed at a time.
SLICE = 1 << 20
_TABLE = np.random.default_rng(13).integers(1, 1 << 63, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        x = np.full(size, base, np.uint64)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    return out[0], out[1]


class Slice(NamedTuple):
    """Some strings of words (one blank between), joined by line breaks: the
    bytes, per word its start, end and string, and prefix sums of the bytes."""
    text: bytes
    starts: np.ndarray
    ends: np.ndarray
    string: np.ndarray
    sums: np.ndarray
    down: np.ndarray

    def spans(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hashes of the bytes from word a to word b."""
        lo = self.starts[a]
        return _mixed((self.sums[self.ends[b]] - self.sums[lo]) * self.down[lo])


def slices(strings: list[bytes]) -> Iterator[Slice]:
    """Strings without words are passed over."""
    which, held = [], 0
    for n, s in enumerate(strings):
        if s:
            which.append(n)
            held += len(s) + 1
        if which and (held >= SLICE or n == len(strings) - 1):
            yield _sliced(b"\n".join([strings[k] for k in which]) + b"\n", which)
            which, held = [], 0
    if which:
        yield _sliced(b"\n".join([strings[k] for k in which]) + b"\n", which)


def _sliced(text: bytes, which: list[int]) -> Slice:
    raw = np.frombuffer(text, np.uint8)
    ends = np.flatnonzero((raw == 32) | (raw == 10))
    up, down = _powers(1 << max(20, len(raw).bit_length()))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_TABLE[raw] * up[:len(raw)], out=sums[1:])
    last = raw[ends] == 10
    string = np.array(which)[np.cumsum(last) - last]
    return Slice(text, np.concatenate([[0], ends[:-1] + 1]), ends, string, sums, down)


def _least_of(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each `size` consecutive values, by doubling."""
    have, out = 1, values
    while have < size:
        step = min(have, size - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def _windows(part: Slice, k: int) -> np.ndarray:
    """First words of the windows: k words of one string."""
    n = len(part.ends) - k + 1
    return np.flatnonzero(part.string[:n] == part.string[k - 1:]) if n > 0 else np.empty(0, np.int64)


def super_kmers(strings: list[bytes], k: int) -> Iterator[tuple[int, int, int, int, bytes]]:
    """(string, first window, windows, minimiser, text) of every super-k-mer."""
    piece = min(PIECE, k)
    for part in slices(strings):
        at = _windows(part, k)
        if not len(at):
            continue
        word = np.arange(len(part.ends) - piece + 1)
        least = _least_of(part.spans(word, word + piece - 1), k - piece + 1)[at]
        string = part.string[at]
        breaks = np.ones(len(at), bool)
        breaks[1:] = (least[1:] != least[:-1]) | (string[1:] != string[:-1])
        run = np.flatnonzero(breaks)
        breaks |= (np.arange(len(at)) - run[np.cumsum(breaks) - 1]) % MAX_RUN == 0
        heads = np.flatnonzero(breaks)
        counts = np.diff(np.append(heads, len(at)))
        first = at[heads]
        new = np.ones(len(part.string), bool)
        new[1:] = part.string[1:] != part.string[:-1]
        origin = np.flatnonzero(new)[np.cumsum(new) - 1][first]
        for s, w, n, m, lo, hi in zip(string[heads].tolist(), (first - origin).tolist(), counts.tolist(),
                                      least[heads].tolist(), part.starts[first].tolist(),
                                      part.ends[first + counts + k - 2].tolist()):
            yield s, w, n, m, part.text[lo:hi]


def _unit_texts(table: pa.Table) -> tuple[list, list[bytes]]:
    """Ids, and texts with one blank between words."""
    return table["doc_id"].to_pylist(), [b" ".join(t.encode().split()) if t else b"" for t in table["text"].to_pylist()]


def _pack(strings: list[bytes], *numbers: np.ndarray) -> bytes:
    body = b"\n".join(strings)
    return zstandard.ZstdCompressor(level=1).compress(
        np.array([len(strings), *map(len, numbers)], np.int64).tobytes() + b"".join(x.tobytes() for x in numbers) + body)


def _unpack(packed: bytes, n_arrays: int) -> tuple[list[bytes], list[np.ndarray]]:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    sizes = np.frombuffer(raw, np.int64, 1 + n_arrays)
    at, arrays = 8 * (1 + n_arrays), []
    for n in sizes[1:].tolist():
        arrays.append(np.frombuffer(raw, np.int64, n, at))
        at += 8 * n
    return (raw[at:].split(b"\n") if sizes[0] else []), arrays


def _send(k: int, buckets: int):
    def send(table: pa.Table) -> pa.Table:
        ids, strings = _unit_texts(table)
        unit = table["unit"][0].as_py()
        found: dict[bytes, list[int]] = {}  # super-k-mer: bucket, smallest and largest document
        for t, _, _, least, text in super_kmers(strings, k):
            doc = INT64_MAX if ids[t] is None else ids[t]
            seen = found.get(text)
            if seen is None:
                found[text] = [least % buckets, doc, doc]
            elif doc < seen[1]:
                seen[1] = doc
            elif doc > seen[2]:
                seen[2] = doc
        by_bucket: dict[int, list] = {}
        for text, (bucket, low, high) in found.items():
            by_bucket.setdefault(bucket, []).append((text, low, high))
        packed = [_pack([x[0] for x in v], np.array([x[1] for x in v], np.int64), np.array([x[2] for x in v], np.int64))
                  for v in by_bucket.values()]
        return pa.table({"bucket": pa.array(list(by_bucket), pa.int32()),
                         "unit": pa.array([unit] * len(packed), pa.int32()), "packed": pa.array(packed, pa.binary())})
    return send


def smallest_documents(text: bytes, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray,
                       low: np.ndarray) -> np.ndarray:
    """For each window text[start:end], the smallest `low` among equal windows."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    alike = np.flatnonzero(ranked[1:] == ranked[:-1])
    spans = list(zip(starts[order].tolist(), ends[order].tolist()))
    same = np.zeros(len(order) - 1, bool)
    same[alike] = True
    for p in alike.tolist():
        (a, b), (c, d) = spans[p], spans[p + 1]
        if text[a:b] != text[c:d]:  # different windows share a hash: sort by the words
            order = np.array(sorted(range(len(starts)), key=lambda j: text[starts[j]:ends[j]]))
            spans = [text[a:b] for a, b in zip(starts[order].tolist(), ends[order].tolist())]
            same = np.array([x == y for x, y in zip(spans[1:], spans)], bool)
            break
    heads = np.flatnonzero(np.concatenate([[True], ~same]))
    least = np.minimum.reduceat(low[order], heads)
    out = np.empty(len(starts), np.int64)
    out[order] = np.repeat(least, np.diff(np.append(heads, len(order))))
    return out


def _sort_bucket(k: int):
    def sort(table: pa.Table) -> pa.Table:
        units, strings, lows, highs = [], [], [], []
        for unit, packed in zip(table["unit"].to_pylist(), table["packed"].to_pylist()):
            texts, (low, high) = _unpack(packed, 2)
            units += [unit] * len(texts)
            strings += texts
            lows.append(low)
            highs.append(high)
        low, high = np.concatenate(lows), np.concatenate(highs)
        found, base = [], 0
        for part in slices(strings):
            at = _windows(part, k)
            found.append((part.starts[at] + base, part.ends[at + k - 1] + base, part.spans(at, at + k - 1), part.string[at]))
            base += len(part.text)
        starts, ends_, hashes, owner = (np.concatenate(x) for x in zip(*found))
        least = smallest_documents(b"\n".join(strings), starts, ends_, hashes, low[owner])
        counts = np.bincount(owner, minlength=len(strings))
        ends = np.cumsum(counts)
        shared = np.logical_or.reduceat(least < high[owner], ends - counts)
        answers: dict[int, list[int]] = {}
        for s in np.flatnonzero(shared).tolist():
            answers.setdefault(units[s], []).append(s)
        out = []
        for which in answers.values():
            keys = np.frombuffer(b"".join(xxhash.xxh3_128_digest(strings[s]) for s in which), np.int64)
            values = np.concatenate([least[ends[s] - counts[s]:ends[s]] for s in which])
            out.append(_pack([], keys, counts[which], values))
        return pa.table({"unit": pa.array(list(answers), pa.int32()), "answers": pa.array(out, pa.binary())})
    return sort


def _drop_words(k: int):
    def drop(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _RESULT.empty_table()
        ids, strings = _unit_texts(docs)
        least: dict[bytes, np.ndarray] = {}  # by digest of the super-k-mer
        for packed in answers["answers"].to_pylist() if answers.num_rows else []:
            _, (keys, counts, values) = _unpack(packed, 3)
            raw, ends = keys.tobytes(), np.cumsum(counts)
            for s, (lo, hi) in enumerate(zip((ends - counts).tolist(), ends.tolist())):
                least[raw[16 * s:16 * s + 16]] = values[lo:hi]
        gone: dict[int, list[int]] = {}
        for t, w, _, _, text in super_kmers(strings, k) if least else ():
            found = least.get(xxhash.xxh3_128_digest(text))
            if found is not None:
                hits = np.flatnonzero(found < (INT64_MAX if ids[t] is None else ids[t]))
                if len(hits):
                    gone.setdefault(t, []).extend((hits + w).tolist())
        sizes = [s.count(b" ") + 1 if s else 0 for s in strings]
        removed, spans, kept = [0] * len(strings), [[] for _ in strings], strings
        for t, starts in gone.items():
            steps = np.zeros(sizes[t] + 1, np.int64)
            np.add.at(steps, np.array(starts), 1)
            np.add.at(steps, np.array(starts) + k, -1)
            out = np.cumsum(steps[:-1]) > 0
            removed[t] = int(out.sum())
            words = strings[t].split(b" ")
            kept[t] = b" ".join([words[i] for i in np.flatnonzero(~out)])
            edges = np.flatnonzero(np.diff(np.concatenate([[0], out.astype(np.int8), [0]])))
            spans[t] = [{"start": a, "end": b} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]
        return pa.Table.from_arrays([
            pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
            pa.array(spans, _SPANS), pa.array([x.decode() for x in kept], pa.string())], schema=_RESULT)
    return drop


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WINDOW) -> DataFrame:
    """One row per document: its words, how many go, their spans (in words) and
    the kept text, words joined by one space. A word goes if a window of k
    words over it also starts in a document with a smaller doc_id."""
    units = in_units(docs, id_col, text_col)
    buckets = UNITS * shuffle_partitions(docs.sparkSession)
    sent = units.groupBy("unit").applyInArrow(_send(k, buckets), SENT)
    answers = sent.groupBy("bucket").applyInArrow(_sort_bucket(k), ANSWER)
    return units.groupBy("unit").cogroup(answers.groupBy("unit")).applyInArrow(_drop_words(k), RESULT)
