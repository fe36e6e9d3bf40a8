"""Periodic runs in documents by enumeration of maximal pairs.

A run is a stretch of words with smallest period q that no neighbouring word
extends and that holds `EXPONENT` periods and `MIN_LENGTH` words at least. Its
first word s and the word one period on are the two starts of a maximal pair:
the stretch shared by the suffixes s and s + q differs left of both starts and
right of both ends. So a pair of equal stretches of l words, q apart, that can
be extended neither way is the stretch [s, s + q + l) with period q, whole as it
stands; it counts where l + q is long enough. Multiples of the smallest period
give the same stretch again, the least of them stays.

The pairs come from the tree of LCP intervals, built bottom-up over the suffix
array with a stack. A node holds the starts that share its l words, in order and
by left word. Where two nodes meet at l, each start of the smaller one looks
among those of the other for partners at most l / (EXPONENT - 1) words off, with
another left word. Within a window shorter than l, starts of the same l words lie
whole periods apart, so all but the first have the same left word: one look-up
finds the partners, and what is found is what is returned. Starts move from the
smaller list to the larger one, O(n log n) of them.

Only suffixes that share enough words with another one enter the tree, and of
those only groups with several left words and two starts close enough; for
prose that is next to nothing. One pass over the documents, no shuffle; a task
holds one batch of texts (a longer text is a batch of its own).

Defined cases: a null or empty text has no words and no runs; order of rows,
repeated rows, a null id and other columns play no part; a text of one word n
times is one run of period 1; runs may overlap.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, Numbers, chunks

#: Periods that a run holds at least. The look-up needs more than 3.
EXPONENT = 4
#: Words that a run has at least.
MIN_LENGTH = 6

_RUNS = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
SCHEMA = ("doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed_text string")
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", _RUNS), ("collapsed_text", pa.string())])


def suffix_groups(tokens: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array without suffixes that share fewer than `least` words with
    both neighbours, and for each how many words it shares with the one before
    (0 where a new group begins). `tokens` are numbers 0..k-1, each in use."""
    n = len(tokens)
    none = np.empty(0, np.int64)
    if n < 2:
        return none, none
    counts = np.bincount(tokens)
    rank = (np.cumsum(counts) - counts)[tokens].astype(np.int32)  # where the suffix's group starts
    active, rounds, width = np.flatnonzero(counts[tokens] > 1), [rank], 1
    while len(active):
        beyond = np.full(len(active), -1, np.int32)  # past the end: before every word
        inside = active + width < n
        beyond[inside] = rank[active[inside] + width]
        by = np.lexsort((beyond, rank[active]))
        order, head, beyond = active[by], rank[active][by], beyond[by]
        group = np.ones(len(order), bool)
        group[1:] = head[1:] != head[:-1]
        split = group.copy()
        split[1:] |= beyond[1:] != beyond[:-1]
        start = np.flatnonzero(split)
        part = np.cumsum(split) - 1
        first = np.flatnonzero(group)[np.cumsum(group) - 1]
        rank = rank.copy()
        rank[order] = head + (start[part] - first)
        rounds.append(rank)
        width *= 2
        active = order[np.diff(np.append(start, len(order)))[part] > 1]
    place = np.empty(n, np.int64)
    place[rounds[-1]] = np.arange(n)
    deep = max(k for k in range(len(rounds)) if 1 << k <= least)
    deep = min(deep, len(rounds) - 1)
    at = np.flatnonzero(rounds[deep][place[:-1]] == rounds[deep][place[1:]])
    a, b = place[at], place[at + 1]
    common = np.zeros(len(at), np.int64)
    for k in range(len(rounds) - 1, -1, -1):
        x, y = a + common, b + common
        ok = (x < n) & (y < n)
        ok[ok] = rounds[k][x[ok]] == rounds[k][y[ok]]
        common[ok] += 1 << k
    at, common = at[common >= least], common[common >= least]
    if not len(at):
        return none, none
    shared = np.zeros(n, np.int64)
    shared[at + 1] = common
    member = shared > 0
    member[at] = True
    return place[member], shared[member]


class _Node:
    """Starts that share a prefix: in order, and by the word on their left."""

    __slots__ = ("order", "classes")

    def __init__(self, start: int, left: int):
        self.order, self.classes = [start], {left: [start]}


def _moved(small: list[int], big: list[int]) -> list[int]:
    if small[0] > big[-1]:
        big += small
    elif len(small) * 8 > len(big):
        big += small
        big.sort()
    else:
        for x in small:
            insort(big, x)
    return big


def _met(one: _Node, other: _Node, shared: int, left: list[int], exponent: int, min_length: int,
         found: list[tuple[int, int, int]]) -> _Node:
    """Appends the pairs between two nodes that meet at `shared` words; returns both as one."""
    small, big = (one, other) if len(one.order) < len(other.order) else (other, one)
    reach, order = shared // (exponent - 1), big.order
    for x in small.order:
        k = bisect_left(order, x - reach)
        if k == len(order) or order[k] > x + reach:
            continue
        first = order[k]
        if left[first] == left[x]:
            continue
        if first < x:
            partners = [(first, x)]
        else:  # x is the first, all others have one left word
            there = big.classes[left[first]]
            partners = [(x, y) for y in there[bisect_left(there, first):bisect_right(there, x + reach)]]
        found += [(i, j, shared) for i, j in partners if shared + j - i >= min_length]
    for word, starts in small.classes.items():
        held = big.classes.get(word)
        big.classes[word] = starts if held is None else _moved(starts, held)
    big.order = _moved(small.order, big.order)
    return big


def maximal_pairs(place: list[int], shared: list[int], left: list[int], exponent: int = EXPONENT,
                  min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """(i, j, l): maximal pairs of l equal words at i < j, close enough, of one
    group of the suffix array; shared[0] is not read."""
    found: list[tuple[int, int, int]] = []
    if exponent < 4:
        raise ValueError("runs of fewer than 4 periods are not looked up")
    stack: list[tuple[int, _Node]] = []
    node = _Node(place[0], left[place[0]])
    for p, depth in zip(place[1:], shared[1:]):
        while stack and stack[-1][0] > depth:
            words, before = stack.pop()
            node = _met(before, node, words, left, exponent, min_length, found)
        stack.append((depth, node))
        node = _Node(p, left[p])
    while stack:
        words, before = stack.pop()
        node = _met(before, node, words, left, exponent, min_length, found)
    return found


def runs(tokens: np.ndarray, starts: np.ndarray, exponent: int = EXPONENT, min_length: int = MIN_LENGTH
         ) -> dict[tuple[int, int], int]:
    """(start, end) -> period of all runs in a sequence of documents that begin at
    `starts` and share no token. `tokens` are numbers 0..k-1, each in use."""
    # l >= min_length - q and l >= (exponent - 1) q: whichever q, l is at least this
    least = min(max(min_length - q, (exponent - 1) * q) for q in range(1, min_length + 1))
    place, shared = suffix_groups(tokens, least)
    if not len(place):
        return {}
    left = np.empty(len(tokens), np.int64)
    left[1:] = tokens[:-1]
    inner = starts[starts < len(tokens)]
    left[inner] = -1
    heads = np.flatnonzero(shared == 0)
    sizes = np.diff(np.append(heads, len(place)))
    group = np.repeat(np.arange(len(heads)), sizes)
    by = np.lexsort((place, group))
    gaps = np.diff(place[by], prepend=0)
    gaps[heads] = len(tokens)
    words = left[place]
    # groups with several left words in which two starts are close enough for the longest shared prefix
    may = ((np.minimum.reduceat(words, heads) != np.maximum.reduceat(words, heads))
           & (np.minimum.reduceat(gaps, heads) <= np.maximum.reduceat(shared, heads) // (exponent - 1)))
    out: dict[tuple[int, int], int] = {}
    if not may.any():
        return out
    known = left.tolist()
    for k in np.flatnonzero(may).tolist():
        cut = slice(heads[k], heads[k] + sizes[k])
        for i, j, same in maximal_pairs(place[cut].tolist(), shared[cut].tolist(), known, exponent, min_length):
            at, period = (i, j + same), j - i
            if period < out.get(at, period + 1):
                out[at] = period
    return out


def _found(cols: dict[str, list], exponent: int, min_length: int) -> pa.RecordBatch:
    words = [(t or "").encode().split() for t in cols["text"]]
    at = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    tokens, used = np.empty(int(at[-1]), np.int64), 0
    for w, lo, hi in zip(words, at[:-1], at[1:]):
        numbers = Numbers()
        tokens[lo:hi] = np.fromiter(map(numbers.__getitem__, w), np.int64, hi - lo) + used
        used += len(numbers)
    per: list[list] = [[] for _ in words]
    dropped: dict[int, list[tuple[int, int]]] = {}
    for (start, end), period in sorted(runs(tokens, at[:-1], exponent, min_length).items(), key=lambda r: (r[0][0], r[1])):
        k = int(np.searchsorted(at, start, "right")) - 1
        lo = int(at[k])
        per[k].append({"start": start - lo, "length": end - start, "period": period})
        dropped.setdefault(k, []).append((start - lo + period, end - lo))
    kept = []
    for k, w in enumerate(words):
        if k in dropped:
            gone = np.zeros(len(w) + 1, np.int64)
            for lo, hi in dropped[k]:
                gone[lo] += 1
                gone[hi] -= 1
            w = [w[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
        kept.append(b" ".join(w).decode())
    return pa.RecordBatch.from_arrays([pa.array(cols["doc_id"], pa.int64()), pa.array(np.diff(at)),
                                       pa.array(per, _RUNS), pa.array(kept, pa.string())], schema=_ARROW)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, exponent: int = EXPONENT,
                  min_length: int = MIN_LENGTH) -> DataFrame:
    """One row per document: doc_id, n_words, its runs (by start, then period; in
    words) and the text without what a run repeats after its first period, words
    joined by one space."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in chunks(batches):
            yield _found(cols, exponent, min_length)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(rows, SCHEMA)


def with_repeated_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text. One document in ten, by the checksum h of its id, repeats
    itself from word a = g % n on (g = h / 10, n words): word i becomes word
    a + (i - a) % p, p = 1 + (n - a) / (3 + g % 8). A null id is never chosen."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    h = F.crc32(F.col(id_col).cast("long").cast("string").cast("binary"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.floor(h / 10).cast("long").alias("g"),
                       F.when(h % 10 == 0, F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).alias("w"))
    # exploded, so that the words are found once and not at every place
    rows = rows.select("doc_id", "text", "g", F.explode(F.array("w")).alias("w"))
    n = F.size("w")
    rows = rows.withColumn("a", F.when(n > 0, F.col("g") % n)).withColumn(
        "p", F.floor((n - F.col("a")) / (3 + F.col("g") % 8)) + 1)

    def source(i: Column) -> Column:
        return F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))

    again = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("w", source(i).cast("int"))), " ")
    return rows.select("doc_id", F.when(n > 0, again).otherwise(F.col("text")).alias("text"))
