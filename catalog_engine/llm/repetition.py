"""Quality rules: repetition inside a document by its suffix array.

Each document is a sequence of words. Prefix doubling sorts its suffixes (many
documents at a time, with word numbers that no two documents share, so that no
repeat spans two of them); the ranks of every round then give the longest
common prefix of neighbours in that order. A maximal repeated substring is an
interval of the suffix array whose neighbours share at least so many words; the
deepest such interval around suffix i has depth L[i], the longer of its two
neighbours' common prefixes, so the union of all repeats of at least m words is
the union of the spans [i, i + L[i]) with L[i] >= m.

Only suffixes that still share a prefix are sorted again, so a round costs what
repeats, not what the document holds. One pass over the documents, no shuffle;
a task holds one batch of texts.

Defined cases: a null or empty text has no words and fails the base rules;
order of rows, repeated rows and other columns play no part; a text of one word
repeated n times has a longest repeat of n - 1 words (occurrences may overlap).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, Numbers, chunks

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: Words of a repeat that counts towards the covered fraction.
MIN_REPEAT = 8
MAX_COVERED = 0.45
#: Words that the longest repeat may have.
MAX_LONGEST = 100

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "covered_words long, longest_repeat long, repeats array<struct<start:int,end:int>>, "
          "base_failed boolean, kept boolean")
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_ARROW = pa.schema([(n, pa.int64()) for n in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                              "n_repeat_words", "covered_words", "longest_repeat")]
                   + [("repeats", _SPANS), ("base_failed", pa.bool_()), ("kept", pa.bool_())])


def longest_repeats(tokens: np.ndarray) -> np.ndarray:
    """L[i]: words of the longest substring that starts at i and also starts
    elsewhere. `tokens` are numbers 0..k-1, each in use."""
    n = len(tokens)
    found = np.zeros(n, np.int64)
    if n < 2:
        return found
    counts = np.bincount(tokens)
    rank = (np.cumsum(counts) - counts)[tokens]  # where the suffix's group starts in the suffix array
    active = np.flatnonzero(counts[tokens] > 1)
    rounds, width = [rank], 1
    order = active[np.argsort(rank[active], kind="stable")]
    while len(active):
        ahead = np.full(len(active), -1, np.int64)  # beyond the end: before every word
        inside = active + width < n
        ahead[inside] = rank[active[inside] + width]
        by = np.lexsort((ahead, rank[active]))
        order, head, ahead = active[by], rank[active][by], ahead[by]
        new_group = np.ones(len(order), bool)
        new_group[1:] = head[1:] != head[:-1]
        first = np.flatnonzero(new_group)
        within = np.arange(len(order)) - first[np.cumsum(new_group) - 1]
        split = new_group.copy()
        split[1:] |= ahead[1:] != ahead[:-1]
        start = np.flatnonzero(split)
        part = np.cumsum(split) - 1
        rank = rank.copy()
        rank[order] = head + within[start[part]]
        rounds.append(rank)
        width *= 2
        active = order[np.diff(np.append(start, len(order)))[part] > 1]
    # neighbours in the suffix array, where they share at least one word
    place = np.empty(n, np.int64)
    place[rounds[-1]] = np.arange(n)
    a, b = place[:-1], place[1:]
    same = rounds[0][a] == rounds[0][b]
    at, a, b = np.flatnonzero(same), a[same], b[same]
    common = np.zeros(len(a), np.int64)
    for k in range(len(rounds) - 1, -1, -1):
        x, y = a + common, b + common
        ok = (x < n) & (y < n)
        ok[ok] = rounds[k][x[ok]] == rounds[k][y[ok]]
        common[ok] += 1 << k
    np.maximum.at(found, place[at], common)
    np.maximum.at(found, place[at + 1], common)
    return found


def covered(lengths: np.ndarray, least: int) -> np.ndarray:
    """Which words lie in a span [i, i + lengths[i]) of at least `least` words."""
    starts = np.flatnonzero(lengths >= least)
    steps = np.zeros(len(lengths) + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + lengths[starts], -1)
    return np.cumsum(steps[:-1]) > 0


def _line_repeats(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return len(lines) - len(set(lines))


def _judge(cols: dict[str, list], min_words: int, min_repeat: int, max_covered: float,
           max_longest: int) -> pa.RecordBatch:
    texts = [t or "" for t in cols["text"]]
    words = [t.encode().split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    tokens, used = np.empty(int(sizes.sum()), np.int64), 0
    at = np.concatenate([[0], np.cumsum(sizes)])
    for w, lo, hi in zip(words, at[:-1], at[1:]):
        numbers = Numbers()
        tokens[lo:hi] = np.fromiter(map(numbers.__getitem__, w), np.int64, hi - lo) + used
        used += len(numbers)
    lengths = longest_repeats(tokens)
    total = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[at])
    n_repeat, long_ones = total(covered(lengths, 3)), covered(lengths, min_repeat)
    n_covered = total(long_ones)
    longest = np.array([lengths[lo:hi].max() if hi > lo else 0 for lo, hi in zip(at[:-1], at[1:])], np.int64)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], long_ones.astype(np.int8), [0]])))
    spans: list[list] = [[] for _ in texts]
    for lo, hi in zip(edges[::2], edges[1::2]):
        k = int(np.searchsorted(at, lo, "right")) - 1
        while lo < hi:  # a run may go on into the next document
            end = min(hi, at[k + 1])
            if end > lo:
                spans[k].append({"start": int(lo - at[k]), "end": int(end - at[k])})
            lo, k = end, k + 1
    failed = (sizes < min_words) | (100 * n_repeat > 50 * sizes)
    kept = ~failed & (n_covered <= max_covered * sizes) & (longest <= max_longest)
    return pa.RecordBatch.from_arrays([
        pa.array(cols["doc_id"], pa.int64()), pa.array(sizes),
        pa.array([len(t) - sum(map(t.count, BLANKS)) for t in texts], pa.int64()),
        pa.array([sum(map(t.count, SYMBOLS)) for t in texts], pa.int64()),
        pa.array([_line_repeats(t) for t in texts], pa.int64()),
        pa.array(n_repeat, pa.int64()), pa.array(n_covered, pa.int64()), pa.array(longest),
        pa.array(spans, _SPANS), pa.array(failed), pa.array(kept)], schema=_ARROW)


def with_verdict(docs: DataFrame, text_col: str = "text", *, min_words: int = MIN_WORDS, min_repeat: int = MIN_REPEAT,
                 max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """row (a struct of all columns of the documents) and kept."""
    row = docs.select(F.col(text_col).cast("string").alias("text"), F.struct("*").alias("row"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for cols in chunks([batch.select(["text"])]):
                n = len(cols["text"])
                kept = _judge({**cols, "doc_id": [None] * n}, min_words, min_repeat, max_covered, max_longest)
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(done, n), kept.column(10)], ["row", "kept"])
                done += n

    return row.mapInArrow(rows, f"row {row.schema['row'].dataType.simpleString()}, kept boolean")


def repetition_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                     min_words: int = MIN_WORDS, min_repeat: int = MIN_REPEAT,
                     max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """One row per document: base counts, the spans (in words) of the union of
    repeats of at least `min_repeat` words, the longest repeat, and `kept`:
    false where a base rule fails, the spans cover more than `max_covered` of
    the words, or the longest repeat has more than `max_longest` words."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in chunks(batches):
            yield _judge(cols, min_words, min_repeat, max_covered, max_longest)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(rows, SCHEMA)
