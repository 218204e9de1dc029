"""Periodic runs: maximal stretches of words with a period, found from Lyndon roots.

A *run* is a stretch of at least ``min_length`` words and two periods that no neighbouring word extends; its period
is the smallest one. Every run has a Lyndon root that is the longest Lyndon word at its place under one of two
opposite orders of the words. Baier's grouping (the first phase of his suffix sorter) yields the longest Lyndon words:
suffixes are grouped by a common beginning, groups are taken from the greatest on, and the suffix before each member
that is in a lower group joins its beginning with the member's. What a group's beginning is when it is taken is the
longest Lyndon word of its members. Each of these roots is extended both ways by the length of common extensions (by
prefix hashes, all roots of a block at once), and what is found is compared word by word.

The words of a run occur twice: a run of L words with period q <= L / 2 repeats its first L - q >= ``min_length`` / 2
words. So only stretches of words that lie in a sequence of ``min_length`` / 2 words found twice in the text go through
the grouping; no run is lost, as a run lies inside such a stretch.

Words are ``[^\\x20\\x09-\\x0D]+``. Everything is within one row, there is no shuffle. Defined cases: NULL and empty texts
have no runs and the empty collapsed text; repeated rows get equal results; input columns named like an output are
replaced; a text needs about 100 bytes of memory for each of its words, more where it repeats itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from visitrisk.llm.common import WORDS, columns, extended, extended_batch, joined, mixed, slices

MIN_LENGTH = 12

RUN = columns("start long, length long, period long")
RESULT = T.StructType([*columns("n_words long"), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])
_RUN = pa.struct([(f.name, pa.int64()) for f in RUN])


def longest_lyndon(symbols: np.ndarray) -> list[int]:
    """Length of the longest Lyndon word that begins at each place of ``symbols``, by Baier's grouping.

    A group is an interval of a sorted array of places, named by the interval's begin, so names are in order.
    """
    n = len(symbols)
    _, number, counts = np.unique(symbols, return_inverse=True, return_counts=True)
    end_of = np.cumsum(counts)
    group = (end_of - counts)[number].tolist()
    members: list = [None] * n
    for places in np.split(np.argsort(number, kind="stable"), end_of[:-1]):
        members[group[places[0]]] = places.tolist()
    begin, end, length = [0] * (n + 1), [0] * n, [0] * n
    for e, c in zip(end_of.tolist(), counts.tolist(), strict=True):
        begin[e], end[e - c], length[e - c] = e - c, e, 1
    before, found, high = [-1] * n, [0] * n, n
    while high:
        own = begin[high]
        size, places, times = length[own], [], []
        for i in members[own]:
            if group[i] != own:  # has left since
                continue
            found[i] = size
            j = i - 1
            while j >= 0 and group[j] >= own:
                j = before[j]
            before[i] = j
            if j >= 0:
                if places and places[-1] == j:
                    times[-1] += 1
                else:
                    places.append(j)
                    times.append(1)
        high = own
        if not places:
            continue
        moved: dict[tuple[int, int], list[int]] = {}
        for j, k in zip(places, times, strict=True):
            moved.setdefault((-k, group[j]), []).append(j)
        old = {g: length[g] for _, g in moved}
        for k, g in sorted(moved):  # the places that repeat the member most come last in their group
            some = moved[k, g]
            new = end[g] - len(some)
            end[new], begin[end[g]] = end[g], new
            if new != g:
                end[g], begin[new] = new, g
                for j in some:
                    group[j] = new
            members[new], length[new] = some, old[g] - k * size
    return found


class Extensions:
    """Lengths of common extensions of two places of a sequence, within bounds, by prefix hashes."""

    def __init__(self, symbols: np.ndarray) -> None:
        self.up = WORDS.upto(len(symbols) + 1)[0]
        self.sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(mixed(symbols.astype(np.uint64) + np.uint64(1)) * self.up[: len(symbols)], out=self.sums[1:])

    def same(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the ``n`` symbols from ``a`` on and from ``b`` on are equal; a <= b."""
        return (self.sums[a + n] - self.sums[a]) * self.up[b - a] == self.sums[b + n] - self.sums[b]

    def right(self, a: np.ndarray, b: np.ndarray, last: np.ndarray) -> np.ndarray:
        """How many symbols from ``a`` and ``b`` on are equal, before ``last``."""
        found, room = np.zeros(len(a), np.int64), last - b
        for bit in reversed(range(int(room.max(initial=0)).bit_length())):
            more = found + (1 << bit)
            at = np.flatnonzero(more <= room)
            at = at[self.same(a[at], b[at], more[at])]
            found[at] = more[at]
        return found

    def left(self, a: np.ndarray, b: np.ndarray, first: np.ndarray) -> np.ndarray:
        """How many symbols that end before ``a`` and ``b`` are equal, from ``first`` on."""
        found, room = np.zeros(len(a), np.int64), a - first
        for bit in reversed(range(int(room.max(initial=0)).bit_length())):
            more = found + (1 << bit)
            at = np.flatnonzero(more <= room)
            at = at[self.same(a[at] - more[at], b[at] - more[at], more[at])]
            found[at] = more[at]
        return found


def _whole(symbols: np.ndarray, run: tuple[int, int, int], first: int, last: int) -> tuple[int, int, int]:
    """``run`` (start, end, period) as it is, or as found word by word where hashes have misled."""
    start, end, period = run
    if np.array_equal(symbols[start : end - period], symbols[start + period : end]):
        return run
    root = start
    while end < last and symbols[end] == symbols[end - period]:
        end += 1
    wrong = np.flatnonzero(symbols[root : end - period] != symbols[root + period : end])
    return (root, root + period + int(wrong[0]), period)


def runs_between(symbols: np.ndarray, first: np.ndarray, last: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """(start, end, period) of the runs inside the stretches from ``first`` to ``last``, in order."""
    roots, bound, ends = [], [], []
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        part = symbols[a:b]
        for order in (part, -part):
            roots.append(np.stack([np.arange(a, b), np.array(longest_lyndon(order), np.int64)]))
            bound.append(np.full(b - a, a))
            ends.append(np.full(b - a, b))
    if not roots:
        return np.zeros((0, 3), np.int64)
    (at, period), bound, ends = np.concatenate(roots, axis=1), np.concatenate(bound), np.concatenate(ends)
    common = Extensions(symbols)
    begin = at - common.left(at, at + period, bound)
    end = at + period + common.right(at, at + period, ends)
    keep = (end - begin >= 2 * period) & (end - begin >= min_length)
    found = np.unique(np.stack([begin, end, period, bound, ends], axis=1)[keep], axis=0)
    whole = [_whole(symbols, tuple(r[:3]), r[3], r[4]) for r in found.tolist()]
    whole = sorted({r for r in whole if r[1] - r[0] >= max(min_length, 2 * r[2])}, key=lambda r: (r[0], r[2]))
    return np.array(whole, np.int64).reshape(-1, 3)


def stretches(symbols: np.ndarray, offsets: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the stretches of ``symbols`` in which a run can be; texts are between ``offsets``."""
    gram, n = -(-min_length // 2), len(symbols)
    if n < min_length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    k = n - gram + 1
    prints = text[:k].astype(np.uint64)
    for i in range(gram):
        prints = mixed(prints * np.uint64(0x9E3779B97F4A7C15) + symbols[i : i + k].astype(np.uint64))
    at = np.flatnonzero(text[:k] == text[gram - 1 :])
    at = at[np.argsort(prints[at], kind="stable")]
    same = prints[at[1:]] == prints[at[:-1]]
    twice = np.unique(np.concatenate([at[1:][same], at[:-1][same]]))
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, twice, 1)
    np.add.at(marks, twice + gram, -1)
    inside = np.cumsum(marks[:-1]) > 0
    change = np.ones(n, bool)
    change[1:] = (inside[1:] != inside[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(change)
    end = np.append(begin[1:], n)
    keep = inside[begin] & (end - begin >= min_length)
    return begin[keep], end[keep]


def find_runs(
    docs: DataFrame,
    min_length: int = MIN_LENGTH,
    prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """``docs`` (doc_id, text, any more) with RESULT: the runs by start and period, and ``collapsed``, the text's words
    with one space between, without those that some run has after its first period.

    ``prepare`` may change the words of a document beforehand; it gets the doc_id and the words.
    """

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            texts = [(text or "").encode().split() for text in batch.column("text").to_pylist()]
            if prepare is not None:
                texts = [prepare(doc, words) for doc, words in zip(batch.column("doc_id").to_pylist(), texts, strict=True)]
            number: dict[bytes, int] = {}
            symbols = joined([np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)) for words in texts])
            offsets = np.concatenate([[0], np.cumsum([len(words) for words in texts])]).astype(np.int64)
            runs = runs_between(symbols, *stretches(symbols, offsets, min_length), min_length)
            marks = np.zeros(len(symbols) + 1, np.int64)
            np.add.at(marks, runs[:, 0] + runs[:, 2], 1)
            np.add.at(marks, runs[:, 1], -1)
            gone = np.cumsum(marks[:-1]) > 0
            first = np.searchsorted(runs[:, 0], offsets)
            zero = np.repeat(offsets[:-1], np.diff(first))
            parts = [pa.array(x) for x in (runs[:, 0] - zero, runs[:, 1] - runs[:, 0], runs[:, 2])]
            items = pa.StructArray.from_arrays(parts, fields=list(_RUN))
            shorter = np.add.reduceat(np.append(gone, False), np.minimum(offsets[:-1], len(gone)), dtype=np.int64) * (np.diff(offsets) > 0)
            kept = [
                b" ".join(words if not cut else [w for w, g in zip(words, gone[a:b].tolist(), strict=True) if not g])
                for words, a, b, cut in zip(texts, offsets[:-1], offsets[1:], shorter, strict=True)
            ]
            yield extended_batch(
                batch,
                n_words=pa.array(np.diff(offsets), pa.int64()),
                runs=pa.ListArray.from_arrays(pa.array(first, pa.int32()), items),
                collapsed=pa.array(kept, pa.binary()).cast(pa.string()),
            )

    return docs.mapInArrow(find, extended(docs.schema, *RESULT))
