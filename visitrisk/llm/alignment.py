"""Cross-tokenizer alignment: two tokenizers' tokens of a text are cut into the smallest groups that span equal bytes.

Divide and conquer at shared cuts: in an interval of the text, the token end of A next to the middle is looked up
among the ends of B by bisection, then those further from the middle, until one is a *shared cut*; both halves are
worked on in the same way, and an interval without a cut inside is a group. The intervals of one depth are worked on
at once, for all texts of a block. An interval in which either side has one token only is a group without a search.

A single space between two characters that are no white space is a shared cut known beforehand for tokenizers of the
two kinds here: byte-level BPE splits there before it merges, and no piece of the other vocabulary has a space after
another character (checked when it is loaded). So texts are first split there, and a task tokenizes and aligns each
different *word* (a stretch between such cuts) once. A text's groups are those of its words.

A *link* is a token of A and a token of B whose byte ranges overlap. The links of each id pair are counted over all
texts: once per task and pair, then in one aggregation. The table of pairs is bounded by the two vocabularies; up to
``MAX_BROADCAST`` pairs it is sent to the tasks, beyond that each text's pairs are joined with it.

Defined cases: a text that is NULL or empty, or that either tokenizer does not give back byte for byte, has no tokens;
strings of special tokens are plain text; repeated rows count each; input columns named like an output are replaced.
The texts of a word are remembered up to ``REMEMBERED`` words, then forgotten all at once. A text without such spaces
is one word and needs about 200 bytes of memory for each of its bytes.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitrisk.llm.common import columns, extended, extended_batch, slices, stored

#: Most id pairs that are sent to every task, 24 bytes each.
MAX_BROADCAST = 4_000_000
#: Words whose alignment a task remembers.
REMEMBERED = 300_000

RESULT = T.StructType(columns("n_a long, n_b long, n_groups long, n_links long").fields + columns("groups string, groups_sha256 string").fields)
PAIRS = T.StructType([T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("links", T.ArrayType(T.LongType()))])
COUNTS = columns("pair long, n long")
SUMS = columns("n_best long, count_sum long")

_ID_BITS = 24
_KNOWN_CUT = re.compile(r"(?<=\S) (?=\S)")
# How byte-level vocabularies split text before merging, and which characters stand for bytes.
_BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PLAIN_BYTES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


class ByteTokens:
    """A byte-level BPE vocabulary from the JSON file of the ``tokenizers`` library, run by ``tiktoken``."""

    def __init__(self, content: bytes) -> None:
        import tiktoken

        spec = json.loads(content)
        split = spec["pre_tokenizer"]
        if spec["model"]["type"] != "BPE" or spec["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]:
            raise ValueError("not a plain byte-level BPE vocabulary")
        others = iter(x for x in range(256) if x not in _PLAIN_BYTES)
        byte = {chr(x): x for x in _PLAIN_BYTES} | {chr(256 + i): x for i, x in enumerate(others)}
        special = {x["content"] for x in spec["added_tokens"]}
        ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        order = [spec["model"]["vocab"]["".join(m)] for m in merges]
        if order != sorted(order):
            raise ValueError("ids are not in the order of the merges")
        self.encoding = tiktoken.Encoding("own", pat_str=_BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes[i] = token

    def encode(self, words: list[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(" " + w) for w in words]


class PieceTokens:
    """A ``sentencepiece`` model that puts a space before each text."""

    def __init__(self, content: bytes) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=content)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if "▁" in piece.lstrip("▁"):
                raise ValueError("a piece has a space after another character")
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())

    def encode(self, words: list[str]) -> list[list[int]]:
        return self.model.encode(words, num_threads=1)


def shared_cuts(a: np.ndarray, b: np.ndarray, a_first: np.ndarray, a_last: np.ndarray, b_first: np.ndarray, b_last: np.ndarray) -> np.ndarray:
    """For each token of A, whether its end is an end of B: by divide and conquer inside the given intervals.

    ``a`` and ``b`` are the ends of all tokens; an interval holds the tokens from first to last, whose ends are equal.
    """
    cut = np.zeros(len(a), bool)
    cut[a_last[a_last >= a_first]] = True
    while True:
        open_ = (a_last > a_first) & (b_last > b_first)
        a_first, a_last, b_first, b_last = a_first[open_], a_last[open_], b_first[open_], b_last[open_]
        if not len(a_first):
            return cut
        low = np.where(a_first > 0, a[a_first - 1], 0)
        middle = np.clip(np.searchsorted(a, (low + a[a_last]) // 2), a_first, a_last - 1)
        at, place = np.full(len(a_first), -1), np.zeros(len(a_first), np.int64)
        left, step = np.arange(len(a_first)), 0
        while len(left):
            found = np.zeros(len(left), bool)
            for here in (middle[left] + step, middle[left] - step):
                inner = (here >= a_first[left]) & (here < a_last[left]) & ~found
                end = a[np.where(inner, here, 0)]
                own = np.searchsorted(b, end)
                hit = inner & (b[np.minimum(own, len(b) - 1)] == end)
                at[left[hit]], place[left[hit]] = here[hit], own[hit]
                found |= hit
            step += 1
            left = left[~found]
            left = left[(middle[left] + step < a_last[left]) | (middle[left] - step >= a_first[left])]
        split = at >= 0
        cut[at[split]] = True
        a_first, a_last = np.concatenate([a_first[split], at[split] + 1]), np.concatenate([at[split], a_last[split]])
        b_first, b_last = np.concatenate([b_first[split], place[split] + 1]), np.concatenate([place[split], b_last[split]])


class Words:
    """What is known of words: tokens, groups and links, each aligned when it is first seen."""

    def __init__(self, a: ByteTokens | PieceTokens, b: ByteTokens | PieceTokens) -> None:
        self.a, self.b = a, b
        self.sizes = [np.array([len(x) for x in t.bytes], np.int64) for t in (a, b)]
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        self.counts = np.zeros((0, 4), np.int64)  # tokens of A and B, groups, links; no tokens: bytes differ
        self.pairs, self.first = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def numbers(self, texts: list[list[str]]) -> np.ndarray:
        """Numbers of the words of ``texts``; new ones are aligned."""
        if len(self.number) > REMEMBERED:
            self.clear()
        known = len(self.number)
        out = np.fromiter((self.number.setdefault(w, len(self.number)) for words in texts for w in words), np.int64)
        new = list(self.number)[known:] if len(self.number) > known else []
        if new:
            self._align(new)
        return out

    def _align(self, words: list[str]) -> None:
        whole = [(" " + w).encode() for w in words]
        ids, counts = [], []
        for tokens in (self.a, self.b):
            own = tokens.encode(words)
            ids.append(own)
        same = [b"".join(map(self.a.bytes.__getitem__, x)) == w == b"".join(map(self.b.bytes.__getitem__, y)) for x, y, w in zip(*ids, whole, strict=True)]
        ids = [[x if s else [] for x, s in zip(own, same, strict=True)] for own in ids]
        counts = [np.array([len(x) for x in own], np.int64) for own in ids]
        flat = [np.fromiter((i for x in own for i in x), np.int64) for own in ids]
        ends = [np.cumsum(size[x]) for size, x in zip(self.sizes, flat, strict=True)]
        lasts = [np.cumsum(n) - 1 for n in counts]
        firsts = [last - n + 1 for last, n in zip(lasts, counts, strict=True)]
        filled = counts[0] > 0
        cut = shared_cuts(*ends, firsts[0][filled], lasts[0][filled], firsts[1][filled], lasts[1][filled])
        cut_b = np.zeros(len(flat[1]), bool)
        cut_b[np.searchsorted(ends[1], ends[0][cut])] = True

        def per_word(values: np.ndarray, side: int) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(values)])
            return sums[lasts[side] + 1] - sums[firsts[side]]

        n_groups = per_word(cut, 0)
        n_links = counts[0] + counts[1] - n_groups
        self.counts = np.concatenate([self.counts, np.stack([*counts, n_groups, n_links], axis=1)])

        # Where either side ends a link ends: so many ends, so many overlapping pairs.
        both = np.union1d(*ends)
        pairs = flat[0][np.searchsorted(ends[0], both)] << _ID_BITS | flat[1][np.searchsorted(ends[1], both)] if len(both) else np.zeros(0, np.int64)
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(n_links)])
        self.pairs = np.concatenate([self.pairs, pairs])

        # Tokens in the order of the output: those of A in a group, then those of B.
        group = [np.cumsum(x) - x for x in (cut, cut_b)]
        tokens = np.concatenate(flat)
        mark = np.concatenate([np.where(cut, 1, 0), np.where(cut_b, 2, 0)])
        order = np.lexsort((np.concatenate([np.zeros(len(cut), int), np.ones(len(cut_b), int)]), np.concatenate(group)))
        text = [f"{i}{',|;'[m]}" for i, m in zip(tokens[order].tolist(), mark[order].tolist(), strict=True)]
        bounds = np.concatenate([[0], np.cumsum(counts[0] + counts[1])]).tolist()
        self.groups += ["".join(text[x:y])[:-1] for x, y in zip(bounds[:-1], bounds[1:], strict=True)]


_words: dict[tuple[bytes, bytes], Words] = {}


def _loaded(contents: tuple[bytes, bytes]) -> Words:
    """The vocabularies, once per Python process."""
    if contents not in _words:
        _words[contents] = Words(*[(ByteTokens if x.lstrip().startswith(b"{") else PieceTokens)(x) for x in contents])
    return _words[contents]


def _content(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``values`` between ``offsets``."""
    zero = np.zeros((1, *values.shape[1:]), values.dtype)
    sums = np.concatenate([zero, np.cumsum(values, axis=0)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def aligned(docs: DataFrame, a: str, b: str, texts: bool = True) -> DataFrame:
    """``docs`` (text, any more) with RESULT and PAIRS: the groups, and the links by id pair (A's id times 2**24 plus B's).

    ``groups`` is ``a1,a2|b1;a3|b2,b3``, and NULL without ``texts``. ``a`` and ``b`` are vocabulary files, a byte-level
    one in JSON or a model of pieces. The driver reads them, and every task gets their content.
    """
    contents = docs.sparkSession.sparkContext.broadcast((_content(a), _content(b)))

    def align(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _loaded(contents.value)
        for batch in (part for whole in batches for part in slices(whole)):
            words = [_KNOWN_CUT.split(text) if text else [] for text in batch.column("text").to_pylist()]
            number = known.numbers(words)
            offsets = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
            own = known.counts[number]
            fine = _sums((own[:, 0] == 0).astype(np.int64), offsets) == 0
            n = _sums(own, offsets) * fine[:, None]
            names = list(map(known.groups.__getitem__, number.tolist()))
            groups = [";".join(names[x:y]) if f else "" for x, y, f in zip(offsets[:-1].tolist(), offsets[1:].tolist(), fine.tolist(), strict=True)]
            digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]

            # Each word once per text, so that its links are written out once.
            key = np.repeat(np.arange(len(words)), np.diff(offsets)) * len(known.groups) + number
            key, times = np.unique(key[np.repeat(fine, np.diff(offsets))], return_counts=True)
            row, word = key // max(1, len(known.groups)), key % max(1, len(known.groups))
            size = known.first[word + 1] - known.first[word]
            at = np.arange(size.sum()) + np.repeat(known.first[word] - (np.cumsum(size) - size), size)
            row, links, pair = np.repeat(row, size), np.repeat(times, size), known.pairs[at]
            order = np.lexsort((pair, row))
            row, links, pair = row[order], links[order], pair[order]
            begin = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (pair[1:] != pair[:-1])])) if len(row) else np.zeros(0, np.int64)
            links = np.add.reduceat(links, begin) if len(begin) else links
            ends = pa.array(np.searchsorted(row[begin], np.arange(len(words) + 1)), pa.int32())
            yield extended_batch(
                batch,
                n_a=pa.array(n[:, 0]),
                n_b=pa.array(n[:, 1]),
                n_groups=pa.array(n[:, 2]),
                n_links=pa.array(n[:, 3]),
                groups=pa.array(groups if texts else [None] * len(groups), pa.string()),
                groups_sha256=pa.array(digests, pa.string()),
                pairs=pa.ListArray.from_arrays(ends, pa.array(pair[begin])),
                links=pa.ListArray.from_arrays(ends, pa.array(links)),
            )

    return docs.mapInArrow(align, extended(docs.schema, *RESULT, *PAIRS))


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n, best): how many links hold an id pair, and whether that is the most of its B id."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair, place = np.unique(batch.column("pairs").flatten().to_numpy(zero_copy_only=False), return_inverse=True)
            n = np.zeros(len(pair), np.int64)
            np.add.at(n, place, batch.column("links").flatten().to_numpy(zero_copy_only=False))
            yield pa.record_batch([pa.array(pair), pa.array(n)], names=COUNTS.names)

    counts = stored(rows.select("pairs", "links").mapInArrow(count, COUNTS).groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    b = F.col("pair").bitwiseAND((1 << _ID_BITS) - 1)
    most = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    joined = counts.withColumn("b", b).join(most, "b")
    return stored(joined.select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "best")


def link_counts(rows: DataFrame, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """``rows`` of :func:`aligned`, stored, with SUMS in place of PAIRS: links whose pair is the best of its B id, and the
    sum over the links of their pairs' counts."""
    counts = pair_counts(rows)
    if counts.count() > max_broadcast:
        rows = rows.drop(*SUMS.names)
        own = rows.dropDuplicates(["groups_sha256"]).select("groups_sha256", F.explode(F.arrays_zip("pairs", "links")).alias("x"))
        own = own.select("groups_sha256", F.col("x.pairs").alias("pair"), F.col("x.links").alias("links")).join(counts, "pair")
        best = F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best")
        sums = stored(own.groupBy("groups_sha256").agg(best, F.sum(F.col("links") * F.col("n")).alias("count_sum")), "sums")
        # The same groups have the same pairs, so their digest is the key.
        out = rows.join(sums, "groups_sha256", "left").drop("pairs", "links")
        return out.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in SUMS.names})
    table = counts.toArrow().sort_by("pair")
    known = rows.sparkSession.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("pair", "n", "best")))

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = known.value
        for batch in batches:
            own, links = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in PAIRS.names)
            ends = np.concatenate([[0], np.cumsum(batch.column("pairs").value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            at = np.searchsorted(pair, own)
            values = np.stack([links * best[at], links * n[at]], axis=1) if len(own) else np.zeros((0, 2), np.int64)
            sums = _sums(values, ends)
            yield extended_batch(batch.drop_columns(PAIRS.names), n_best=pa.array(sums[:, 0]), count_sum=pa.array(sums[:, 1]))

    schema = extended(T.StructType([f for f in rows.schema if f.name not in PAIRS.names]), *SUMS)
    return rows.mapInArrow(add, schema)


def align(docs: DataFrame, a: str, b: str, texts: bool = True, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """``docs`` (text, any more) with RESULT and SUMS."""
    return link_counts(stored(aligned(docs, a, b, texts), "aligned"), max_broadcast)
