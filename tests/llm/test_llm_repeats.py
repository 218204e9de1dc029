"""Periodic runs, token alignment and suffix dedup against plain versions; edge cases of each."""

import hashlib
import random
import zlib
from bisect import bisect_left
from collections import Counter

import numpy as np
import plain
import pytest
import sentencepiece
from pyspark.sql import functions as F
from test_llm_documents import EDGE, SF, documents
from tokenizers import Tokenizer

from visitrisk.llm import alignment, periodic, queries, suffixdedup

A_FILE, B_FILE = queries.VOCABULARIES
CLASHING = ("runs", "n_words", "start", "collapsed", "groups", "pairs", "links", "n_a", "n_best", "spans", "kept", "doc", "at", "digit", "first", "n_bytes", "asked", "windows")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, "doc_id long, text string").select("*", *[F.lit("x").alias(c) for c in CLASHING])


# --- periodic runs ------------------------------------------------------------------------------


def plain_lyndon(s):
    longest = lambda i: max(n for n in range(1, len(s) - i + 1) if all(s[i : i + n] < s[i + k : i + n] for k in range(1, n)))
    return [longest(i) for i in range(len(s))]


def plain_runs(words, min_length):
    """(start, length, period) of maximal stretches of equal words at each distance, the least distance of each."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(2 * q, min_length):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_grouping_gives_the_longest_lyndon_words():
    rng = random.Random(1)
    for _ in range(800):
        s = [rng.randrange(rng.choice([1, 2, 3, 4])) for _ in range(rng.randrange(1, 14))]
        assert periodic.longest_lyndon(np.array(s)) == plain_lyndon(s)


@pytest.mark.parametrize("min_length", [2, 5, 12])
def test_runs_equal_plain_version(spark, min_length):
    rng, docs = random.Random(min_length), []
    for i in range(300):
        words = []
        while len(words) < rng.randrange(1, 70):
            words += [rng.choice("abc"[: rng.randrange(1, 4)]) for _ in range(rng.randrange(1, 9))] * rng.randrange(1, 4)
        docs.append((i, " ".join(words)))
    rows = periodic.find_runs(spark.createDataFrame(docs, "doc_id long, text string"), min_length).collect()
    assert len(rows) == len(docs)
    for r in rows:
        words = docs[r.doc_id][1].split()
        assert [tuple(x) for x in r.runs] == plain_runs(words, min_length)
        assert r.collapsed == plain_collapsed(words, plain_runs(words, min_length)) and r.n_words == len(words)


def test_runs_that_hashes_mislead_are_measured_word_by_word():
    symbols = np.array([1, 2, 1, 2, 1, 3, 1, 2])
    assert periodic._whole(symbols, (0, 5, 2), 0, 8) == (0, 5, 2)
    assert periodic._whole(symbols, (0, 7, 2), 0, 8) == (0, 5, 2)


def test_periodic_query_equals_plain_version(spark):
    docs, n_planted = dict(documents(spark)), 0
    for r in queries.queries()["op11_periodic_runs"](spark, SF).collect():
        words = plain.SPACE_WORD.findall(docs[r.doc_id] or "")
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            n_planted += 1
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words, 12)
        top = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        expected = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *expected)
        assert r.runs_sha256 == sha("".join("%d,%d,%d\n" % x for x in runs)) and r.collapsed_sha256 == sha(plain_collapsed(words, runs))
    assert n_planted


def test_runs_of_edge_cases(spark, edge):
    rows = periodic.find_runs(edge).collect()
    assert len(rows) == len(EDGE) and {r.start for r in rows} == {"x"}
    for r in rows:
        words = plain.SPACE_WORD.findall(r.text or "")
        if len(words) < 1000:
            assert [tuple(x) for x in r.runs] == plain_runs(words, 12) and r.collapsed == plain_collapsed(words, plain_runs(words, 12))
    assert periodic.find_runs(edge.limit(0)).count() == 0
    long = spark.createDataFrame([(1, "a b " * 200_000), (2, " ".join(f"w{i % 90_000}" for i in range(300_000)))], "doc_id long, text string")
    found = {r.doc_id: ([tuple(x) for x in r.runs], len(r.collapsed.split())) for r in periodic.find_runs(long).collect()}
    assert found == {1: ([(0, 400_000, 2)], 2), 2: ([(0, 300_000, 90_000)], 90_000)}


# --- alignment ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabularies():
    a, b = Tokenizer.from_file(A_FILE), sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    a.encode_special_tokens = True
    return a, b


def token_bytes(a, b):
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}
    own = {i: bytes(byte[c] for c in t) for t, i in a.get_vocab().items() if i != 50256}
    return own, [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.get_piece_size())]


def plain_alignment(texts, a, b):
    """n_a, n_b, n_groups, n_links, groups, n_best and count_sum of each text, by whole texts, byte by byte."""
    names, rows, links, counts = token_bytes(a, b), [], [], Counter()
    for text in texts:
        ids = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        if any(b"".join(n[i] for i in own) != (" " + text).encode() for n, own in zip(names, ids, strict=True) if text):
            ids = ([], [])
        ranges = []
        for own, name in zip(ids, names, strict=True):
            ends = np.cumsum([len(name[i]) for i in own], dtype=int).tolist()
            ranges.append(list(zip([0, *ends], ends, own, strict=False)))
        cuts = sorted({e for _, e, _ in ranges[0]} & {e for _, e, _ in ranges[1]})
        groups = [([], []) for _ in cuts]
        for k, side in enumerate(ranges):
            for _, e, i in side:
                groups[bisect_left(cuts, e)][k].append(str(i))
        groups = [f"{','.join(x)}|{','.join(y)}" for x, y in groups]
        covers = [[n for n, (x, y, _) in enumerate(side) for _ in range(y - x)] for side in ranges]
        own = [(ids[0][i], ids[1][j]) for i, j in dict.fromkeys(zip(*covers, strict=True))]
        counts.update(own)
        links.append(own)
        rows.append((*map(len, ids), len(groups), len(own), ";".join(groups)))
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(n, best.get(j, 0))
    return [(*r, sum(counts[x] == best[x[1]] for x in own), sum(counts[x] for x in own)) for r, own in zip(rows, links, strict=True)]


def aligned_rows(rows):
    return {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups, r.n_best, r.count_sum) for r in rows}


PARTS = ["a", "bc", " ", "  ", "\n", "\t", "é", "▁", "'s", "1", "!!", "漢", "\x85", "\x1c", "́", "the", " word", "<s>", "<|endoftext|>", "\x00"]


@pytest.mark.parametrize("limit", [alignment.MAX_BROADCAST, 0])
def test_alignment_equals_plain_version(spark, vocabularies, limit):
    rng = random.Random(5)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(30))) for _ in range(300)] + [None, "", " ", "  a", "a" * 900, "x y", "x y", "b "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("links", F.lit("x"))
    found = aligned_rows(alignment.align(docs, A_FILE, B_FILE, max_broadcast=limit).collect())
    expected = plain_alignment(texts, *vocabularies)
    assert [found[i] for i in range(len(texts))] == expected
    assert any(t and not r[0] for t, r in zip(texts, expected, strict=True))


def test_alignment_query_equals_plain_version(spark, vocabularies):
    docs = documents(spark)
    found = {r.doc_id: r for r in queries.queries()["op12_alignment"](spark, SF).collect()}
    for (doc, _), (n_a, n_b, n_groups, n_links, groups, n_best, total) in zip(docs, plain_alignment([t for _, t in docs], *vocabularies), strict=True):
        r = found[doc]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum) == (n_a, n_b, n_groups, n_links, n_best, total)
        assert r.groups_sha256 == (sha(groups) if groups else "")


@pytest.mark.parametrize("limit", [alignment.MAX_BROADCAST, 0])
def test_alignment_of_edge_cases(spark, edge, vocabularies, limit):
    rows = alignment.align(edge, A_FILE, B_FILE, max_broadcast=limit).collect()
    assert len(rows) == len(EDGE) and {r.windows for r in rows} == {"x"}
    for r in rows:
        ids = (vocabularies[0].encode(" " + r.text, add_special_tokens=False).ids, vocabularies[1].encode(r.text)) if r.text else ([], [])
        assert (r.n_a, r.n_b) == tuple(map(len, ids)) and r.n_links == r.n_a + r.n_b - r.n_groups
    assert alignment.align(edge.limit(0), A_FILE, B_FILE, max_broadcast=limit).count() == 0


def test_forgotten_words_are_aligned_again(vocabularies, monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    known = alignment.Words(*[kind(alignment._content(f)) for kind, f in ((alignment.ByteTokens, A_FILE), (alignment.PieceTokens, B_FILE))])
    for words in (["one", "two"], ["three", "one", "four"], ["five", "one"], ["one"]):
        groups = [known.groups[i] for i in known.numbers([words]).tolist()]
        assert groups == [r[4] for r in plain_alignment(words, *vocabularies)]
    assert len(known.number) == 2


def test_shared_cuts_equal_intersection():
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        ends = [np.unique(np.append(rng.integers(1, n + 1, int(rng.integers(0, n + 1))), n)) for _ in range(2)]
        first, last = np.array([0]), [np.array([len(e) - 1]) for e in ends]
        cut = alignment.shared_cuts(*ends, first, last[0], first, last[1])
        assert ends[0][cut].tolist() == np.intersect1d(*ends).tolist()


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        alignment.ByteTokens(alignment._content(A_FILE.replace("byte_bpe_50k", "word_bpe_49k")))


# --- suffix dedup -------------------------------------------------------------------------------


def plain_removed(docs, threshold):
    """(doc_id, bytes, removed bytes, spans, kept) by a table of all windows."""
    place = lambda d: -(1 << 63) if d is None else d
    data, least = [(d, (t or "").encode()) for d, t in docs], {}
    for d, b in data:
        for i in range(len(b) - threshold + 1):
            w = b[i : i + threshold]
            least[w] = min(place(d), least.get(w, place(d)))
    out = []
    for d, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - threshold + 1):
            if least[b[i : i + threshold]] < place(d):
                gone[i : i + threshold] = b"\1" * threshold
        spans = sum(g and not before for before, g in zip(b"\0" + gone, gone, strict=False))
        out.append((d, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return sorted(out, key=str)


def removed_rows(rows):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows), key=str)


@pytest.mark.parametrize("threshold", [50, 20, 7, 1])
def test_suffix_dedup_equals_plain_version(spark, threshold):
    rng = random.Random(threshold)
    pool = ["".join(rng.choice("ab é") for _ in range(rng.randrange(1, 90))) for _ in range(6)]
    more = lambda: chr(rng.randrange(97, 123)) * rng.randrange(1, 150)
    docs = [(rng.choice([i, i, i % 7, None]), "".join(rng.choice([*pool, more()]) for _ in range(rng.randrange(7)))) for i in range(60)]
    docs += [(500, None), (501, ""), (502, "a" * 3000), (503, "a" * 2900), (3, "a" * 1000), (504, "ab" * 800), (505, "ba" * 800)]
    rows = suffixdedup.dedup(spark.createDataFrame(docs, "doc_id long, text string"), threshold).collect()
    assert removed_rows(rows) == plain_removed(docs, threshold)
    for r in rows:
        assert sum(s.length for s in r.spans) == r.n_removed


def test_suffix_dedup_query_equals_plain_version(spark):
    expected = [(d, n, gone, spans, hashlib.sha256(kept).hexdigest()) for d, n, gone, spans, kept in plain_removed(documents(spark), 50)]
    assert sorted(map(tuple, queries.queries()["op13_suffix_dedup"](spark, SF).collect()), key=str) == sorted(expected, key=str)
    assert any(r[2] for r in expected)


def test_suffix_dedup_of_edge_cases(spark, edge):
    rows = suffixdedup.dedup(edge).collect()
    assert removed_rows(rows) == plain_removed(EDGE, 50) and {r.doc for r in rows} == {"x"}
    assert suffixdedup.dedup(edge.limit(0)).count() == 0


def test_parts_of_a_long_text_lose_no_window(spark, monkeypatch):
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefgh") for _ in range(3 << 20))
    docs = [(1, text), (2, text[(1 << 20) - 40 : (1 << 20) + 30]), (3, "x" + text[(2 << 20) - 1 : (2 << 20) + 60] + "y"), (4, text[100:400_000])]
    found = {r.doc_id: (r.n_removed, r.n_spans) for r in suffixdedup.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert found == {1: (0, 0), 2: (70, 1), 3: (61, 1), 4: (399_900, 1)}
