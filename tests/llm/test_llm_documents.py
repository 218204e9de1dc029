"""Decontamination, quality rules, SimHash and line dedup against plain versions; edge cases of each."""

import itertools
import random

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from visitrisk.llm import components, decontam, linededup, passages, quality, queries, simhash

SF = "/root/testdata/sf0.001"
SF_LARGER = "/root/testdata/sf0.01"

LONG = " ".join(f"word{i % 977} other{i}" for i in range(60_000))
PASSAGE = " ".join(f"p{i}" for i in range(60))
EDGE = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b"),
    (4, "One."),
    (5, LONG),
    (6, f"start here\n{PASSAGE}\nend"),
    (7, f"Different start\n{PASSAGE}\nother end"),
    (7, f"Different start\n{PASSAGE}\nother end"),
    (8, PASSAGE),
    (9, "Ünïcode é 漢字 😀 " * 30),
    (None, f"no id\n{PASSAGE}"),
    (None, None),
    (10, "!!! ### |||"),
    (11, "ab\x00cd \x7f ef"),
]


@pytest.fixture(scope="module")
def edge(spark):
    rows = spark.createDataFrame(EDGE, "doc_id long, text string")
    clashing = ("score", "n_words", "bits", "fingerprint", "runs", "kept", "first", "last", "own", "a", "b", "root", "key", "rows", "contaminated", "lang_pred", "item", "n")
    return rows.select("*", *[F.lit("x").alias(c) for c in clashing])


def documents(spark, sf=SF):
    return [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


# --- decontamination ----------------------------------------------------------------------------


def contaminated(rows):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows), key=str)


def test_decontamination_equals_plain_version(spark):
    bench = [tuple(r) for r in spark.read.parquet(f"{SF_LARGER}/benchmark.parquet").collect()]
    expected = plain.contamination(documents(spark, SF_LARGER), bench)
    found = queries.queries()["op2_decontamination"](spark, SF_LARGER).collect()
    assert contaminated(found) == sorted(((k, *v) for k, v in expected.items()), key=str)
    assert any(r.contaminated for r in found) and not all(r.contaminated for r in found)


BENCH = [(1, PASSAGE), (2, "word1 other1 word2"), (3, None), (4, "..."), (None, "Ünïcode É 漢字"), (5, "ünïcode é 漢字 ünïcode"), (6, "one")]


@pytest.mark.parametrize("limit", [200_000, 7])
def test_decontamination_of_edge_cases_in_one_or_more_slices(spark, edge, limit):
    bench = spark.createDataFrame(BENCH, "item_id long, text string").withColumn("hash", F.lit(1))
    found = decontam.decontaminate(edge, bench, broadcast_windows=limit).collect()
    expected = [(doc, *plain.contamination([(doc, text)], [("" if i is None else i, t) for i, t in BENCH])[doc]) for doc, text in EDGE]
    assert contaminated(found) == sorted(expected, key=str)
    clean = {r.doc_id: r.clean_text for r in found if r.doc_id}
    assert clean[6] == "start here\n\nend" and clean[4] == "." and clean[1] is None and clean[2] == ""
    assert {r.score for r in found} == {"x"}


def test_decontamination_of_empty_tables(spark, edge):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontam.decontaminate(edge, none).collect())
    assert decontam.decontaminate(edge.limit(0), none).count() == 0


def test_short_windows_do_not_cross_texts(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a b", "c d", "b c"])], "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame([(1, "b c")], "item_id long, text string")
    assert [r.n_hit for r in decontam.decontaminate(docs, bench).orderBy("doc_id").collect()] == [0, 0, 2]


# --- quality rules ------------------------------------------------------------------------------


def test_rule_counts_equal_plain_version(spark):
    docs = dict(documents(spark, SF_LARGER))
    rows = queries.queries()["op3_quality"](spark, SF_LARGER).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, chars, symbols, lines, repeated = plain.rule_counts(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeated)
        assert r.base_failed == (n < 10 or 100 * repeated > 20 * n)
        assert not (r.kept and r.base_failed)


def test_quality_keeps_good_and_refuses_bad_rows(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.queries()["op3_quality"](spark, sf).filter("NOT base_failed").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    share = {r.quality: r.share for r in rows.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert share[1] > 0.99 and share[0] < 0.2


@pytest.mark.parametrize("refused_good", [0.002, 0.05])
def test_kept_rows_equal_plain_version(spark, refused_good):
    docs, labels = (spark.read.parquet(f"{SF_LARGER}/{name}.parquet") for name in ("documents", "labels"))
    counted = quality.stored(quality.with_counts(docs.select("doc_id", "text"), texts=False), "counted")
    trees, size = quality.fit(counted)
    marks = {r.doc_id: r.quality for r in labels.collect()}
    found = {r.doc_id: r for r in quality.judge(docs, labels, refused_good).collect()}
    scores = {}
    for r in counted.collect():
        values = quality.statistics(np.array([[r[c] for c in quality.COUNTS.names]]))[0]
        scores[r.doc_id] = plain.isolation(values.tolist(), trees, size)
        assert scores[r.doc_id] == pytest.approx(found[r.doc_id].anomaly, abs=1e-9)
    passed = {d: found[d].anomaly for d in scores if not found[d].base_failed and marks.get(d) is not None}
    good, bad = ([x for d, x in passed.items() if (marks[d] > 0) == kind] for kind in (True, False))
    limit = plain.calibrated(good, bad, refused_good, quality.GRID)
    assert good and bad and 0 < limit < 1
    assert {d: r.kept for d, r in found.items()} == {d: not r.base_failed and r.anomaly < limit for d, r in found.items()}
    assert 0 < sum(not r.kept and not r.base_failed for r in found.values()) < len(found)


def test_quality_of_edge_cases(spark, edge):
    labels = spark.createDataFrame([(6, None, 1)], "doc_id long, quality int, toxic int")
    rows = quality.judge(edge, labels).collect()
    found = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows), key=str)
    assert found == sorted(((doc, *plain.rule_counts(text)) for doc, text in EDGE), key=str)
    assert all(r.kept != r.base_failed for r in rows)  # no labels: nothing more is refused
    assert quality.judge(edge.limit(0), labels).count() == 0


def test_isolation_forest_finds_the_outlier(spark):
    values = [[0.01 * random.Random(i).random(), 0.1 * random.Random(-i).random(), 1.0] for i in range(500)] + [[0.9, 3.0, 0.2]]
    rows, rng = np.array(values), np.random.default_rng(1)
    trees = [quality.grow(rows[rng.choice(len(rows), 256, replace=False)], rng) for _ in range(50)]
    scores = quality.anomaly(rows, trees, 256)
    assert scores.argmax() == 500 and scores[500] > np.quantile(scores[:500], 0.99)


# --- SimHash ------------------------------------------------------------------------------------


def expected_components(docs):
    prints = [plain.simhash(t) for _, t in docs]
    of = plain.roots(prints, plain.linked(prints))
    least = {}
    for (doc, _), p in zip(docs, prints, strict=True):
        if doc is not None:
            least[of[p]] = min(doc, least.get(of[p], doc))
    return sorted(((doc, f"{p:016x}", least.get(of[p])) for (doc, _), p in zip(docs, prints, strict=True)), key=str)


def test_near_duplicates_equal_plain_version(spark):
    docs = documents(spark, SF_LARGER)
    found = sorted(map(tuple, queries.queries()["op4_simhash"](spark, SF_LARGER).collect()), key=str)
    assert found == expected_components(docs)
    assert any(int(c) != d for d, _, c in found)


def test_near_duplicates_of_edge_cases(spark, edge):
    found = simhash.near_duplicates(edge).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, found), key=str) == expected_components(EDGE)
    assert simhash.near_duplicates(edge.limit(0)).count() == 0


@pytest.mark.parametrize("crowd", [256, 2, 0])
def test_crowded_keys_lose_no_link(spark, crowd):
    rng = random.Random(7)
    centres = [rng.getrandbits(64) for _ in range(6)] + [0]
    prints = {c for c in centres}
    for c in centres:
        for n in range(120):
            prints.add(c ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(1, 6))}))
    rows = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "bits long")
    found = [(a % (1 << 64), b % (1 << 64)) for a, b in simhash.links(rows, crowd).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in found)
    assert plain.roots(prints, found) == plain.roots(prints, plain.linked(prints))


def test_one_document_of_each_group_stays(spark):
    docs = [(3, "a b c d"), (2, "a b c d"), (2, "a b c d"), (9, "other words stand here"), (None, "a b c d"), (8, None), (5, "")]
    kept = simhash.one_of_each(spark.createDataFrame(docs, "doc_id long, text string").withColumn("bits", F.lit(0)))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(2, "a b c d"), (5, ""), (9, "other words stand here")]


def test_components_equal_plain_version(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(90)]
    edges += [(7, 7), (1, 0), (1, 0)]
    found = dict(map(tuple, components.components(spark.createDataFrame([*edges, (None, 3)], "a long, b long")).collect()))
    real = [(a, b) for a, b in edges if a != b]
    assert found == plain.roots({n for e in real for n in e}, real)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- line dedup ---------------------------------------------------------------------------------


def deduplicated(docs, min_words):
    """Expected (doc_id, text) of distinct documents in the operator's order."""
    import xxhash

    def place(doc):
        hashed = 42 if doc[1] is None else xxhash.xxh64_intdigest(doc[1].encode(), 42)
        return (doc[0] is not None, doc[0] or 0, hashed - (1 << 64) if hashed >> 63 else hashed)

    ordered = sorted(set(docs), key=place)
    gone = plain.removed_lines([(d, d[1]) for d in ordered], min_words)
    return {d: "\n".join(x for i, x in enumerate(d[1].split("\n")) if i not in gone[d]) if d[1] else d[1] for d in ordered}


@pytest.mark.parametrize("min_words", [50, 3, 1])
def test_line_dedup_equals_plain_version(spark, min_words):
    docs = documents(spark)
    expected = deduplicated(docs, min_words)
    found = linededup.dedup_lines(spark.read.parquet(f"{SF}/documents.parquet"), min_words).collect()
    assert sorted((r.doc_id, r.text) for r in found) == sorted((d[0], t) for d, t in expected.items())
    assert sum(r.n_removed for r in found) > 0


def test_line_dedup_query_equals_plain_version(spark):
    expected = deduplicated(documents(spark, SF_LARGER), linededup.MIN_WORDS)
    found = queries.queries()["op6_line_dedup"](spark, SF_LARGER).collect()
    assert sorted((r.doc_id, r.text) for r in found) == sorted((d[0], t) for d, t in expected.items())


def test_line_dedup_of_edge_cases(spark, edge):
    expected = deduplicated(EDGE, 50)
    found = linededup.dedup_lines(edge).collect()
    assert sorted(((r.doc_id, r.text) for r in found), key=str) == sorted(((d[0], expected[d]) for d in EDGE), key=str)
    of = {r.doc_id: r for r in found if r.doc_id}
    assert of[6].text == "start here\nend" and of[8].text == "" and of[8].n_removed == 1 and of[8].removed_words == 60
    assert linededup.dedup_lines(edge.limit(0)).count() == 0


def test_line_dedup_of_random_runs(spark):
    rng = random.Random(5)
    docs = [(i, "\n".join(rng.choice(["a b", "c", "d e f", "", "g", "a b c d e"]) for _ in range(rng.randrange(30)))) for i in range(60)]
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)

    def worded(text):  # of the lines without words, those between two windows stay, but go with a maximal run
        return [x for x in text.split("\n") if x.split()]

    for min_words in (2, 6):
        expected = deduplicated(docs, min_words)
        assert sorted((r.doc_id, worded(r.text)) for r in linededup.dedup_lines(rows, min_words).collect()) == sorted((d[0], worded(t)) for d, t in expected.items())


@pytest.mark.parametrize("sizes", [(60, 5), (40, 20, 5), (5, 60), (20, 40, 10, 30, 3)])
def test_repeated_run_goes_to_its_last_line(spark, sizes):
    run = [" ".join(f"r{k}w{i}" for i in range(n)) for k, n in enumerate(sizes)]
    docs = [(1, "\n".join(["one begins", *run, "one ends"])), (2, "\n".join(["two begins", *run, "two ends"])), (3, "\n".join(run))]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r.doc_id: r.text for r in linededup.dedup_lines(rows).collect()}
    assert found == {1: docs[0][1], 2: "two begins\ntwo ends", 3: ""}


def test_no_passage_of_over_fifty_words_is_left_twice(spark):
    kept = queries.queries()["op6_line_dedup"](spark, SF_LARGER).select("text").collect()
    lines = [x for r in kept for x in (r.text or "").split("\n") if len(x.split()) >= 50]
    assert len(lines) == len(set(lines))
    assert list(itertools.islice(lines, 1))


# --- passage dedup ------------------------------------------------------------------------------


def passages_cut(docs, n):
    """Expected (words left, words cut) of documents with distinct ids, in order."""
    seen, out = set(), {}
    for doc, text in docs:
        words, gone = plain.SPACE_WORD.findall(text or ""), set()
        for i in range(len(words) - n + 1):
            if (w := tuple(words[i : i + n])) in seen:
                gone |= set(range(i, i + n))
            seen.add(w)
        out[doc] = ([w for i, w in enumerate(words) if i not in gone], len(gone))
    return out


def same_cut(found, docs, n):
    return {r.doc_id: (plain.SPACE_WORD.findall(r.text or ""), r.n_cut) for r in found} == passages_cut(docs, n)


def test_passage_inside_lines_that_differ_goes(spark):
    docs = [(1, f"one {PASSAGE} begins here\nnext"), (2, f"other  start {PASSAGE.replace('p30 ', 'p30\n\n')} and\tend \n\nlast"), (3, PASSAGE), (4, None), (5, "")]
    rows = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_cut", F.lit("x"))
    found = {r.doc_id: (r.text, r.n_cut) for r in passages.cut_passages(rows).collect()}
    assert found == {1: (docs[0][1], 0), 2: ("other  start\nand\tend \n\nlast", 60), 3: ("", 60), 4: (None, 0), 5: ("", 0)}


@pytest.mark.parametrize("min_words", [50, 12])
def test_passages_equal_plain_version(spark, min_words):
    docs = sorted(documents(spark, SF_LARGER))
    rows = spark.read.parquet(f"{SF_LARGER}/documents.parquet")
    found = passages.cut_passages(rows, min_words).collect()
    assert same_cut(found, docs, min_words) and sum(r.n_cut for r in found) > 0


def test_passages_of_random_texts(spark):
    rng = random.Random(8)
    docs = [(i, "".join(rng.choice(["a", "b", "ü"]) + rng.choice([" ", "\n", "  ", "\n\n"]) for _ in range(rng.randrange(40)))) for i in range(80)]
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    for n in (1, 3, 7):
        assert same_cut(passages.cut_passages(rows, n).collect(), docs, n)


def test_passages_of_edge_cases(spark, edge):
    found = passages.cut_passages(edge).collect()
    assert len(found) == len(EDGE) and {r.text for r in found if r.doc_id is None} == {None, f"no id\n{PASSAGE}"}
    assert [r.text for r in found if r.doc_id == 7] == ["Different start\nother end"] * 2
    assert passages.cut_passages(edge.limit(0)).count() == 0
