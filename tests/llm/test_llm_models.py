"""Held-out accuracy of the trained operators, their edge cases, and the pipeline against its parts."""

import random
import re

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from visitrisk.llm import langid, queries, toxicity

SF = "/root/testdata/sf0.1"
SMALL = "/root/testdata/sf0.01"

INSULTS = r"(?i)\b(trash|pathetic|idiot|worthless|disgusting|stupid|clown|scum|loser|moron)\b"


def test_language_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = queries.queries()["op5_language"](spark, SF).join(truth, "doc_id")
    found = {r.held_out: r for r in rows.groupBy("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"), F.count("*").alias("n"), F.min("score").alias("low"), F.max("score").alias("high")).collect()}
    assert found[True].n > 2000 and found[True].right > 0.99 and found[False].right > 0.99
    assert 0 <= found[True].low and found[True].high <= 1


def test_language_edge_cases(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der Hund und die Katze", "de"), ("the house", "en"), ("das Haus", "de")] * 4)]
    rows += [(100, None, "en"), (101, "x", None), (None, "the", "en"), (102, "", "de"), (103, "123 !", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash")).withColumn("grams", F.lit(1))
    model = langid.fit(docs)
    asked = spark.createDataFrame([(1, None), (2, ""), (3, "42 !?"), (4, "the dog"), (5, "die Katze"), (6, "漢字"), (7, "the dog " * 50_000)], "doc_id long, text string")
    found = {r.doc_id: r for r in langid.predict(asked, model).collect()}
    assert [found[i].lang_pred for i in (1, 2, 3, 4, 5, 7)] == ["und", "und", "und", "en", "de", "en"]
    assert found[6].lang_pred in ("en", "de") and not found[6].known and found[4].known
    assert found[1].score == 0 and found[1].text is None
    assert langid.fit(docs.limit(0)) is None and langid.fit(docs.filter("text = ''")) is None
    assert {r.lang_pred for r in langid.predict(asked, None).collect()} == {"und"}
    assert langid.predict(asked.limit(0), model).count() == 0


def test_kernel_is_presence_cosine():
    import numpy as np

    a, b = langid.ngrams("Ab, ab"), langid.ngrams("ab c")
    common = len(np.intersect1d(a, b))
    grams = np.unique(b)
    kernel, sizes = langid.kernels(["Ab, ab"], grams, np.full((len(grams), 1), 1 / np.sqrt(len(b)), np.float32))
    assert sizes[0] == len(a) and kernel[0, 0] == pytest.approx(common / np.sqrt(len(a) * len(b)), rel=1e-5)


def test_toxicity_held_out(spark):
    rows = queries.queries()["op1_toxicity"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.col("text").rlike(INSULTS).alias("insult"))
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    seen = rows.join(docs, "doc_id").filter("held_out").join(labels, "doc_id", "left")
    assert seen.filter("insult").agg(F.avg("predicted")).first()[0] > 0.95
    assert seen.filter("toxic = 0").agg(F.avg("predicted")).first()[0] < 0.01
    assert rows.filter("score < 0 OR score > 1 OR predicted <> int(score >= 0.7)").count() == 0


def test_toxicity_locates_the_sentence(spark):
    rng = random.Random(2)
    said = lambda n: " ".join(f"word{rng.randrange(400)}" for _ in range(n))
    rows = []
    for i in range(900):
        insult = f" You {rng.choice(['idiot', 'fool'])} {said(2)}." if i % 3 == 0 else ""
        rows.append((i, f"You {said(6)}. {said(5)}!{insult} " + f"{said(4)}. " * rng.randrange(6), int(i % 3 == 0) ^ (i % 50 == 1)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs.drop("toxic"), docs.drop("text"))
    asked = spark.createDataFrame([(1, "Hello. What a day! An idiot came.\nHe left."), (2, None), (3, ""), (4, "..."), (5, "Word1 word2 there. " * 40_000), (6, "Hello. " * 20_000 + "idiot fool")], "doc_id long, text string").withColumn("predicted", F.lit("clash"))
    found = {r.doc_id: r for r in toxicity.score(asked, model).collect()}
    assert [found[i].predicted for i in range(1, 7)] == [1, 0, 0, 0, 0, 1]
    assert [s.sentence for s in found[1].sentences] == [2] and found[1].n_sentences == 4
    assert [s.sentence for s in found[6].sentences] == [20_000] and found[2].score == 0
    assert toxicity.score(asked.limit(0), model).count() == 0


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (None, "c")], "doc_id long, text string")
    for labels in ([], [(1, None)], [(1, 0)], [(1, 1), (1, 1), (None, 0)]):
        model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert [r.score for r in toxicity.score(docs, model).collect()] == [0.0] * 3


def test_noisy_or():
    import numpy as np

    assert toxicity.noisy_or(np.array([0.5, 0.5, 0.2]), np.array([0, 0, 2]), 3) == pytest.approx([0.75, 0, 0.2])


TAUGHT = {
    "en": ["the cat sits on the mat", "a dog and the other dogs", "this is what they thought", "where there is a will"],
    "de": ["die Katze sitzt auf der Matte", "ein Hund und die Hunde", "das ist was wir dachten"],
    "fi": ["kissa istuu ikkunalla", "koira ja toiset koirat", "t\u00e4m\u00e4 on se mit\u00e4 ajattelimme", "miss\u00e4 on tahtoa", "p\u00f6yt\u00e4 ja tuoli"],
}


def plain_grams(text):
    line = f" {re.sub(r'[^a-z\u00e4\u00f6\u00fc\u00df]+', ' ', text.lower()).strip()} "
    return {line[i : i + n] for n in (1, 2, 3) for i in range(len(line) - n + 1)} - {" "}


def test_language_model_equals_exact_kernel_ridge(spark):
    """With every training text as a landmark, the regression is the one with the whole kernel matrix."""
    rows = [(t, lang) for lang, texts in TAUGHT.items() for t in texts]
    ridge = 0.01
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string")
    model = langid.fit(docs, training_texts=10**6, landmarks=10**6, ridge=ridge)
    kernel = lambda a, b: len(a & b) / (len(a) * len(b)) ** 0.5
    own, n = [plain_grams(t) for t, _ in rows], len(rows)
    square = np.array([[kernel(a, b) + 1 for b in own] for a in own])
    weight = np.array([n / len(TAUGHT) / len(TAUGHT[lang]) for _, lang in rows])
    answers = np.array([[1.0 if lang == of else -1.0 for of in sorted(TAUGHT)] for _, lang in rows])
    alpha = np.linalg.solve(square + ridge * n * np.diag(1 / weight), answers)
    asked = ["The dogs thought: 12 cats!", "Hunde und Katzen", "kissat ja koirat", "xyz", "e", *[t for t, _ in rows]]
    expected = np.array([[kernel(plain_grams(t), g) + 1 for g in own] for t in asked]) @ alpha
    found, letters, _ = model.decisions(asked)
    assert model.languages == sorted(TAUGHT) and letters.all()
    assert np.abs(found - expected).max() < 2e-3


def test_limit_of_the_score(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs)
    rows = langid.predict(docs, model).filter("known").select("score").toPandas()["score"].to_numpy()
    steps = np.sort(np.floor(rows * langid.STEPS))
    for kept in (1.0, 0.999, 0.9):
        least = langid.limit(docs, model, kept)
        passed = lambda at: (steps >= at).sum()
        assert passed(least) >= kept * len(steps) > 0 and (passed(least + 1) < kept * len(steps) or least == langid.STEPS)
    assert langid.limit(docs.limit(0), model) == 0 and langid.limit(docs, None) == 0


# --- pipeline -----------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    extra = spark.createDataFrame([(10**6, "12 34", "en", "s", 5), (10**6 + 1, None, None, None, None), (10**6 + 2, "", "en", "s", 0)], docs.schema)
    stages = dict(corpus_pipeline.STAGES)
    asked = docs.unionByName(extra).withColumn("known", F.lit("clash"))

    known = stages["language_id"](spark, asked, SMALL)
    assert known.columns == docs.columns and {r.doc_id for r in docs.collect()} - {r.doc_id for r in known.collect()} == {r.doc_id for r in docs.collect() if not any(c.isalpha() for c in r.text)}
    assert not {10**6, 10**6 + 1, 10**6 + 2} & {r.doc_id for r in known.collect()}
    known = corpus_pipeline.stored(known, "test")

    cut = corpus_pipeline.stored(stages["line_dedup"](spark, known, SMALL), "test")
    assert cut.columns == docs.columns and cut.filter("n_chars <> length(text)").count() == 0

    single = corpus_pipeline.stored(stages["near_dedup"](spark, cut, SMALL), "test")
    rows = [(r.doc_id, r.text) for r in cut.collect()]
    prints = {d: plain.simhash(t) for d, t in rows}
    of = plain.roots(prints.values(), plain.linked(prints.values()))
    least = {}
    for d, p in prints.items():
        least[of[p]] = min(d, least.get(of[p], d))
    assert {r.doc_id for r in single.collect()} == set(least.values()) and single.columns == docs.columns

    clean = corpus_pipeline.stored(stages["decontamination"](spark, single, SMALL), "test")
    rows = [(r.doc_id, r.text) for r in single.collect()]
    judged = plain.contamination(rows, bench)
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in rows if not judged[d][4]}
    assert sum(v[1] for v in plain.contamination([(r.doc_id, r.text) for r in clean.collect()], bench).values()) == 0

    last = stages["packing"](spark, clean, SMALL).collect()
    sizes = {r.doc_id: len(r.text.encode()) for r in clean.collect() if r.text}
    found = {}
    for r in last:
        found[r.doc_id] = found.get(r.doc_id, 0) + r.n_tokens
    assert found == sizes


def test_pipeline_runs_as_a_whole_and_on_no_documents(spark, tmp_path):
    assert corpus_pipeline.run(spark, SMALL).filter("batch_id IS NULL").count() == 0
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


UNLEARNED = [
    "T\u00e4m\u00e4 on suomenkielinen teksti, joka kertoo siit\u00e4 kuinka kissa istuu ikkunalla ja katselee lintuja pihalla.",
    "To jest polski tekst, kt\u00f3ry opowiada o tym, jak kot siedzi w oknie i patrzy na ptaki w ogrodzie.",
    "qqq zzz xkcd",
]


def test_language_stage_rejects_what_was_never_learned(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    extra = spark.createDataFrame([(10**9 + i, t, None, "s", len(t)) for i, t in enumerate(UNLEARNED)], docs.schema)
    asked, kept = docs.unionByName(extra), dict(corpus_pipeline.STAGES)["language_id"]
    found = corpus_pipeline.stored(kept(spark, asked, folder), "test")
    assert found.filter(f"doc_id >= {10**9}").count() == 0
    assert found.count() >= 0.995 * docs.count()


def test_line_stage_leaves_no_residue(spark):
    words = lambda k, n: " ".join(f"{k}{i}" for i in range(n))
    texts = [
        words("a", 80),
        words("a", 80) + " " + words("b", 9),  # fewer than ten words stay
        words("a", 80) + "\n" + words("c", 12),
        words("d", 300),
        words("d", 300) + "\n" + words("e", 20),  # less than a tenth stays
        words("d", 300) + "\n" + words("f", 40),
        "short text",
        "",
        None,
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    found = {r.doc_id: r.text for r in dict(corpus_pipeline.STAGES)["line_dedup"](spark, docs, SMALL).collect()}
    assert found == {0: texts[0], 2: words("c", 12), 3: texts[3], 5: words("f", 40), 6: "short text", 7: "", 8: None}
