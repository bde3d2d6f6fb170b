"""Toxicity, quality, top-k search and the pipeline."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stopmetrics.llm import quality, toxicity, voronoi
from llm_fixtures import documents, empty

CLEAN = "river stone walks under open sky while birds sing over green fields of wheat".split()


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    pick = random.Random(2)
    automaton = toxicity.LexiconAutomaton(toxicity.SEED_TERMS)
    words = set()
    for term in toxicity.SEED_TERMS:
        for _ in range(120):
            word = list(term)
            for _ in range(pick.randint(0, 3)):
                at = pick.randrange(len(word) + 1)
                word[at : at + pick.randint(0, 1)] = pick.choice(["", "a", "t", "oo"])
            words.add("".join(word))
    for word in sorted(words):
        near = [(distance(word, t), t) for t in toxicity.SEED_TERMS]
        allowed = [(d, t) for d, t in near if d <= (0 if len(t) < 5 else 1 if len(t) < 9 else 2)]
        found = automaton.match(word)
        assert (found is None) == (not allowed), word
        assert found is None or (found[1], found[0]) == min(allowed)


def labelled(spark):
    pick = random.Random(11)
    rows, labels = [], []
    for i in range(400):
        words = pick.choices(CLEAN, k=40)
        toxic = int(i % 4 == 0)
        for _ in range(3 * toxic):
            words[pick.randrange(40)] = pick.choice(["idiot", "moron", "zarkel"])
        rows.append((i, " ".join(words), 0.5))
        labels.append((i, toxic, toxic, "noise"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    labels += [(None, 1, 1, ""), (9999, None, None, ""), labels[0]]
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int, quality int, text string")


def test_toxicity_learns_and_holds_out(spark):
    docs, labels = labelled(spark)
    model = toxicity.fit_toxicity(docs, labels)
    assert "zarkel" in model.terms
    assert not set(CLEAN) & set(model.terms)
    rows = toxicity.score_toxicity(docs, model).collect()
    assert all(r.predicted == int(r.doc_id % 4 == 0) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    told = spark.createDataFrame(
        [(1, "you are such an idiiot my friend"), (2, "the river sings"), (3, None), (4, "")], "doc_id long, text string"
    )
    found = {r.doc_id: r for r in toxicity.score_toxicity(told, model).collect()}
    assert found[1].predicted == 1 and found[1].hits[0].term == "idiot" and found[1].hits[0].edits == 1
    assert found[2].predicted == found[3].predicted == found[4].predicted == 0
    assert found[2].score == found[3].score


def test_context_tells_quotation_from_abuse():
    automaton = toxicity.LexiconAutomaton(toxicity.SEED_TERMS)

    def quoted(text):
        return [hit["quoted"] for hit in toxicity.find_hits(text, automaton, frozenset())]

    assert quoted('The word "idiot" is old.') == [True]
    assert quoted("He wrote idiot on the wall, and the rest was silence for many years; you moron") == [True, False]
    assert quoted("You idiot.") == [False]
    assert [h["term"] for h in toxicity.find_hits("what an 1di0t", automaton, frozenset())] == ["idiot"]
    assert toxicity.find_hits("uses idiott often", automaton, frozenset(["idiott"])) == []


def test_toxicity_without_labels_or_documents(spark):
    docs, labels = labelled(spark)
    model = toxicity.fit_toxicity(docs, labels.limit(0))
    assert model.terms == tuple(sorted(toxicity.SEED_TERMS))
    model = toxicity.fit_toxicity(docs.limit(0), labels)
    assert toxicity.score_toxicity(empty(spark), model).count() == 0
    assert toxicity.score_toxicity(documents(spark), model).count() == documents(spark).count()


def test_quality_separates_and_orders_grades(spark):
    pick = random.Random(4)
    rows, labels = [], []
    for i in range(500):
        grade = i % 4
        words = [w.upper() + "%%%" if pick.random() > grade / 3 else w for w in pick.choices(CLEAN, k=30)]
        rows.append((i, " ".join(words), 1))
        labels.append((i, grade))
    docs = spark.createDataFrame(rows, "doc_id long, text string, latent int")
    rated = spark.createDataFrame([*labels, (None, 3), (7777, None)], "doc_id long, quality int")
    model = quality.fit_quality(docs, rated, grades=4)
    assert list(model.thresholds) == sorted(model.thresholds)
    again = quality.fit_quality(docs.repartition(5), rated, grades=4)
    assert np.allclose(model.vector, again.vector, atol=1e-4)
    scored = quality.score_quality(docs, model, tail_from=2).collect()
    expected = np.array([r.expected_grade for r in scored])
    grade = np.array([r.doc_id % 4 for r in scored])
    assert np.corrcoef(expected, grade)[0, 1] > 0.85
    assert np.mean([(r.tail_probability >= 0.5) == (r.doc_id % 4 >= 2) for r in scored]) > 0.85
    odd = quality.score_quality(documents(spark), model)
    assert odd.count() == documents(spark).count()
    assert odd.where("text IS NULL").first().latent == 0
    assert quality.score_quality(empty(spark), quality.fit_quality(docs.limit(0), rated)).count() == 0


def test_ordinal_fit_reaches_what_a_slow_optimiser_finds():
    pick = random.Random(12)
    rows, grades = [], []
    for _ in range(90):
        held = sorted(pick.sample(range(5), pick.randrange(0, 4)))
        rows.append(np.array(held, dtype=np.int64))
        lean = 2 * (0 in held) - 1.5 * (1 in held) + pick.gauss(0, 1)
        grades.append(int(lean > -0.5) + int(lean > 1))
    ridge = 0.01

    def loss(weights, thresholds):
        total = 0.0
        for row, grade in zip(rows, grades):
            z = sum(weights[j] for j in row) / max(1, len(row)) ** 0.5
            tail = [1.0, *(1 / (1 + np.exp(t - z)) for t in thresholds), 0.0]
            total -= np.log(max(tail[grade] - tail[grade + 1], 1e-300))
        return total / len(rows) + ridge / 2 * sum(w * w for w in weights)

    at, step = [0.0] * 5 + [-0.5, 0.5], 1.0  # one coordinate at a time, with shrinking steps
    best = loss(at[:5], at[5:])
    while step > 1e-3:
        moved = False
        for j in range(7):
            for change in (step, -step):
                tried = [*at]
                tried[j] += change
                if tried[5] < tried[6] and (now := loss(tried[:5], tried[5:])) < best - 1e-12:
                    at, best, moved = tried, now, True
        step = step if moved else step / 2
    model = quality.fit_ordinal(rows, np.array(grades), 3, 5, steps=600, ridge=ridge)
    assert list(model.thresholds) == sorted(model.thresholds) and len(model.thresholds) == 2
    assert loss(model.vector.tolist(), model.thresholds) < best + 1e-3
    assert np.allclose(model.vector, at[:5], atol=0.1) and np.allclose(model.thresholds, at[5:], atol=0.1)


def test_quality_scores_equal_a_plain_computation(spark):
    model = quality.OrdinalModel(np.linspace(-2, 3, 64).astype("<f4").tobytes(), (-0.5, 0.25, 1.0))
    docs = documents(spark).withColumn("tail_probabilities", F.lit("replaced"))
    for row in quality.score_quality(docs, model, tail_from=3).collect():
        held = quality.features(row.text, 64, {})
        z = float(np.linspace(-2, 3, 64).astype("<f4")[held].sum()) / max(1, len(held)) ** 0.5
        tails = [1 / (1 + np.exp(t - z)) for t in model.thresholds]
        assert np.allclose(row.tail_probabilities, tails, atol=1e-5) and tails == sorted(tails, reverse=True)
        assert abs(row.expected_grade - sum(tails)) < 1e-4 and row.tail_probability == row.tail_probabilities[2]


@pytest.mark.parametrize("copies", [0, 300])
def test_top_k_equals_brute_force(spark, monkeypatch, copies):
    monkeypatch.setattr(voronoi, "_BLOCK_ROWS", 50)
    monkeypatch.setattr(voronoi, "_BLOCK_QUERIES", 4)
    rng = np.random.default_rng(8)
    vectors = {i: rng.normal(size=6).tolist() for i in range(200)} | {i: [1.0] * 6 for i in range(200, 200 + copies)}
    rows = [(i, v, "clash") for i, v in vectors.items()]
    rows += [(900, None, ""), (920, [1.0, None], ""), (940, [float("nan")] * 6, ""), (None, [1.0] * 6, ""), (960, [], "")]
    rows += [(980, [float("inf"), 0.0], "")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cell string")
    found = {}
    for r in voronoi.top_k(frame, F.col("vec_id") % 20 == 0, k=7, pivots=9).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    whole = {i: np.floor(64 * np.array(v)) for i, v in vectors.items()}
    for query in (i for i in vectors if i % 20 == 0):
        best = sorted((-int(whole[query] @ x), i) for i, x in whole.items() if i != query)[:7]
        assert sorted(found.pop(query)) == [(n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert not found
    assert voronoi.top_k(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    docs, labels = labelled(spark)
    docs = docs.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    extra = documents(spark).select(
        (F.col("doc_id") + 1000).alias("doc_id"), "text", F.lit(None).cast("string").alias("lang"), F.col("block").alias("source"), F.lit(1).cast("long").alias("n_chars")
    )
    docs.drop("score").unionByName(extra).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    sizes = [now.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == list(corpus_pipeline.COLUMNS), name
        now.write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        sizes.append(now.count())
        if name == "toxicity":
            assert now.where("doc_id < 1000 AND doc_id % 4 = 0").count() == 0
            assert now.where("doc_id < 1000 AND doc_id % 4 <> 0").count() == 300
    assert sizes == sorted(sizes, reverse=True)
    assert now.where("n_chars <> coalesce(length(text), 0)").count() == 0
    packed = corpus_pipeline.run(spark, str(tmp_path)).cache()
    assert packed.select("doc_id").distinct().count() == now.select("doc_id").distinct().count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0


def test_registered_names():
    from stopmetrics.llm import queries

    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.queries())
    assert numbers == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(queries.queries())
