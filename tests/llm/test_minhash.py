"""MinHash near-duplicates against all pairs of full shingle sets."""

from __future__ import annotations

import random

import numpy as np
import pytest

from stopmetrics.llm import hot_keys, minhash
from llm_fixtures import documents, empty


def plain_set(text, width=2):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = lowered.encode().split()
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows, width=2, percent=80):
    """Sorted (doc_id or -1, size, component or -1, kept) by comparing all pairs."""
    sets = [plain_set(text, width) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if shared and 100 * shared >= percent * (len(a) + len(sets[j]) - shared):
                root[find(i)] = find(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    found = []
    for i, (doc_id, _) in enumerate(rows):
        least = min((one for one in groups[find(i)] if one is not None), default=None)
        kept = least is None or doc_id == least
        found.append((-1 if doc_id is None else doc_id, len(sets[i]), -1 if least is None else least, kept))
    return sorted(found)


def got(result):
    return sorted((-1 if r[0] is None else r[0], r[1], -1 if r[2] is None else r[2], r[3]) for r in result.collect())


def near_texts():
    """Families of texts with all shares of words changed, and chains in which only neighbours are alike."""
    pick = random.Random(3)
    words = [f"w{i}" for i in range(4000)]
    found = []
    for family in range(25):
        base = pick.choices(words, k=pick.choice((8, 30, 120, 400)))
        for copy in range(6):
            changed = list(base)
            for at in pick.sample(range(len(base)), k=len(base) * copy // 60):
                changed[at] = pick.choice(words)
            found.append(" ".join(changed))
    chain = pick.choices(words, k=200)
    for _ in range(15):
        found.append(" ".join(chain))
        at = pick.randrange(180)
        chain[at : at + 8] = pick.choices(words, k=8)
    found += ["Lone", "lone", "lone\n", "two Words", "TWO words", "Ä b", "ä b", "\x1c a", "a"]
    return found


def test_components_equal_all_pairs(spark):
    rows = [(i * 3 % 211 if i % 40 else None, text) for i, text in enumerate(near_texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(minhash.near_duplicates(docs, words_per_shingle=2)) == brute(rows)


def test_every_corner_document_has_its_row(spark):
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(minhash.near_duplicates(docs, words_per_shingle=2)) == brute(rows)
    assert got(minhash.near_duplicates(docs)) == brute(rows, width=5)
    assert minhash.near_duplicates(empty(spark)).count() == 0


def test_few_bands_leave_the_rest_to_open_buckets(spark, monkeypatch):
    """Small blocks and representatives' groups, all keys cold or hot: the same components."""
    rows = [(i, text) for i, text in enumerate(near_texts()[:90])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(minhash, "_BLOCK", 700)
    monkeypatch.setattr(minhash, "_SHINGLES", 7)
    assert got(minhash.near_duplicates(docs, words_per_shingle=2, bands=30, rows=2)) == brute(rows)


def test_large_group_of_near_copies(spark):
    pick = random.Random(5)
    base = [f"v{i}" for i in range(150)]
    rows = []
    for i in range(700):
        own = list(base)
        own[pick.randrange(150)] = f"own{i}"
        rows.append((i + 10, " ".join(own)))
    docs = spark.createDataFrame(rows + [(5, "something else altogether")], "doc_id long, text string")
    found = minhash.near_duplicates(docs, words_per_shingle=2).collect()
    assert {(r.component_id, r.kept) for r in found} == {(10, True), (10, False), (5, True)}
    assert sum(r.kept for r in found) == 2


def test_minhashes_estimate_similarity():
    functions = minhash.Minhashes(bands=200, rows=1)
    pick = np.random.default_rng(1)
    for share in (0.2, 0.5, 0.8, 0.95):
        both = int(400 * share)
        pool = pick.integers(0, 1 << 63, size=800, dtype=np.uint64)
        a, b = pool[:400], np.concatenate((pool[:both], pool[400 : 800 - both]))
        equal = (functions.sketch(a)[0] == functions.sketch(b)[0]).mean()
        assert abs(equal - both / (800 - both)) < 0.08


@pytest.mark.parametrize("hot", [1, 3, 10_000])
def test_counted_join_keeps_every_row(spark, hot):
    rows = spark.createDataFrame([(i % 7 if i % 50 else None, i) for i in range(300)] + [(99, -1)] * 60, "k int, v int")
    table = rows.where("k <> 3").groupBy("k").count().withColumnRenamed("count", "n")
    joined = hot_keys.join_counted(rows, table, ["k"], "n", hot_keys=hot)
    assert sorted(tuple(r) for r in joined.collect()) == sorted(tuple(r) for r in rows.join(table, "k").collect())
    assert hot_keys.join_counted(rows, table.limit(0), ["k"], "n").count() == 0
