"""Line, string and near-duplicate removal, and fingerprints, against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stopmetrics.llm import graph, line_dedup, merkle, simhash, suffix_dedup
from llm_fixtures import documents, empty, texts


def removed_bytes(rows, width=50):
    """Per row the bytes of strings that start in a document with a smaller id."""
    first = {}
    for doc_id, text in rows:
        raw = (text or "").encode()
        for at in range(len(raw) - width + 1):
            key = raw[at : at + width]
            first[key] = min(first.get(key, 1 << 62), 1 << 61 if doc_id is None else doc_id)
    found = []
    for doc_id, text in rows:
        raw, own = (text or "").encode(), 1 << 61 if doc_id is None else doc_id
        gone = np.zeros(len(raw), bool)
        for at in range(len(raw) - width + 1):
            if first[raw[at : at + width]] < own:
                gone[at : at + width] = True
        found.append(gone)
    return found


def test_repeated_strings_equal_brute_force(spark):
    docs = documents(spark)
    given_rows = docs.select("doc_id", "text").collect()
    expected = []
    for (doc_id, text), gone in zip(given_rows, removed_bytes(given_rows)):
        raw = np.frombuffer((text or "").encode(), np.uint8)
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(int), [0]))))
        expected.append((doc_id or -1, len(raw), raw[~gone].tobytes(), edges.tolist()))
    result = suffix_dedup.remove_repeats(docs)
    assert set(result.columns) == {"doc_id", "block", "score", "row", "kept", "n_bytes", "n_removed", "spans"}
    rows = result.collect()
    found = [
        (r.doc_id or -1, r.n_bytes, bytes(r.kept), [edge for s in r.spans for edge in (s.start, s.end)]) for r in rows
    ]
    assert sorted(found) == sorted(expected)
    assert sum(r.n_removed for r in rows) > 1000
    assert all(r.row == r.doc_id for r in rows if r.block == "kept")
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0


def test_whole_characters_stay_readable(spark):
    base = "".join(random.Random(1).choices("äöüßéèñ漢字", k=120))
    docs = spark.createDataFrame([(1, "x" + base), (2, "é" + base[1:90] + "è")], "doc_id long, text string")
    last = suffix_dedup.remove_repeats(docs, whole_characters=True).where("doc_id = 2").first()
    assert bytes(last.kept).decode() == "éè"


@settings(max_examples=60, deadline=None)
@given(st.text("abc", min_size=1, max_size=200), st.integers(0, 2**32))
def test_suffix_array_and_prefixes(text, seed):
    depth = 40
    raw = np.frombuffer(text.encode() + bytes(depth + 32), np.uint8)
    wanted = np.zeros(len(raw), bool)
    wanted[: len(text)] = np.random.default_rng(seed).random(len(text)) < 0.7
    places = suffix_dedup.suffix_array(raw, wanted, depth)
    suffix = [raw[p : p + depth].tobytes() for p in places]
    assert sorted(places.tolist()) == np.flatnonzero(wanted).tolist()
    assert suffix == sorted(suffix)
    expected = [0] * len(places)
    for i in range(1, len(places)):
        a, b = suffix[i - 1], suffix[i]
        expected[i] = next((k for k in range(depth) if a[k] != b[k]), depth)
    assert suffix_dedup.common_prefixes(raw, places, depth).tolist() == expected


def chunks_of(text, divisor=4):
    lines = (text or "").split("\n")
    hashes = [int(hashlib.md5(line.encode()).hexdigest()[:8], 16) for line in lines]
    chunks, own = [], []
    for at, line in enumerate(lines):
        own.append(line)
        if (hashes[at] + 31 * (hashes[at - 1] if at else 0)) % divisor == 0 or at == len(lines) - 1:
            chunks.append(own)
            own = []
    return chunks


def test_repeated_chunks_equal_brute_force(spark):
    docs = documents(spark)
    given_rows = docs.select("doc_id", "text").collect()
    first = {}
    for doc_id, text in given_rows:
        for place, chunk in enumerate(chunks_of(text)):
            key, at = "\n".join(chunk), (doc_id is None, doc_id or 0, place)
            first[key] = min(first.get(key, at), at)
    expected = []
    for doc_id, text in given_rows:
        kept, gone, chunks = [], 0, chunks_of(text)
        for place, chunk in enumerate(chunks):
            again = first["\n".join(chunk)] != (doc_id is None, doc_id or 0, place)
            if sum(bool(line.strip(" ")) for line in chunk) >= 2 and again:
                gone += 1
            else:
                kept.append("\n".join(chunk))
        expected.append((str(doc_id), str("\n".join(kept) if gone else text), len(chunks), gone))
    result = line_dedup.remove_repeated_chunks(docs)
    assert result.columns == [*docs.columns, "n_chunks", "n_removed"]
    rows = result.collect()
    assert sorted((str(r.doc_id), str(r.text), r.n_chunks, r.n_removed) for r in rows) == sorted(expected)
    assert sum(r.n_removed for r in rows) >= 3
    assert line_dedup.remove_repeated_chunks(empty(spark)).count() == 0


def test_chunks_need_no_python(spark):
    plan = line_dedup.remove_repeated_chunks(documents(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def plain_simhash(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(one, seed=42).intdigest() for one in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def components(values, radius):
    label = list(range(len(values)))
    for _ in values:
        for i, a in enumerate(values):
            for j, b in enumerate(values):
                if bin(a ^ b).count("1") <= radius:
                    label[i] = label[j] = min(label[i], label[j])
    return label


def test_near_duplicates_equal_brute_force(spark):
    docs = documents(spark)
    given_rows = docs.select("doc_id", "text").collect()
    prints = [plain_simhash(text) for _, text in given_rows]
    label = components(prints, 3)
    least = {}
    for (doc_id, _), group in zip(given_rows, label):
        if doc_id is not None:
            least[group] = min(least.get(group, doc_id), doc_id)
    expected = [(str(d), p, str(least.get(g))) for (d, _), p, g in zip(given_rows, prints, label)]
    rows = simhash.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), r.simhash % 2**64, str(r.component_id)) for r in rows) == sorted(expected)
    assert simhash.near_duplicates(empty(spark)).count() == 0
    kept = simhash.keep_one_per_component(docs).where("doc_id IS NOT NULL").collect()
    assert sorted(r.doc_id for r in kept) == sorted(least.values())


def test_a_repeated_id_keeps_its_different_texts(spark):
    one, other = "alpha beta gamma delta epsilon zeta", "one two three four five six seven"
    third = "red green blue white black brown"
    rows = [(1, one, "a"), (1, one, "a"), (1, other, "b"), (2, one, "c"), (2, third, "d"), (3, other, "e"), (None, one, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, simhash string")
    kept = simhash.keep_one_per_component(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.collect())) == sorted(
        map(str, spark.createDataFrame([rows[i] for i in (0, 2, 4, 6)], docs.schema).collect())
    )


def test_covering_masks_cover():
    pick = random.Random(3)
    masks = simhash.covering_masks(3)
    assert len(masks) == 15
    for _ in range(3000):
        differing = sum(1 << bit for bit in pick.sample(range(64), 3))
        assert any(mask & differing == 0 for mask in masks)


def test_large_buckets_split_without_loss(monkeypatch):
    monkeypatch.setattr(simhash, "_BRUTE", 20)
    pick = random.Random(5)
    values = sorted({0x1234 << 40 | pick.getrandbits(14) << 3 for _ in range(150)})
    links = simhash.bucket_links(np.array(values, dtype=np.uint64), 3)
    label = {value: value for value in values}
    for _ in values:
        for a, b in links:
            assert bin(a ^ b).count("1") <= 3
            label[a] = label[b] = min(label[a], label[b])
    assert [label[value] for value in values] == [values[i] for i in components(values, 3)]


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    frame = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    found = {r.node: r.component for r in graph.connected_components(frame).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}
    assert graph.connected_components(frame.limit(0)).count() == 0


def test_merkle_comparison_equals_brute_force(spark):
    docs = documents(spark).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    ordered = sorted((r.doc_id, r.text or "") for r in docs.collect())
    rows = {r.doc_id: r for r in merkle.compare_with_edit(docs).collect()}
    assert len(rows) == len(ordered)
    for at, (doc_id, text) in enumerate(ordered):
        after = ordered[(at + 1) % len(ordered)][1]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        row = rows[doc_id]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.fingerprint == merkle.merkle_tree(text).fingerprint
        assert row.edited_fingerprint == merkle.merkle_tree(edited).fingerprint
        tree, changed = merkle.merkle_tree(text), merkle.merkle_tree(edited)
        assert [(span.start, span.end) for span in row.edited_spans] == merkle.edited_spans(tree, changed)
        assert row.near_edited == pytest.approx(plain_likeness(tree, changed))
        assert row.near_next == pytest.approx(plain_likeness(tree, merkle.merkle_tree(after)))
        assert 0 <= row.near_next <= 1 and (row.fingerprint == row.edited_fingerprint) == (text == edited)
        if len(text.split()) > 40 and len(set(text)) > 8:
            assert row.near_edited > 0.5
    assert merkle.compare_with_edit(docs.limit(0)).count() == 0


def test_merkle_of_one_and_of_repeated_documents(spark):
    one = spark.createDataFrame([(5, "abcdefgh", "x")], "doc_id long, text string, run string")
    assert merkle.compare_with_edit(one).first().edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()
    assert merkle.compare_with_edit(documents(spark)).count() == documents(spark).count()


def test_trees_locate_edits(spark):
    lines = [f"Paragraph {i} has words of its own, number {i * i}.\n" for i in range(40)]
    changed = [*lines]
    changed[17] = "Something else altogether.\n"
    tree, other = merkle.merkle_tree("".join(lines)), merkle.merkle_tree("".join(changed))
    assert tree.root != other.root
    assert ["".join(lines).encode()[a:b].decode() for a, b in merkle.edited_spans(tree, other)] == [lines[17]]
    assert merkle.edited_spans(tree, tree) == []
    marked = merkle.fingerprints(documents(spark)).collect()
    for row in marked:
        own = merkle.merkle_tree(row.text)
        assert row.tree.root == own.root and row.tree.fingerprint == own.fingerprint
        assert [p.hash % 2**64 for p in row.tree.paragraphs] == own.paragraphs


@pytest.mark.parametrize(("a", "b", "expected"), [("", "", 1.0), ("a b c d", "", 0.0), ("same text", "same text", 1.0)])
def test_likeness_ends(a, b, expected):
    assert merkle.likeness(merkle.merkle_tree(a).fingerprint, merkle.merkle_tree(b).fingerprint) == expected


def plain_likeness(tree, other):
    """Share of common leaves, by counting all of them."""
    mine, theirs = ([phrase % 2**24 for phrase in one.phrases] for one in (tree, other))
    if tree.root == other.root:
        return 1.0
    shared = sum(min(mine.count(leaf), theirs.count(leaf)) for leaf in set(mine))
    return 2 * shared / (len(mine) + len(theirs)) if mine and theirs else 0.0


def plain_lacking(tree, other):
    """How many bytes the leaves have of which the other tree has fewer, by counting all of them."""
    size = dict(zip(tree.phrases, np.diff([0, *tree.ends]).tolist()))
    return sum(size[leaf] * max(0, tree.phrases.count(leaf) - other.phrases.count(leaf)) for leaf in size)


def test_likeness_and_edits_by_the_tree_equal_counting_all_leaves():
    pick = random.Random(9)
    lines = [f"{name} number {i} went {way} and came home again late." for i in range(25) for name in "AB" for way in ("up", "down")]
    given_texts = [text or "" for text in texts() if len(text or "") < 10_000]
    for _ in range(25):
        held = pick.choices(lines, k=pick.randrange(1, 60))
        given_texts.append("\n".join(held))
        held[pick.randrange(len(held))] = "an edited line, with other words"
        given_texts.append("\n".join(held) + pick.choice(["", "\n", "\n\n"]))
    trees = [merkle.merkle_tree(text) for text in given_texts]
    for tree, text in zip(trees, given_texts):
        assert tree.fingerprint.count(";") == len(tree.sections) and tree.ends[-1:] == [len(text.encode())][: len(tree.ends)]
        assert merkle._leaves(tree.fingerprint) == len(tree.phrases) == tree.first[-1]
    for at, tree in enumerate(trees):
        for other in trees[max(0, at - 3) : at + 4]:
            near = merkle.likeness(tree.fingerprint, other.fingerprint)
            assert abs(near - plain_likeness(tree, other)) < 1e-12
    once = [f"{i} is a line of its own, told once in this text of {i * 7} words.\n" for i in range(60)]
    for _ in range(20):
        changed = [line for line in once if pick.random() > 0.1]
        changed[pick.randrange(len(changed))] = "Something else altogether.\n"
        a, b = merkle.merkle_tree("".join(once)), merkle.merkle_tree("".join(changed))
        for tree, other in ((a, b), (b, a)):
            spans = merkle.edited_spans(tree, other)
            assert sum(end - start for start, end in spans) == plain_lacking(tree, other)
            edited = [span for span, paragraph in zip(tree.spans, tree.paragraphs) if paragraph not in other.paragraphs]
            assert {byte for span in spans for byte in range(*span)} <= {byte for span in edited for byte in range(*span)}
            assert all(end < start for (_, end), (start, _) in zip(spans, spans[1:]))


def test_fixture_has_long_texts():
    assert max(len(text or "") for text in texts()) > 30_000 and F is not None
