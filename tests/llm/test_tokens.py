"""Token files, packing and byte-level BPE against the tokenizers and tiktoken libraries."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import Whitespace

from stopmetrics.llm import byte_bpe, packing, token_files
from stopmetrics.llm.word_tokens import WordTokenizer
from stopmetrics.scratch import new_folder
from llm_fixtures import documents, empty, texts

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(WORDS)
    return lambda text: found.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def tik():
    ranks = byte_bpe.load_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_words_encode_like_the_library(text):
    whole = WordTokenizer.of_worker(WORDS)
    expected = np.array(whole.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert whole.encode([text]) == [expected]


SPECIAL = ["hello <|endoftext|> world", "a<|StartOfText|>b <|startoftext|>c", "<|endoftext|>", "no <|end of text|>"]


@pytest.mark.parametrize("as_text", [False, True])
def test_special_tokens_are_what_the_untouched_library_makes_of_them(as_text):
    untouched = Tokenizer.from_file(WORDS)
    if as_text:
        untouched.encode_special_tokens = True
    expected = [np.array(untouched.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in SPECIAL]
    assert WordTokenizer.of_worker(WORDS, as_text).encode(SPECIAL) == expected


def test_packing_without_ids_places_alike(spark):
    docs = documents(spark)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    with_ids = packing.pack(docs, WORDS, end_id=1, capacity=64).select(*columns).collect()
    without = packing.pack(docs, WORDS, end_id=1, capacity=64, with_ids=False)
    assert without.where("ids IS NOT NULL").count() == 0
    assert sorted(map(str, without.select(*columns).collect())) == sorted(map(str, with_ids))


def test_long_words_and_a_full_memory(library):
    small = WordTokenizer(WORDS, memo_limit=3)
    for text in texts() * 2:
        assert small.encode([text])[0] == np.array(library(text), "<u4").tobytes()


def test_words_are_encoded_once_whatever_signs_follow(library, monkeypatch):
    whole = WordTokenizer(WORDS)
    asked = []
    letters = whole._ids_of_letters
    monkeypatch.setattr(whole, "_ids_of_letters", lambda words: asked.extend(words) or letters(words))
    rows = ["Zorbel zorbel, (zorbel) don't zorbel's", "zorbel.%%% zorbel### été*** ... '' 42&&& !?zorbel«", "zorbel;"]
    long = "q" * 100
    for text in [*rows, f"{long} {long}, zorbel:"]:
        assert whole.encode([text])[0] == np.array(library(text), "<u4").tobytes()
    assert asked.count("zorbel") == 1
    assert "zorbel," not in whole.memo and long not in whole.memo


def test_a_file_that_cuts_otherwise_keeps_its_own_steps(tmp_path):
    other = Tokenizer.from_file(WORDS)
    other.pre_tokenizer = Whitespace()
    other.save(path := str(tmp_path / "other.json"))
    own = WordTokenizer(path)
    assert own.of_letters is own.library
    assert WordTokenizer(WORDS).of_letters is not WordTokenizer(WORDS).library


def test_token_files_round_trip(spark, library):
    path = new_folder(spark, "tokens")
    docs = documents(spark)
    token_files.write_token_files(docs, path, WORDS, end_id=2)
    files = token_files.read_token_files(spark, path)
    rows = token_files.with_starts(token_files.token_digests(files), files, "ids_crc32").collect()
    given_rows = docs.select("doc_id", "text").collect()
    expected = sorted(((d is not None, d or 0), crc([*library(t), 2]), len(library(t)) + 1) for d, t in given_rows)
    assert sorted(((r.doc_id is not None, r.doc_id or 0), r.ids_crc32, r.n_tokens) for r in rows) == expected
    at = 0
    for row in sorted(rows, key=lambda r: r.start):
        assert row.start == at
        at += row.n_tokens
    in_order = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert in_order == sorted(in_order, key=lambda d: (d is not None, d))
    one = files.where(F.col("doc_id") == 4)
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,4)]" in one._jdf.queryExecution().toString()
    assert one.first().ids == [*library(texts()[4]), 2]


def test_token_files_of_no_documents(spark):
    path = new_folder(spark, "tokens")
    token_files.write_token_files(empty(spark), path, WORDS, end_id=2)
    files = token_files.read_token_files(spark, path)
    assert token_files.with_starts(token_files.token_digests(files), files).count() == 0


def plain_best_fit(lengths, capacity):
    """Piece by piece into the tightest open bin; returns the sorted remaining capacities."""
    bins = []
    for length in sorted(lengths, reverse=True):
        fitting = [room for room in bins if room >= length]
        if fitting:
            tightest = min(fitting)
            bins.remove(tightest)
            bins.append(tightest - length)
        else:
            bins.append(capacity - length)
    return sorted(bins)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_plan_equals_piece_by_piece(lengths):
    counts = {length: lengths.count(length) for length in set(lengths)}
    plan = packing.best_fit_plan(counts.items(), 20)
    load = {}
    for length, number in counts.items():
        rows = plan[plan[:, 0] == length]
        rows = rows[np.argsort(rows[:, 1])]
        for rank in range(number):
            _, first, per, at, offset = rows[rows[:, 1] <= rank][-1]
            load.setdefault(at + (rank - first) // per, []).append((offset + (rank - first) % per * length, length))
    for pieces in load.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
    assert sorted(20 - sum(size for _, size in one) for one in load.values()) == plain_best_fit(lengths, 20)


def test_packing_of_documents(spark, library):
    docs = documents(spark)
    rows = packing.pack(docs, WORDS, end_id=1, capacity=64).collect()
    expected = []
    for doc_id, text in docs.select("doc_id", "text").collect():
        ids = [*library(text), 1]
        expected += [(doc_id or -1, p, a, crc(ids[a : a + 64])) for p, a in enumerate(range(0, len(ids), 64))]
    assert sorted((r.doc_id or -1, r.piece, r.start, r.ids_crc32) for r in rows) == sorted(expected)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)
    load = {}
    for row in rows:
        load.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for pieces in load.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 64
    assert len(load) == len(plain_best_fit([r.length for r in rows], 64))
    assert packing.pack(empty(spark), WORDS, end_id=1).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_byte_bpe_encodes_like_tiktoken(text):
    bpe = byte_bpe.ByteBpe.of_worker(RANKS, public_tokenizers.PATTERN)
    if not hasattr(test_byte_bpe_encodes_like_tiktoken, "tik"):
        test_byte_bpe_encodes_like_tiktoken.tik = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={}
        )
    expected = test_byte_bpe_encodes_like_tiktoken.tik.encode_ordinary(text)
    assert np.frombuffer(bpe.encode([text])[0], "<u4").tolist() == expected
    assert bpe.decode([np.array(expected)]) == [text.encode()]


def test_long_words_merge_like_tiktoken(tik, monkeypatch):
    monkeypatch.setattr(byte_bpe, "_BYTES", 20_000)
    bpe = byte_bpe.ByteBpe(RANKS, public_tokenizers.PATTERN)
    pick = random.Random(6)
    words = ["ab" * 150, "the" * 120, "abcdefghijklmnopqrstuvwxyz" * 14, "x" * 32, "x" * 33, "x" * 399, "=" * 5001, "xy" * 30_000 + "z"]
    words += ["".join(pick.choices("aex", k=pick.randrange(20, 200))) for _ in range(60)]
    words += ["".join(chr(pick.randrange(0x4E00, 0x5E00)) for _ in range(130)) for _ in range(120)]
    for word, ids in zip(words, bpe.merge_words([word.encode() for word in words])):
        assert ids.tolist() == tik._encode_single_piece(word), word[:60]
    settings_of = "SELECT current_setting('temp_directory'), current_setting('memory_limit')"
    folder, limit = bpe.duck.execute(settings_of).fetchone()
    assert not folder and limit == "286.1 MiB"


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from("abx=é日"), min_size=1, max_size=60), min_size=1, max_size=8))
def test_both_recursions_make_the_same_merges(words):
    bpe = byte_bpe.ByteBpe.of_worker(RANKS, public_tokenizers.PATTERN)
    raw = [word.encode() for word in words]
    all_rounds, in_place = (bpe._merge(raw, query) for query in (byte_bpe._MERGE, byte_bpe._MERGE_IN_PLACE))
    assert [ids.tolist() for ids in all_rounds] == [ids.tolist() for ids in in_place]


def test_byte_bpe_merges_a_word_once_whatever_signs_follow(tik, monkeypatch):
    bpe = byte_bpe.ByteBpe(RANKS, public_tokenizers.PATTERN, memo_limit=40)
    merged = []
    merge = bpe._merge
    monkeypatch.setattr(bpe, "_merge", lambda words, query: merged.extend(words) or merge(words, query))
    rows = ["a zorbelqux, zorbelqux", "so zorbelqux.%%% zorbelqux### it's zorbelqux's été*** ... '' 42&&&", "if zorbelqux;"]
    for text in [*rows, "zorbelqux" * 20 + ", x", "\0 \0a\xff zorbelqux'll ’s", *texts()]:
        ids = np.frombuffer(bpe.encode([text])[0], "<u4")
        assert ids.tolist() == tik.encode_ordinary(text or "")
        assert bpe.decode([ids]) == [(text or "").encode()]
        assert bpe.digest(ids) == hashlib.sha256(" ".join(map(str, ids.tolist())).encode()).hexdigest()
    assert merged.count(b" zorbelqux") == 1


def test_decoding_in_parts(tik, monkeypatch):
    monkeypatch.setattr(byte_bpe, "_IDS", 7)
    bpe = byte_bpe.ByteBpe.of_worker(RANKS, public_tokenizers.PATTERN)
    given_texts = ["", "one two three four five six seven eight nine ten", "日本語", ""]
    assert bpe.decode([np.array(tik.encode_ordinary(text), "<u4") for text in given_texts]) == [t.encode() for t in given_texts]


def test_byte_bpe_of_documents(spark, tik):
    docs = documents(spark).withColumn("ids", F.lit("replaced"))
    coded = byte_bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN)
    rows = byte_bpe.decode_documents(coded, RANKS, public_tokenizers.PATTERN)
    rows = byte_bpe.round_trip(rows, RANKS, public_tokenizers.PATTERN).collect()
    assert len(rows) == docs.count()
    for row in rows:
        ids = tik.encode_ordinary(row.text or "")
        assert np.frombuffer(bytes(row.ids), "<u4").tolist() == ids
        assert bytes(row.decoded) == (row.text or "").encode()
        assert bytes(row.coded.ids) == bytes(row.ids) and bytes(row.coded.decoded) == bytes(row.decoded)
        assert row.coded.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert byte_bpe.encode_documents(empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0


def test_ranks_are_base64(tmp_path):
    (tmp_path / "r").write_bytes(base64.b64encode(b"ab") + b" 7\n")
    assert byte_bpe.load_ranks(str(tmp_path / "r")) == {b"ab": 7}
