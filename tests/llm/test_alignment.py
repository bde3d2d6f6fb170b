"""Cross-tokenizer alignment against a plain walk over byte ranges."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from stopmetrics.llm import token_alignment
from llm_fixtures import documents, empty, texts

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_tokens(text):
    """(id, bytes) of both tokenizers, or nothing where either loses bytes."""
    if not text:
        return [], []
    a = Tokenizer.from_file(PATHS[0]) if not hasattr(byte_tokens, "a") else byte_tokens.a
    byte_tokens.a = a
    a.encode_special_tokens = True
    found = a.encode(" " + text, add_special_tokens=False)
    whole, raw_a, at = (" " + text).encode(), [], 0
    letters = {chr(b): b for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(letters.values()))}
    raw_a = [(i, bytes(letters[c] for c in token)) for i, token in zip(found.ids, found.tokens)]
    model = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    raw_b = []
    for i in model.encode(text):
        piece = model.id_to_piece(i)
        hexed = re.fullmatch("<0x(..)>", piece)
        raw_b.append((i, bytes([int(hexed[1], 16)]) if hexed else piece.replace("▁", " ").encode()))
    for raw in (raw_a, raw_b):
        if b"".join(token for _, token in raw) != whole:
            return [], []
    return raw_a, raw_b


def spans(raw):
    at, found = 0, []
    for i, token in raw:
        found.append((i, at, at + len(token)))
        at += len(token)
    return found


def plain(listed):
    per_doc, counts = [], Counter()
    for text in listed:
        a, b = map(spans, byte_tokens(text))
        links = [(i, j) for i, s, e in a for j, t, f in b if max(s, t) < min(e, f)] if len(a) < 3000 else None
        if links is None:  # the same by walking both lists
            links, j = [], 0
            for i, s, e in a:
                while b[j][2] <= s:
                    j += 1
                k = j
                while k < len(b) and b[k][1] < e:
                    links.append((i, b[k][0]))
                    k += 1
        both = sorted({e for _, _, e in a} & {f for _, _, f in b})
        groups, at = [], 0
        by_end_a, by_end_b = defaultdict(list), defaultdict(list)
        for one, into in ((a, by_end_a), (b, by_end_b)):
            k = 0
            for i, _, e in one:
                into[both[k]].append(str(i))
                k += e == both[k]
        groups = [",".join(by_end_a[e]) + "|" + ",".join(by_end_b[e]) for e in both]
        per_doc.append((len(a), len(b), groups, links))
        counts.update(set(links))
    best = defaultdict(int)
    for (i, _), n in counts.items():
        best[i] = max(best[i], n)
    return [
        (
            n_a,
            n_b,
            len(groups),
            len(links),
            sum(counts[link] == best[link[0]] for link in links),
            sum(counts[link] for link in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for n_a, n_b, groups, links in per_doc
    ]


MORE = ["aaaaaaaaaaa aaa aaaa", "xaaa  aaa", "</s> <0x41> <s> ▁ under", "tab\tand\r\nline", "naïve 東京 \U0001f600!", "\x00 zero"]


@pytest.mark.parametrize("hot_pairs", [1, 40, 1 << 19])
def test_alignment_equals_plain_walk(spark, hot_pairs):
    docs = documents(spark).unionByName(
        spark.createDataFrame([(900 + i, text) for i, text in enumerate(MORE)], "doc_id long, text string"),
        allowMissingColumns=True,
    )
    listed = docs.select("doc_id", "text").collect()
    expected = [(row.doc_id or -1, *one) for row, one in zip(listed, plain([row.text for row in listed]))]
    result = token_alignment.align_corpus(docs, *PATHS, hot_pairs=hot_pairs)
    found = [(-1 if row[0] is None else row[0], *row[1:]) for row in result.collect()]
    assert sorted((a or -1, *rest) for a, *rest in found) == sorted(expected)
    assert result.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_texts_that_do_not_come_back_have_no_tokens(spark):
    rows = [(1, None), (2, ""), (3, "lower ▁ one eighth block")]
    found = token_alignment.align_corpus(spark.createDataFrame(rows, "doc_id long, text string"), *PATHS).collect()
    assert [tuple(row[1:]) for row in found] == [(0, 0, 0, 0, 0, 0, "")] * 3
    assert token_alignment.align_corpus(empty(spark), *PATHS).count() == 0


def test_plain_texts_are_merged_like_the_library():
    tokens = token_alignment.Aligner.of_worker(*PATHS).a
    assert tokens.fast
    pick = random.Random(2)
    letters = [chr(i) for i in range(0x10000) if token_alignment._PLAIN.fullmatch(chr(i))]
    listed = ["".join(pick.choices(letters[:200] if i % 2 else letters, k=60)) for i in range(400)]
    listed += ["".join(pick.choices("ab '\n\t\r st12.,é", k=40)) for _ in range(400)] + ["<|endoftext|>"]
    expected = tokens.library.encode_batch([" " + text for text in listed], add_special_tokens=False)
    assert [ids.tolist() for ids in tokens.encode(listed)] == [one.ids for one in expected]


def test_same_bytes_in_a_shifted_group_count_once():
    aligner = token_alignment.Aligner.of_worker(*PATHS)
    found = aligner.align(texts()[0:1] + [""] + ["hello world"]).to_pydict()
    assert found["n_links"][1] == 0 and found["groups_sha256"][1] == ""
    for i in (0, 2):
        assert sum(found["same_n"][i]) + sum(found["pair_n"][i]) == found["n_links"][i]
        assert found["n_links"][i] == found["n_a"][i] + found["n_b"][i] - found["n_groups"][i]
