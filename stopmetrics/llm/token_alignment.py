"""Alignment of two tokenizers over a corpus: which tokens of one cover the bytes of which tokens of the other."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopmetrics.llm.worker_memory import release_memory
from stopmetrics.scratch import written

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark already runs one task per core

_BATCH_BYTES = 1 << 20  # text aligned at a time
_PAIR = 32  # bits of the second id in a pair's key
HOT_PAIRS = 1 << 19
_NONE = np.zeros(0, dtype=np.uint32)
# Fixed value: the words of the library's byte-level splitter.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters whose class no version of Unicode or engine disputes.
_PLAIN = re.compile("[\t\n\r -~\u00a1-\u00ac\u00ae-\u024f\u0370-\u0373\u0391-\u03a1\u03a3-\u03ff\u0400-\u04ff‐-‧‹›…€\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5]*")


def _byte_letters() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [byte for byte in range(256) if byte not in set(plain)]
    return {chr(byte): byte for byte in plain} | {chr(0x100 + i): byte for i, byte in enumerate(rest)}


class ByteLevelTokens:
    """A byte-level BPE file of the tokenizers library; special tokens in a text are ordinary text.

    Where the file's merges are numbered in their order, a text of plain characters, which all engines split into words
    alike, is merged by tiktoken, which is faster; any other text goes to the library.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        letters = _byte_letters()
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.tokens = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, number in vocabulary.items():
            known = all(letter in letters for letter in token)
            self.tokens[number] = bytes(letters[a] for a in token) if known else token.encode()
        self.fast = self._fast(json.loads(Path(path).read_text(encoding="utf-8")))

    def _fast(self, file: dict) -> tiktoken.Encoding | None:
        splits = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        cut = file.get("pre_tokenizer") or {}
        if file.get("normalizer") or any(cut.get(name) != value for name, value in splits.items()):
            return None
        model = file["model"]
        pairs = [tuple(merge.split(" ")) if isinstance(merge, str) else tuple(merge) for merge in model["merges"]]
        places = [model["vocab"].get(a + b) for a, b in pairs]
        if places != list(range(256, 256 + len(pairs))) or model.get("ignore_merges"):
            return None
        ranks = {token: number for number, token in enumerate(self.tokens[: 256 + len(pairs)])}
        return tiktoken.Encoding("plain", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of a space and each text."""
        found: list[np.ndarray] = [_NONE] * len(texts)
        rare = []
        for i, text in enumerate(texts):
            if self.fast and _PLAIN.fullmatch(text):
                found[i] = self.fast.encode_to_numpy(" " + text, disallowed_special=())
            else:
                rare.append(i)
        coded = self.library.encode_batch_fast([" " + texts[i] for i in rare], add_special_tokens=False)
        for i, one in zip(rare, coded):
            found[i] = np.array(one.ids, dtype=np.uint32)
        return found


class PieceTokens:
    """A sentencepiece model, which puts a space before the text itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.tokens = [
            bytes([int(piece[3:5], 16)]) if self.library.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(pieces)
        ]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        return [np.array(ids, dtype=np.uint32) for ids in self.library.encode(texts, num_threads=1)]


class Aligner:
    """Both tokenizers and the tables that depend on their vocabularies only."""

    _loaded: dict[tuple[str, str], Aligner] = {}

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = ByteLevelTokens(path_a), PieceTokens(path_b)
        self.length_a = np.array([len(token) for token in self.a.tokens], dtype=np.int64)
        self.length_b = np.array([len(token) for token in self.b.tokens], dtype=np.int64)
        self.same = identity_map(self.a.tokens, self.b.tokens)
        self.forms = _written_forms(len(self.a.tokens), len(self.b.tokens))
        self.form_length = (self.forms != 0).sum(axis=1)

    @classmethod
    def of_worker(cls, path_a: str, path_b: str) -> Aligner:
        """The aligner of this Python process, loaded once."""
        if (path_a, path_b) not in cls._loaded:
            cls._loaded[path_a, path_b] = cls(path_a, path_b)
        return cls._loaded[path_a, path_b]

    def _ids(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both; none for a text that is empty or that either tokenizer does not give back byte by byte."""
        ids_a, ids_b = self.a.encode(texts), self.b.encode(texts)
        for i, text in enumerate(texts):
            whole = b" " + text.encode("utf-8", "surrogatepass")
            if not text or any(
                b"".join(map(side.tokens.__getitem__, ids.tolist())) != whole
                for side, ids in ((self.a, ids_a[i]), (self.b, ids_b[i]))
            ):
                ids_a[i] = ids_b[i] = _NONE
        return ids_a, ids_b

    def align(self, texts: list[str]) -> pa.RecordBatch:
        """One row per text: counts, the written groups' digest, and its links by distinct id or pair.

        All texts are laid end to end; both tokenizers end a token at the end of each, so no group or link reaches over.
        """
        listed_a, listed_b = self._ids(texts)
        n = len(texts)
        n_a, n_b = (np.array([len(ids) for ids in listed], dtype=np.int64) for listed in (listed_a, listed_b))
        a, b = (np.concatenate([_NONE, *listed]).astype(np.int64) for listed in (listed_a, listed_b))
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        # Marks and their numbers so far, by byte offset.
        is_a, is_b = np.zeros((2, int(ends_a[-1]) + 1 if len(a) else 1), dtype=bool)
        is_a[ends_a] = is_b[ends_b] = True
        number_a, number_b = np.cumsum(is_a, dtype=np.int32), np.cumsum(is_b, dtype=np.int32)
        groups = np.cumsum(is_a & is_b, dtype=np.int32)

        # Links: the ends of both cut the bytes into stretches, each under one token of A and one of B.
        cuts = np.flatnonzero(is_a | is_b)
        at_a = number_a[cuts] - is_a[cuts]
        link_a, link_b = a[at_a], b[number_b[cuts] - is_b[cuts]]
        doc_a = np.repeat(np.arange(n), n_a)
        doc = doc_a[at_a]
        regular = self.same[link_a] == link_b
        size_a, size_b = len(self.length_a), len(self.length_b)
        ids, id_docs, id_n = _counted(doc[regular], link_a[regular], size_a)
        pairs, pair_docs, pair_n = _counted(doc[~regular], link_a[~regular] * size_b + link_b[~regular], size_a * size_b)
        pairs = pairs // size_b << _PAIR | pairs % size_b

        # The written form lists the groups in order, the tokens of A before those of B in each.
        last_a, last_b = is_b[ends_a], is_a[ends_b]
        shared = np.flatnonzero(is_a & is_b)
        b_before = np.concatenate(([0], number_b[shared]))
        forms = np.empty(len(a) + len(b), dtype=np.int64)
        forms[np.arange(len(a)) + b_before[groups[ends_a] - last_a]] = a + last_a * size_a
        forms[np.arange(len(b)) + number_a[shared][groups[ends_b] - last_b]] = b + 2 * size_a + last_b * size_b
        letters = self.forms[forms]
        spelled = letters[letters != 0].tobytes()
        ends = np.concatenate(([0], np.cumsum(self.form_length[forms])))[np.concatenate(([0], np.cumsum(n_a + n_b)))].tolist()
        digests = [
            hashlib.sha256(spelled[start : end - 1]).hexdigest() if end > start else ""
            for start, end in zip(ends[:-1], ends[1:])
        ]
        n_groups, n_links = np.bincount(doc_a[last_a], minlength=n), np.bincount(doc, minlength=n)
        lists = [
            _lists(values, docs, n)
            for values, docs in (
                (ids.astype(np.int32), id_docs),
                (id_n.astype(np.int32), id_docs),
                (pairs, pair_docs),
                (pair_n.astype(np.int32), pair_docs),
            )
        ]
        longs = [pa.array(values.astype(np.int64)) for values in (n_a, n_b, n_groups, n_links)]
        return pa.RecordBatch.from_arrays([*longs, pa.array(digests, pa.string()), *lists], names=_NAMES)


_NAMES = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "same_ids", "same_n", "pairs", "pair_n"]
_ALIGNED = (
    "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "same_ids array<int>, same_n array<int>, pairs array<long>, pair_n array<int>"
)


def identity_map(tokens_a: list[bytes], tokens_b: list[bytes]) -> np.ndarray:
    """For each A id the B id of the same bytes, -1 without one; of several B ids the greatest, a piece before a lone byte."""
    by_bytes = {token: number for number, token in enumerate(tokens_b)}
    return np.array([by_bytes.get(token, -1) for token in tokens_a], dtype=np.int64)


def _counted(doc: np.ndarray, key: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys, all below `size`, of each document, ordered by document, with their documents and numbers."""
    both, number = np.unique(doc * size + key, return_counts=True)
    return both % size, both // size, number


def _written_forms(size_a: int, size_b: int) -> np.ndarray:
    """Letters, zero behind their end, of each token's number and what follows it: `,` and `|` for A, `,` and `;` for B."""
    listed = [f"{i}{after}" for size, last in ((size_a, "|"), (size_b, ";")) for after in ("," + last) for i in range(size)]
    letters = np.array(listed, dtype=bytes)
    return letters.view(np.uint8).reshape(len(letters), -1)


def _lists(values: np.ndarray, docs: np.ndarray, n: int) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(np.bincount(docs, minlength=n)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _portions(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """The texts in runs of bounded size, NULL as empty; a longer text is a run of its own."""
    at, held, size = 0, [], 0
    for i, text in enumerate(texts):
        if held and size + len(text or "") > _BATCH_BYTES:
            yield at, held
            at, held, size = i, [], 0
        held.append(text or "")
        size += len(held[-1])
    if held:
        yield at, held


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, same_ids, same_n, pairs, pair_n) per row of `docs`, written once.

    `same_ids` are the A ids linked to the B id of the same bytes, `pairs` the keys of all other links, each with the
    number of its occurrences in the document.
    """

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner.of_worker(path_a, path_b)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                for at, texts in _portions(part.column(1).to_pylist()):
                    found = aligner.align(texts)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).slice(at, len(texts)), *found.columns], names=["doc_id", *_NAMES]
                    )
        release_memory()

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = texts.mapInArrow(of_batches, f"doc_id long, {_ALIGNED}")
    return written(found.withColumn("row", F.monotonically_increasing_id()), "aligned")


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the row of each."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(column.offsets.to_numpy())
    return values, np.repeat(np.arange(len(column)), lengths)


def same_counts(rows: DataFrame, size: int) -> np.ndarray:
    """By A id, the number of documents that link it to the B id of the same bytes.

    Every task counts in one vector of vocabulary length and gives its counts once; they meet in sums by id, of which
    there are at most `size`.
    """

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, dtype=np.int64)
        for batch in batches:
            counts += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], names=["id", "n"])

    summed = rows.select("same_ids").mapInArrow(of_batches, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(size, dtype=np.int64)
    for number, n in summed.collect():
        counts[number] = n
    return counts


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n): the number of documents that hold each other pair linked; written once."""
    each = rows.select(F.explode("pairs").alias("pair"))
    return written(each.groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "pairs")


def align_corpus(docs: DataFrame, path_a: str, path_b: str, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row of `docs` (doc_id, text, ...).

    A is a byte-level BPE file, given a space and the text; B a sentencepiece model, which adds the space itself. Byte
    offsets where both end a token cut the text into groups; tokens whose bytes overlap are linked. A pair's count is the
    number of rows that hold it linked anywhere. `n_best` counts the links with the highest count of their A id,
    `count_sum` sums the counts of all links. A text that is NULL, empty, or that either tokenizer does not give back byte
    by byte has no tokens: zeros and an empty digest. Rows that repeat, with or without an id, count each; no documents
    give no rows; further columns of `docs` are not used. A single text is aligned in memory as a whole.

    Most groups are one A token over the B token of the same bytes. Such links are told by a precomputed map from A id to
    B id and counted in vectors of vocabulary length. Only the other links enter a shuffle by pair. The counts return the
    same way: vectors of vocabulary length, and the pairs with more than a `hot_pairs`-th of all counted pairs, of which
    there are fewer than `hot_pairs`, go to every task. The rest join by pair, where no pair holds more than that share.
    """
    spark = docs.sparkSession
    rows = aligned(docs, path_a, path_b)
    size = len(Aligner.of_worker(path_a, path_b).same)
    by_id = same_counts(rows, size)
    pairs = pair_counts(rows)
    best = by_id.copy()
    highest = pairs.groupBy(F.shiftright("pair", _PAIR).alias("id")).agg(F.max("n").alias("n"))
    for number, n in highest.collect():
        best[number] = max(best[number], n)
    total = pairs.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") > total // hot_pairs
    listed = pairs.where(is_hot).toArrow()
    order = np.argsort(listed.column("pair").to_numpy())
    tables = spark.sparkContext.broadcast(
        (by_id, best, listed.column("pair").to_numpy()[order], listed.column("n").to_numpy()[order])
    )

    def is_known(keys: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(hot):
            return np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=np.int64)
        place = np.minimum(np.searchsorted(hot, keys), len(hot) - 1)
        return hot[place] == keys, place

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_id, best, hot, hot_n = tables.value
        for batch in batches:
            n_best, count_sum = np.zeros(batch.num_rows, dtype=np.int64), np.zeros(batch.num_rows, dtype=np.int64)
            ids, row = _flat(batch.column(1))
            times = _flat(batch.column(2))[0].astype(np.int64)
            np.add.at(n_best, row, times * (by_id[ids] == best[ids]))
            np.add.at(count_sum, row, times * by_id[ids])
            keys, row = _flat(batch.column(3))
            times = _flat(batch.column(4))[0].astype(np.int64)
            known, place = is_known(keys, hot)
            n, times, row, ids = hot_n[place[known]], times[known], row[known], keys[known] >> _PAIR
            np.add.at(n_best, row, times * (n == best[ids]))
            np.add.at(count_sum, row, times * n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_best), pa.array(count_sum)], names=["row", "n_best", "count_sum"]
            )
        release_memory()

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, best, hot, _ = tables.value
        for batch in batches:
            keys, row = _flat(batch.column(1))
            times = _flat(batch.column(2))[0]
            left = ~is_known(keys, hot)[0]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row[left])),
                    pa.array(keys[left]),
                    pa.array(times[left].astype(np.int64)),
                    pa.array(best[keys[left] >> _PAIR]),
                ],
                names=["row", "pair", "times", "best"],
            )
        release_memory()

    known = rows.select("row", "same_ids", "same_n", "pairs", "pair_n").mapInArrow(
        sums, "row long, n_best long, count_sum long"
    )
    unknown = rows.select("row", "pairs", "pair_n").mapInArrow(rare, "row long, pair long, times long, best long")
    priced = unknown.join(pairs.where(~is_hot), "pair").select(
        "row",
        F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(F.lit(0)).alias("n_best"),
        (F.col("times") * F.col("n")).alias("count_sum"),
    )
    per_row = known.unionByName(priced).groupBy("row").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")
    )
    return rows.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(per_row, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
