"""Byte-level BPE: DuckDB recursive queries inside each task merge words into tokens, ordered aggregation decodes them."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from itertools import filterfalse
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TEXTS = 500
_BYTES = 100_000  # bytes of words per recursive query; a longer word has a query of its own
_IDS = 500_000  # ids per aggregation that decodes
_SHORT = 32  # bytes of words whose recursion may keep every round; that of longer words keeps the last state only
# Pieces that a match of the word pattern never crosses: a word with the blank before it, or white space. Texts with
# control characters that engines class differently are cut by the word pattern alone.
_COARSE = re.compile(r" ?\S+|\s+(?!\S)|\s+")
# Pieces that are one word, or one and the signs behind it, whatever the Unicode version of an engine.
_PLAIN = re.compile("( ?[A-Za-zÀ-ÖØ-öø-ÿŒœŸ]+)([!-/:-@[-`{-~]*)")
_KEPT = 64  # characters of pieces and words that are kept in memory
_ODD = re.compile("[\x1c-\x1f\x85᠎​⁠﻿]")

# A row is a token of a word: its first byte, the byte after it, its id, and the round. Joins find the token that follows.
_MERGE = """
WITH RECURSIVE round(w, p, z, id, n) AS (
    SELECT w, p, p + 1, id, 0 FROM bytes_of_words
    UNION ALL
    (
        WITH best AS (
            SELECT l.w, min((CAST(merged AS BIGINT) << 16) | l.p) AS best
            FROM round l JOIN round r ON r.w = l.w AND r.p = l.z JOIN merges ON merges.a = l.id AND merges.b = r.id
            GROUP BY l.w
        ), contracted AS (
            SELECT w, best & 65535 AS place, vocabulary.id AS merged, size
            FROM best JOIN vocabulary ON vocabulary.id = CAST(best >> 16 AS INTEGER)
        )
        SELECT w, p, CASE WHEN p = place THEN p + size ELSE z END, CASE WHEN p = place THEN merged ELSE id END, n + 1
        FROM round JOIN contracted USING (w) WHERE NOT (p > place AND p < place + size)
    )
), last AS (SELECT w, max(n) AS n FROM round GROUP BY w)
SELECT w, list(id ORDER BY p) AS ids FROM round JOIN last USING (w, n) GROUP BY w ORDER BY w
"""

# The same merges over one row per (word, byte), replaced in place; a token taken in by the one before it has id -1. Where
# no merge of the new token ranks below it (`vocabulary.settled`), all its occurrences are the next merges in any case, so
# a round makes them all: of occurrences that overlap, every other one, as merging from the left does.
_MERGE_IN_PLACE = """
WITH RECURSIVE round(w, p, z, id) USING KEY (w, p) AS (
    SELECT w, p, p + 1, id FROM bytes_of_words
    UNION
    (
        WITH pairs AS (
            SELECT l.w, l.p, r.p AS q, r.z, merged
            FROM recurring.round l JOIN recurring.round r ON r.w = l.w AND r.p = l.z
            JOIN merges ON merges.a = l.id AND merges.b = r.id
            WHERE l.w IN (SELECT w FROM round)
        ), least AS (
            SELECT w, min(merged) AS merged FROM pairs GROUP BY w
        ), linked AS (
            SELECT pairs.*, settled, row_number() OVER of_word AS n, lag(q) OVER of_word IS NOT DISTINCT FROM p AS chained
            FROM pairs JOIN least USING (w, merged) JOIN vocabulary ON vocabulary.id = merged
            WINDOW of_word AS (PARTITION BY w ORDER BY p)
        ), counted AS (
            SELECT *, n - max(CASE WHEN chained THEN 0 ELSE n END) OVER (PARTITION BY w ORDER BY p) AS place FROM linked
        ), contracted AS (
            SELECT w, p, q, z, merged FROM counted WHERE n = 1 OR (settled AND place % 2 = 0)
        )
        SELECT w, p, z, merged FROM contracted UNION ALL SELECT w, q, z, -1 FROM contracted
    )
)
SELECT w, list(id ORDER BY p) AS ids FROM round WHERE id >= 0 GROUP BY w ORDER BY w
"""

# One sort of all rows instead of one per text; the connection has one thread, so the aggregate takes rows in that order.
_DECODE = """
SELECT d, string_agg(token, '') AS bytes
FROM (SELECT d, token FROM ids_of_texts JOIN vocabulary USING (id) ORDER BY d, p) GROUP BY d
"""


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id, from a file with a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class ByteBpe:
    """Encoder and decoder of one vocabulary, with a DuckDB connection of its own.

    Encoding joins the tokens of every word with a table of all pairs that form a token, and contracts the leftmost
    pair of least rank per word and round, until no pair is left. Words met before are answered from memory, whatever signs
    follow them; the later half of it goes when it holds more than `memo_limit` words.
    """

    _loaded: dict[tuple[str, str], ByteBpe] = {}

    def __init__(self, path: str, pattern: str, memo_limit: int = 500_000) -> None:
        import duckdb
        import regex

        self.ranks = load_ranks(path)
        self.token = {rank: token for token, rank in self.ranks.items()}
        self.words = regex.compile(pattern)
        self.memo: dict[str, bytes] = {}
        self.memo_limit = memo_limit
        self.duck = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        pairs = [
            (self.ranks[token[:cut]], self.ranks[token[cut:]], rank)
            for token, rank in self.ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in self.ranks and token[cut:] in self.ranks
        ]
        a, b, merged = (pa.array(column, pa.int32()) for column in zip(*pairs)) if pairs else [pa.array([], pa.int32())] * 3
        self._create("merges", pa.table({"a": a, "b": b, "merged": merged}))
        unsettled = {part for left, right, rank in pairs for part in (left, right) if rank <= part}
        # A token's bytes as the characters of these numbers.
        names = [(rank, token.decode("latin-1"), len(token), rank not in unsettled) for token, rank in self.ranks.items()]
        ids, spelled, sizes, settled = zip(*names)
        rows = {"id": pa.array(ids, pa.int32()), "token": pa.array(spelled), "size": pa.array(sizes, pa.int32())}
        rows["settled"] = pa.array(settled)
        self._create("vocabulary", pa.table(rows))
        self.decimals = pa.array([b"%d " % number for number in range(max(ids) + 1)], pa.large_binary())

    def _create(self, name: str, rows: pa.Table) -> None:
        self.duck.register("given", rows)
        self.duck.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.duck.unregister("given")

    @classmethod
    def of_worker(cls, path: str, pattern: str) -> ByteBpe:
        if (path, pattern) not in cls._loaded:
            cls._loaded[path, pattern] = cls(path, pattern)
        return cls._loaded[path, pattern]

    def merge_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Token ids of each word, by one recursive query per `_BYTES` bytes of words."""
        return [np.frombuffer(ids, dtype="<u4") for ids in self._ids_of_words(words)]

    def _ids_of_words(self, words: list[bytes]) -> list[bytes]:
        found = [b""] * len(words)
        short, long = [], []
        for at, word in enumerate(words):
            whole = self.ranks.get(word)
            if whole is not None:
                found[at] = whole.to_bytes(4, "little")
            else:
                (short if len(word) <= _SHORT else long).append(at)
        for query, places in ((_MERGE, short), (_MERGE_IN_PLACE, long)):
            behind = np.cumsum([len(words[at]) for at in places])
            first = 0
            while first < len(places):
                before = behind[first - 1] if first else 0
                end = max(first + 1, int(np.searchsorted(behind, before + _BYTES, side="right")))
                part = places[first:end]
                for at, ids in zip(part, self._merge([words[at] for at in part], query)):
                    found[at] = ids.tobytes()
                first = end
        return found

    def _merge(self, words: list[bytes], query: str) -> list[np.ndarray]:
        single = np.array([self.ranks[bytes([byte])] for byte in range(256)], dtype=np.int32)
        sizes = np.array([len(word) for word in words])
        raw = np.frombuffer(b"".join(words), np.uint8)
        place = np.arange(len(raw)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        rows = pa.table(
            {
                "w": pa.array(np.repeat(np.arange(len(words), dtype=np.int32), sizes)),
                "p": pa.array(place.astype(np.int32)),
                "id": pa.array(single[raw]),
            }
        )
        self.duck.register("bytes_of_words", rows)
        lists = self.duck.execute(query).to_arrow_table().column("ids").combine_chunks()
        self.duck.unregister("bytes_of_words")
        offsets = lists.offsets.to_numpy().tolist()
        values = lists.values.to_numpy().astype("<u4")
        return [values[a:b] for a, b in zip(offsets, offsets[1:])]

    def _learn(self, pieces: set[str]) -> list[str]:
        """Put the ids of new pieces of text into memory, by way of their words; returns those not to stay there."""
        memo = self.memo
        words: set[str] = set()
        ended, cores, signs, others = [], [], [], []
        for piece in pieces:
            plain = _PLAIN.fullmatch(piece)
            if plain is None:
                others.append(piece)
            elif plain[2]:
                ended.append(piece)
                cores.append(plain[1])
                signs.append(plain[2])
            else:
                words.add(piece)
        cut = [self.words.findall(piece) for piece in others]
        new = list(words.union(cores, signs, *cut).difference(memo))
        memo.update(zip(new, self._ids_of_words([word.encode("utf-8", "surrogatepass") for word in new])))
        memo.update(zip(ended, map(add, map(memo.__getitem__, cores), map(memo.__getitem__, signs))))
        memo.update([(piece, b"".join([memo[word] for word in one])) for piece, one in zip(others, cut)])
        several = [piece for piece, one in zip(others, cut) if len(one) > 1]
        return ended + several + [word for word in new if len(word) > _KEPT]

    def _group(self, texts: list[str | None]) -> list[bytes]:
        memo = self.memo
        if len(memo) > self.memo_limit:  # what came first is frequent and stays
            for word in list(memo)[self.memo_limit // 2 :]:
                del memo[word]
        cut = [[text] if text and _ODD.search(text) else _COARSE.findall(text or "") for text in texts]
        fresh: set[str] = set()
        for one in cut:
            fresh.update(filterfalse(memo.__contains__, one))
        passing = self._learn(fresh)
        ids = [b"".join(map(memo.__getitem__, one)) for one in cut]
        for piece in passing:
            memo.pop(piece, None)
        return ids

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers; none for a NULL or empty text."""
        return [ids for at in range(0, len(texts), _TEXTS) for ids in self._group(texts[at : at + _TEXTS])]

    def decode(self, encoded: list[np.ndarray]) -> list[bytes]:
        """Bytes of each list of ids."""
        found: list[list[bytes]] = [[] for _ in encoded]
        sizes = np.array([len(ids) for ids in encoded], dtype=np.int64)
        owner = np.repeat(np.arange(len(encoded), dtype=np.int32), sizes)
        ids = np.concatenate([np.zeros(0, "<u4"), *encoded]).astype(np.int32)
        for first in range(0, len(ids), _IDS):
            part = slice(first, first + _IDS)
            rows = {"d": owner[part], "p": np.arange(len(ids[part]), dtype=np.int32), "id": ids[part]}
            self.duck.register("ids_of_texts", pa.table(rows))
            for d, text in self.duck.execute(_DECODE).fetchall():
                found[d].append(text.encode("latin-1"))
            self.duck.unregister("ids_of_texts")
        return [b"".join(one) for one in found]

    def digest(self, ids: np.ndarray) -> str:
        """sha256 of the decimal ids joined by blanks."""
        written = self.decimals.take(pa.array(ids))
        end = np.frombuffer(written.buffers()[1], np.int64)[len(ids)]
        return hashlib.sha256(memoryview(written.buffers()[2])[: end - 1] if end else b"").hexdigest()


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """`docs` (text, ...) with `ids`, the token ids as little-endian 32-bit integers; a column of that name is replaced.

    Special tokens are ordinary text; a NULL or empty text has no ids. Every row stays.
    """

    def of_batch(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = ByteBpe.of_worker(ranks_path, pattern)
        for batch in texts:
            yield pa.array(bpe.encode(batch.to_pylist()), pa.binary())

    return docs.withColumn("ids", F.arrow_udf(of_batch, "binary")(F.col("text").cast("string")))


def decode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """`docs` (ids, ...) with `decoded`, the bytes of the ids; NULL ids decode to nothing."""

    def of_batch(encoded: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = ByteBpe.of_worker(ranks_path, pattern)
        for batch in encoded:
            lists = [np.frombuffer(ids or b"", dtype="<u4") for ids in batch.to_pylist()]
            texts = [text for at in range(0, len(lists), _TEXTS) for text in bpe.decode(lists[at : at + _TEXTS])]
            yield pa.array(texts, pa.binary())

    return docs.withColumn("decoded", F.arrow_udf(of_batch, "binary")("ids"))


_ROUND_TRIP = "ids binary, ids_sha256 string, decoded binary"


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """`docs` (text, ...) with `coded`: ids as in `encode_documents`, sha256 of the decimal ids joined by blanks, and the
    bytes that decoding those ids gives. One Python worker per task does all three; a column `coded` is replaced."""
    kinds = pa.struct([("ids", pa.binary()), ("ids_sha256", pa.string()), ("decoded", pa.binary())])

    def of_batch(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = ByteBpe.of_worker(ranks_path, pattern)
        for batch in texts:
            columns: tuple[list, list, list] = ([], [], [])
            for at in range(0, len(batch), _TEXTS):
                encoded = bpe.encode(batch.slice(at, _TEXTS).to_pylist())
                lists = [np.frombuffer(ids, dtype="<u4") for ids in encoded]
                columns[0].extend(encoded)
                columns[1].extend(map(bpe.digest, lists))
                columns[2].extend(bpe.decode(lists))
            yield pa.StructArray.from_arrays(
                [pa.array(column, field.type) for column, field in zip(columns, kinds)], fields=list(kinds)
            )

    return docs.withColumn("coded", F.arrow_udf(of_batch, _ROUND_TRIP)(F.col("text").cast("string")))
