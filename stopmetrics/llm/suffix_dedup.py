"""Exact removal of byte strings that documents with a smaller id hold already, decided on suffix arrays.

A string of `width` bytes belongs to the smallest hash among the shorter grams inside it, so equal strings meet in one
bucket wherever they occur. Three passes over blocks of documents, which are shuffled once and read again:

1. every block names the hashes its strings belong to; buckets answer which of them other documents have too;
2. stretches of text whose strings belong to such a hash, each different one once per block, go to their buckets, where
   a suffix array finds equal strings and the smallest document that has each;
3. the answers, a bit per starting byte, go back to the blocks, which remove the bytes.

A stretch that a third of all documents share costs one row part per block, not per document. Hashes only group:
whether strings are equal is decided on their bytes.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopmetrics.llm.worker_memory import releasing, releasing_both

_GRAM = 24  # bytes of a gram; `width` - _GRAM + 1 grams compete for a string
_TILE = 2 << 20  # bytes hashed at a time
_RUN = 32  # starting bytes of a stretch at most: as many as an answer has bits
_NO_ID = np.iinfo(np.int64).max  # rows without doc_id come last and remove nothing from each other
_RESULTS = ("kept", "n_bytes", "n_removed", "spans")


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _gram_hashes(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the _GRAM bytes from each place on, by joining halves."""
    base = 0xD6E8FEB86659FD93
    parts = {1: _mixed(x.astype(np.uint64) + np.uint64(1))}

    def joined(a: int, b: int) -> np.ndarray:
        n = len(x) - a - b + 1
        return parts[a][:n] * np.uint64(pow(base, b, 1 << 64)) + parts[b][a : a + n]

    for size in (1, 2, 4, 8):
        parts[2 * size] = joined(size, size)
        if size < 8:
            del parts[size]
    return _mixed(joined(16, 8))


def _window_minimum(h: np.ndarray, size: int) -> np.ndarray:
    span = 1
    while 2 * span <= size:
        h, span = np.minimum(h[:-span], h[span:]), 2 * span
    return np.minimum(h[: len(h) - (size - span)], h[size - span :]) if size > span else h


class _Block:
    """Documents of one block, in ascending doc_id, as one run of bytes."""

    def __init__(self, table: pa.Table) -> None:
        ids = table.column("doc_id").fill_null(_NO_ID).to_numpy()
        order = np.lexsort((table.column("tie").to_numpy(), ids))
        self.table = table.take(pa.array(order))
        self.ids = ids[order]
        texts = self.table.column("text").fill_null(b"").combine_chunks()
        self.lengths = np.diff(np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4)).astype(
            np.int64
        )
        self.offsets = np.concatenate(([0], np.cumsum(self.lengths)))
        first = int(np.frombuffer(texts.buffers()[1], np.int32, 1, texts.offset * 4)[0]) if len(texts) else 0
        size = int(self.offsets[-1])
        self.x = np.frombuffer(texts.buffers()[2], np.uint8, size, first) if size else np.zeros(0, np.uint8)

    def stretches(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of runs of starting bytes whose strings belong to one hash: first byte, length, hash, document's place."""
        ends = self.offsets[1:]
        found = []
        for at in range(0, max(0, len(self.x) - width + 1), _TILE):
            tile = self.x[at : at + _TILE + width - 1]
            least = _window_minimum(_gram_hashes(tile), width - _GRAM + 1)
            n = len(least)
            first_doc = int(np.searchsorted(ends, at, side="right"))
            last_doc = int(np.searchsorted(ends, at + n - 1, side="right"))
            inside = np.zeros(n + 1, dtype=np.int32)
            a = np.clip(self.offsets[first_doc : last_doc + 1] - at, 0, n)
            b = np.clip(ends[first_doc : last_doc + 1] - width + 1 - at, 0, n)
            real = b > a
            np.add.at(inside, a[real], 1)
            np.add.at(inside, b[real], -1)
            valid = np.cumsum(inside[:-1]) > 0
            cut = np.flatnonzero((least[1:] != least[:-1]) | (valid[1:] != valid[:-1])) + 1
            starts = np.concatenate(([0], cut))
            sizes = np.diff(np.concatenate((starts, [n])))
            starts, sizes = starts[valid[starts]], sizes[valid[starts]]
            parts = -(-sizes // _RUN)
            nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            starts, sizes = np.repeat(starts, parts) + nth * _RUN, np.repeat(sizes, parts) - nth * _RUN
            found.append((starts + at, np.minimum(sizes, _RUN), _mixed(least[starts])))
        if not found:
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        starts, sizes, keys = (np.concatenate(column) for column in zip(*found))
        return starts, sizes, keys, np.searchsorted(ends, starts, side="right")


def _buckets(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _tags(keys: np.ndarray) -> np.ndarray:
    return keys.astype(np.uint32)  # the low half; the high half chose the bucket


_NAMED = "bucket int, block int, once binary, often binary"


def _name_hashes(width: int, buckets: int):
    def of_block(table: pa.Table) -> pa.Table:
        block = _Block(table)
        _, _, keys, docs = block.stretches(width)
        order = np.argsort(keys, kind="stable")
        keys, ids = keys[order], block.ids[docs[order]]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, int)
        last = np.concatenate((first[1:], [len(keys)])) - 1 if len(keys) else first
        several, keys = ids[first] != ids[last], keys[first]
        bucket = _buckets(keys, buckets)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        tags, several = _tags(keys)[order], several[order]
        rows = [
            (b, tags[i:j][~several[i:j]].tobytes(), tags[i:j][several[i:j]].tobytes())
            for b, (i, j) in enumerate(zip(edges[:-1], edges[1:]))
            if j > i
        ]
        number = table.column("block")[0].as_py()
        return pa.table(
            {
                "bucket": pa.array([row[0] for row in rows], pa.int32()),
                "block": pa.array([number] * len(rows), pa.int32()),
                "once": pa.array([row[1] for row in rows], pa.binary()),
                "often": pa.array([row[2] for row in rows], pa.binary()),
            }
        )

    return of_block


def _shared_hashes(table: pa.Table) -> pa.Table:
    """For each block the hashes it named that occur in several documents, here or elsewhere."""
    once = [np.frombuffer(one, np.uint32) for one in table.column("once").to_pylist()]
    often = [np.frombuffer(one, np.uint32) for one in table.column("often").to_pylist()]
    tags = np.concatenate(once + often)
    _, group, count = np.unique(tags, return_inverse=True, return_counts=True)
    single = sum(map(len, once))
    several = count > 1
    several[group[single:]] = True
    shared = several[group]
    edges = np.cumsum([0] + [len(one) for one in once + often])
    answers = []
    for i in range(len(once)):
        j = i + len(once)
        own = np.concatenate(
            (once[i][shared[edges[i] : edges[i + 1]]], often[i][shared[edges[j] : edges[j + 1]]])
        )
        answers.append(own.tobytes())
    answer = pa.table(
        {
            "block": table.column("block"),
            "bucket": table.column("bucket"),
            "tags": pa.chunked_array([pa.array(answers, pa.binary())]),
        }
    )
    return answer.filter(pa.array([bool(one) for one in answers], pa.bool_()))


_SENT = "bucket int, block int, docs binary, places binary, sizes binary, data binary"


def _send_stretches(width: int, buckets: int):
    def of_block(table: pa.Table, shared: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if shared.num_rows and table.num_rows:
            number = table.column("block")[0].as_py()
            known = [
                (np.uint64(b) << np.uint64(32)) | np.frombuffer(tags, np.uint32).astype(np.uint64)
                for b, tags in zip(shared.column("bucket").to_pylist(), shared.column("tags").to_pylist())
            ]
            block = _Block(table)
            starts, sizes, keys, docs = block.stretches(width)
            bucket = _buckets(keys, buckets)
            hit = np.isin((bucket.astype(np.uint64) << np.uint64(32)) | _tags(keys), np.concatenate(known))
            order = np.flatnonzero(hit)
            order = order[np.argsort(bucket[order], kind="stable")]
            starts, sizes, bucket, ids = starts[order], sizes[order], bucket[order], block.ids[docs[order]]
            edges = np.searchsorted(bucket, np.arange(buckets + 1))
            text = block.x.tobytes()
            pack = zstandard.ZstdCompressor(level=1)
            for b, (i, j) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
                if j == i:
                    continue
                seen: dict[bytes, int] = {}
                sent, here = [], []
                for k, (start, size, doc) in enumerate(
                    zip(starts[i:j].tolist(), sizes[i:j].tolist(), ids[i:j].tolist()), i
                ):
                    piece = text[start : start + size + width - 1]
                    if seen.setdefault(piece, doc) == doc:
                        sent.append(k)  # first document here to have it, or a repeat within that document
                    else:
                        here.append(k)
                data = b"".join(text[starts[k] : starts[k] + sizes[k] + width - 1] for k in sent)
                rows.append(
                    (b, number, ids[sent].tobytes(), starts[sent].tobytes(), sizes[sent].astype(np.uint8).tobytes(),
                     pack.compress(data))
                )
                if here:  # an earlier document of this block has the whole stretch: nothing left to ask
                    rows.append((b, number, None, starts[here].tobytes(), sizes[here].astype(np.uint8).tobytes(), None))
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
        columns = list(zip(*rows)) or [[]] * len(kinds)
        names = [name.split()[0] for name in _SENT.split(", ")]
        return pa.table([pa.array(column, kind) for column, kind in zip(columns, kinds)], names)

    return of_block


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a big-endian number."""
    w = text.astype(np.uint64)
    for size in (1, 2, 4):
        w = (w[:-size] << np.uint64(8 * size)) | w[size:]
    return w


def _sorted_directly(at: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """`at` by the `depth` bytes from each place on, eight at a time; only ties look further."""
    order = np.argsort(words[at], kind="stable")
    at = at[order]
    group = np.concatenate(([0], np.cumsum(words[at][1:] != words[at][:-1]))) if len(at) else np.zeros(0, np.int64)
    for far in range(8, depth, 8):
        tied = np.concatenate(([False], group[1:] == group[:-1]))
        tied[:-1] |= tied[1:].copy() if len(at) else tied[:-1]
        some = np.flatnonzero(tied)
        if not len(some):
            break
        next_word = words[at[some] + far]
        order = np.lexsort((next_word, group[some]))
        at[some] = at[some][order]
        word, own = next_word[order], group[some]
        new = np.zeros(len(at), dtype=np.int64)
        new[some[1:]] = (own[1:] == own[:-1]) & (word[1:] != word[:-1])
        fresh = np.concatenate(([0], (group[1:] != group[:-1]).astype(np.int64))) if len(at) else group
        group = np.cumsum(np.maximum(new, fresh))
    return at


def suffix_array(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """Places of `text` (uint8) where `wanted` is set, by the suffixes from there on, compared over `depth` bytes.

    Two stages. A suffix whose first byte is greater than the next one's is greater than its successor: it is not
    compared at all. The others are sorted directly; then a scan over the buckets of first bytes, smallest first, puts
    the predecessor of each suffix met behind those already in the bucket of its own first byte. `text` must go on for
    `depth` + 16 bytes behind the last place wanted.
    """
    greater = np.zeros(len(text), dtype=bool)
    greater[:-1] = text[:-1] > text[1:]
    chosen = wanted.copy()
    fresh = chosen & greater
    while fresh.any():  # what is induced needs its successor sorted
        step = np.zeros_like(chosen)
        step[1:] = fresh[:-1]
        fresh = step & ~chosen
        chosen |= fresh
        fresh &= greater
    direct = _sorted_directly(np.flatnonzero(chosen & ~greater), _words(text), depth)
    edges = np.searchsorted(text[direct], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    buckets = []
    for byte in range(256):
        own = np.concatenate([*induced[byte], direct[edges[byte] : edges[byte + 1]]])
        induced[byte] = []
        buckets.append(own)
        before = own[own > 0] - 1
        before = before[chosen[before] & (text[before] > byte)]
        first = text[before]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        cuts = np.flatnonzero(np.diff(first)) + 1
        for part in np.split(before, cuts) if len(before) else ():
            induced[text[part[0]]].append(part)
    places = np.concatenate(buckets)
    return places[wanted[places]]


def common_prefixes(text: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """Bytes, up to `depth`, that the suffix at each place shares with the one before it in `places`; 0 for the first."""
    words = _words(text)
    length = np.zeros(len(places), dtype=np.int64)
    live = np.arange(1, len(places))
    for far in range(0, depth, 8):
        differ = words[places[live] + far] ^ words[places[live - 1] + far]
        same = differ == 0
        length[live[same]] += 8
        rest = differ[~same]
        if len(rest):
            lead = np.zeros(len(rest), dtype=np.int64)
            for back in range(1, 8):
                lead += (rest >> np.uint64(64 - 8 * back)) == 0
            length[live[~same]] += lead
        live = live[same]
    return np.minimum(length, depth)


_ANSWERED = "block int, places binary, masks binary"


def _answer_stretches(width: int):
    def of_bucket(table: pa.Table) -> pa.Table:
        out: list[tuple] = []
        index: dict[bytes, int] = {}
        sent = []
        unpack = zstandard.ZstdDecompressor()
        for row in table.to_pylist():
            sizes = np.frombuffer(row["sizes"], np.uint8)
            if row["data"] is None:
                out.append((row["block"], row["places"], np.full(len(sizes), 0, np.uint32) + _full(sizes)))
                continue
            data, ends = unpack.decompress(row["data"]), np.cumsum(sizes.astype(np.int64) + width - 1)
            pieces = [data[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
            number = np.array([index.setdefault(piece, len(index)) for piece in pieces], dtype=np.int64)
            sent.append((row["block"], np.frombuffer(row["docs"], np.int64), row["places"], number))
        if sent:
            count = len(index)
            sizes = np.fromiter(map(len, index), np.int64, count) - width + 1
            text = np.frombuffer(b"".join(index) + bytes(width + 32), np.uint8)
            index.clear()
            least = np.full(count, _NO_ID)
            for _, docs, _, number in sent:
                np.minimum.at(least, number, docs)
            begins = np.concatenate(([0], np.cumsum(sizes + width - 1)))[:-1]
            wanted = np.zeros(len(text), dtype=bool)
            nth = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            wanted[np.repeat(begins, sizes) + nth] = True
            places = suffix_array(text, wanted, width)
            owner = np.searchsorted(begins, places, side="right") - 1
            group = np.flatnonzero(common_prefixes(text, places, width) < width)
            smallest = np.minimum.reduceat(least[owner], group)
            smaller = np.repeat(smallest, np.diff(np.append(group, len(places)))) < least[owner]
            bit = np.ldexp(1.0, (places - begins[owner])[smaller].astype(np.int32))
            masks = np.bincount(owner[smaller], weights=bit, minlength=count).astype(np.uint32)
            full = _full(sizes)
            for block, docs, spots, number in sent:
                mask = np.where(docs > least[number], full[number], masks[number])
                out.append((block, spots, mask))
        answers = []
        for block, spots, mask in out:
            some = np.flatnonzero(mask)
            if len(some):
                answers.append((block, np.frombuffer(spots, np.int64)[some].tobytes(), mask[some].tobytes()))
        kinds = (pa.int32(), pa.binary(), pa.binary())
        columns = list(zip(*answers)) or [[]] * 3
        return pa.table(
            [pa.array(column, kind) for column, kind in zip(columns, kinds)], ["block", "places", "masks"]
        )

    return of_bucket


def _full(sizes: np.ndarray) -> np.ndarray:
    return ((np.uint64(1) << sizes.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)


def _covered(block: _Block, answers: pa.Table, width: int) -> np.ndarray:
    """Which bytes of the block lie in a string that an earlier document has."""
    change = np.zeros(len(block.x) + 1, dtype=np.int32)
    for places, masks in zip(answers.column("places").to_pylist(), answers.column("masks").to_pylist()):
        bits = np.unpackbits(np.frombuffer(masks, np.uint8), bitorder="little").reshape(-1, _RUN)
        row, bit = np.nonzero(bits)
        start = np.frombuffer(places, np.int64)[row] + bit
        np.add.at(change, start, 1)
        np.add.at(change, start + width, -1)
    return np.cumsum(change[:-1]) > 0


def _whole_characters(x: np.ndarray, covered: np.ndarray) -> np.ndarray:
    """`covered` without characters of which a byte stays."""
    if not len(x):
        return covered
    character = np.cumsum((x & 0xC0) != 0x80)
    stays = np.zeros(int(character[-1]) + 1, dtype=bool)
    stays[character[~covered]] = True
    return ~stays[character]


def _remove(width: int, whole_characters: bool):
    def of_block(table: pa.Table, answers: pa.Table) -> pa.Table:
        block = _Block(table)
        covered = _covered(block, answers, width)
        if whole_characters:
            covered = _whole_characters(block.x, covered)
        kept, removed, spans = [], [], []
        for a, b in zip(block.offsets[:-1].tolist(), block.offsets[1:].tolist()):
            own = covered[a:b]
            if own.any():
                edge = np.flatnonzero(np.diff(np.concatenate(([False], own, [False])).astype(np.int8)))
                kept.append(block.x[a:b][~own].tobytes())
                spans.append([{"start": int(s), "end": int(e)} for s, e in zip(edge[::2], edge[1::2])])
                removed.append(int(own.sum()))
            else:
                kept.append(block.x[a:b].tobytes())
                spans.append([])
                removed.append(0)
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        return pa.table(
            {
                "row": block.table.column("row"),
                "kept": pa.array(kept, pa.binary()),
                "n_bytes": pa.array(block.lengths, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "spans": pa.array(spans, pa.list_(span)),
            }
        )

    return of_block


def remove_repeats(docs: DataFrame, width: int = 50, whole_characters: bool = False) -> DataFrame:
    """`docs` (doc_id, text, ...) without the bytes of strings that a document with a smaller doc_id has.

    A byte goes if any `width`-byte string over it also starts in such a document; texts are compared as given, in
    UTF-8, and a string never reaches across documents. Adds kept (binary), n_bytes, n_removed and spans (start and end
    of the maximal removed runs) and drops text; a column of such a name is replaced, other columns stay. NULL and
    empty texts keep nothing and lose nothing; rows with the same doc_id do not take from each other, and a row without
    doc_id counts as coming after all others. With `whole_characters` a character stays unless all its bytes would go,
    so what is kept is valid text. No documents give no rows. `width` is at least 32.

    The number of blocks and buckets follows the session's number of shuffle partitions.
    """
    if width < _GRAM + 8:
        raise ValueError(f"width must be at least {_GRAM + 8}.")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = 2 * parts
    others = [name for name in docs.columns if name not in ("text", *_RESULTS)]
    text = F.col("text").cast("string")
    dealt = docs.select(
        F.pmod(F.xxhash64(F.col("doc_id").cast("long"), text), F.lit(blocks)).cast("int").alias("block"),
        F.struct(*[F.col(f"`{name}`") for name in others]).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("tie"),
        text.cast("binary").alias("text"),
    )
    by_block = dealt.groupBy("block")
    named = by_block.applyInArrow(releasing(_name_hashes(width, parts)), _NAMED)
    shared = named.groupBy("bucket").applyInArrow(releasing(_shared_hashes), "block int, bucket int, tags binary")
    sent = by_block.cogroup(shared.groupBy("block")).applyInArrow(releasing_both(_send_stretches(width, parts)), _SENT)
    answered = sent.groupBy("bucket").applyInArrow(releasing(_answer_stretches(width)), _ANSWERED)
    schema = T.StructType(
        [
            T.StructField("row", dealt.schema["row"].dataType),
            T.StructField("kept", T.BinaryType()),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("spans", T.ArrayType(T.StructType.fromDDL("start long, end long"))),
        ]
    )
    remove = releasing_both(_remove(width, whole_characters))
    cleaned = by_block.cogroup(answered.groupBy("block")).applyInArrow(remove, schema)
    return cleaned.select("row.*", *_RESULTS)


assert sys.byteorder == "little", "ids and masks travel as little-endian numbers"
