"""Document fingerprints: Merkle trees over sections, paragraphs and phrases."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PHRASE = 4  # words per phrase on average
_SECTION = 4  # paragraphs per section on average
_CODE = 6  # hex digits per phrase in a fingerprint
_BRANCH = 8  # hex digits per paragraph and section in a fingerprint
_ROOT = 32
_NO_ID = np.iinfo(np.int64).min


@dataclass(frozen=True)
class Tree:
    """Hashes of a text: of the whole, its sections, paragraphs and phrases. `paragraphs[i]` belongs to section
    `section_of[i]`, covers `spans[i]` of the UTF-8 bytes and holds the phrases from `first[i]` to before `first[i + 1]`;
    phrase j ends before byte `ends[j]`."""

    root: str
    sections: list[int]
    paragraphs: list[int]
    section_of: list[int]
    spans: list[tuple[int, int]]
    phrases: list[int]
    first: list[int]
    ends: list[int]

    @property
    def fingerprint(self) -> str:
        """The root, then each section behind a ";": its code and, joined by ",", its paragraphs, each a code and the codes
        of its phrases."""
        leaves = [f"{phrase & 0xFFFFFF:06x}" for phrase in self.phrases]
        branches: list[list[str]] = [[] for _ in self.sections]
        for paragraph, section, a, b in zip(self.paragraphs, self.section_of, self.first, self.first[1:]):
            branches[section].append(f"{paragraph & 0xFFFFFFFF:08x}" + "".join(leaves[a:b]))
        return self.root + "".join(
            [f";{section & 0xFFFFFFFF:08x}" + ",".join(held) for section, held in zip(self.sections, branches)]
        )


def _phrase_ends(x: np.ndarray) -> np.ndarray:
    """Ends of phrases, from the bytes before them alone: every line end, and about one word end in _PHRASE."""
    blank = (x == 32) | (x == 10) | (x == 9) | (x == 13)
    word_end = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
    word_end = word_end[word_end >= 8]
    recent = np.zeros(len(word_end), dtype=np.uint64)
    for back in range(8, 0, -1):
        recent = (recent << np.uint64(8)) | x[word_end - back]
    mixed = (recent ^ (recent >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    chosen = word_end[(mixed >> np.uint64(40)) % np.uint64(_PHRASE) == 0]
    return np.union1d(np.union1d(chosen, np.flatnonzero(x == 10) + 1), [len(x)])


def merkle_tree(text: str | None) -> Tree:
    """The tree of `text`; NULL counts as empty. Equal texts have equal trees, and equal roots mean equal texts."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return Tree(xxhash.xxh3_128_hexdigest(b""), [], [], [], [], [], [0], [])
    x = np.frombuffer(raw, np.uint8)
    ends = _phrase_ends(x)
    digest = xxhash.xxh64_intdigest
    starts = [0, *ends[:-1].tolist()]
    phrases = [digest(raw[a:b]) for a, b in zip(starts, ends.tolist())]
    packed = np.array(phrases, dtype="<u8").tobytes()
    line_ends = np.union1d(np.flatnonzero(x == 10) + 1, [len(x)])
    counts = np.searchsorted(ends, line_ends, side="right").tolist()
    first = [0, *counts[:-1]]
    paragraphs = [digest(packed[8 * a : 8 * b]) for a, b in zip(first, counts)]
    spans = list(zip([0, *line_ends[:-1].tolist()], line_ends.tolist()))
    sections, section_of, members = [], [], []
    for at, paragraph in enumerate(paragraphs):
        members.append(paragraph)
        section_of.append(len(sections))
        if paragraph % _SECTION == 0 or at == len(paragraphs) - 1:
            sections.append(digest(np.array(members, dtype="<u8").tobytes()))
            members = []
    root = xxhash.xxh3_128_hexdigest(np.array(sections, dtype="<u8").tobytes())
    return Tree(root, sections, paragraphs, section_of, spans, phrases, [0, *counts], ends.tolist())


def _pair_off(mine: list, theirs: list) -> tuple[list[int], list[int]]:
    """Places of what each list has beyond the other, repeats counted."""
    over = Counter(mine)
    over.subtract(theirs)
    left, right = [], []
    for own, places, sign in ((mine, left, 1), (theirs, right, -1)):
        for at in range(len(own) - 1, -1, -1):
            if sign * over[own[at]] > 0:
                over[own[at]] -= sign
                places.append(at)
        places.reverse()
    return left, right


def edited_spans(tree: Tree, other: Tree) -> list[tuple[int, int]]:
    """Byte ranges of `tree`'s text that the other lacks, from the differing branches: of sections that differ the
    paragraphs, of those that differ the phrases. Subtrees with equal hashes are not entered; ranges that touch are one."""
    if tree.root == other.root:
        return []
    mine, theirs = _pair_off(tree.sections, other.sections)
    open_mine, open_theirs = set(mine), set(theirs)
    mine = [at for at, section in enumerate(tree.section_of) if section in open_mine]
    theirs = [at for at, section in enumerate(other.section_of) if section in open_theirs]
    left, right = _pair_off([tree.paragraphs[at] for at in mine], [other.paragraphs[at] for at in theirs])
    mine = [leaf for at in left for leaf in range(tree.first[mine[at]], tree.first[mine[at] + 1])]
    theirs = [leaf for at in right for leaf in range(other.first[theirs[at]], other.first[theirs[at] + 1])]
    left, _ = _pair_off([tree.phrases[leaf] for leaf in mine], [other.phrases[leaf] for leaf in theirs])
    found: list[tuple[int, int]] = []
    for leaf in [mine[at] for at in left]:
        start, end = tree.ends[leaf - 1] if leaf else 0, tree.ends[leaf]
        if found and found[-1][1] == start:
            found[-1] = (found[-1][0], end)
        else:
            found.append((start, end))
    return found


def _leaves(fingerprint: str) -> int:
    """Phrases below the sections of a fingerprint."""
    sections, commas = fingerprint.count(";"), fingerprint.count(",")
    return (len(fingerprint) - _ROOT - sections * (2 * _BRANCH + 1) - commas * (_BRANCH + 1)) // _CODE


def likeness(fingerprint: str, other: str) -> float:
    """Share of phrases, repeats counted, that two fingerprints have in common; 1 for equal ones, 0 beside an empty one.

    The trees are walked from the roots: sections with equal codes are shared as a whole, then equal paragraphs of the other
    sections, and phrases are compared in the paragraphs that differ only.
    """
    if fingerprint[:_ROOT] == other[:_ROOT]:
        return 1.0
    mine, theirs = fingerprint.split(";")[1:], other.split(";")[1:]
    if not mine or not theirs:
        return 0.0
    total = _leaves(fingerprint) + _leaves(other)
    left, right = _pair_off([one[:_BRANCH] for one in mine], [one[:_BRANCH] for one in theirs])
    mine = [part for at in left for part in mine[at][_BRANCH:].split(",")]
    theirs = [part for at in right for part in theirs[at][_BRANCH:].split(",")]
    left, right = _pair_off([one[:_BRANCH] for one in mine], [one[:_BRANCH] for one in theirs])
    mine = [mine[at][p : p + _CODE] for at in left for p in range(_BRANCH, len(mine[at]), _CODE)]
    theirs = [theirs[at][p : p + _CODE] for at in right for p in range(_BRANCH, len(theirs[at]), _CODE)]
    lacking = Counter(mine)
    lacking.subtract(theirs)
    return (total - sum(map(abs, lacking.values()))) / total


_TREE = "root string, sections array<long>, paragraphs array<struct<hash:long,section:int,start:long,end:long>>, fingerprint string"


def fingerprints(docs: DataFrame) -> DataFrame:
    """`docs` (text, ...) with `tree`: root, section hashes, paragraphs with their hash, section and bytes, fingerprint.

    A column `tree` is replaced, all rows stay. A NULL or empty text has no sections and the root of the empty text.
    """

    def of_batch(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            trees = [merkle_tree(text) for text in batch]
            yield pd.DataFrame(
                {
                    "root": [tree.root for tree in trees],
                    "sections": [np.array(tree.sections, dtype="<u8").view(np.int64) for tree in trees],
                    "paragraphs": [
                        [
                            {"hash": own - (own >> 63 << 64), "section": section, "start": start, "end": end}
                            for own, section, (start, end) in zip(tree.paragraphs, tree.section_of, tree.spans)
                        ]
                        for tree in trees
                    ],
                    "fingerprint": [tree.fingerprint for tree in trees],
                }
            )

    return docs.withColumn("tree", F.pandas_udf(of_batch, _TREE)(F.col("text").cast("string")))


def with_neighbours(docs: DataFrame, of_run: Callable[[list, list], pa.Table], schema: str) -> DataFrame:
    """Apply `of_run(ids, texts)` to runs of documents in ascending doc_id, each with the document after its last one.

    Runs cover successive ranges of doc_id, about four per shuffle partition, and the first document follows the last.
    `of_run` gets one id fewer than texts. Rows without doc_id come first, equal ids are ordered by a hash of the text
    and stay in one run. Range borders are found from the ids alone; the driver gets one id per run.
    """
    spark = docs.sparkSession
    runs = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("key", F.coalesce("doc_id", F.lit(_NO_ID))).withColumn("tie", F.xxhash64("text"))
    ranges = rows.select("key").repartitionByRange(runs, "key").groupBy(F.spark_partition_id()).agg(F.min("key"))
    heads = np.sort(np.array([row[1] for row in ranges.collect()], dtype=np.int64))

    @F.pandas_udf("array<int>")
    def runs_of(key: pd.Series) -> pd.Series:
        own = np.searchsorted(heads, key.to_numpy(np.int64), side="right") - 1
        leads = heads[own] == key.to_numpy(np.int64)
        return pd.Series([[run, (run - 1) % len(heads)] if lead else [run] for run, lead in zip(own.tolist(), leads)])

    def of_group(table: pa.Table) -> pa.Table:
        after = table.column("after").to_numpy()
        order = np.lexsort((table.column("tie").to_numpy(), table.column("key").to_numpy(), after))
        count = int((~after).sum())
        taken = table.take(pa.array(order[: count + 1]))
        return of_run(taken.column("doc_id").to_pylist()[:count], [text or "" for text in taken.column("text").to_pylist()])

    dealt = rows.select("*", F.posexplode(runs_of("key")).alias("place", "run"))
    marked = dealt.select("run", "doc_id", "key", "tie", "text", (F.col("place") > 0).alias("after"))
    return marked.groupBy("run").applyInArrow(of_group, schema)


_COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, edited_spans array<struct<start:long,end:long>>"
)


def compare_with_edit(docs: DataFrame) -> DataFrame:
    """Fingerprint of every document, and its likeness to that of an edited version and of the next document.

    The edited text has the last quarter (floor of the code points / 4) replaced by as many first code points, or all,
    of the next document by ascending doc_id; after the last comes the first. NULL texts count as empty. `edited_spans`
    are the bytes of the document that the edited text lacks, by the branches in which their trees differ. Further
    columns of `docs` are not used; no documents give no rows.
    """

    kinds = dict(
        doc_id=pa.int64(),
        n_chars=pa.int64(),
        edited_sha256=pa.string(),
        fingerprint=pa.string(),
        edited_fingerprint=pa.string(),
        near_edited=pa.float64(),
        near_next=pa.float64(),
        edited_spans=pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
    )

    def of_run(ids: list, texts: list) -> pa.Table:
        columns: dict[str, list] = {name: [] for name in kinds}
        after = merkle_tree(texts[0])
        after_print = after.fingerprint
        for at, (doc_id, text) in enumerate(zip(ids, texts)):
            tree, own = after, after_print
            after = merkle_tree(texts[at + 1])
            after_print = after.fingerprint
            quarter = len(text) // 4
            edited = text[: len(text) - quarter] + texts[at + 1][:quarter]
            changed = merkle_tree(edited)
            sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
            changed_print = changed.fingerprint
            near = likeness(own, changed_print), likeness(own, after_print)
            spans = [{"start": start, "end": end} for start, end in edited_spans(tree, changed)]
            for column, value in zip(columns.values(), (doc_id, len(text), sha, own, changed_print, *near, spans)):
                column.append(value)
        return pa.table([pa.array(columns[name], kind) for name, kind in kinds.items()], list(kinds))

    return with_neighbours(docs, of_run, _COMPARED)
