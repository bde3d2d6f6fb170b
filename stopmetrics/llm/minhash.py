"""Near-duplicates by MinHash with tensored banding, every link verified on full shingle sets."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopmetrics.llm.graph import connected_components
from stopmetrics.llm.hot_keys import join_counted
from stopmetrics.llm.samples import slices
from stopmetrics.llm.worker_memory import release_memory, releasing
from stopmetrics.scratch import new_folder, written

SEED = 13
_SHINGLES, _FUNCTIONS = 2048, 64  # hashed at a time
_BLOCK = 1 << 20  # shingles and buckets that meet in one group


def shingle_set(text: str | None, words_per_shingle: int = 2) -> np.ndarray:
    """Sorted distinct XXH64 hashes of the word shingles of `text`: A-Z in lower case, words between ASCII blanks.

    Fewer words are one shingle, no words none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    width = min(words_per_shingle, len(words))
    digest = xxhash.xxh64_intdigest
    shingles = {b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)}
    return np.sort(np.array([digest(shingle, SEED) for shingle in shingles], dtype=np.uint64))


class Minhashes:
    """Two collections of minhash bands, `bands` of `rows` functions each; a table key is a band of each.

    The `bands` * `bands` tables have keys of 2 * `rows` minhashes, from 2 * `bands` * `rows` functions. Two sets of
    similarity s miss each other in all tables only if they differ in every band of one collection, which has a
    probability below 2 * (1 - s ** rows) ** bands.
    """

    def __init__(self, bands: int, rows: int) -> None:
        self.bands, self.rows = bands, rows
        number = 2 * bands * rows
        draws = np.array([xxhash.xxh32_intdigest(b"%d" % i, SEED) for i in range(2 * number)], dtype=np.uint32)
        self.factor, self.shift = draws[:number, None] | np.uint32(1), draws[number:, None]

    def sketch(self, hashes: np.ndarray) -> tuple[np.ndarray, bytes]:
        """The keys of all bands, the first collection before the second, as signed 64-bit integers, and a byte of each minhash."""
        short = (hashes >> np.uint64(32)).astype(np.uint32)
        least = np.full(len(self.factor), np.iinfo(np.uint32).max, dtype=np.uint32)
        for at in range(0, len(short), _SHINGLES):
            part = short[at : at + _SHINGLES]
            for i in range(0, len(self.factor), _FUNCTIONS):
                values = part ^ self.shift[i : i + _FUNCTIONS]
                values *= self.factor[i : i + _FUNCTIONS]
                values ^= values >> np.uint32(15)
                values *= np.uint32(0x2C1B3C6D)
                np.minimum(least[i : i + _FUNCTIONS], values.min(axis=1), out=least[i : i + _FUNCTIONS])
        least = least.astype(np.uint64)
        key = np.zeros(2 * self.bands, dtype=np.uint64)
        for value in least.reshape(2 * self.bands, self.rows).T:
            key = (key ^ value) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        return key.view(np.int64), (least & np.uint64(255)).astype(np.uint8).tobytes()


_ROW = "doc_id long, text string, digest binary, n long, keys array<long>, sketch binary"


def shingled(docs: DataFrame, words_per_shingle: int, bands: int, rows: int) -> tuple[DataFrame, str]:
    """(row, doc_id, text, digest, n, keys, sketch) per row of `docs`, stored once as a table bucketed by row; and its name.

    `n` counts the shingles, equal sets have equal 128-bit digests, `keys` are the bands of both collections, `sketch` has a
    byte of each minhash. Joins on row
    read the texts where they are: what meets them is shuffled to them. The caller drops the table; its files stay in
    the shared folder.
    """

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        functions = Minhashes(bands, rows)
        for batch in batches:
            at = 0
            for part in slices(batch.column(1)):
                sizes, digests, keys, sketches = [], [], [], []
                for text in part:
                    own = shingle_set(text, words_per_shingle)
                    sizes.append(len(own))
                    digests.append(xxhash.xxh3_128_digest(own.tobytes(), SEED))
                    own_keys, sketch = functions.sketch(own)
                    keys.append(own_keys)
                    sketches.append(sketch)
                ends = np.arange(len(part) + 1, dtype=np.int32) * (2 * bands)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(column.slice(at, len(part)) for column in batch.columns),
                        pa.array(digests, pa.binary()),
                        pa.array(sizes, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys))),
                        pa.array(sketches, pa.binary()),
                    ],
                    names=[field.split()[0] for field in _ROW.split(", ")],
                )
                at += len(part)
        release_memory()

    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    spread = texts.mapInArrow(of_batches, _ROW).withColumn("row", F.monotonically_increasing_id()).repartition(buckets, "row")
    name = f"shingled_{uuid.uuid4().hex}"
    stored = spread.write.bucketBy(buckets, "row").option("compression", "zstd")
    stored.option("path", new_folder(spark, "shingled")).saveAsTable(name)
    return spark.table(name), name


class _Members:
    """The members of a group: their sizes and sketches at once, their shingle sets when asked for."""

    def __init__(self, table: pa.Table, percent: int, width: int) -> None:
        self.table, self.texts, self.percent, self.width = table, table.column("text"), percent, width
        self.sizes = table.column("n").to_numpy()
        self.sketches = np.array([np.frombuffer(one, np.uint8) for one in table.column("sketch").to_pylist()])
        functions = self.sketches.shape[1]
        share = percent / 100
        # Equal minhashes of two sets at the threshold are a binomial number: this is eight deviations below its mean.
        self.least = functions * share - 8 * (functions * share * (1 - share)) ** 0.5
        self.sets: dict[int, np.ndarray] = {}

    def shingles(self, i: int) -> np.ndarray:
        if i not in self.sets:
            self.sets[i] = shingle_set(self.texts[i].as_py(), self.width)
        return self.sets[i]

    def near(self, i: int, others: np.ndarray) -> list[int]:
        """Those of `others` whose full sets are similar to that of `i`."""
        n = self.sizes[i]
        fits = 100 * np.minimum(self.sizes[others], n) >= self.percent * np.maximum(self.sizes[others], n)
        others = others[fits]
        others = others[(self.sketches[others] == self.sketches[i]).sum(axis=1) >= self.least]
        found = []
        for j in others.tolist():
            shared = len(np.intersect1d(self.shingles(i), self.shingles(j), assume_unique=True))
            if 100 * shared >= self.percent * (n + self.sizes[j] - shared):
                found.append(j)
        return found


Solve = Callable[[_Members, np.ndarray, np.ndarray], list[tuple[int, int]]]


def _in_groups(members: DataFrame, texts: DataFrame, keys: list[str], solve: Solve, percent: int, width: int) -> DataFrame:
    """Links (a, b) that `solve` finds in each group of `members` (keys..., node, component, side)."""

    def of_group(table: pa.Table) -> pa.Table:
        found = []
        if table.num_rows > 1:
            found = solve(_Members(table, percent, width), table.column("component").to_numpy(), table.column("side").to_numpy())
        ends = table.column("node").to_numpy()[np.array(found, dtype=np.int64).reshape(-1, 2)]
        return pa.table({"a": pa.array(ends[:, 0]), "b": pa.array(ends[:, 1])})

    loaded = members.join(texts, "node")
    return loaded.groupBy(*keys).applyInArrow(releasing(of_group), "a long, b long")


def _star(members: _Members, component: np.ndarray, side: np.ndarray) -> list[tuple[int, int]]:
    """Links (indices) of the one member of side 0 with the others."""
    center = int(np.argmin(side))
    return [(center, i) for i in members.near(center, np.flatnonzero(side > 0))]


def _stars(members: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """The links of `members` (center, node, n; distinct, stored) with their centers.

    A center may be that of many: its members are dealt to groups of bounded size, and it goes to each of them.
    """
    counts = members.groupBy("center").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("shingles"))
    parts = written(counts.withColumn("parts", F.ceil(F.col("shingles") / _BLOCK).cast("int")), "centers")
    dealt = join_counted(members, parts, ["center"], "rows").select(
        "center", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), "node", F.lit(1).alias("side")
    )
    own = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    centers = parts.select("center", own, F.col("center").alias("node"), F.lit(0).alias("side"))
    both = dealt.unionByName(centers).withColumn("component", F.lit(0).cast("long"))
    return _in_groups(both, texts, ["center", "part"], _star, percent, width)


def _shared(keyed: DataFrame) -> DataFrame:
    """Rows (key, node, n, component, ...) whose key also stands in another component, with `least`, the key's least (node, n).

    `keyed` is made twice: from stored rows, it costs less to make than to store.
    """
    seen = keyed.groupBy("key").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(F.struct("node", "n")).alias("least"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
    )
    several = written(seen.where("low < high").select("key", "rows", "least"), "shared-keys")
    return join_counted(keyed, several, ["key"], "rows")


def _forest(members: _Members, component: np.ndarray, side: np.ndarray) -> list[tuple[int, int]]:
    """Links (indices) that join what verified links join, among members of different components that share a bucket.

    Members already joined are not compared, nor two of one side when there are two sides: others compare those.
    """
    lists = members.table.column("buckets").combine_chunks()
    sizes = lists.value_lengths().to_numpy()
    bucket = np.unique(lists.flatten().to_numpy(), return_inverse=True)[1]
    by_bucket = np.repeat(np.arange(len(sizes)), sizes)[np.argsort(bucket, kind="stable")]
    in_bucket = np.split(by_bucket, np.cumsum(np.bincount(bucket))[:-1])
    own = np.split(bucket, np.cumsum(sizes)[:-1])
    root = np.unique(component, return_inverse=True)[1]
    two_sides, first = side.min() < side.max(), side.min()
    links = []
    for i in range(len(root)):
        if two_sides and side[i] != first:
            continue
        met = np.concatenate([in_bucket[b] for b in own[i].tolist()])
        ahead = side[met] != first if two_sides else met > i
        for j in members.near(i, np.unique(met[ahead & (root[met] != root[i])])):
            if root[j] != root[i]:
                links.append((i, j))
                root[root == root[j]] = root[i]
    return links


def _forests(members: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """Links between the components that meet in buckets of `members` (low, node, n, component, buckets; stored).

    All buckets with the same least component, `low`, are one group, so a text goes to a task once and not once for each
    of its buckets. A group too large for one task is cut into blocks by a hash of the node, and every two blocks meet in
    a task, so all members of a bucket are compared wherever they are.
    """
    weight = F.col("n") + F.size("buckets") + 64
    sized = members.groupBy("low").agg(F.count(F.lit(1)).alias("rows"), F.sum(weight).alias("weight"))
    sized = written(sized.select("low", "rows", F.ceil(F.col("weight") / _BLOCK).cast("int").alias("blocks")), "groups")
    dealt = join_counted(members, sized, ["low"], "rows").withColumn(
        "side", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "low",
        F.least("side", "other").alias("x"),
        F.greatest("side", "other").alias("y"),
        "side",
        "node",
        "component",
        "buckets",
    )
    return _in_groups(met, texts, ["low", "x", "y"], _forest, percent, width)


def _relabelled(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component; stored) of all `nodes` (node, component) after `links` (stored) between nodes of different components."""
    if links.isEmpty():
        return nodes
    low = nodes.select(F.col("node").alias("a"), F.col("component").alias("of_a"))
    high = nodes.select(F.col("node").alias("b"), F.col("component").alias("of_b"))
    between = links.join(low, "a").join(high, "b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
    joined = connected_components(between).select(F.col("node").alias("component"), F.col("component").alias("to"))
    return written(
        nodes.join(joined, "component", "left").select("node", F.coalesce("to", "component").alias("component")), "labels"
    )


def _components(nodes: DataFrame, texts: DataFrame, bands: int, percent: int, width: int) -> DataFrame:
    """(node, component) of `nodes` (node, n, keys; stored) that chains of verified links join."""
    alone = nodes.select("node", F.col("node").alias("component"))
    keyed = nodes.select("node", "n", F.col("node").alias("component"), F.posexplode("keys").alias("at", "value"))
    keyed = keyed.select(F.xxhash64("at", "value").alias("key"), "node", "n", "component", F.col("at").cast("int").alias("at"))
    found = written(_shared(keyed).select("key", "node", "n", "at"), "shared-bands")

    def tables(rows: DataFrame, *by: str) -> DataFrame:
        x = rows.where(F.col("at") < bands).withColumnRenamed("key", "x").withColumn("band", F.col("at"))
        y = rows.where(F.col("at") >= bands).select("node", F.col("key").alias("y"), (F.col("at") - bands).alias("band"))
        met = x.join(y if "band" in by else y.drop("band"), ["node", *by])
        return met.select(F.xxhash64("x", "y").alias("key"), "node", "n", "component")

    # Tables of equal bands first: every member is compared with the least one of its bucket.
    first = _shared(tables(found.withColumn("component", F.col("node")), "band")).where("node <> least.node")
    fits = F.least("n", "least.n") * 100 >= F.greatest("n", "least.n") * percent
    starred = first.where(fits).select(F.col("least.node").alias("center"), "node", "n").distinct()
    links = _stars(written(starred, "stars"), texts, percent, width)
    labels = _relabelled(alone, written(links, "links"))

    # All tables for what these did not join: keys of one component have nothing left to find.
    open_bands = written(_shared(found.join(labels, "node")).select("key", "node", "n", "at", "component"), "open-bands")
    open_tables = written(_shared(tables(open_bands)).select("key", "node", "n", "component"), "open-tables")
    if open_tables.isEmpty():
        return labels
    # Tables with the same members in a bucket would find the same links: one of them is enough.
    member = F.xxhash64("node")
    of_key = open_tables.groupBy("key").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("component").alias("low"),
        F.bit_xor(member).alias("x"),
        F.sum(F.shiftright(member, 32)).alias("y"),
    )
    one_of_equal = of_key.groupBy("rows", "low", "x", "y").agg(F.min("key").alias("key")).select("key", "rows", "low")
    members = join_counted(open_tables, written(one_of_equal, "kept-tables"), ["key"], "rows")
    of_node = members.groupBy("low", "node", "n", "component").agg(F.collect_list("key").alias("buckets"))
    more = _forests(written(of_node, "open-groups"), texts, percent, width)
    return _relabelled(labels, written(more, "links"))


def _without_table(rows: DataFrame, table: str) -> DataFrame:
    """The rows by their files, after the table's name is dropped from the catalog."""
    spark = rows.sparkSession
    place = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]
    spark.sql(f"DROP TABLE {table}")
    return spark.read.schema(rows.schema).parquet(place)


def near_duplicates(
    docs: DataFrame, words_per_shingle: int = 5, percent: int = 80, bands: int = 24, rows: int = 4
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of `docs` (doc_id, text, ...).

    Rows are linked whose sets of distinct word shingles have 100 * intersection >= `percent` * union; component_id is
    the smallest doc_id that links reach, `kept` whether it is the row's own. Texts of fewer words are one shingle; NULL
    and empty texts have no shingles and are linked with nothing. A row without doc_id takes part but names no component:
    where no member has an id, component_id is NULL and all are kept. Rows that repeat a doc_id with another text are
    rows of their own. No documents give no rows; further columns of `docs` are not used.

    Equal sets collapse to one node. A table key joins a band of one collection of minhashes with a band of another, so
    `bands`² tables need 2 * `bands` * `rows` functions; at the threshold of 80 % a link is missed with a probability
    below 1 in 100,000. Table keys are formed for bands only that another node shares. Tables of equal bands come first,
    where each member is compared with the least of its bucket; the others are formed for bands that still stand in
    several components. Their buckets are solved in tasks, all buckets of one component together, where no pair leaves a
    task but a link. Every link is verified by the 64-bit hashes of all shingles
    of both texts; pairs whose minhashes are eight deviations from the threshold, which a similar pair is once in 10^14, are
    not compared further.
    """
    every, table = shingled(docs, words_per_shingle, bands, rows)
    classes = written(
        every.where("n > 0").groupBy("digest").agg(
            F.min("row").alias("node"), F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")
        ),
        "classes",
    )
    known = every.withColumnRenamed("row", "node")
    nodes = written(known.select("node", "n", "keys").join(classes.select("node"), "node"), "nodes")
    labels = _components(nodes, known.select("node", "text", "n", "sketch"), bands, percent, words_per_shingle)
    named = classes.join(labels, "node")
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_digest = written(named.join(smallest, "component").select("digest", "copies", "component_id"), "components")
    every = _without_table(every, table)
    filled = join_counted(every.where("n > 0").select("doc_id", "digest", "n"), by_digest, ["digest"], "copies")
    bare = every.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    found = filled.select("doc_id", "n", "component_id").unionByName(bare)
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"),
    )
