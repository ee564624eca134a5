"""SimHash near-duplicates: fingerprints of word shingles, linked through BK-trees.

Fingerprints within ``RADIUS`` differing bits of each other agree in one of ``RADIUS + 1`` blocks of
their 64 bits at least. So each distinct fingerprint goes to one tree for each block, named by the
block's place and value, and a tree is searched by those fingerprints alone that share its block: that
takes the place of sending every tree to every task, whose size would grow with the corpus. In a tree,
a node's children are keyed by their Hamming distance to it, and a search follows only the edges whose
key lies within the radius of the distance found. A block value with more than ``CAP`` fingerprints is
cut into shards; each shard's tree is searched by the fingerprints of its own and of the later shards,
so no task holds or searches more than 2 x CAP at a time and no link is lost. A task emits a spanning
forest of its links, never all pairs.

``first_of_each`` takes the similarity itself: documents whose sets of five-word shingles have a Jaccard similarity
of 0.8 or more are linked. Their fingerprints differ in some ten of 64 bits, and blocks that such a radius leaves
would hold everything; so its trees are named by MinHash bands instead, of which two sets of similarity s share one
with the probability 1 - (1 - s^3)^16, all but 1 in 50,000 at 0.8. Each tree is searched within ``WIDE_RADIUS``
bits (some 3.5 standard deviations over the mean at 0.8), and what it finds is checked by the exact similarity of
the texts, unless links found before connect the two. Documents of one set of shingles are one node, and trees of
the same nodes are one tree. A tree of more than ``CAP`` nodes or ``CAP_BYTES`` of texts is cut into shards: each is
linked inside, and with ``HUBS`` nodes of the whole tree; then what is not in the tree's largest component meets all
of its shards. So a huge group of copies costs a comparison or two a node, and no pair found is left unchecked.

Defined results: null or empty texts, or texts of white space only, have fingerprint 0 and are linked
like any other; texts of fewer than three words have one shingle; rows with a null id take part, and a
component whose ids are all null has a null component_id. Repeated rows repeat in the result. Only
named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, free_names, materialize, once, quoted, release, written
from .components import connected_components

SHINGLE, SEED, RADIUS, CAP = 3, 42, 3, 2048
STEP = 1 << 16
#: Of near copies by similarity: words of a shingle, least Jaccard similarity, radius; bands, and minima of each.
WIDE_SHINGLE, SIMILARITY, WIDE_RADIUS = 5, 0.8, 20
BANDS, ROWS = 16, 3
#: The bytes of texts in a shard, the nodes that search all shards of a tree, and the words whose hash is kept.
CAP_BYTES, HUBS, KNOWN = 16 << 20, 8, 300_000
#: Up to so many candidates of a node are compared one by one.
FEW = 6


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bit k is set where over half of the shingles' XXH64 have it set; no words: 0."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[: -shingle]])
    ends = ends[shingle - 1 :] - 1
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for k in range(0, len(starts), STEP):
        spans = zip(starts[k : k + STEP].tolist(), ends[k : k + STEP].tolist(), strict=True)
        hashes = np.array([digest(line[a:b], seed) for a, b in spans], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(starts), bitorder="little").view(np.uint64)[0])


def _fingerprints(texts: pa.Array) -> pa.Array:
    values = np.array([fingerprint(t) for t in texts.to_pylist()], np.uint64)
    return pa.array(values.view(np.int64))


def fingerprints(df: DataFrame, text: str = "text", out: str = "fp") -> DataFrame:
    """Adds the fingerprint, as the signed long of the same bits."""
    bound_batches(df.sparkSession)
    return df.withColumn(out, once(_fingerprints, "bigint")(df[text].cast("binary")))


class BKTree:
    """A metric tree over integers under the Hamming distance."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def insert(self, value: int) -> None:
        """Equal values are kept once."""
        if self.values:
            at = 0
            while d := (self.values[at] ^ value).bit_count():
                down = self.children[at].get(d)
                if down is None:
                    self.children[at][d] = len(self.values)
                    break
                at = down
            else:
                return
        self.values.append(value)
        self.children.append({})

    def within(self, value: int, radius: int) -> Iterator[int]:
        """Values at most ``radius`` from ``value``."""
        values, children = self.values, self.children
        pending = [0] if values else []
        while pending:
            at = pending.pop()
            d = (values[at] ^ value).bit_count()
            if d <= radius:
                yield values[at]
            edges = children[at]
            if len(edges) > 2 * radius:
                pending += [edges[k] for k in range(d - radius, d + radius + 1) if k in edges]
            else:
                pending += [n for k, n in edges.items() if -radius <= k - d <= radius]


def _forest(build: list[int], probe: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that connect what the links of build with build, or with probe if there is one, connect."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while (p := parent.get(x, x)) != x:
            parent[x] = parent.get(p, p)
            x = p
        return x

    tree, links = BKTree(), []
    for grow, values in ((True, build), (False, probe)):
        for value in values:
            if not (grow and probe):
                for other in tree.within(value, radius):
                    a, b = top(value), top(other)
                    if a != b:
                        parent[a] = b
                        links.append((value, other))
            if grow:
                tree.insert(value)
    return links


_MASK = (1 << 64) - 1


def _search(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows (group, role, fp) that are sorted by group: each group is one tree and its searches."""
    names = ["a", "b"]

    def emit(links: list[tuple[int, int]]) -> pa.RecordBatch:
        pairs = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names)

    current, build, probe, links = None, [], [], []
    for batch in batches:
        keys, roles, values = (batch.column(i).to_pylist() for i in range(3))
        for key, role, value in zip(keys, roles, values, strict=True):
            if key != current:
                if len(build) + len(probe) > 1:
                    links += _forest(build, probe, radius)
                    if len(links) > 50_000:
                        yield emit(links)
                        links = []
                current, build, probe = key, [], []
            (probe if role else build).append(value & _MASK)
    if len(build) + len(probe) > 1:
        links += _forest(build, probe, radius)
    if links:
        yield emit(links)


def links(fps: DataFrame, radius: int = RADIUS, cap: int = CAP) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp``, enough to connect all within the radius."""
    spark = fps.sparkSession
    blocks = radius + 1
    width = 64 // blocks
    edges = [64 * i // blocks for i in range(blocks + 1)]
    value = lambda i: F.shiftrightunsigned("fp", edges[i]).bitwiseAND((1 << (edges[i + 1] - edges[i])) - 1)
    keyed = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), value(i).alias("v")) for i in range(blocks)])).alias("k"))
    keyed = keyed.select("fp", (F.col("k.v") * blocks + F.col("k.i")).alias("key"))
    # at most blocks << width different keys, whatever the corpus: 262144 for radius 3
    hot = keyed.groupBy("key").count().filter(F.col("count") > cap)
    hot = hot.select("key", F.ceil(F.col("count") / cap).cast("int").alias("shards"))
    hot = F.broadcast(hot) if blocks << width <= 1 << 20 else hot
    spread = keyed.join(hot, "key", "left").withColumn("shards", F.coalesce("shards", F.lit(1)))
    spread = spread.withColumn("mine", F.pmod(F.xxhash64("fp", F.lit(1)), F.col("shards")).cast("int"))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    spread = spread.select(
        F.concat_ws("/", "key", F.least("mine", "other"), F.greatest("mine", "other")).alias("grp"),
        (F.col("mine") > F.col("other")).cast("int").alias("role"),
        "fp",
    )
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = spread.repartition(n, "grp").sortWithinPartitions("grp", "role", "fp")
    bound_batches(spark, rows=10_000)
    found = dealt.mapInArrow(lambda it: _search(it, radius), "a bigint, b bigint")
    return found.distinct()


def classes(rows: DataFrame, key: str = "doc_id", fp: str = "fp", radius: int = RADIUS, cap: int = CAP) -> DataFrame:
    """(fp, root, component_id) of each distinct fingerprint of ``rows``: its class, named by the
    least fingerprint in it, and the least key in reach."""
    fps = materialize(rows.groupBy(F.col(fp).alias("fp")).agg(F.min(key).alias("first")), "fps")
    roots = materialize(connected_components(links(fps, radius, cap)), "roots")
    linked = materialize(fps.join(roots, fps["fp"] == roots["node"]).select("fp", "first", "root"), "linked")
    least = linked.groupBy("root").agg(F.min("first").alias("least"))
    least = materialize(least.withColumnRenamed("root", "r"), "least")
    linked = linked.join(least, linked["root"] == least["r"]).select(F.col("fp").alias("node"), "root", "least")
    linked = materialize(linked, "linked")
    out = fps.join(linked, fps["fp"] == linked["node"], "left")
    out = out.select("fp", F.coalesce("root", "fp").alias("root"), F.when(F.col("node").isNull(), F.col("first")).otherwise(F.col("least")).alias("component_id"))
    return materialize(out, "classes")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, cap: int = CAP) -> DataFrame:
    """One row per row: key, fingerprint (16 hex digits), component_id."""
    rows = materialize(fingerprints(df.select(key, text), text).select(key, "fp"), "fingerprints")
    found = classes(rows, key, "fp", radius, cap).withColumnRenamed("fp", "node")
    return rows.join(found, rows["fp"] == found["node"]).select(
        key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


_FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


class Words(dict):
    """The hash of each word, kept for up to ``KNOWN`` words."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word, SEED)
        if len(self) >= KNOWN:
            self.clear()
        self[word] = value
        return value


_words = Words()


def shingles(text: bytes | None, size: int = WIDE_SHINGLE) -> np.ndarray:
    """The different 64-bit hashes of the shingles, in order: a shingle's is mixed from those of its words."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    own = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    size = min(size, len(own))
    mixed = np.full(len(own) - size + 1, size, np.uint64)
    for k in range(size):
        mixed = (mixed ^ own[k : k + len(mixed)]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two arrays of different values; two empty ones are alike."""
    total = len(a) + len(b)
    if not total:
        return 1.0
    both = np.sort(np.concatenate([a, b]))
    same = int(np.count_nonzero(both[1:] == both[:-1]))
    return same / (total - same)


def _sketch(hashes: np.ndarray) -> tuple[int, list[int]]:
    """The fingerprint of a set of shingles, and the names of its trees."""
    ones, least = np.zeros(64, np.int64), np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(hashes), STEP >> 4):
        part = hashes[k : k + (STEP >> 4)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        least = np.minimum(least, (part[None, :] * _FACTORS[:, None]).min(axis=1))
    fp = int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.int64)[0])
    bands = [xxhash.xxh64_intdigest(r.tobytes(), i) for i, r in enumerate(least.reshape(BANDS, ROWS))] if len(hashes) else []
    return fp, np.array(bands, np.uint64).view(np.int64).tolist()


def _sketches(texts: pa.Array) -> pa.Array:
    nodes, fps, bands = [], [], []
    for text in texts.to_pylist():
        hashes = shingles(text)
        nodes.append(xxhash.xxh64_intdigest(hashes.tobytes(), SEED))
        fp, names = _sketch(hashes)
        fps.append(fp)
        bands.append(names)
    columns = [pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(fps, pa.int64()), pa.array(bands, pa.list_(pa.int64()))]
    return pa.StructArray.from_arrays(columns, ["node", "fp", "bands"])


def sketches(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds struct<node, fp, bands>: the set of shingles' hash, its fingerprint, and its trees."""
    bound_batches(df.sparkSession)
    return df.withColumn(out, once(_sketches, "struct<node: bigint, fp: bigint, bands: array<bigint>>")(df[text].cast("binary")))


class Overlaps:
    """How many values each of some sets shares with another set, all counted at once."""

    def __init__(self, sets: dict[int, np.ndarray], size: int) -> None:
        flat = np.concatenate([np.empty(0, np.uint64), *sets.values()])
        owner = np.repeat(np.array(list(sets), np.int64), [len(s) for s in sets.values()])
        order = np.argsort(flat, kind="stable")
        self.values, self.owner, self.size = flat[order], owner[order], size
        self.sizes = np.zeros(size, np.int64)
        self.sizes[list(sets)] = [len(s) for s in sets.values()]

    def similar(self, own: np.ndarray, others: np.ndarray) -> np.ndarray:
        """The Jaccard similarity of a set that isn't empty with each of the others."""
        low, high = np.searchsorted(self.values, own), np.searchsorted(self.values, own, side="right")
        many = high - low
        at = np.arange(int(many.sum())) + np.repeat(low - np.cumsum(many) + many, many)
        both = np.bincount(self.owner[at], minlength=self.size)[others]
        return both / (len(own) + self.sizes[others] - both)


def _verified(rows: list[tuple], least: float, radius: int, inside: bool) -> list[tuple[int, int]]:
    """Links of one tree: rows are (role, node, root, fp, text), those of role 0 are in the tree, the others
    search it (and with ``inside`` they too). Rows of one component are not compared."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while (p := parent.get(x, x)) != x:
            parent[x] = parent.get(p, p)
            x = p
        return x

    tree, at, links = BKTree(), {}, []
    sets: dict[int, np.ndarray] = {}
    overlaps = None

    def of(i: int) -> np.ndarray:
        if i not in sets:
            sets[i] = shingles(rows[i][4])
        return sets[i]

    for i, (role, node, root, fp, _) in enumerate(rows):
        value = fp & _MASK
        near = (j for v in tree.within(value, radius) for j in at[v]) if role or inside else ()
        own = top(root)
        found = [j for j in near if top(rows[j][2]) != own]
        if len(found) > FEW and len(of(i)):
            if overlaps is None:
                overlaps = Overlaps({j: of(j) for j, r in enumerate(rows) if not r[0]}, len(rows))
            others = np.array(found)
            found = others[overlaps.similar(of(i), others) >= least].tolist()
        else:
            found = [j for j in found if jaccard(of(i), of(j)) >= least]
        for j in found:
            a, b = top(root), top(rows[j][2])
            if a != b:
                parent[a] = b
                links.append((node, rows[j][1]))
        if not role:
            tree.insert(value)
            at.setdefault(value, []).append(i)
    return links


def _search_verified(batches: Iterator[pa.RecordBatch], least: float, radius: int, inside: bool) -> Iterator[pa.RecordBatch]:
    """Rows (group, role, node, root, fp, text) that are sorted by group and role."""
    current, rows, links = None, [], []

    def emit() -> pa.RecordBatch:
        pairs = np.array(links, np.int64).reshape(-1, 2)
        return pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    for batch in batches:
        for key, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != current:
                links += _verified(rows, least, radius, inside)
                if len(links) > 50_000:
                    yield emit()
                    links = []
                current, rows = key, []
            rows.append(tuple(row))
    links += _verified(rows, least, radius, inside)
    if links:
        yield emit()


def _verify(dealt: DataFrame, texts: DataFrame, least: float, radius: int, inside: bool) -> DataFrame:
    """Links of the trees of rows (grp, role, node, root)."""
    spark = dealt.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bound_batches(spark)
    # dealt by node already, where one text of each is kept
    rows = dealt.join(texts.hint("merge"), F.col("node") == F.col("tn")).select("grp", "role", "node", "root", "fp", "t")
    rows = rows.repartition(n, "grp").sortWithinPartitions("grp", "role", "node")
    return rows.mapInArrow(lambda it: _search_verified(it, least, radius, inside), "a bigint, b bigint").distinct()


def similar_roots(rows: DataFrame, source: DataFrame, least: float = SIMILARITY, radius: int = WIDE_RADIUS, cap: int = CAP, cap_bytes: int = CAP_BYTES) -> tuple:
    """(node, root) of each linked node of rows (p, q, node, fp, bands, size), and the paths of tables that may go;
    ``source`` (p, q, t) has the texts, which are read for the nodes of trees alone."""
    spark = rows.sparkSession
    used: list[str] = []

    def kept(df: DataFrame, tag: str) -> DataFrame:
        df, path = written(df, tag)
        used.append(path)
        return df

    nodes = rows.groupBy("node").agg(F.first("bands").alias("bands"), F.max("size").alias("size"), F.first("fp").alias("fp"), F.min(F.struct("p", "q")).alias("at"))
    nodes = kept(nodes, "nodes")
    every = nodes.select("node", "size", F.explode("bands").alias("band"))
    marks = [F.expr(f"bit_xor(xxhash64({i}, node))").alias(f"s{i}") for i in (1, 2)]
    trees = every.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"), *marks).filter("n > 1")
    # trees of the same nodes are one tree
    trees = trees.groupBy("n", "bytes", "s1", "s2").agg(F.min("band").alias("tree"))
    shards = F.ceil(F.greatest(F.col("n") / cap, F.col("bytes") / cap_bytes)).cast("int").alias("shards")
    trees = kept(trees.select("tree", shards), "trees")
    members = every.join(trees, F.col("band") == F.col("tree")).select("tree", "shards", "node")
    members = kept(members.withColumn("mine", F.pmod(F.xxhash64("node", F.lit(1)), F.col("shards")).cast("int")), "members")
    needed = members.select(F.col("node").alias("tn")).distinct()
    reps = nodes.join(needed, F.col("node") == F.col("tn")).select("tn", "fp", F.col("at.p").alias("rp"), F.col("at.q").alias("rq"))
    reps = kept(reps, "texts")
    # by sorting at every size: neither side has a bound
    texts = source.join(reps.hint("merge"), (F.col("p") == F.col("rp")) & (F.col("q") == F.col("rq"))).select("tn", "fp", F.col("t").cast("binary").alias("t")).dropDuplicates(["tn"])
    grp = lambda *parts: F.concat_ws("/", *parts)
    own = members.select(grp("tree", "mine").alias("grp"), F.lit(0).alias("role"), "node", F.col("node").alias("root"))
    # some nodes of a tree of several shards search each shard, so that one large group of copies is linked at once
    hubs = members.filter("shards > 1").groupBy("tree", "shards", F.pmod(F.xxhash64("node", F.lit(7)), F.lit(HUBS)).alias("slot")).agg(F.min("node").alias("node"))
    hubs = hubs.withColumn("to", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    hubs = hubs.filter(F.col("to") != F.pmod(F.xxhash64("node", F.lit(1)), F.col("shards")))
    guests = hubs.select(grp("tree", "to").alias("grp"), F.lit(1).alias("role"), "node", F.col("node").alias("root"))
    links = kept(_verify(own.unionByName(guests), texts, least, radius, True), "links")
    roots = kept(connected_components(links), "roots")
    wide = members.filter("shards > 1")
    if wide.isEmpty():
        return roots, *used
    # in these, nodes outside of the largest component meet all nodes of other shards
    named = roots.select(F.col("node").alias("rn"), F.col("root").alias("r"))
    wide = wide.join(named, F.col("node") == F.col("rn"), "left").select("tree", "node", "mine", F.coalesce("r", "node").alias("root"))
    sizes = wide.groupBy("tree", "root").count().groupBy(F.col("tree").alias("wt"))
    sizes = sizes.agg(F.max(F.struct("count", "root")).alias("most"), F.sum("count").alias("all"))
    sizes = kept(sizes.filter("all > most.count").select("wt", F.col("most.root").alias("main"), F.ceil((F.col("all") - F.col("most.count")) / cap).cast("int").alias("parts")), "sizes")
    wide = kept(wide.join(sizes, F.col("tree") == F.col("wt")).select("tree", "node", "mine", "root", "main", "parts"), "wide")
    shards = wide.groupBy(F.col("tree").alias("wt")).agg(F.max("mine").alias("last"))
    rest = wide.filter("root <> main").withColumn("part", F.pmod(F.xxhash64("node", F.lit(3)), F.col("parts")))
    rest = rest.join(shards, F.col("tree") == F.col("wt")).withColumn("to", F.explode(F.sequence(F.lit(0), F.col("last"))))
    rest = rest.select(grp("tree", "part", "to").alias("grp"), F.lit(0).alias("role"), "node", "root")
    search = wide.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    search = search.select(grp("tree", "part", "mine").alias("grp"), F.lit(1).alias("role"), "node", "root")
    more = _verify(rest.unionByName(search), texts, least, radius, False)
    links = kept(links.unionByName(more), "links")
    return kept(connected_components(links), "roots"), *used


def first_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``df``, all columns, without near copies: of each component of ``similar_roots`` the row of
    least key stays (nulls first, then by a hash of all its columns); of wholly equal rows one stays."""
    names = df.columns
    mark1, mark2, m1, m2 = free_names(df, "mark1", "mark2", "m1", "m2")
    kinds = dict(df.dtypes)
    every = [F.to_json(F.struct(quoted(c))) if "map" in kinds[c] or "variant" in kinds[c] else F.col(quoted(c)) for c in names]
    marks = [F.xxhash64(F.lit(i), *every) for i in (1, 2)]
    source = df.select(F.col(quoted(key)).alias("k"), F.col(quoted(text)).alias("t"), marks[0].alias("p"), marks[1].alias("q"))
    size = F.coalesce(F.octet_length("t"), F.lit(0)).cast("long").alias("size")
    rows, path = written(sketches(source, "t", "s").select("k", "p", "q", "s.node", "s.fp", "s.bands", size), "sketches")
    roots, *used = similar_roots(rows, source.select("p", "q", "t"), **options)
    roots = roots.select(F.col("node").alias("n"), "root")
    joined = rows.select("k", "p", "q", "node").join(roots, F.col("node") == F.col("n"), "left").withColumn("root", F.coalesce("root", "node"))
    best = joined.groupBy("root").agg(F.min(F.struct("k", "p", "q")).alias("best"))
    best = materialize(best.select(F.col("best.p").alias(m1), F.col("best.q").alias(m2)).distinct(), "kept")
    more = rows.groupBy("p", "q").count().filter("count > 1").select(F.col("p").alias(m1)).distinct()
    more = materialize(more, "repeats")
    for p in (path, *used):
        release(df.sparkSession, p)
    kept = df.select("*", marks[0].alias(mark1), marks[1].alias(mark2))
    kept = kept.join(best.hint("merge"), (F.col(mark1) == F.col(m1)) & (F.col(mark2) == F.col(m2))).drop(m1, m2)
    if more.isEmpty():
        return kept.select(*map(quoted, names))
    flat = [quoted(c) for c in names if "map" not in kinds[c] and "variant" not in kinds[c] and c != text]
    single = kept.join(more, F.col(mark1) == F.col(m1), "left_anti")
    repeated = kept.join(more, F.col(mark1) == F.col(m1), "left_semi").dropDuplicates([mark1, mark2, *(c.strip("`") for c in flat)])
    return single.select(*map(quoted, names)).unionByName(repeated.select(*map(quoted, names)))
