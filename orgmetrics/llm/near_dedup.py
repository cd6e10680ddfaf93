"""MinHash near-dedup over an LSH forest, confirmed on full shingle sets.

1. Texts with equal shingle sets become one node.
2. Every tree of the forest sorts all nodes by min-hashes in an order of its own. In the sorted order
   the nodes with the longest common prefixes stand together: a node's candidates are the ``WINDOW``
   nodes before and after it that share at least ``DEPTH`` min-hashes with it. How deep the tree
   looked at a node follows from its region: where more nodes share a prefix than the window holds,
   only longer prefixes were compared in full.
3. A node whose regions were deep could have missed a partner. Its chance of that is summed up over
   the trees, and as long as it is above ``MISS`` the node goes through further trees, with such nodes
   alone. Nodes found to be neighbours by then are one cluster, and no longer take up each other's
   windows. So candidates grow with the nodes, and no pair is dropped for the size of a region.
4. Candidates whose signatures agree well enough are neighbours and form loose clusters: any two texts
   that reach the threshold are in one. The full sets of a cluster are compared exactly, block by
   block. A text that is known to be linked to the largest part of its blocks is compared no
   further, all others are compared with every text of the cluster.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orgmetrics.llm.batches import BINARY, LONG, SharedFolder, filled, per_text, text_slices
from orgmetrics.llm.components import components
from orgmetrics.llm.shingles import MinHash, Shingler, mix

DEPTH = 3  # min-hashes that two nodes of a region share
LONGEST = 16  # min-hashes by which a tree sorts
APART = 6  # min-hashes from the first of one tree to that of the next
MISS = 1e-6  # chance at most that a pair at the threshold is never compared
HASHES = 128
WIDTHS_OF_ERROR = 4.5  # signatures may fall short of the threshold by so many standard deviations
FURTHER = 3  # times the trees in every further turn, which has few nodes
WINDOW = 64  # nodes before and after a node in a sorted order that it is compared with
CLOSEST = 4  # rows after a row that are compared before all others
ROWS = 4096  # of a sorted order in one block; neighbours beyond its ends are copied to it
BEYOND = 256
BLOCKS = 24  # per cluster, of at least 64 and at most ...
BLOCK_SHINGLES = 2_000_000  # ... so many shingles


@lru_cache(maxsize=4)
def _shingler(width: int) -> Shingler:
    return Shingler(width)


@lru_cache(maxsize=1)
def _minhash() -> MinHash:
    return MinHash(HASHES)


def _describe(docs: DataFrame, width: int, text: str, key: str) -> DataFrame:
    """(doc, n_shingles, digest of the set, two bytes of each min-hash)."""

    def make():
        shingler, minhash = _shingler(width), _minhash()

        def one(found: np.ndarray) -> tuple:
            if not len(found):
                return 0, None, None
            signature = minhash.signature(found)
            return (
                len(found),
                hashlib.blake2b(found.tobytes(), digest_size=16).digest(),
                (signature & 0xFFFF).astype(">u2").tobytes(),
            )

        return lambda texts: [one(s) for s in shingler.sets(texts)]

    rows = docs.select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("body"))
    return per_text(rows, ["doc"], "body", {"n_shingles": LONG, "digest": BINARY, "signature": BINARY}, make)


def _by_key(df: DataFrame, keys: list[str], run: Callable, schema: str) -> DataFrame:
    """``run(group)`` for every key, many small groups per task; groups are of bounded size."""

    # Nullable integers: a column of integers and None would become floats, which round 64-bit keys.
    types = {"bigint": "Int64", "double": "float64"}
    named = [(c.split()[0], types[c.split()[1]]) for c in schema.split(", ")]

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame({n: pd.array([r[i] for r in rows], dtype=t) for i, (n, t) in enumerate(named)})

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if not len(batch):
                continue
            columns = [batch[k].to_numpy() for k in keys]
            new = np.zeros(len(batch), dtype=bool)
            for c in columns:
                new[1:] |= c[1:] != c[:-1]
            cuts = [0, *np.flatnonzero(new).tolist()]
            found = [run(batch.iloc[a:b]) for a, b in zip(cuts, cuts[1:])]
            rest = batch.iloc[cuts[-1] :]
            yield frame([r for rows in found for r in rows])
        if rest is not None and len(rest):
            yield frame(run(rest))

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartition(n, *keys).sortWithinPartitions(*keys)
    return dealt.mapInPandas(stream, schema)


def _trees(level: float) -> int:
    """Trees that compare all but ``MISS`` of the pairs of similarity ``level``, none deeper than ``DEPTH``."""
    return math.ceil(math.log(MISS) / math.log1p(-(level**DEPTH)))


@lru_cache(maxsize=64)
def _orders(trees: int, turn: int) -> np.ndarray:
    """Which min-hashes each tree of a turn sorts by."""
    rng, each = np.random.default_rng(100 + turn), HASHES // APART
    mixed = [rng.permutation(HASHES) for _ in range(-(-trees // each))]
    return np.stack([np.roll(mixed[t // each], -APART * (t % each))[:LONGEST] for t in range(trees)])


def _signatures(packed) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, packed)), dtype=">u2").reshape(-1, HASHES)


def _sorted_orders(nodes: DataFrame, trees: int, turn: int, folder: SharedFolder) -> DataFrame:
    """(rank, region, tail, node, cluster, signature): every tree's order, one after another.

    ``region`` stands for a tree and a prefix of ``DEPTH`` min-hashes, ``tail`` for those after it.
    Regions of one node are left out.
    """

    def regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = _orders(trees, turn)
        for batch in batches:
            first = _signatures(batch.column(1).to_pylist())[:, orders[:, :DEPTH]].astype(np.uint64)
            found = np.arange(trees, dtype=np.uint64) + np.uint64(1)
            for j in range(DEPTH):
                found = mix(found * np.uint64(0x9E3779B97F4A7C15) + first[:, :, j])
            lists = pa.array(list(found.view(np.int64)), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["node", "regions"])

    rows = nodes.select("node", "signature").mapInArrow(regions, "node bigint, regions array<bigint>")
    rows = folder.table(rows.select("node", F.posexplode("regions").alias("tree", "region")), f"regions{turn}")
    several = rows.groupBy("region").agg(F.count("*").alias("n")).filter("n > 1").select("region")
    # Written first: so a region that holds much of the rows can be split in the join.
    rows = rows.join(folder.table(several, f"several{turn}"), "region", "left_semi").join(nodes, "node")

    def tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = _orders(trees, turn)
        for batch in batches:
            if not batch.num_rows:
                continue
            signatures, tree = _signatures(batch.column(4).to_pylist()), batch.column(1).to_numpy()
            tail = np.ascontiguousarray(np.take_along_axis(signatures, orders[tree, DEPTH:], axis=1))
            tail = pa.array([t.tobytes() for t in tail], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, tail], ["node", "tree", "region", "cluster", "signature", "tail"])

    rows = rows.select("node", "tree", "region", "cluster", "signature").mapInArrow(
        tails, "node bigint, tree int, region bigint, cluster bigint, signature binary, tail binary"
    )
    by = ["region", "tail", "node"]
    placed = rows.drop("tree").repartitionByRange(*by).sortWithinPartitions(*by)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = folder.table(placed.withColumn("range", F.spark_partition_id()).withColumn("place", place), f"order{turn}")
    # A place in its range, after the rows of all earlier ranges: one number per range.
    counts = placed.groupBy("range").agg(F.count("*").alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return placed.join(F.broadcast(counts), "range").withColumn("rank", F.col("before") + F.col("place"))


class _Forest:
    """Nodes of a block that are known to be connected."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> list[int]:
        """Connects pairs; the places of those that connected something new."""
        pairs = self.label[np.stack([a, b])]
        pairs.sort(axis=0)
        _, first = np.unique(pairs[0] * len(self.label) + pairs[1], return_index=True)
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while x in root:
                x = root[x]
            return x

        new = []
        for at in sorted(first.tolist()):
            x, y = find(int(pairs[0, at])), find(int(pairs[1, at]))
            if x != y:
                root[max(x, y)] = min(x, y)
                new.append(at)
        if root:
            table = np.arange(len(self.label))
            for x in root:
                table[x] = find(x)
            self.label = table[self.label]
        return new


def _common(tails: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-hashes at the beginning that rows of one region share."""
    same = tails[a] == tails[b]
    return DEPTH + np.where(same.all(axis=1), same.shape[1], same.argmin(axis=1))


def _neighbours(least: float, level: float) -> Callable:
    """For the rows of a block: (a, b, 0) links that connect neighbours; (node, null, lack).

    ``lack`` is by how much the logarithm of a node's chance to miss a partner is larger than if the
    whole region had been compared.
    """
    enough = math.ceil(least * HASHES)
    full = math.log1p(-(level**DEPTH))

    def run(group: pd.DataFrame) -> list[tuple]:
        group = group.iloc[np.argsort(group["rank"].to_numpy(), kind="stable")]
        node, region, cluster = (group[c].to_numpy() for c in ("node", "region", "cluster"))
        n = len(node)
        own = np.flatnonzero(group["rank"].to_numpy() // ROWS == group["block"].to_numpy())
        if n < 2 or not len(own):
            return []
        signatures = _signatures(group["signature"])
        tails = np.frombuffer(b"".join(map(bytes, group["tail"])), dtype=">u2").reshape(n, -1)
        forest, found = _Forest(n), []
        # Rows of one cluster are connected already.
        forest.label = np.unique(cluster, return_index=True, return_inverse=True)[1:]
        forest.label = forest.label[0][forest.label[1]]

        def connect(a: np.ndarray, b: np.ndarray) -> None:
            found.extend((int(node[a[i]]), int(node[b[i]]), 0.0) for i in forest.join(a, b))

        def compare(a: np.ndarray, b: np.ndarray) -> None:
            new = forest.label[a] != forest.label[b]
            a, b = a[new], b[new]
            near = np.zeros(len(a), dtype=bool)
            for k in range(0, len(a), 2048):
                part = slice(k, k + 2048)
                near[part] = (signatures[a[part]] == signatures[b[part]]).sum(axis=1) >= enough
            if near.any():
                connect(a[near], b[near])

        # Rows that agree on all that a tree sorts by are neighbours without more ado.
        next_ = own[own < n - 1]
        next_ = next_[region[next_] == region[next_ + 1]]
        equal = next_[(tails[next_] == tails[next_ + 1]).all(axis=1)]
        if len(equal):
            connect(equal, equal + 1)
        # The closest rows first: what they connect is one cluster from here on.
        for w in range(1, CLOSEST + 1):
            near = own[own < n - w]
            near = near[region[near] == region[near + w]]
            if len(near):
                compare(near, near + w)
        cluster = forest.label.copy()
        # Rows of one cluster side by side are passed over together.
        change = np.flatnonzero((region[1:] != region[:-1]) | (cluster[1:] != cluster[:-1])) + 1
        edges = np.r_[0, change, n]
        run_of = np.searchsorted(change, np.arange(n), side="right")
        start, stop = edges[run_of], edges[run_of + 1]
        for w in range(WINDOW):
            sides = [(stop[own] + w, 1)]
            if len(edges) <= n:
                sides.append((start[own] - 1 - w, -1))
            for other, _ in sides:
                good = (other >= 0) & (other < n)
                a, b = own[good], other[good]
                good = (region[a] == region[b]) & (cluster[a] != cluster[b])
                if good.any():
                    compare(a[good], b[good])
        # The last row looked at on each side: what has a longer prefix in common was looked at.
        depth = np.full(len(own), DEPTH)
        for last in (np.minimum(stop[own] + WINDOW - 1, n - 1), np.maximum(start[own] - WINDOW, 0)):
            within = (region[last] == region[own]) & (last != own)
            deep = np.minimum(LONGEST, _common(tails, own, last) + 1)
            depth = np.where(within, np.maximum(depth, deep), depth)
        lack = np.log1p(-(level**depth)) - full
        found.extend((int(node[own[i]]), None, float(lack[i])) for i in np.flatnonzero(lack > 0))
        return found

    return run


def _merged(clusters: DataFrame, links: DataFrame, folder: SharedFolder, turn: int) -> DataFrame:
    """``clusters`` after links between some of them; a further turn finds few or none."""
    ends = links
    for end in ("a", "b"):
        of = clusters.select(F.col("node").alias(end), F.col("cluster").alias(f"{end}c"))
        ends = ends.join(of, end)
    ends = folder.table(ends.filter("ac <> bc").select(F.col("ac").alias("a"), F.col("bc").alias("b")).distinct(), f"new{turn}")
    if ends.isEmpty():
        return clusters
    roots = components(ends, folder, f"loose{turn}").select(F.col("node").alias("cluster"), "root")
    merged = clusters.join(folder.table(roots, f"roots{turn}"), "cluster", "left")
    return folder.table(merged.select("node", F.coalesce("root", "cluster").alias("cluster")), f"clusters{turn}")


def _loose_clusters(nodes: DataFrame, level: float, folder: SharedFolder) -> DataFrame:
    """(node, cluster) of every node, by neighbours in the forest: nodes that reach ``level`` share a cluster."""
    least = level - WIDTHS_OF_ERROR * (level * (1 - level) / HASHES) ** 0.5
    trees, target = _trees(level), math.log(MISS)
    # Equal signatures are one node of the forest.
    named = nodes.select("signature", "node").groupBy("signature").agg(F.min("node").alias("first"))
    named = folder.table(named, "signatures")
    links = nodes.join(named, "signature").filter("node <> first").select(
        F.col("first").alias("a"), F.col("node").alias("b")
    )
    going = named.select(F.col("first").alias("node"), "signature", F.col("first").alias("cluster"))
    so_far, clusters, turn = None, None, 0
    while True:
        gain = trees * math.log1p(-(level**DEPTH))
        rows = _sorted_orders(going, trees, turn, folder)
        at, last = F.col("rank"), (F.col("rank") / ROWS).cast("bigint")
        seen = F.array_distinct(
            F.array(last, F.floor((at - BEYOND) / ROWS).cast("bigint"), F.floor((at + BEYOND) / ROWS).cast("bigint"))
        )
        copies = rows.select(F.explode(seen).alias("block"), "rank", "region", "tail", "node", "cluster", "signature")
        copies = copies.filter("block >= 0")
        found = _by_key(copies, ["block"], _neighbours(least, level), "a bigint, b bigint, lack double")
        found = folder.table(found, f"found{turn}")
        fresh = found.filter("b IS NOT NULL").select("a", "b")
        if clusters is None:
            roots = components(links.union(fresh), folder, "loose")
            clusters = nodes.select("node").join(roots, "node", "left").select(
                "node", F.coalesce("root", "node").alias("cluster")
            )
            clusters = folder.table(clusters, "clusters")
        else:
            clusters = _merged(clusters, fresh, folder, turn)
        lack = found.filter("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("lack").alias("lack"))
        # What a node still lacks, over all turns.
        lack = lack if so_far is None else lack.join(so_far, "node").select(
            "node", (F.col("lack") + F.col("before")).alias("lack")
        )
        lack = folder.table(lack.filter(F.col("lack") + F.lit(gain) > target), f"lack{turn}")
        if lack.isEmpty():
            return clusters
        going = named.select(F.col("first").alias("node"), "signature").join(lack.select("node"), "node", "left_semi")
        going = folder.table(going.join(clusters, "node"), f"going{turn}")
        # Nodes of one cluster have nothing to find among themselves.
        if len(going.select("cluster").distinct().head(2)) < 2:
            return clusters
        so_far = lack.select("node", (F.col("lack") + F.lit(gain)).alias("before"))
        trees, turn = FURTHER * _trees(level), turn + 1


def _links_within(shared: int, union: int) -> Callable:
    """(node, leader) for the nodes of a pair of blocks that are linked to a smaller one there."""

    def run(group: pd.DataFrame) -> list[tuple[int, int]]:
        nodes = group["node"].to_numpy()
        sets = [_unpack(s) for s in group["shingles"]]
        n, sizes = len(sets), np.array([len(s) for s in sets])
        tokens, ids = np.unique(np.concatenate(sets), return_inverse=True)
        of = np.repeat(np.arange(n), sizes)
        order = np.argsort(ids, kind="stable")
        postings, edge = of[order], np.searchsorted(ids[order], np.arange(len(tokens) + 1))
        starts = np.cumsum(sizes) - sizes

        def linked(i: int) -> np.ndarray:
            own = ids[starts[i] : starts[i] + sizes[i]]
            begin, count = edge[own], edge[own + 1] - edge[own]
            at = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())
            both = np.bincount(postings[at], minlength=n)
            return union * both >= shared * (sizes + sizes[i] - both)

        root = np.arange(n)
        # A large part first, from one text after another that is in it; then everybody outside of
        # it against all. Two texts that are both inside need no comparison.
        inside, todo, seen = np.zeros(n, dtype=bool), [0], np.zeros(n, dtype=bool)
        inside[0] = True
        while todo and inside.sum() - seen.sum() > 0 and 2 * inside.sum() < n:
            i = todo.pop()
            seen[i] = True
            new = linked(i) & ~inside
            inside |= new
            todo += np.flatnonzero(new).tolist()
        root[inside] = 0
        for i in np.flatnonzero(~inside):
            around = np.unique(root[linked(i)])
            root[np.isin(root, around)] = around[0]
        leader = {r: int(nodes[root == r].min()) for r in np.unique(root)}
        return [(int(x), leader[r]) for x, r in zip(nodes, root) if int(x) != leader[r]]

    return run


def _pack(hashes: np.ndarray) -> bytes:
    """Six of the eight bytes of each hash."""
    return np.ascontiguousarray(hashes.view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(packed, dtype=np.uint8).reshape(-1, 6)
    return out.view(np.uint64)[:, 0]


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """(cluster, block, blocks, node, shingles) of texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = filled(batch["text"])
            for a, b in text_slices(texts):
                found = [_pack(s) for s in _shingler(width).sets(texts[a:b])]
                yield batch.iloc[a:b].drop(columns="text").assign(shingles=found)

    return docs.mapInPandas(
        run, "cluster bigint, block int, blocks int, node bigint, shingles binary"
    )


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    shared: int = 80,
    union: int = 100,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """``key, n_shingles, component_id, kept`` of every row.

    Two texts are linked if union * |intersection| >= shared * |union| holds for their sets of
    ``width``-word shingles; a text of fewer words is one shingle, and a text without words, or
    null, is linked with nothing. ``component_id`` is the smallest key that can be reached, and the
    row with that key is kept. Equal keys are one document. A null key has no component and is kept.
    Keys are integers.
    """
    folder = SharedFolder(docs, "near-dedup")
    described = folder.table(_describe(docs, width, text, key), "described")
    named = described.filter(F.col("doc").isNotNull())
    full = named.filter("n_shingles > 0")
    nodes = full.groupBy("digest").agg(
        F.min("doc").alias("node"),
        F.max("n_shingles").alias("n_shingles"),
        # Equal for all rows of a digest.
        F.any_value("signature").alias("signature"),
    )
    nodes = folder.table(nodes, "nodes")

    clusters = _loose_clusters(nodes, shared / union, folder)
    # One document may have several texts.
    same = full.groupBy("doc", "digest").agg(F.max("n_shingles").alias("n"))
    same = same.join(nodes.select("digest", "node"), "digest").select("doc", "node").filter("doc <> node")

    sizes = clusters.join(nodes.select("node", "n_shingles"), "node").groupBy("cluster").agg(
        F.count("*").alias("n"), F.sum("n_shingles").alias("s")
    ).filter("n > 1")
    blocks = F.greatest(
        F.least(F.ceil(F.col("n") / 64), F.lit(BLOCKS)), F.ceil(F.col("s") / BLOCK_SHINGLES)
    ).cast("int")
    members = clusters.join(sizes.select("cluster", blocks.alias("blocks")), "cluster").select(
        "cluster", "node", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block")
    )
    texts = docs.select(F.col(key).cast("bigint").alias("node"), F.col(text).alias("text"))
    texts = texts.join(members, "node").select("cluster", "block", "blocks", "node", "text")
    sets = _sets(texts, width)
    pairs = sets.select(
        "cluster", "block", "node", "shingles",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    ).select(
        "cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "node", "shingles",
    )
    links = _by_key(pairs, ["cluster", "i", "j"], _links_within(shared, union), "a bigint, b bigint")
    found = components(links.union(same.toDF("a", "b")), folder, "component")

    # Every row by its set, then by its component; a row without a set stands alone.
    rows = described.select("doc", "n_shingles", "digest").join(
        nodes.select("digest", "node"), "digest", "left"
    )
    rows = rows.withColumn("node", F.coalesce("node", "doc")).join(found, "node", "left")
    component = F.when(F.col("doc").isNotNull(), F.coalesce("root", "node"))
    return rows.select(
        F.col("doc").alias(key),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc") == component, F.lit(True)).alias("kept"),
    )
