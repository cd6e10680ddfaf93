"""A Merkle manifest of a table: a digest per row, roots, and a proof per row, by nested rollup.

Rows are numbered within their tree. The digits of the number are grouped away one after another:
a group's structs become children of the next, until a block of ``DIGITS`` digits is one nested row
with its digest. Blocks are numbered in turn and rolled up the same way, tier by tier, to one node
per tree; the trees' nodes form the last tree. On the way down every nested row meets the path above
it in one grouping, and transforms and explodes hand it on to the children. Rows are never joined to
digests, and no group holds more than a block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orgmetrics.llm.batches import SharedFolder

LEVELS = 4  # levels of the tree per digit
DIGITS = 2  # digits per block

PATH = "array<struct<left: string, right: string>>"


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    """Digest of a row: every value with its length in bytes, so that no two rows read alike."""
    return digest(F.concat(*map(_field, values)))


def _numbered(rows: DataFrame, order: list[str], folder: SharedFolder, name: str) -> tuple[DataFrame, int]:
    """``rows`` with ``rank`` (from 0 within ``tree``) and ``n`` (rows of the tree); the largest n.

    Sorted ranges of the whole table are written once. A rank is a row's place in its range plus
    the tree's rows in earlier ranges; only these counts, one per range and tree, are added up.
    """
    by = ["tree", *order, "salt"]  # equal rows are spread as well
    dealt = rows.withColumn("salt", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(*by).sortWithinPartitions(*by).drop("salt")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    dealt = dealt.withColumn("range", F.spark_partition_id()).withColumn("place", place)
    dealt = folder.table(dealt, f"{name}-ranges")
    counts = dealt.groupBy("tree", "range").agg(F.count("*").alias("rows"), F.min("place").alias("first"))
    whole = Window.partitionBy("tree")
    earlier = whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "tree", "range", "first",
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
        F.sum("rows").over(whole).alias("n"),
    )
    counts = folder.table(counts, f"{name}-counts")
    most = counts.agg(F.max("n")).first()[0] or 1
    found = dealt.join(counts, ["tree", "range"]).withColumn("rank", F.expr("before + place - first"))
    return found.drop("range", "place", "first", "before"), most


def _left(nodes: str, by: int) -> str:
    """Nodes that remain of ``nodes`` where every ``by`` consecutive ones become one."""
    return f"(({nodes}) + {by - 1}) div {by}"


def _nest(rows: DataFrame, keys: list[str], nodes: str, fan_out: int) -> DataFrame:
    """One row per group: the digests of its levels, its children, and its own digest ``node``."""
    groups = rows.groupBy(*keys).agg(F.expr("sort_array(collect_list(struct(place, node, below)))").alias("kids"))
    groups = groups.withColumn("level0", F.expr("transform(kids, k -> k.node)"))
    for j in range(LEVELS):
        runs = (
            f"transform(sequence(0, (size(level{j}) - 1) div {fan_out}), "
            f"r -> sha2(array_join(slice(level{j}, int(r * {fan_out} + 1), {fan_out}), ''), 256))"
        )
        # A tree that has come down to one node stays as it is.
        groups = groups.withColumn(
            f"level{j + 1}", F.expr(f"if({_left(nodes, fan_out**j)} > 1, {runs}, level{j})")
        )
    levels = ", ".join(f"level{j}" for j in range(LEVELS))
    return groups.selectExpr(
        *keys,
        f"level{LEVELS}[0] AS node",
        f"struct(array({levels}) AS levels, transform(kids, k -> k.below) AS kids) AS below",
    )


def _unnest(rows: DataFrame, nodes: str, fan_out: int) -> DataFrame:
    """The children of every row, each with the steps of its group before the path above it."""
    kept = [c for c in rows.columns if c not in ("below", "path")]
    rows = rows.selectExpr(*kept, "path", "below.levels AS levels", "posexplode(below.kids) AS (c, below)")
    steps = []
    for j in range(LEVELS):
        i = f"(c div {fan_out**j})"
        first = f"({i} div {fan_out} * {fan_out})"  # of the run, from 0
        left = f"array_join(slice(levels[{j}], int({first} + 1), int({i} - {first})), '')"
        right = f"array_join(slice(levels[{j}], int({i} + 2), int({first} + {fan_out - 1} - {i})), '')"
        steps.append(f"if({_left(nodes, fan_out**j)} > 1, struct({left} AS left, {right} AS right), NULL)")
    steps = f"filter(array({', '.join(steps)}), s -> s IS NOT NULL)"
    return rows.selectExpr(*kept, f"concat({steps}, path) AS path", "below")


def _climb(
    nodes: DataFrame, most: int, fan_out: int, above, folder: SharedFolder, name: str, tier: int = 0
) -> DataFrame:
    """``tree, subroot, root, path, below`` of every node of ``tree, rank, n, node, below``.

    ``above(subroots)`` gives ``tree, subroot, root, path`` of the node of every whole tree.
    """
    base = fan_out**LEVELS
    width = base**DIGITS
    digits = [f"rank div {base**d} % {base} AS digit{d}" for d in range(DIGITS)]
    rows = nodes.selectExpr("tree", "n", f"rank div {width} AS block", *digits, "node", "below")
    rows = rows.repartition("tree", "block")
    for d in range(DIGITS):
        keys = ["tree", "n", "block"] + [f"digit{e}" for e in range(DIGITS - 1, d, -1)]
        rows = _nest(rows.withColumnRenamed(f"digit{d}", "place"), keys, _left("n", base**d), fan_out)
    blocks = folder.table(rows, f"{name}-tier{tier}")
    heads = blocks.selectExpr("tree", "block AS rank", f"{_left('n', width)} AS n", "node")
    if most > width:
        ids = heads.withColumn("below", F.expr("struct(rank AS block)"))
        found = _climb(ids, -(-most // width), fan_out, above, folder, name, tier + 1)
        found = found.selectExpr("tree", "below.block AS block", "subroot", "root", "path")
    else:
        found = above(heads.select("tree", "node")).selectExpr("tree", "0L AS block", "subroot", "root", "path")
    # The nested rows and the paths of their heads, brought together by grouping.
    both = blocks.select("tree", "block", "n", "below").unionByName(found, allowMissingColumns=True)
    columns = ("n", "below", "subroot", "root", "path")
    rows = both.groupBy("tree", "block").agg(*(F.any_value(c, True).alias(c) for c in columns))
    for d in reversed(range(DIGITS)):
        rows = _unnest(rows, _left("n", base**d), fan_out)
    return rows.select("tree", "subroot", "root", "path", "below")


def manifest(
    docs: DataFrame,
    columns: list[str],
    tree: str = "lang",
    key: str = "doc_id",
    carry: dict[str, Column] | None = None,
    fan_out: int = 2,
) -> DataFrame:
    """``key, leaf, subroot, root, path`` of every row, and the columns of ``carry``.

    A row's leaf is the digest of ``columns``. The leaves of one value of ``tree`` ascend by key,
    null first, then by leaf; while there are several nodes, every ``fan_out`` consecutive ones
    become the digest of their digests end to end, the last run also if it is shorter. The nodes
    that remain, ordered by the bytes of ``tree``, null first, likewise give ``root``. ``path`` holds
    for each level, bottom up, the digests before and after a row's node in its run, joined; a level
    that a tree does not have has no step, and a node without siblings has two empty sides. Equal rows
    are leaves of their own. An empty table has no rows. Columns not named are ignored.
    """
    carried = carry or {}
    folder = SharedFolder(docs, "manifest")
    value = F.col(tree).cast("string")
    rows = docs.select(
        F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), value)).alias("tree"),
        F.col(key).alias("key"),
        leaf_digest([F.col(c) for c in columns]).alias("node"),
        *(c.alias(f"carried{i}") for i, c in enumerate(carried.values())),
    )
    names = ["key", "node", *(f"carried{i}" for i in range(len(carried)))]
    rows, most = _numbered(rows, ["key", "node"], folder, "rows")
    rows = rows.select("tree", "rank", "n", "node", F.struct(*names).alias("below"))

    def whole(subroots: DataFrame) -> DataFrame:
        trees = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "node")
        trees, number = _numbered(trees, ["name"], folder, "trees")
        trees = trees.select("tree", "rank", "n", "node", F.struct("name", "node").alias("below"))

        def top(roots: DataFrame) -> DataFrame:
            return roots.selectExpr("tree", "node AS subroot", "node AS root", f"CAST(array() AS {PATH}) AS path")

        found = _climb(trees, number, fan_out, top, folder, "trees")
        return folder.table(
            found.select(F.col("below.name").alias("tree"), F.col("below.node").alias("subroot"), "root", "path"),
            "roots",
        )

    found = _climb(rows, most, fan_out, whole, folder, "rows")
    return found.select(
        F.col("below.key").alias(key),
        F.col("below.node").alias("leaf"),
        "subroot",
        "root",
        "path",
        *(F.col(f"below.carried{i}").alias(c) for i, c in enumerate(carried)),
    )


def folded(leaf: Column, path: str = "path") -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda x, s: digest(F.concat(s["left"], x, s["right"])))


def path_digest(path: str = "path") -> Column:
    """Digest of all digests of a path, level by level, each from left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))
