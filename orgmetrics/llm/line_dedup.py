"""Line dedup over the suffixes of line sequences, ranked by distributed prefix doubling.

Every place of a table (a line of a document) begins a suffix: that line and all that follow. A
rank of order k is equal for two places exactly if their next 2^k lines are, and the ranks of order
k + 1 come from pairs of ranks 2^k lines apart. Ranks are hashes: they have to nest, not to count,
and so no round sorts the table. Places whose rank no other place shares are out of all later rounds.

An LCP interval is the set of suffixes with a common prefix. From the longest prefixes to the
shortest, every place descends to the deepest interval in which an earlier place exists: its
prefix is the longest run of lines that stood before, and it is maximal. Runs of enough characters
are deleted. All of it is joins, groupings and windows of built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orgmetrics.llm.batches import SharedFolder

DOC = ["d", "t"]  # key and text hash: rows of one key with other texts are other documents
PLACE = [*DOC, "i"]


def _hash(*columns) -> Column:
    """128 bits: of 10^12 different lines the chance that any two are equal is below 10^-14."""
    return F.struct(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit(1), *columns).alias("b"))


def _lines(docs: DataFrame, text: str, key: str) -> DataFrame:
    """A row per line: its place, the hash of the line and its characters."""
    rows = docs.filter(F.col(text).isNotNull()).select(
        F.col(key).alias("d"),
        F.xxhash64(F.col(text)).alias("t"),
        F.posexplode(F.split(F.col(text), "\n", -1)).alias("i", "line"),
    )
    chars = F.char_length("line")
    return rows.select(*PLACE, _hash("line", chars).alias("rank"), chars.cast("bigint").alias("chars"))


def _shared(ranks: DataFrame, folder: SharedFolder, name: str) -> DataFrame:
    """The places whose rank another place shares.

    The counts are written first: a join with a table, unlike one with an aggregation, can be split
    where one line holds much of the places.
    """
    counts = ranks.groupBy("rank").agg(F.count("*").alias("n")).filter("n > 1")
    counts = folder.table(counts.select("rank"), f"shared-{name}")
    return ranks.join(counts, "rank").select(*PLACE, "rank", "chars")


def _doubled(ranks: DataFrame, span: int) -> DataFrame:
    """Ranks of twice the order: of the places whose two halves both recur."""
    second = ranks.withColumn("i", F.col("i") - span).filter("i >= 0")
    both = ranks.alias("a").join(second.alias("b"), _same(PLACE))
    return both.select(
        *(f"a.{c}" for c in PLACE),
        _hash("a.rank", "b.rank").alias("rank"),
        (F.col("a.chars") + F.col("b.chars")).alias("chars"),
    )


def _same(columns: list[str]) -> Column:
    """Equal columns of the sides a and b; a document without a key equals itself."""
    return F.expr(" AND ".join(f"a.{c} {'<=>' if c == 'd' else '='} b.{c}" for c in columns))


def _levels(lines: DataFrame, folder: SharedFolder) -> list[DataFrame]:
    """The shared ranks of order 0, 1, 2, ... as long as there are any."""
    ranks = folder.table(_shared(lines, folder, "0"), "ranks-0")
    levels = []
    while not ranks.isEmpty():
        levels.append(ranks)
        # Written before it is read twice, to be counted and to be joined.
        twice = folder.table(_doubled(ranks, 1 << (len(levels) - 1)), f"doubled-{len(levels)}")
        ranks = folder.table(_shared(twice, folder, str(len(levels))), f"ranks-{len(levels)}")
    return levels


def _descend(inside: DataFrame | None, ranks: DataFrame, order: int, folder: SharedFolder) -> DataFrame:
    """One step down: prefixes that go on for 2^order lines as those of an earlier place do.

    ``inside`` has the places within an interval so far: ``lines`` and ``chars`` of its prefix, its
    name ``at``, and whether the place itself got there (``own``) or stands for the interval as its
    earliest place. A place that goes deeper is still represented in the interval it leaves by the
    earliest place of the deeper one, which stays.
    """
    here = ranks.select(
        *PLACE,
        F.lit(0).cast("bigint").alias("lines"),
        F.lit(0).cast("bigint").alias("chars"),
        F.struct(F.lit(0).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b")).alias("at"),
        F.lit(True).alias("own"),
        F.col("rank").alias("next"),
        F.col("chars").alias("more"),
    )
    if inside is not None:
        # Places that are in no interval yet start from the interval of all.
        gone = inside.filter("own").select(*PLACE)
        here = here.alias("a").join(gone.alias("b"), _same(PLACE), "left_anti")
        meets = _same(DOC) & F.expr("a.i + a.lines = b.i")
        on = inside.alias("a").join(ranks.alias("b"), meets, "left").select(
            "a.*", F.col("b.rank").alias("next"), F.col("b.chars").alias("more")
        )
        here = here.unionByName(on)
    place = F.struct(*PLACE)
    first = (
        here.filter(F.col("next").isNotNull())
        .groupBy("at", "next")
        .agg(F.min(place).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    # A table, so that the interval of the most common line can be split in the join.
    here = here.join(folder.table(first, f"first-{order}"), ["at", "next"], "left")
    deeper = [
        (F.col("lines") + (1 << order)).alias("lines"),
        (F.col("chars") + F.col("more")).alias("chars"),
        _hash("at", "next", F.lit(order)).alias("at"),
    ]
    later = F.coalesce(place != F.col("first"), F.lit(False))
    earliest = F.coalesce(place == F.col("first"), F.lit(False))
    # What a place becomes: deeper itself, or what it was, and if earliest the interval's mark too.
    went = F.struct(*deeper, F.col("own"))
    stays = F.struct("lines", "chars", "at", "own")
    mark = F.struct(*deeper, F.lit(False).alias("own"))
    becomes = F.when(later, F.array(went)).when(earliest, F.array(stays, mark)).otherwise(F.array(stays))
    return here.select(*PLACE, F.explode(becomes).alias("x")).select(*PLACE, "x.*").filter("lines > 0")


def repeated_runs(
    docs: DataFrame, folder: SharedFolder, text: str = "text", key: str = "doc_id"
) -> DataFrame | None:
    """For every place with an earlier copy: ``lines`` and ``chars`` of the longest such run there.

    Columns ``d`` (the key), ``t`` (hash of the text), ``i`` (line from 0), ``lines``, ``chars``. None
    if no line recurs.
    """
    lines = folder.table(_lines(docs, text, key).distinct(), "lines")
    levels = _levels(lines, folder)
    inside = None
    for order in reversed(range(len(levels))):
        inside = folder.table(_descend(inside, levels[order], order, folder), f"inside-{order}")
    return None if inside is None else inside.filter("own").select(*PLACE, "lines", "chars")


def line_dedup(
    docs: DataFrame,
    min_chars: int = 60,
    text: str = "text",
    key: str = "doc_id",
    counts: tuple[str, str] = ("n_lines", "n_deleted"),
) -> DataFrame:
    """All columns of ``docs``, with later copies of line runs deleted from ``text``.

    Adds the numbers of lines and of deleted ones, named by ``counts``. A run of consecutive lines is deleted where it is as long as
    any that stood earlier in the table, by key and line, and has ``min_chars`` characters or more
    besides line ends; its first copy stays, and so do shorter runs. A copy may begin inside the
    run it repeats. Lines end with a line feed. A text whose lines are all deleted becomes empty; a
    null text stays null and has no lines. A document without a key comes first. Documents of one
    key are ordered by a hash of their text; rows of equal key and text are one document, and all of
    them get its text.
    """
    folder = SharedFolder(docs, "line-dedup")
    runs = repeated_runs(docs, folder, text, key)
    if runs is None:
        lines = F.when(F.col(text).isNull(), 0).otherwise(F.size(F.split(F.col(text), "\n", -1)))
        none = F.lit(0).cast("bigint")
        return docs.select("*", lines.cast("bigint").alias(counts[0]), none.alias(counts[1]))
    # A line is deleted if a run that began before it, in its document, ends after it.
    until = F.when(F.col("chars") >= min_chars, F.col("i") + F.col("lines"))
    so_far = Window.partitionBy(*DOC).orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    deleted = runs.withColumn("until", F.max(until).over(so_far)).filter("until > i")
    deleted = deleted.groupBy(*DOC).agg(F.sort_array(F.collect_list("i")).alias("gone"))

    names = docs.columns
    own = [f"c{n}" for n in range(len(names))]
    given = docs.toDF(*own)
    text_, key_ = own[names.index(text)], own[names.index(key)]
    given = given.select("*", F.xxhash64(text_).alias("hash"))
    same = F.expr(f"{key_} <=> d AND hash = t AND {text_} IS NOT NULL")
    joined = given.join(deleted, same, "left")
    # One sign per line, 1 for a deleted one, made out of the gaps between deleted lines.
    gaps = F.transform(
        "gone", lambda x, n: x - F.when(n > 0, F.get("gone", n - 1)).otherwise(-1) - 1
    )
    signs = F.array_join(F.transform(gaps, lambda g: F.concat(F.repeat(F.lit("0"), g), F.lit("1"))), "")
    lines = F.split(F.col(text_), "\n", -1)
    marks = F.split(F.rpad(signs, F.size(lines), "0"), "")
    left = F.filter(F.arrays_zip(lines.alias("line"), marks.alias("mark")), lambda x: x["mark"] == "0")
    cleaned = F.array_join(F.transform(left, lambda x: x["line"]), "\n")
    value = F.when(F.col("gone").isNull(), F.col(text_)).otherwise(cleaned)
    count = F.when(F.col(text_).isNull(), 0).otherwise(F.size(lines)).cast("bigint")
    return joined.select(
        *((value if c == text_ else F.col(c)).alias(n) for c, n in zip(own, names)),
        count.alias(counts[0]),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("bigint").alias(counts[1]),
    )
