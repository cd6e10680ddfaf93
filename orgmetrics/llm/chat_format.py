"""Chat formatting that is checked by a grammar round trip.

    conversation = turn*
    turn         = "<|im_start|>" role "\n" text "<|im_end|>" "\n"

Every turn is rendered as it is and parsed again. Where the parser does not recover role and text,
the content that conflicts with the grammar is escaped and the turn is rendered anew. The whole
conversation is parsed once more, and a difference ends the job. All of it is built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

START, END = "<|im_start|>", "<|im_end|>"
# A control string, or one that was escaped before: a bar after any number of backslashes.
_CONTROL = r"im_(?:start|end)\|>"


def escape_text(text: Column) -> Column:
    """One backslash more before the bar of every control string, escaped ones included."""
    return F.regexp_replace(text, rf"<(\\*)\|(?={_CONTROL})", r"<$1\\|")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, rf"<(\\*)\\\|(?={_CONTROL})", "<$1|")


def escape_role(role: Column) -> Column:
    """Backslash, line end and bar as two characters each: a role keeps to its line."""
    for plain, coded in (("\\", "\\b"), ("\n", "\\n"), ("|", "\\p")):
        role = F.replace(role, F.lit(plain), F.lit(coded))
    return role


def unescape_role(role: Column) -> Column:
    for plain, coded in (("|", "\\p"), ("\n", "\\n"), ("\\", "\\b")):
        role = F.replace(role, F.lit(coded), F.lit(plain))
    return role


def render_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))


def _parse_block(block: Column) -> Column:
    """Role and text, still escaped, of what follows a start mark; null if it is no turn."""
    body = F.substring_index(block, END, 1)
    role = F.substring_index(body, "\n", 1)
    text = F.substr(body, F.char_length(role) + 2)
    whole = F.concat(role, F.lit("\n"), text, F.lit(END + "\n"))
    return F.when(block == whole, F.struct(role.alias("role"), text.alias("text")))


def parse(formatted: Column) -> Column:
    """Turns of a formatted conversation; null if it does not follow the grammar."""
    blocks = F.split(formatted, r"\Q" + START + r"\E", -1)
    turns = F.transform(F.slice(blocks, 2, F.size(blocks)), _parse_block)
    good = (blocks[0] == "") & ~F.exists(turns, lambda t: t.isNull())
    return F.when(
        good,
        F.transform(
            turns,
            lambda t: F.struct(
                unescape_role(t["role"]).alias("role"), unescape_text(t["text"]).alias("text")
            ),
        ),
    )


def _recovers(block: Column, role: Column, text: Column) -> Column:
    turns = parse(block)
    first = F.get(turns, F.lit(0))
    return F.coalesce(
        (F.size(turns) == 1) & (first["role"] == role) & (first["text"] == text), F.lit(False)
    )


def format_conversations(
    rows: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    trained: str = "assistant",
) -> DataFrame:
    """One row per conversation: ``formatted``, ``loss_spans`` and the ``turns`` it was made of.

    Spans are (start, length) in code points of ``formatted`` and hold the texts, as escaped, of the
    turns whose role is ``trained``. Null roles and texts count as empty, a null turn comes first,
    rows of one turn are ordered by role and text, repeated rows are kept, and rows without a
    conversation form one. A conversation is one value of the result, so one task builds it; nothing
    else is gathered.
    """
    given = rows.select(
        F.col(conversation).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    plain = render_turn(F.col("role"), F.col("text"))
    conflict = ~_recovers(plain, F.col("role"), F.col("text"))
    given = given.withColumn("conflict", conflict).select(
        "*",
        F.when(F.col("conflict"), escape_role(F.col("role"))).otherwise(F.col("role")).alias("_role"),
        F.when(F.col("conflict"), escape_text(F.col("text"))).otherwise(F.col("text")).alias("_text"),
    )
    block = render_turn(F.col("_role"), F.col("_text"))
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = given.withColumn("block", block).select(
        "conv",
        F.row_number().over(order).alias("n"),
        "role",
        "text",
        "block",
        F.coalesce(F.sum(F.char_length("block")).over(before), F.lit(0)).alias("offset"),
        F.char_length("_role").alias("role_chars"),
        F.char_length("_text").alias("text_chars"),
    )
    start = F.col("offset") + len(START) + F.col("role_chars") + 1
    span = F.when(
        F.col("role") == trained, F.struct(start.alias("start"), F.col("text_chars").alias("length"))
    )
    turns = placed.groupBy("conv").agg(
        F.sort_array(
            F.collect_list(F.struct("n", "role", "text", "block", span.alias("span")))
        ).alias("all")
    )
    pick = lambda name: F.transform("all", lambda t: t[name])
    made = turns.select(
        F.col("conv").alias(conversation),
        F.array_join(pick("block"), "").alias("formatted"),
        F.filter(pick("span"), lambda s: s.isNotNull()).alias("loss_spans"),
        F.transform(
            "all", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))
        ).alias("turns"),
    )
    # The proof of the whole: what does not parse back ends the job.
    same = F.coalesce(parse(F.col("formatted")) == F.col("turns"), F.lit(False))
    checked = F.when(same, F.col("formatted")).otherwise(
        F.raise_error(F.lit("a conversation does not parse back")).cast("string")
    )
    return made.withColumn("formatted", checked)


CHUNK = 256  # elements whose sums are built one after another


def sums_before(lengths: str) -> str:
    """SQL for the sum of all earlier elements at each element of an array, chunk by chunk.

    An array that grows by one element is copied each time; chunks keep that linear in the length.
    """
    chunks = f"transform(sequence(0, (size({lengths}) - 1) div {CHUNK}), i -> slice({lengths}, int(i * {CHUNK} + 1), {CHUNK}))"

    def running(array: str, start: str) -> str:
        zero = f"named_struct('at', {start}, 'all', CAST(array() AS array<bigint>))"
        return f"aggregate({array}, {zero}, (a, x) -> named_struct('at', a.at + x, 'all', concat(a.all, array(a.at)))).all"

    totals = f"transform({chunks}, c -> aggregate(c, 0L, (a, x) -> a + x))"
    starts = running(totals, "0L")
    return f"flatten(zip_with({chunks}, {starts}, (c, s) -> {running('c', 's')}))"


def read_back(formatted: DataFrame, trained: str = "assistant") -> DataFrame:
    """Adds ``read_turns`` and ``loss_text``, both read out of ``formatted``.

    ``loss_text`` is what stands under the mask: the text is cut at every span, unescaped and joined. A
    span is cut out of the block of its turn, so that long conversations are not counted through for
    each. Spans that do not give exactly the texts of the trained turns, one by one, end the job.
    """
    read = formatted.withColumn("read_turns", parse(F.col("formatted")))
    blocks = F.slice(F.split("formatted", r"\Q" + START + r"\E", -1), 2, F.size("read_turns"))
    read = read.withColumn("_blocks", blocks)
    sizes = F.transform("_blocks", lambda b: (F.char_length(b) + len(START)).cast("bigint"))
    read = read.withColumn("_sizes", sizes).withColumn("_offsets", F.expr(f"IF(size(_sizes) > 0, {sums_before('_sizes')}, CAST(array() AS array<bigint>))"))
    turns = F.arrays_zip(F.col("read_turns").alias("turn"), F.col("_blocks").alias("block"), F.col("_offsets").alias("offset"))
    read = read.withColumn("_trained", F.filter(turns, lambda t: t["turn"]["role"] == trained))

    def cut(turn: Column, span: Column) -> Column:
        place = span["start"] - turn["offset"] - len(START)
        inside = (place >= 0) & (span["length"] >= 0)
        text = unescape_text(F.substr(turn["block"], (place + 1).cast("int"), span["length"].cast("int")))
        return F.when(inside, text)

    read = read.withColumn("_cut", F.zip_with("_trained", "loss_spans", cut))
    texts = F.transform("_trained", lambda t: t["turn"]["text"])
    text = F.when(F.coalesce(F.col("_cut") == texts, F.lit(False)), F.array_join("_cut", "")).otherwise(
        F.raise_error(F.lit("the loss mask does not cover the trained turns")).cast("string")
    )
    return read.withColumn("loss_text", text).select(*formatted.columns, "read_turns", "loss_text")
