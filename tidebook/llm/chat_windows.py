"""Conversations formatted into windows of a token budget, cut between turns, with a loss mask. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name

#: The template: a window begins with BEGIN, each turn with its role's mark, and each turn ends with END.
BEGIN, END = "<s>", "</s>"
MARKS = {"user": "[INST] ", "assistant": "[/INST] ", "system": "[SYS] "}
ROLE, ROLE_END = "[ROLE] ", "[/ROLE] "
#: A control string has an opener and a rest; inside texts backslashes stand between them, one more than the text has.
REST = r"(/?s>|/?INST\]|SYS\]|/?ROLE\])"
PLAIN, ESCAPED = rf"([<\[])(\\*){REST}", rf"([<\[])\\(\\*){REST}"
#: Tokens of a turn's marks.
MARK_TOKENS = 4
#: A conversation is worked on in cells of this many turn numbers, so that a very long one is many tasks' work.
CELL = 1024


def about_tokens(text: Column) -> Column:
    """A token for each four bytes of UTF-8, or part of them."""
    return F.ceil(F.octet_length(text) / 4).cast("bigint")


def escape(text: Column) -> Column:
    """The text without any control string; ``unescape`` gives it back."""
    return F.regexp_replace(text, PLAIN, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def _by_role(role: Column, known: dict[str, Column], other: Column) -> Column:
    found = F
    for name, value in known.items():
        found = found.when(role == name, value)
    return found.otherwise(other)


def _mark(role: Column) -> Column:
    return _by_role(role, {k: F.lit(v) for k, v in MARKS.items()}, F.concat(F.lit(ROLE), escape(role), F.lit(ROLE_END)))


def format_windows(
    conversations: DataFrame,
    budget: int = 2048,
    history: int = 256,
    tokens_of: Callable[[Column], Column] = about_tokens,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Windows of at most ``budget`` tokens that together have every turn once as a target.

    Prefix sums of the turns' tokens (``tokens_of`` its text, and MARK_TOKENS) choose the spans: what the history and the system turn leave is the
    room; turns that begin in one stretch of three quarters of the room are a span, and a turn of over a quarter of it is one by itself, so
    a span never has more than the room, but for one single longer turn (``over_budget``: turns are never cut). A window is the
    conversation's first system turn, the turns just before the span that fit into ``history`` tokens, and the span. What
    is repeated, the system turn or history, is masked; the loss mask has the span's assistant texts.

    Turns of one conversation are dealt to tasks by cells of CELL turn numbers, each with a copy of the turns numbered just before it, so no
    conversation is one task's; a span ends with its cell. A cell is sorted, and spilt where needed, but never gathered.

    Turns go in order (null first), ties by role and text; repeated rows are turns of their own; null roles and texts are empty; null
    ids are one conversation; a text of any length is one turn; other columns are ignored; no rows give no windows.

    Returns conv_id, cell, window (from 1 in its cell), text, n_repeated (turns at its beginning that aren't targets), n_turns (targets),
    n_tokens, over_budget, loss (code points from 0: start, length).
    """
    if not 0 <= history < budget:
        raise ValueError("history must leave room in the budget")
    id, text = F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    role, turn = F.coalesce(F.col(role_col).cast("string"), F.lit("")), F.col(turn_col).cast("bigint")
    cell = F.when(turn.isNotNull(), F.floor(turn / CELL)).otherwise(F.lit(-(1 << 60)))
    rows = conversations.select(
        id.isNull().alias("no_id"), F.coalesce(id, F.lit(0).cast(conversations.schema[id_col].dataType)).alias("conv"), cell.alias("cell"), turn.alias("turn"), role.alias("role"), text.alias("text")
    )
    conv, key = ["no_id", "conv"], ["no_id", "conv", "cell"]
    system = rows.where("role = 'system'").groupBy(*conv).agg(F.min_by(F.struct("text", F.col("turn").alias("number")), F.struct(F.col("turn").isNotNull(), "turn", "text")).alias("system"))
    of_cells = rows.select(*key).distinct().join(system, conv)

    # a turn that may be history of the next cell's first window is in both; it has MARK_TOKENS tokens at least
    reach = min(CELL, history // MARK_TOKENS)
    both = F.when(F.pmod("turn", F.lit(CELL)) >= CELL - reach, F.array(F.col("cell"), F.col("cell") + 1)).otherwise(F.array("cell"))
    dealt = rows.withColumn("in_cell", F.explode(both)).withColumn("ghost", F.col("in_cell") != F.col("cell")).drop("cell").withColumnRenamed("in_cell", "cell")
    found = dealt.join(of_cells, key, "left")
    mark, body = _mark(F.col("role")), escape(F.col("text"))
    known_system = (F.col("role") == "system") & F.col("turn").eqNullSafe(F.col("system.number")) & (F.col("text") == F.col("system.text"))
    system_tokens = F.when(F.col("system").isNotNull(), tokens_of(F.col("system.text")) + MARK_TOKENS).otherwise(0)
    room = F.greatest(F.lit(budget - history) - system_tokens, F.lit(4))
    in_order = Window.partitionBy(*key).orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turns = found.select(
        *key, "turn", "role", "text", "ghost", "system", mark.alias("mark"), F.concat(mark, body, F.lit(END)).alias("shown"), (tokens_of(F.col("text")) + MARK_TOKENS).alias("tokens"),
        F.coalesce(known_system, F.lit(False)).alias("is_system"), system_tokens.alias("system_tokens"), room.alias("room"),
    ).select(
        "*", (F.sum("tokens").over(so_far) - F.col("tokens")).alias("at"), (F.sum(F.length("shown")).over(so_far) - F.length("shown")).alias("chars_before")
    )
    alone = F.col("tokens") > F.floor(F.col("room") / 4)
    stretch = F.floor(F.col("at") / (F.col("room") - F.floor(F.col("room") / 4)))
    by_tokens = Window.partitionBy(*key).orderBy("at")
    before = lambda c: F.lag(c).over(by_tokens)
    turns = turns.withColumns({"alone": alone, "stretch": stretch}).select(
        *key, "ghost", "at", "chars_before", "mark", "shown", "role", "tokens", "is_system", "system", "system_tokens",
        (~F.col("ghost") & (F.coalesce(before("ghost"), F.lit(True)) | F.col("alone") | before("alone") | (F.col("stretch") != before("stretch")))).alias("first"),
        F.collect_list(F.struct("at", "shown", "tokens", "is_system")).over(by_tokens.rangeBetween(-history, -1)).alias("past"),
    ).withColumn("window", F.sum(F.col("first").cast("int")).over(by_tokens.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("int"))

    its = F.struct("at", "shown", "chars_before", F.length("mark").alias("mark_chars"), (F.length("shown") - F.length("mark") - len(END)).alias("chars"), (F.col("role") == "assistant").alias("trained"))
    spans = turns.where(~F.col("ghost")).groupBy(*key, "window").agg(
        F.array_sort(F.collect_list(its)).alias("its"), F.first(F.when(F.col("first"), F.col("past")), ignorenulls=True).alias("past"), F.max("is_system").alias("has_system"),
        F.first("system", ignorenulls=True).alias("system"), F.max("system_tokens").alias("system_tokens"), F.sum("tokens").alias("tokens"),
    )
    past = F.array_sort("past")
    repeats_system = F.col("system").isNotNull() & ~F.col("has_system") & ~F.exists("past", lambda x: x.is_system)
    head = F.concat(F.lit(BEGIN), F.when(F.col("repeats_system"), F.concat(F.lit(MARKS["system"]), escape(F.col("system.text")), F.lit(END))).otherwise(""), F.array_join(F.transform("past", lambda x: x.shown), ""))
    start = lambda x: (F.length("head") - F.col("its")[0].chars_before + x.chars_before + x.mark_chars).cast("bigint")
    spans = spans.withColumn("past", past).withColumn("repeats_system", repeats_system).withColumn("head", head)
    n_tokens = F.col("tokens") + F.when(F.col("repeats_system"), F.col("system_tokens")).otherwise(0) + F.aggregate("past", F.lit(0).cast("bigint"), lambda a, x: a + x.tokens)
    return spans.select(
        F.when(~F.col("no_id"), F.col("conv")).alias("conv_id"), "cell", "window",
        F.concat("head", F.array_join(F.transform("its", lambda x: x.shown), "")).alias("text"),
        (F.size("past") + F.col("repeats_system").cast("int")).alias("n_repeated"), F.size("its").alias("n_turns"), n_tokens.alias("n_tokens"), (n_tokens > budget).alias("over_budget"),
        F.transform(F.filter("its", lambda x: x.trained), lambda x: F.struct(start(x).alias("start"), x.chars.cast("bigint").alias("length"))).alias("loss"),
    )


def read_windows(windows: DataFrame) -> DataFrame:
    """Windows with what their text and mask say: ``turns`` (role, text), the targets alone, and ``learnt``, the texts under the mask.

    Both are unescaped. Other columns stay; those called so already are replaced.
    """
    parts = free_name(windows, "parts")
    inside = F.split(F.substring("text", len(BEGIN) + 1, (1 << 31) - 1), END, -1)  # no text has an END of its own

    def turn(x: Column) -> Column:
        name_end = F.instr(x, ROLE_END)
        role = _by_role_mark(x, unescape(x.substr(F.lit(len(ROLE) + 1), name_end - len(ROLE) - 1)), lambda name, mark: F.lit(name))
        text = _by_role_mark(x, x.substr(name_end + len(ROLE_END), F.length(x)), lambda name, mark: x.substr(F.lit(len(mark) + 1), F.length(x)))
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    targets = F.slice(parts, F.col("n_repeated") + 1, F.greatest(F.size(parts) - 1 - F.col("n_repeated"), F.lit(0)))
    learnt = F.transform("loss", lambda x: unescape(F.col("text").substr((x.start + 1).cast("int"), x.length.cast("int"))))
    return windows.withColumn(parts, inside).withColumns({"turns": F.transform(targets, turn), "learnt": learnt}).drop(parts)


def _by_role_mark(x: Column, other: Column, value: Callable[[str, str], Column]) -> Column:
    found = F
    for name, mark in MARKS.items():
        found = found.when(x.startswith(mark), value(name, mark))
    return found.otherwise(other)


def digests(windows: DataFrame) -> DataFrame:
    """Conversations as read back from windows: a row for each, with hashes of its turns and of what is learnt.

    A conversation's hash needs its whole text in one row, so this, unlike the windows, is bounded by what a row holds.
    """
    said = lambda turns: F.array_join(F.transform(turns, lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    each = read_windows(windows).select(
        "conv_id", F.struct("cell", "window", said(F.col("turns")).alias("said"), F.array_join("learnt", "").alias("learnt")).alias("its"), F.size("turns").alias("n"), F.length("text").alias("chars")
    )
    whole = each.groupBy("conv_id").agg(F.array_sort(F.collect_list("its")).alias("its"), F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"))
    learnt = F.array_join(F.transform("its", lambda x: x.learnt), "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(F.array_join(F.transform("its", lambda x: x.said), ""), 256).alias("turns_sha256"), F.length(learnt).cast("bigint").alias("loss_chars"), F.sha2(learnt, 256).alias("loss_sha256"), "formatted_chars"
    )
