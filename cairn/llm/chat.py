"""Chat formatting into budgeted training windows (built-in functions only).

A conversation is its rows ordered by turn (rows of the same turn by role,
then text). Its template writes each turn as::

    ### Role: text</turn>

with a line break after ``</turn>``. Inside texts the control strings are
replaced, reversibly: a backslash doubles, ``### `` becomes ``\\h`` and
``</turn>`` becomes ``\\e``; so neither can be read as a mark. ``unescape``
undoes it. Roles other than user, assistant and system are written as ``@``
and the escaped role with ``:`` as ``\\c``.

Windows. Running sums of the turns' token counts cut a conversation into
turn-aligned spans of at most ``budget`` tokens together with what is
repeated before them: the system turn (if the conversation starts with one)
and up to ``history_turns`` earlier turns of together at most ``history``
tokens. A span takes turns as long as their sum stays within ``room = budget -
history - system tokens``; a fold over the token counts finds the cuts, which
are as few as such spans allow. A turn is never cut: one longer than the room
has a window of its own that exceeds the budget (``over_budget``). Every turn
is new in exactly one window; repeated turns are masked, so each assistant text
is a target once.

A conversation is one row while it is cut, as its digest needs its turns in
order: memory is bounded by the longest conversation, not by the table. Null
texts and roles count as empty. Rows with a null conversation id form one
conversation (so they stand in one row too); null turns come first. Repeated
rows are turns of their own; very long texts stay whole; other columns are
ignored. An empty table gives no windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUDGET = 2048
HISTORY = 256
HISTORY_TURNS = 2

HEAD, TAIL = "### ", "</turn>\n"
LABELS = {"user": "User", "assistant": "Assistant", "system": "System"}


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit("### "), F.lit("\\h")), F.lit("</turn>"), F.lit("\\e"))


def unescape(text: Column) -> Column:
    """Split at doubled backslashes first, so that what is left of the
    backslashes belongs to control strings."""
    parts = F.split(text, r"\\\\")
    plain = F.transform(
        parts,
        lambda p: F.replace(
            F.replace(F.replace(p, F.lit("\\h"), F.lit("### ")), F.lit("\\e"), F.lit("</turn>")), F.lit("\\c"), F.lit(":")
        ),
    )
    return F.array_join(plain, "\\")


def role_label(role: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair])
    return F.coalesce(known[role], F.concat(F.lit("@"), F.replace(escape(role), F.lit(":"), F.lit("\\c"))))


def label_role(label: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair[::-1]])
    return F.coalesce(known[label], unescape(F.substring(label, F.lit(2), F.length(label))))


def token_estimate(text: Column) -> Column:
    """A token count without a tokenizer: word pieces of up to four
    characters and single other marks, plus three for the turn's marks."""
    return F.regexp_count(text, F.lit(r"\w{1,4}|[^\w\s]")) + F.lit(3)


def window_starts(tokens: Column, room: Column, free: Column) -> Column:
    """Positions (from 1) of the first turn of every window: a turn opens a
    window when it no longer fits. The first ``free`` turns take no room (the
    system turn, for which ``room`` leaves place in every window)."""
    zero = F.struct(F.lit(0).alias("pos"), F.lit(0).cast("long").alias("used"), F.lit(0).alias("n"), F.array(F.lit(1)).alias("starts"))

    def step(a, t):
        full = (a["n"] > 0) & (a["used"] + t > room)
        counts = a["pos"] >= free
        return F.struct(
            (a["pos"] + 1).alias("pos"),
            F.when(~counts, F.lit(0).cast("long")).when(full, t).otherwise(a["used"] + t).alias("used"),
            F.when(~counts, F.lit(0)).when(full, F.lit(1)).otherwise(a["n"] + 1).alias("n"),
            F.when(full, F.concat(a["starts"], F.array(a["pos"] + 1))).otherwise(a["starts"]).alias("starts"),
        )

    return F.aggregate(tokens, zero, step, lambda a: a["starts"])


def format_windows(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    budget: int = BUDGET,
    history: int = HISTORY,
    history_turns: int = HISTORY_TURNS,
    tokens=token_estimate,
) -> DataFrame:
    """One row per window: conv, window (from 0), formatted, mask (array of
    start and length in code points of ``formatted``), n_repeated (turns at
    its start that an earlier window has as new ones), n_new, n_tokens,
    over_budget."""
    rows = conversations.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    turn = F.struct("turn", "role", "text", tokens(F.col("text")).cast("long").alias("tokens"))
    whole = rows.groupBy("conv").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def piece(t, i):
        start = F.concat(F.lit(HEAD), role_label(t["role"]), F.lit(": "))
        body = escape(t["text"])
        return F.struct(
            (i + 1).alias("pos"),
            F.length(start).alias("skip"),
            F.length(body).alias("n"),
            (t["role"] == "assistant").alias("target"),
            t["tokens"].alias("tokens"),
            F.concat(start, body, F.lit(TAIL)).alias("s"),
        )

    whole = whole.select("conv", (F.col("turns")[0]["role"] == "system").alias("has_system"), F.transform("turns", piece).alias("pieces"))
    whole = whole.withColumn("system", F.when(F.col("has_system"), F.col("pieces")[0]))
    whole = whole.withColumn("room", F.greatest(F.lit(budget - history) - F.coalesce(F.col("system.tokens"), F.lit(0)), F.lit(1)))
    whole = whole.withColumn("cuts", window_starts(F.transform("pieces", lambda x: x["tokens"]), F.col("room"), F.col("has_system").cast("int")))

    def span(first, k):
        last = F.coalesce(F.get(F.col("cuts"), k + 1) - 1, F.size("pieces"))
        back = F.least(F.lit(history_turns), first - 1)
        return F.struct(
            k.cast("long").alias("window"),
            F.slice("pieces", first, last - first + 1).alias("new"),
            F.slice("pieces", first - back, back).alias("before"),
            F.when(first > 1, F.col("system")).alias("system"),
        )

    grouped = whole.select("conv", F.explode(F.transform("cuts", span)).alias("w")).select("conv", "w.*")
    # of the turns before, keep the longest tail within the history budget;
    # the system turn is repeated on its own
    tail_tokens = lambda x: F.aggregate(
        F.filter("before", lambda y: y["pos"] >= x["pos"]), F.lit(0).cast("long"), lambda a, y: a + y["tokens"]
    )
    kept = F.filter(
        "before",
        lambda x: (F.col("system").isNull() | (x["pos"] > 1)) & (tail_tokens(x) <= history),
    )
    repeated = F.concat(F.when(F.col("system").isNotNull(), F.array("system")).otherwise(F.slice(F.array("system"), 1, 0)), kept)
    placed = grouped.withColumn("repeated", repeated).withColumn("all", F.concat("repeated", "new"))
    # start of each piece in the window text, by a running sum of lengths
    lengths = F.transform("all", lambda x: F.length(x["s"]))
    placed = placed.withColumn("lengths", lengths).withColumn(
        "starts",
        F.aggregate(
            "lengths",
            F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
            lambda a, n: F.struct((a["at"] + n).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")),
            lambda a: a["out"],
        ),
    )
    spots = F.arrays_zip(F.col("all").alias("p"), F.col("starts").alias("at"), F.sequence(F.lit(1), F.size("all")).alias("i"))
    targets = F.filter(spots, lambda x: x["p"]["target"] & (x["i"] > F.size("repeated")))
    mask = F.transform(targets, lambda x: F.struct((x["at"] + x["p"]["skip"]).alias("start"), x["p"]["n"].alias("length")))
    total = F.aggregate("all", F.lit(0).cast("long"), lambda a, x: a + x["tokens"])
    return placed.select(
        "conv",
        "window",
        F.array_join(F.transform("all", lambda x: x["s"]), "").alias("formatted"),
        mask.alias("mask"),
        F.size("repeated").alias("n_repeated"),
        F.size("new").alias("n_new"),
        total.alias("n_tokens"),
        (total > budget).alias("over_budget"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation, from the windows alone: the turns (parsed from the
    formatted text; repeated ones once) and the text under the loss mask.

    A conversation's digest needs its texts in one row; nothing larger than
    a conversation is gathered.
    """
    blocks = F.split("formatted", TAIL)
    new = F.slice(blocks, F.col("n_repeated") + 1, F.size(blocks) - 1 - F.col("n_repeated"))

    def turn(block):
        rest = F.substring(block, F.lit(len(HEAD) + 1), F.length(block))
        label = F.substring_index(rest, ": ", 1)
        text = F.substring(rest, F.length(label) + F.lit(3), F.length(rest))
        return F.concat(label_role(label), F.lit("\n"), unescape(text), F.lit("\n"))

    loss = F.transform("mask", lambda m: unescape(F.substring(F.col("formatted"), m["start"] + 1, m["length"])))
    parsed = windows.select(
        "conv",
        F.struct(
            F.col("window"),
            F.array_join(F.transform(new, turn), "").alias("turns"),
            F.array_join(loss, "").alias("loss"),
            (F.size(blocks) - 1 - F.col("n_repeated")).cast("long").alias("n_turns"),
            F.length("formatted").cast("long").alias("chars"),
        ).alias("w"),
    )
    joined = parsed.groupBy("conv").agg(F.sort_array(F.collect_list("w")).alias("w"))
    whole = lambda name: F.array_join(F.col("w." + name), "")
    add = lambda name: F.aggregate(F.col("w." + name), F.lit(0).cast("long"), lambda a, x: a + x)
    return joined.select(
        "conv",
        add("n_turns").alias("n_turns"),
        whole("turns").alias("turns"),
        whole("loss").alias("loss"),
        add("chars").alias("formatted_chars"),
        F.size("w").cast("long").alias("n_windows"),
    )
