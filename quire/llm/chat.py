"""Chat formatting in budgeted windows. Built-in expressions only.

A turn is written ``<s>[role]text</s>``. Inside texts and roles a backslash is doubled and a control
string gets a backslash after its first character (so does ``]`` in a role), so no text can end a
turn, and taking the character behind each backslash gives the text back.

Windows: ``room`` is what ``budget`` leaves after the system turn and the history. With the prefix sums of the turns' tokens, a window
that starts behind P tokens takes every turn that ends within P + room; the next turn starts the next window. Windows start
anew where (prefix sum + turns so far) passes a multiple of ``STRETCH`` rooms, so that a stretch of bounded size can be cut by itself;
that leaves one window in some ``STRETCH`` short. So every window is a span of whole turns that fits the budget, unless a
single turn, or the system turn, doesn't. Each window starts with the system turn
(the first turn, if its role is ``system``) and as much of the last ``history_turns`` turns as ``history`` tokens hold; these
are repeated, so the loss mask leaves them out. It covers the texts of new assistant turns, each once over all windows.

* null text or role: empty. ``tokens_col`` gives the tokens of turns; without it they are estimated at 4, and 1 for every 4 code points.
* Order is (turn, role, text), nulls first; repeated rows are turns of their own. null conversation: one of its own.
* A very long turn is a window by itself, never cut. A system turn that leaves less than ``LEAST`` tokens leaves those, over
  the budget. Empty table: no rows. Extra columns aren't carried.

Scale: turns are dealt by ranges of their order and written; token sums are combined by range, summed over ranges, then within
one, so a conversation with a third of all rows spreads by its ranges, whether its turns have numbers or not, and by its stretches and
windows. One row a conversation (its system turn) and one row a range are written before they meet, so that adaptive
execution splits a hot conversation; a turn's window and the history are fetched by equi-joins on (conversation, ordinal).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quire.session import Scratch

CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
#: Rooms of a stretch of turns that is cut into windows by itself; code points of a text that take part in dealing turns to ranges.
STRETCH, PREFIX = 64, 64
#: Tokens that are left for new turns whatever the system turn takes.
LEAST = 64
_LEAD = r"(<(?=/?s>|<SYS>>|</SYS>>)|\[(?=/?INST\]))"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _LEAD, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _tokens(text: Column) -> Column:
    return (F.floor((F.char_length(text) + 3) / 4) + 4).cast("long")


def _starts(turns: Column, room: Column) -> Column:
    """Ordinals at which the windows of a stretch start; ``turns``: (ord, p, end) in order, the prefix sums before and behind each."""
    first = F.get(turns, F.lit(0))
    start = F.struct(F.array(first["ord"]).alias("starts"), first["p"].alias("base"))

    def put(acc: Column, turn: Column) -> Column:
        fits = (turn["p"] == acc["base"]) | (turn["end"] - acc["base"] <= room)
        return F.struct(F.when(fits, acc["starts"]).otherwise(F.concat(acc["starts"], F.array(turn["ord"]))).alias("starts"), F.when(fits, acc["base"]).otherwise(turn["p"]).alias("base"))

    return F.aggregate(turns, start, put)["starts"]


def chat_windows(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", budget: int = 1024, history: int = 128, history_turns: int = 4,
    tokens_col: str | None = None,
) -> DataFrame:
    """Columns: conv_id, window, formatted, loss_spans (start from 0 and length, in code points), n_repeated, n_turns, tokens (of all its turns)."""
    scratch = Scratch(turns.sparkSession, "chat")
    empty = F.lit("")
    tokens = _tokens(F.coalesce(turns[text_col], empty)) if tokens_col is None else F.coalesce(turns[tokens_col].cast("long"), F.lit(0))
    rows = turns.select(
        turns[conv_col].alias("conv"), turns[turn_col].cast("long").alias("turn"), F.coalesce(turns[role_col], empty).alias("role"), F.coalesce(turns[text_col], empty).alias("text"), tokens.alias("tokens"),
    )
    # rows that only differ behind the prefix share a range; the ids of ranges are written, as they hang on a sample
    rows = scratch.keep(rows.repartitionByRange("conv", "turn", "role", F.left("text", F.lit(PREFIX))).withColumn("block", F.spark_partition_id()), "ordered")

    order = ["turn", "role", "text", "tokens"]
    lead = rows.groupBy("conv").agg(F.min(F.struct(*order)).alias("f")).select("conv", (F.col("f.role") == "system").alias("has_system"), F.when(F.col("f.role") == "system", F.col("f.tokens")).otherwise(0).alias("s_tokens"))
    lead = scratch.keep(lead, "lead")
    sums = rows.groupBy("conv", "block").agg(F.count("*").alias("n"), F.sum("tokens").alias("t"))
    earlier = W.partitionBy("conv").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    base = sums.select("conv", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"), F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("t0"))
    base = scratch.keep(base, "blocks")
    base = scratch.keep(base.alias("b").join(lead.alias("l"), F.col("b.conv").eqNullSafe(F.col("l.conv"))).select("b.*", "has_system", "s_tokens"), "blocks")
    inside = W.partitionBy("conv", "block").orderBy(*order)
    placed = (
        rows.alias("r").join(base.alias("b"), F.col("r.conv").eqNullSafe(F.col("b.conv")) & (F.col("r.block") == F.col("b.block")))
        .select("r.*", "n0", "t0", "has_system", "s_tokens")
        .select(
            "conv", "role", "text", "tokens", "has_system", "s_tokens",
            (F.col("n0") + F.row_number().over(inside) - 1).alias("ord"),
            (F.col("t0") + F.sum("tokens").over(inside.rowsBetween(W.unboundedPreceding, 0)) - F.col("tokens") - F.col("s_tokens")).alias("p"),
        )
    )
    is_system = F.col("has_system") & (F.col("ord") == 0)
    room = F.greatest(F.lit(LEAST), F.lit(budget - history) - F.col("s_tokens"))
    placed = placed.select("conv", "ord", "role", "text", "tokens", F.greatest("p", F.lit(0)).alias("p"), is_system.alias("is_system"), "has_system", room.alias("room"))
    placed = scratch.keep(placed, "turns")
    end = F.col("p") + F.when(F.col("is_system"), 0).otherwise(F.col("tokens"))
    stretch = F.floor((F.col("p") + F.col("ord")) / (STRETCH * F.col("room")))
    cut = placed.groupBy("conv", stretch.alias("stretch")).agg(F.sort_array(F.collect_list(F.struct("ord", "p", end.alias("end"), "is_system"))).alias("turns"), F.first("room").alias("room"), F.first("has_system").alias("has_system"))
    cut = cut.select("conv", "has_system", "turns", _starts(F.col("turns"), F.col("room")).alias("starts")).select("conv", "has_system", "starts", F.explode("turns").alias("t"))
    window = F.array_max(F.filter("starts", lambda x: x <= F.col("t.ord")))
    cut = scratch.keep(cut.select("conv", "has_system", "t.ord", "t.p", "t.is_system", window.alias("window")), "windows-of-turns")
    spans = cut.where(~F.col("is_system")).groupBy("conv", "window").agg(F.min("ord").alias("first"), F.min("p").alias("first_p"), F.first("has_system").alias("has_system"))
    spans = scratch.keep(spans, "windows")
    back = spans.select("*", F.explode(F.sequence(F.lit(1), F.lit(history_turns))).alias("k")).select("*", (F.col("first") - F.col("k")).alias("at"))
    said = back.alias("w").join(placed.where(~F.col("is_system")).alias("t"), F.col("w.conv").eqNullSafe(F.col("t.conv")) & (F.col("w.at") == F.col("t.ord"))).where(F.col("first_p") - F.col("t.p") <= history)
    turn_of = ("t.ord", "t.role", "t.text", "t.tokens", F.lit(True).alias("repeated"))
    repeated = said.select("w.conv", "w.window", *turn_of)
    system = spans.where("has_system and window > 0").alias("w").join(placed.where("is_system").alias("t"), F.col("w.conv").eqNullSafe(F.col("t.conv")))
    system = system.select("w.conv", "w.window", *turn_of)
    new = placed.alias("t").join(cut.alias("w"), F.col("t.conv").eqNullSafe(F.col("w.conv")) & (F.col("t.ord") == F.col("w.ord")))
    new = new.select("t.conv", "w.window", "t.ord", "t.role", "t.text", "t.tokens", F.lit(False).alias("repeated"))

    head = F.concat(F.lit("<s>["), F.replace(escape(F.col("role")), F.lit("]"), F.lit("\\]")), F.lit("]"))
    written = new.unionByName(repeated).unionByName(system).select("conv", "window", "ord", "role", "tokens", "repeated", head.alias("head"), escape(F.col("text")).alias("body"))
    upto = W.partitionBy("conv", "window").orderBy("ord").rowsBetween(W.unboundedPreceding, -1)
    size = F.char_length("head") + F.char_length("body") + 4
    placed_text = written.withColumn("start", F.coalesce(F.sum(size).over(upto), F.lit(0)) + F.char_length("head"))
    turn = F.struct("ord", "tokens", F.concat("head", "body", F.lit("</s>")).alias("s"), "start", F.char_length("body").cast("long").alias("length"), ((F.col("role") == "assistant") & ~F.col("repeated")).alias("loss"), "repeated")
    grouped = placed_text.groupBy("conv", "window").agg(F.sort_array(F.collect_list(turn)).alias("ts"))
    return grouped.select(
        F.col("conv").alias("conv_id"), "window", F.array_join(F.transform("ts", lambda t: t["s"]), "").alias("formatted"),
        F.transform(F.filter("ts", lambda t: t["loss"]), lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"))).alias("loss_spans"),
        F.size(F.filter("ts", lambda t: t["repeated"])).alias("n_repeated"), F.size("ts").alias("n_turns"), F.aggregate("ts", F.lit(0).cast("long"), lambda n, t: n + t["tokens"]).alias("tokens"),
    )


def read_windows(windows: DataFrame) -> DataFrame:
    """From the formatted text and its mask alone: conv_id, window, new turns (role, text), loss_text."""
    pieces = F.slice(F.split("formatted", "</s>"), F.col("n_repeated") + 1, F.col("n_turns") - F.col("n_repeated"))
    role = lambda x: unescape(F.regexp_extract(x, r"(?s)^<s>\[((?:\\.|[^\]\\])*)\]", 1))
    text = lambda x: unescape(F.regexp_replace(x, r"(?s)^<s>\[(?:\\.|[^\]\\])*\]", ""))
    said = F.transform(pieces, lambda x: F.struct(role(x).alias("role"), text(x).alias("text")))
    loss = F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return windows.select("conv_id", "window", "formatted", said.alias("turns"), F.array_join(loss, "").alias("loss_text"))
