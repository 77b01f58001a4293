"""Chat formatting into budgeted windows, with DataFrame functions only.

Prefix sums of turn tokens (a running window sum) choose turn-aligned spans: a window that opens at a turn may
reach up to a limit on the prefix sum, and the next one opens at the first turn whose prefix sum is beyond it. A
later window begins with the conversation's system turn and a limited history, both repeated and masked: the loss
mask covers each assistant text once, where it is new.

No window exceeds the budget, but for one: a new turn that doesn't fit into it even without history has a window of
its own, behind the system turn. History is as many of the last turns, `history` at most, as fit into a quarter of
the budget and leave room for the system turn and the new one.

The template is `<|im_start|>role\\ntext<|im_end|>\\n`. Control strings inside texts and roles get one
backslash more behind their first character, so reading back is exact; roles write a line break as `\\n`
and a backslash as `\\e`.

A conversation is the unit: its turns meet in one task, as reading it back as one text asks for. Every turn is then
held once, and once more for each window that repeats it.

Defined results: null texts and roles are empty; rows go by turn, null turns first, ties by role and text,
and repeated rows are turns of their own; a null conv_id is one conversation; very long texts are whole turns; an
empty table gives no windows; other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mandrel.llm.common import scanned

BUDGET, HISTORY = 1024, 2

#: The marks of a turn, and the control strings that texts may not hold bare.
START, END = "<|im_start|>", "<|im_end|>\n"
_CONTROL = r"(\|im_start\|>|\|im_end\|>|/?s>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*){_CONTROL}", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*){_CONTROL}", "$1$2$3")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\e")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("\\n"), F.lit("\n")), F.lit("\\e"), F.lit("\\"))


#: Scripts that are written without spaces, and how many characters of a word are one token.
UNSPACED = ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")
WORD = 16


def pieces(text: Column) -> Column:
    """The default measure of tokens: each character of a script without spaces, words of other scripts by WORD characters
    or fewer, and single other characters."""
    alone = "[" + "".join(rf"\p{{Is{s}}}" for s in UNSPACED) + "]"
    text = F.when(text.rlike(alone), F.regexp_replace(text, f"({alone})", " $1 ")).otherwise(text)
    return F.size(F.regexp_extract_all(text, F.lit(rf"[\p{{L}}\p{{M}}\p{{N}}_]{{1,{WORD}}}|[^\p{{L}}\p{{M}}\p{{N}}_\x20\x09-\x0D]"), F.lit(0)))


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens: Callable[[Column], Column] = pieces) -> DataFrame:
    """One row for each window: conv_id, window, n_context (leading turns that are repeated), n_tokens, formatted, loss.

    loss lists (start, length) in code points of formatted.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    rows = rows.select("conv_id", "turn", "role", "text", escape_role(F.col("role")).alias("er"), escape(F.col("text")).alias("et"))
    block = F.concat(F.lit(START), "er", F.lit("\n"), "et", F.lit(END))
    rows = rows.withColumn("block", block).withColumn("tok", tokens(F.col("block")).cast("long")).withColumn("len", F.length("block").cast("long"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    sofar = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("i", F.row_number().over(order) - 1).withColumn("p", F.sum("tok").over(sofar)).withColumn("at", F.sum("len").over(sofar) - F.col("len"))
    rows = rows.withColumn("has_system", F.first("role").over(sofar) == "system")
    system = F.when(F.col("has_system"), F.first("tok").over(sofar)).otherwise(F.lit(0).cast("long"))
    # How much history a window that begins here repeats, and the prefix sum up to which it may reach.
    kept, cost = F.lit(0), F.lit(0).cast("long")
    for k in range(1, history + 1):
        spent = F.sum("tok").over(order.rowsBetween(-k, -1))
        fits = (F.col("i") - k >= F.col("has_system").cast("int")) & (spent <= budget // 4) & (F.col("system") + spent + F.col("tok") <= budget)
        kept, cost = F.when(fits, F.lit(k)).otherwise(kept), F.when(fits, spent).otherwise(cost)
    rows = rows.withColumn("system", system).withColumns({"back": kept, "cost": cost})
    fresh = F.when(F.col("i") > 0, F.col("system") + F.col("cost")).otherwise(F.lit(0))
    rows = rows.withColumn("limit", F.col("p") - F.col("tok") + F.lit(budget) - fresh)
    turn = F.struct(
        "i", "p", "limit", "tok", "back", "at", (F.lit(len(START) + 1) + F.length("er")).cast("long").alias("head"),
        F.length("et").cast("long").alias("size"), (F.col("role") == "assistant").alias("target"), "block", "has_system",
    )
    convs = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))

    def step(acc: Column, t: Column) -> Column:
        opens = t["p"] > acc["limit"]
        opened = F.when(opens, F.array(F.struct(t["i"].alias("from"), t["back"].alias("back")))).otherwise(F.array().cast("array<struct<from:int,back:int>>"))
        return F.struct(F.struct(F.when(opens, t["limit"]).otherwise(acc["limit"]).alias("limit")).alias("state"), opened.alias("out"))

    # The first turn opens a window whatever its size: every prefix sum is beyond the first limit.
    bare = F.transform("t", lambda t: F.struct(t["i"].alias("i"), t["p"].alias("p"), t["limit"].alias("limit"), t["back"].alias("back")))
    convs = convs.withColumn("starts", scanned(bare, F.struct(F.lit(-1).cast("long").alias("limit")), step, "struct<from:int,back:int>"))
    none = F.slice("t", 1, 0)

    def window(s: Column, w: Column) -> Column:
        later = w > 0
        end = F.coalesce(F.get("starts", w + 1)["from"], F.size("t"))
        head = F.when(later & F.col("t")[0]["has_system"], F.slice("t", 1, 1)).otherwise(none)
        again = F.when(later, F.slice("t", s["from"] - s["back"] + 1, s["back"])).otherwise(none)
        return F.struct(w.alias("window"), F.concat(head, again).alias("context"), F.slice("t", s["from"] + 1, end - s["from"]).alias("new"))

    out = convs.select("conv_id", F.explode(F.transform("starts", window)).alias("w")).select("conv_id", "w.*")
    chars = F.aggregate("context", F.lit(0).cast("long"), lambda a, t: a + F.length(t["block"]))
    out = out.withColumn("shift", chars - F.col("new")[0]["at"])
    whole = F.concat("context", "new")
    loss = F.transform(F.filter("new", lambda t: t["target"]), lambda t: F.struct((F.col("shift") + t["at"] + t["head"]).alias("start"), t["size"].alias("length")))
    return out.select(
        "conv_id", "window", F.size("context").alias("n_context"), F.aggregate(whole, F.lit(0).cast("long"), lambda a, t: a + t["tok"]).alias("n_tokens"),
        F.array_join(F.transform(whole, lambda t: t["block"]), "").alias("formatted"), loss.alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Windows with `turns` (role, text), repeated ones left out, and `target`, the text under the loss mask, unescaped."""
    parts = F.split("formatted", r"<\|im_end\|>\n", -1)
    new = F.slice(parts, F.col("n_context") + 1, F.size(parts) - 1 - F.col("n_context"))
    bare = F.transform(new, lambda x: F.substr(x, F.lit(len(START) + 1)))
    role = lambda x: F.substring_index(x, "\n", 1)
    turns = F.transform(bare, lambda x: F.struct(unescape_role(role(x)).alias("role"), unescape(F.substr(x, F.length(role(x)) + 2)).alias("text")))
    masked = F.transform("loss", lambda s: unescape(F.substring("formatted", (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return formatted.select("conv_id", "window", turns.alias("turns"), F.array_join(masked, "").alias("target"), F.length("formatted").cast("long").alias("chars"))
