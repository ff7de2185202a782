"""Chat formatting with Spark expressions only.

A conversation becomes one string. Each run of adjacent rows of one role is one turn block:

    <|turn|>ROLE<|says|>TEXT<|also|>TEXT<|end|>

``<|also|>`` stands between the rows of one run, so that a merged turn can be taken apart again.
Control strings all begin with ``<|``. In roles and texts a backslash is doubled and ``<|`` becomes
``<\\|``; the single backslash stands between ``<`` and ``|`` only, so unescaping is unambiguous.

The loss mask is an array of (start, length) in code points over the formatted string, one span for
each assistant text, without the control strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows whose spans are listed by one fold, which copies its list at each row.
FOLD = 64
TURN, SAYS, ALSO, END = "<|turn|>", "<|says|>", "<|also|>", "<|end|>"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def format_conversations(rows: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """conv_id, formatted, loss_mask for rows (conv_id, turn, role, text).

    Rows are taken by turn, ties by role, then text; repeated rows stay. Null roles and texts count
    as empty; a null turn comes first; rows of null conv_id form one conversation. Other columns are
    ignored. No rows: no conversations.
    """
    turns = rows.select(
        "conv_id",
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            escape(F.coalesce(F.col("role").cast("string"), F.lit(""))).alias("role"),
            escape(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"),
        ).alias("t"),
    )
    convs = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))

    def head(x: Column, i: Column) -> Column:
        """What stands before the text of row i."""
        merged = (i > 0) & (F.get("turns", i - 1)["role"] == x["role"])
        opened = F.concat(F.lit(TURN), x["role"], F.lit(SAYS))
        return F.when(merged, F.lit(ALSO)).when(i > 0, F.concat(F.lit(END), opened)).otherwise(opened)

    parts = convs.select("conv_id", F.transform("turns", lambda x, i: F.struct(x["role"].alias("role"), head(x, i).alias("head"), x["text"].alias("text"))).alias("parts"))
    # folds over FOLD rows each, from where these begin: a single one would take time quadratic in the rows
    size = lambda x: F.length(x["head"]) + F.length(x["text"])
    each = lambda f: F.transform(F.sequence(F.lit(0), F.floor((F.size("parts") - 1) / FOLD).cast("int")), lambda b: f(b, F.slice("parts", b * FOLD + 1, F.lit(FOLD))))
    parts = parts.withColumn("sizes", each(lambda b, own: F.aggregate(own, F.lit(0), lambda n, x: n + size(x))))

    def step(acc: Column, x: Column) -> Column:
        start = acc["end"] + F.length(x["head"])
        span = F.array(F.struct(start.alias("start"), F.length(x["text"]).alias("length")))
        return F.struct((start + F.length(x["text"])).alias("end"), F.when(x["role"] == escape(F.lit(loss_role)), F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    def spans(b: Column, own: Column) -> Column:
        begin = F.aggregate(F.slice("sizes", F.lit(1), b), F.lit(0), lambda n, x: n + x)
        none = F.array().cast("array<struct<start:int,length:int>>")
        return F.aggregate(own, F.struct(begin.alias("end"), none.alias("spans")), step, lambda acc: acc["spans"])

    return parts.select(
        "conv_id",
        F.concat(F.array_join(F.transform("parts", lambda x: F.concat(x["head"], x["text"])), ""), F.lit(END)).alias("formatted"),
        F.flatten(each(spans)).alias("loss_mask"),
    )


def parse_conversations(formatted: DataFrame) -> DataFrame:
    """Adds turns (array of role, text, one for each row) and loss_text, both read from formatted and loss_mask."""
    literal = lambda s: s.replace("|", "\\|")

    def of_block(b: Column) -> Column:
        role = F.substring_index(b, SAYS, 1)
        body = b.substr(F.length(role) + F.lit(len(SAYS) + 1), F.length(b))
        return F.transform(F.split(body, literal(ALSO), -1), lambda p: F.struct(unescape(role).alias("role"), unescape(p).alias("text")))

    inner = F.col("formatted").substr(F.lit(len(TURN) + 1), F.length("formatted") - len(TURN) - len(END))

    def under(b: Column) -> Column:
        """The texts of FOLD spans, from a cut of the output that holds them: a substring is counted out from the front."""
        own = F.slice("loss_mask", b * FOLD + 1, F.lit(FOLD))
        begin, last = F.get(own, F.lit(0))["start"], F.element_at(own, -1)
        cut = F.transform(F.array(F.col("formatted").substr(begin + 1, last["start"] + last["length"] - begin)), lambda c: F.transform(own, lambda s: unescape(c.substr(s["start"] - begin + 1, s["length"]))))
        return F.array_join(F.flatten(cut), "")

    folds = F.when(F.size("loss_mask") > 0, F.sequence(F.lit(0), F.floor((F.size("loss_mask") - 1) / FOLD).cast("int"))).otherwise(F.array().cast("array<int>"))
    return formatted.withColumns({
        "turns": F.flatten(F.transform(F.split(inner, literal(END + TURN), -1), of_block)),
        "loss_text": F.array_join(F.transform(folds, under), ""),
    })
