"""Chat formatting with quotation linking. DataFrame functions only.

Quoted lines start with one or more ``>``; a passage is a run of lines of one depth. Every quoted passage and every line of it
is hashed in normal form (markers off, white space collapsed, lower case) and joined to the messages that wrote it in their own text.

Candidates of a passage are the earliest message that wrote the whole passage as one, and the earliest writer of each of its lines; a line that at
most RARE messages wrote names them all. Where commoner lines hold most of a passage's weight, messages that wrote several of them are compared
by classes: those that wrote the same ones count once, with their earliest message (``classed``). So no source is missed, and the number of candidates
doesn't grow with the square of a common line's messages. Each candidate is then verified on all lines: it must hold more than half of the passage's weight, in which a line counts the
less the more messages wrote it. The best is an earlier message of the same conversation, then one that holds the whole passage, then the most weight, then the earliest.

Messages come out without quotes, each with the message it replies to, and in reply order: a reply that quotes goes to the thread of the
earliest message that is reached by following quotes, also in another conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meshwright.llm.common import let, table, written

#: A line that more messages of a conversation (or of all) wrote names the earliest of them, and others only by their classes.
RARE = 32
#: A quoted mark may be followed by one blank that isn't the line's. One class of characters, so that no run of marks nests the matcher.
_MARK = r"^[ \t>]*>[ \t]?"
_KEY = "conv_id", "turn", "part", "depth"
#: Weights are summed in different orders.
SLACK = 1e-8


def attribution(line: Column) -> Column:
    """Whether a line is like "On Monday X wrote:"; right before a quote it belongs to the quote."""
    x = F.lower(F.trim(F.translate(line, "\t", " ")))
    said = lambda start, end: x.startswith(start) & x.rlike(end)
    return said("on ", r"\bwrote *:$") | (said("am ", ":$") & x.contains(" schrieb")) | said("le ", "a écrit *:$") | said("el ", "escribió *:$")


def depth(line: Column) -> Column:
    return F.length(F.translate(F.regexp_extract(line, r"^[ \t>]*", 0), " \t", ""))


def normal(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(line, _MARK, ""), r"\s+", " ")))


def text_lines(text: Column) -> Column:
    return F.split(F.regexp_replace(text, r"\r\n?", "\n"), "\n", -1)


def parse(text: Column) -> Column:
    """Array of passages (d, body, lines): runs of lines of one depth; body is their text, lines their normal forms that aren't blank.

    A run is a slice between two changes of depth, so the work is linear in the text, however many lines or runs it has.
    """

    def runs(x: Column) -> Column:  # x: (t, d) of every line
        first = F.filter(F.sequence(F.lit(0), F.size(x) - 1), lambda i: (i == 0) | (F.get(x, i)["d"] != F.get(x, i - 1)["d"]))
        return let(first, lambda s: F.transform(s, lambda at, k: F.struct(F.get(x, at)["d"].alias("d"), F.slice(x, at + 1, F.coalesce(F.get(s, k + 1), F.size(x)) - at).alias("l"))))

    def levels(raw: Column) -> Column:
        return F.transform(raw, lambda x: F.struct(x.alias("t"), depth(x).alias("d")))

    def joined(x: Column) -> Column:  # attributions become depth -1
        ahead = lambda i: F.coalesce(F.get(x, i + 1)["d"], F.lit(0)) > 0
        return F.transform(x, lambda y, i: F.struct(F.regexp_replace(y["t"], _MARK, "").alias("t"), F.when((y["d"] == 0) & ahead(i) & attribution(y["t"]), F.lit(-1)).otherwise(y["d"]).alias("d")))

    got = let(let(levels(text_lines(text)), joined), runs)
    body = lambda r: F.array_join(F.transform(r["l"], lambda y: y["t"]), "\n")
    return F.transform(F.filter(got, lambda r: r["d"] >= 0), lambda r: F.struct(r["d"].alias("d"), body(r).alias("body"), F.filter(F.transform(r["l"], lambda y: normal(y["t"])), lambda s: s != "").alias("lines")))


def messages(conv: DataFrame) -> DataFrame:
    df = conv.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    plain = ~F.col("text").rlike(r"(?m)^[ \t]*>")  # nothing to parse
    whole = F.array(F.struct(F.lit(0).alias("d"), F.col("text").alias("body"), F.filter(F.transform(text_lines(F.col("text")), normal), lambda x: x != "").alias("lines")))
    return df.withColumn("parts", F.when(plain, whole).otherwise(parse(F.col("text"))))


def hashed(parsed: DataFrame) -> DataFrame:
    """conv_id, turn, own (hashes of the lines and whole passages that the message wrote), quotes (part, depth, whole, lines): no text."""
    line = lambda s: F.xxhash64(F.lit("line"), s)
    whole = lambda p: F.xxhash64(F.lit("passage"), F.array_join(p["lines"], "\n"))
    filled = F.filter("parts", lambda p: (p["d"] == 0) & (F.size(p["lines"]) > 0))
    own = F.array_distinct(F.flatten(F.transform(filled, lambda p: F.concat(F.array(whole(p)), F.transform(p["lines"], line)))))
    numbered = F.transform("parts", lambda p, i: F.struct(i.alias("part"), p["d"].alias("depth"), whole(p).alias("whole"), F.array_distinct(F.transform(p["lines"], line)).alias("lines")))
    quotes = F.filter(numbered, lambda q: (q["depth"] > 0) & (F.size(q["lines"]) > 0))
    return parsed.where("conv_id is not null and turn is not null").select("conv_id", "turn", own.alias("own"), quotes.alias("quotes"))


def classed(asked: DataFrame, wrote: DataFrame, scope: list[str]) -> DataFrame:
    """scope, lines, own, w: classes of passages and of messages that share more than half the weight of ``asked(*scope, lines, half)``.

    ``lines`` holds (total, h, w) of a passage's common lines, rarest first; ``wrote(*scope, own)`` is what messages wrote of such lines. A message that holds none of
    the rarest lines up to where the others weigh half can't hold more than half, so classes meet only by these.
    """
    spare = F.aggregate("lines", F.lit(0.0), lambda a, x: a + x["w"])
    rarest = F.aggregate("lines", F.struct(spare.alias("rest"), F.lit(0).alias("k")), lambda a, x: F.when(a["rest"] > F.col("half") - SLACK, F.struct((a["rest"] - x["w"]).alias("rest"), (a["k"] + 1).alias("k"))).otherwise(a))["k"]
    asked = asked.groupBy(*scope, "lines").agg(F.min("half").alias("half"))
    asked = asked.withColumn("keys", F.array_distinct(F.transform(F.slice("lines", F.lit(1), rarest), lambda x: x["h"])))
    met = asked.withColumn("h", F.explode("keys")).join(wrote.select(*scope, "own").distinct().withColumn("h", F.explode("own")), [*scope, "h"])
    met = met.where(F.col("h") == F.get(F.filter("keys", lambda x: F.array_contains("own", x)), F.lit(0)))  # two classes meet once
    met = met.withColumn("w", F.round(F.aggregate(F.filter("lines", lambda x: F.array_contains("own", x["h"])), F.lit(0.0), lambda a, x: a + x["w"]), 9))
    return met.where(F.col("w") > F.col("half") - SLACK).select(*scope, "lines", "own", "w")


def common_sources(asked: DataFrame, wrote: DataFrame, rare: int = RARE) -> DataFrame:
    """_KEY, to_conv, to_turn: the best messages among those that hold most of a passage's weight in lines that more than ``rare`` messages wrote.

    ``asked`` has each passage's lines with their writers in its conversation (n) and in all (total); ``wrote(conv_id, turn, h)`` is what messages wrote of them.
    A message that wrote only one such line is no better than that line's earliest writer, so classes have at least two.
    """
    of = lambda often: (F.array_sort(F.collect_list(F.when(F.expr(often), F.struct("total", "h", "w")))), F.sum(F.when(F.expr(often), F.col("w")).otherwise(0.0)))
    (near, near_w), (far, far_w) = of(f"n > {rare}"), of(f"total > {rare}")
    some = asked.where(f"not whole and total > {rare}").select(*_KEY).distinct()
    each = asked.where("not whole").join(some, [*_KEY], "left_semi").groupBy(*_KEY).agg((F.sum("w") / 2).alias("half"), near.alias("near"), near_w.alias("near_w"), far.alias("far"), far_w.alias("far_w"))
    each = each.select(*_KEY, "half", *(F.when((F.size(c) > 1) & (F.col(f"{c}_w") > F.col("half") - SLACK), F.col(c)).alias(c) for c in ("near", "far")))
    each = written(each.where("near is not null or far is not null"), "common")
    out = each.select(*_KEY, F.col("conv_id").alias("to_conv"), F.col("turn").alias("to_turn")).limit(0)
    if each.isEmpty():
        return out

    def messages_of(asked: DataFrame, scope: list[str]) -> DataFrame:  # what each message wrote of the lines asked, two at least
        wanted = asked.select(*scope, F.explode(F.transform("lines", lambda x: x["h"])).alias("h")).distinct()
        return wrote.join(wanted, [*scope, "h"], "left_semi").groupBy("conv_id", "turn").agg(F.array_sort(F.collect_list("h")).alias("own")).where(F.size("own") > 1)

    # in the conversation: the earliest message of a class, and only if it holds more than any before it
    here = each.where("near is not null").withColumnRenamed("near", "lines").select(*_KEY, "half", "lines")
    firsts = written(messages_of(here, ["conv_id"]).groupBy("conv_id", "own").agg(F.min("turn").alias("first")), "near")
    found = classed(here, firsts, ["conv_id"]).join(firsts, ["conv_id", "own"])
    before = F.max("w").over(Window.partitionBy("conv_id", "lines").orderBy("first").rowsBetween(Window.unboundedPreceding, -1))
    found = found.withColumn("before", before).where("before is null or w > before").select("conv_id", "lines", "first")
    out = here.join(found, ["conv_id", "lines"]).where("first < turn").select(*_KEY, F.col("conv_id").alias("to_conv"), F.col("first").alias("to_turn"))

    # in others: the earliest message of the class that holds most, and the best of any other conversation than that one's
    there = each.where("far is not null").withColumnRenamed("far", "lines").select(*_KEY, "half", "lines")
    firsts = written(messages_of(there, []).groupBy("own", "conv_id").agg(F.min("turn").alias("turn")), "far")
    first = written(firsts.groupBy("own").agg(F.min(F.struct("conv_id", "turn")).alias("f")), "far")
    second = firsts.join(first, "own").where("conv_id <> f.conv_id").groupBy("own").agg(F.min(F.struct("conv_id", "turn")).alias("f"))
    found = classed(there, first, []).join(first.unionByName(second), "own")
    found = written(found.select("lines", F.struct("w", (-F.col("f.conv_id")).alias("c"), (-F.col("f.turn")).alias("t")).alias("x")), "far")
    best = written(found.groupBy("lines").agg(F.max("x").alias("one")), "far")
    best = best.join(found.join(best, "lines").where("x.c <> one.c").groupBy("lines").agg(F.max("x").alias("two")), "lines", "left")
    x = F.when(F.col("one.c") != -F.col("conv_id"), F.col("one")).otherwise(F.col("two"))
    far = there.join(best, "lines").select(*_KEY, x.alias("x")).where("x is not null")
    return out.unionByName(far.select(*_KEY, (-F.col("x.c")).alias("to_conv"), (-F.col("x.t")).alias("to_turn")))


def link(parsed: DataFrame, rare: int = RARE) -> DataFrame:
    """conv_id, turn, part, depth, to_conv, to_turn: the message that each quoted passage comes from (absent if none)."""
    known = written(hashed(parsed), "quotes")
    passages = known.select("conv_id", "turn", F.explode("quotes").alias("q")).select("conv_id", "turn", "q.*").distinct()
    asked = passages.select(*_KEY, F.explode(F.concat(F.array(F.struct(F.lit(True).alias("whole"), F.col("whole").alias("h"))), F.transform("lines", lambda h: F.struct(F.lit(False).alias("whole"), h.alias("h"))))).alias("x")).select(*_KEY, "x.*")
    # what messages wrote of all that is quoted; aggregates are written before they are joined, so that a common line's partition can be split
    wrote = written(known.select("conv_id", "turn", F.explode("own").alias("h")).join(asked.select("h").distinct(), "h", "left_semi").distinct(), "wrote")
    here = written(wrote.groupBy("conv_id", "h").agg(F.count("*").alias("n"), F.min("turn").alias("first")), "here")
    total = written(here.groupBy("h").agg(F.sum("n").alias("total"), F.min(F.struct("conv_id", "first")).alias("f")), "total")
    second = here.join(total, "h").where("conv_id <> f.conv_id").groupBy("h").agg(F.min(F.struct("conv_id", "first")).alias("g"))
    everywhere = written(total.join(second, "h", "left"), "everywhere")
    # a line's weight falls with its messages; one that nobody wrote weighs most
    weight = F.when(F.col("whole"), 0.0).otherwise(F.lit(1.0) / (1 + F.log2(F.coalesce("total", F.lit(1)))))
    asked = written(asked.join(everywhere, "h", "left").join(here, ["conv_id", "h"], "left").withColumn("w", weight), "asked")
    elsewhere = F.when(F.col("f.conv_id") != F.col("conv_id"), F.col("f")).otherwise(F.col("g"))
    candidates = asked.where("first < turn").select(*_KEY, F.col("conv_id").alias("to_conv"), F.col("first").alias("to_turn"))
    candidates = candidates.unionByName(asked.withColumn("o", elsewhere).where("o is not null").select(*_KEY, F.col("o.conv_id").alias("to_conv"), F.col("o.first").alias("to_turn")))
    few = f"n > 1 and n <= {rare}"
    near = wrote.join(here.where(few).select("conv_id", "h"), ["conv_id", "h"]).withColumnRenamed("turn", "to_turn")
    candidates = candidates.unionByName(asked.where(few).select(*_KEY, "h").join(near, ["conv_id", "h"]).where("to_turn < turn").select(*_KEY, F.col("conv_id").alias("to_conv"), "to_turn"))
    few = f"total > 1 and total <= {rare}"
    far = wrote.join(everywhere.where(few).select("h"), "h").select("h", F.col("conv_id").alias("to_conv"), F.col("turn").alias("to_turn"))
    candidates = candidates.unionByName(asked.where(few).select(*_KEY, "h").join(far, "h").where("to_conv <> conv_id").select(*_KEY, "to_conv", "to_turn"))
    candidates = candidates.unionByName(common_sources(asked, wrote, rare))
    # verification of each candidate on all lines of its passage
    hit = candidates.distinct().join(asked.select(*_KEY, "whole", "h", "w"), [*_KEY])
    held = wrote.select(F.col("conv_id").alias("to_conv"), F.col("turn").alias("to_turn"), "h")
    hit = hit.join(held, ["to_conv", "to_turn", "h"], "left_semi").groupBy(*_KEY, "to_conv", "to_turn").agg(F.sum("w").alias("w"), F.max("whole").alias("whole"))
    need = asked.groupBy(*_KEY).agg((F.sum("w") / 2).alias("half"))
    best = F.max(F.struct((F.col("to_conv") == F.col("conv_id")).alias("near"), F.col("whole"), F.round("w", 9).alias("w"), (-F.col("to_conv")).alias("c"), (-F.col("to_turn")).alias("t"))).alias("b")
    return hit.join(need, [*_KEY]).where("w > half").groupBy(*_KEY).agg(best).select(*_KEY, (-F.col("b.c")).alias("to_conv"), (-F.col("b.t")).alias("to_turn"))


def anchors(reply: DataFrame, max_rounds: int = 64) -> DataFrame:
    """conv_id, turn, anchor_conv, anchor_turn: the earliest message reached by following ``reply``'s links to earlier messages; hops double in a round."""
    earlier = "reply_conv < conv_id or (reply_conv = conv_id and linked < turn)"  # ids order the messages, so links can't run in a circle
    hops = written(reply.where(earlier).select("conv_id", "turn", F.col("reply_conv").alias("anchor_conv"), F.col("linked").alias("anchor_turn")), "hops")
    if hops.isEmpty():
        return hops
    for _ in range(max_rounds):
        to = hops.select(F.col("conv_id").alias("anchor_conv"), F.col("turn").alias("anchor_turn"), F.col("anchor_conv").alias("c"), F.col("anchor_turn").alias("t"))
        after = hops.join(to, ["anchor_conv", "anchor_turn"], "left")
        after = written(after.select("conv_id", "turn", F.coalesce("c", "anchor_conv").alias("anchor_conv"), F.coalesce("t", "anchor_turn").alias("anchor_turn"), F.col("c").isNotNull().alias("moved")), "hops")
        hops = after.drop("moved")
        if after.where("moved").isEmpty():
            return hops
    raise RuntimeError("chains of quotes did not end")


def places(anchored: DataFrame) -> DataFrame:
    """``anchored`` (conv_id, turn, anchor_conv, anchor_turn, each message once) with position, its place in the thread anchor_conv.

    Ranks are taken from a distributed sort: the row's number in its partition, and the thread's rows in earlier partitions.
    So a thread of any size is spread over tasks.
    """
    order = "anchor_conv", "anchor_turn", "conv_id", "turn"
    rows = written(anchored.orderBy(*order).select(*order, F.spark_partition_id().alias("pid"), F.monotonically_increasing_id().alias("row")), "places")
    part = rows.groupBy("anchor_conv", "pid").agg(F.min("row").alias("lo"), F.count("*").alias("n"))
    before = part.select("anchor_conv", F.col("pid").alias("earlier"), F.col("n").alias("rows"))
    part = written(part.join(before, "anchor_conv").where("earlier <= pid").groupBy("anchor_conv", "pid").agg(F.min("lo").alias("lo"), F.sum(F.when(F.col("earlier") < F.col("pid"), F.col("rows")).otherwise(0)).alias("before")), "parts")
    return rows.join(part, ["anchor_conv", "pid"]).select(*order, (F.col("row") - F.col("lo") + F.col("before")).alias("position"))


def conversations(conv: DataFrame) -> DataFrame:
    """One row per message: conv_id, turn, role, reply_conv, reply_turn, thread_conv, anchor_turn, position, n_quotes, n_linked, max_depth, body, formatted.

    A message replies to the message of its first linked passage of depth 1 (deeper ones only if there is none), else to the turn
    before its own (null for turn 0). Its thread and anchor are the conversation and turn of the earliest message reached by following linked quotes
    (its own if it quotes none, or only messages of greater ids); ``position`` is its place in the thread, by anchor, conversation and turn: replies
    follow what they quote, and rows in order of (thread_conv, position) are the built conversations. ``body`` has no quotes.

    Null text counts as empty; rows with a null conv_id or turn are kept, link with nothing and have no place; repeated rows stay repeated and share a
    place; a very long text or run of quotes is parsed in linear time; an empty table gives no rows; other columns are ignored.
    """
    parsed = messages(conv)
    links = written(link(parsed), "links")
    reply = written(links.groupBy("conv_id", "turn").agg(F.min(F.struct("depth", "part", "to_conv", "to_turn")).alias("r"), F.count("*").alias("n_linked")).select("conv_id", "turn", F.col("r.to_conv").alias("reply_conv"), F.col("r.to_turn").alias("linked"), "n_linked"), "reply")
    each = parsed.where("conv_id is not null and turn is not null").select("conv_id", "turn").distinct().join(anchors(reply), ["conv_id", "turn"], "left")
    placed = places(each.select("conv_id", "turn", F.coalesce("anchor_conv", "conv_id").alias("anchor_conv"), F.coalesce("anchor_turn", "turn").alias("anchor_turn")))
    quotes = lambda c: F.filter(c, lambda x: x["d"] > 0)
    body = F.trim(F.regexp_replace(F.array_join(F.transform(F.filter("parts", lambda x: x["d"] == 0), lambda x: x["body"]), "\n"), r"\n{3,}", "\n\n"))
    body = F.when(F.size(quotes("parts")) > 0, F.regexp_replace(F.regexp_replace(body, r"^\s+", ""), r"(?<!\s)\s+$", "")).otherwise(F.col("text"))
    out = parsed.select("conv_id", "turn", "role", body.alias("body"), F.size(quotes("parts")).cast("long").alias("n_quotes"), F.coalesce(F.array_max(F.transform("parts", lambda x: x["d"])), F.lit(0)).alias("max_depth"))
    out = out.join(placed, ["conv_id", "turn"], "left").join(reply, ["conv_id", "turn"], "left")
    before = F.when(F.col("turn") > 0, F.col("turn") - 1)
    return out.select(
        "conv_id", "turn", "role",
        F.when(F.col("linked").isNotNull(), F.col("reply_conv")).when(F.col("turn") > 0, F.col("conv_id")).alias("reply_conv"),
        F.coalesce("linked", before).alias("reply_turn"), F.coalesce("anchor_conv", "conv_id").alias("thread_conv"), F.coalesce("anchor_turn", "turn").alias("anchor_turn"), "position",
        "n_quotes", F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), "max_depth", "body",
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), "body", F.lit("\n<|end|>\n")).alias("formatted"),
    )


def op7_chat_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations(table(spark, sf_dir, "conversations"))
