"""Chat formatting by quotation linking.

Every message is parsed into lines with a quote level (the ``>`` marks in front). Runs of
lines of one level are quoted passages; a line that only announces a quotation (``... wrote:``)
goes with it. Passages and their lines are normalised (lower case, marks and white space as
single spaces) and hashed, as are each message's own text and lines. An equal hash within the
conversation links a passage to the latest earlier message that says it. A message answers
the message that its outermost linked quotation comes from, with most characters quoted; a
message without one begins a thread. ``order_key`` sorts a conversation by replies: every
message stands behind the one it answers, threads and answers by turn.

DataFrame functions only. Look-ups "latest before" run within ranges of turns and carry the
last value over from earlier ranges, so a conversation or a line with very many rows is many
small groups; no conversation is gathered into one row.

Defined results: null text is empty; a row with a null conv_id or turn has no links and a null
order_key; rows repeated under one (conv_id, turn) are one message with their quotations pooled
and come back as often as they are given; further columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._spark import checkpoint, fenced

#: Turns in one range of a "latest before" look-up.
RANGE = 1000
#: Line endings that announce a quotation.
ANNOUNCES = r"(?i)\b(?:wrote|writes|said|schrieb|écrit|escribió)\s*:\s*$"


def parse(messages: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds own (lines of level 0), passages (array of level and lines), levels."""
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\r?\n", -1)
    mark = lambda line: F.regexp_extract(line, r"^[ \t>]*>", 0)
    parsed = F.transform(lines, lambda line: F.struct(
        F.length(F.regexp_replace(mark(line), r"[ \t]", "")).alias("level"),
        F.substr(line, F.length(mark(line)) + 1).alias("body")))
    plain = F.transform(lines, lambda line: F.struct(F.lit(0).alias("level"), line.alias("body")))
    marked = F.contains(F.coalesce(F.col(text_col), F.lit("")), F.lit(">"))
    out = messages.withColumn("__lines", fenced(F.when(marked, parsed).otherwise(plain)))
    level = lambda i: F.coalesce(F.get(F.col("__lines"), i)["level"], F.lit(0))
    n = F.size("__lines")
    # an announcing line directly before a quotation belongs to it
    own = F.filter("__lines", lambda x, i: (x["level"] == 0) & ~((level(i + 1) > 0) & x["body"].rlike(ANNOUNCES)))
    heads = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (level(i) != level(i - 1)))
    runs = F.transform("__heads", lambda at, k: F.struct(
        level(at).alias("level"),
        F.transform(F.slice("__lines", at + 1, F.coalesce(F.get("__heads", k + 1), n) - at), lambda x: x["body"]).alias("lines")))
    return (out.withColumns({"own": fenced(F.transform(own, lambda x: x["body"])), "__heads": fenced(heads),
                             "levels": F.array_max(F.transform("__lines", lambda x: x["level"]))})
            .withColumn("passages", fenced(F.filter(runs, lambda r: r["level"] > 0)))
            .drop("__heads", "__lines"))


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[\s\p{Punct}]+", " "))


def _units(lines: Column) -> Column:
    """The whole of some lines and each line: array of (hash, characters), without empty ones."""
    whole = F.array(F.array_join(lines, " "))
    texts = F.filter(F.transform(F.array_distinct(F.concat(whole, lines)), normalised), lambda t: t != "")
    return F.transform(F.array_distinct(texts), lambda t: F.struct(F.xxhash64(t).alias("hash"), F.length(t).alias("chars")))


def latest_before(asked: DataFrame, given: DataFrame, keys: list[str], order: str = "turn", width: int = RANGE) -> DataFrame:
    """``asked`` rows with ``found``: the greatest ``order`` of ``given`` before theirs, by key.

    Both sides hold distinct (keys, order)."""
    span = lambda df: df.withColumn("__range", F.floor(F.col(order) / width))
    asked, given = span(asked), span(given)
    last = given.groupBy(*keys, "__range").agg(F.max(order).alias("__last"))
    wanted = asked.select(*keys, "__range").distinct()
    earlier = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    carried = (last.select(*keys, "__range", "__last").unionByName(wanted.withColumn("__last", F.lit(None).cast("bigint")))
               .groupBy(*keys, "__range").agg(F.max("__last").alias("__last"))
               .select(*keys, "__range", F.max("__last").over(earlier).alias("__carried")))
    before = Window.partitionBy(*keys, "__range").orderBy(order, F.desc("__asks")).rowsBetween(Window.unboundedPreceding, -1)
    events = (given.select(*keys, "__range", order, F.lit(False).alias("__asks"))
              .unionByName(asked.select(*keys, "__range", order, F.lit(True).alias("__asks"))))
    seen = (events.withColumn("__near", F.max(F.when(~F.col("__asks"), F.col(order))).over(before)).filter("__asks")
            .select(*keys, "__range", order, "__near"))
    return (seen.join(carried, [*keys, "__range"], "left")
            .select(*keys, order, F.coalesce("__near", "__carried").alias("found")).filter("found is not null"))


def link_quotations(parsed: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to, linked_passages) of messages with a linked quotation."""
    known = parsed.filter("conv_id is not null and turn is not null").select("conv_id", "turn", "own", "passages")
    quoted = (known.select("conv_id", "turn", F.posexplode("passages").alias("passage", "p"))
              .select("conv_id", "turn", "passage", F.col("p.level").alias("level"), F.explode(_units(F.col("p.lines"))).alias("u"))
              .select("conv_id", "turn", "passage", "level", "u.hash", "u.chars"))
    said = (known.select("conv_id", "turn", F.explode(_units(F.col("own"))).alias("u"))
            .select("conv_id", "turn", "u.hash").distinct())
    asked = quoted.select("conv_id", "hash", "turn").distinct()
    hits = latest_before(asked, said.select("conv_id", "hash", "turn"), ["conv_id", "hash"])
    votes = (quoted.join(hits, ["conv_id", "hash", "turn"])
             .groupBy("conv_id", "turn", "level", F.col("found").alias("original"))
             .agg(F.sum("chars").alias("chars"), F.countDistinct("passage").alias("passages")))
    best = F.max_by("original", F.struct(-F.col("level"), F.col("chars"), F.col("original")))
    return votes.groupBy("conv_id", "turn").agg(best.alias("reply_to"), F.sum("passages").alias("linked_passages"))


def reply_paths(links: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(conv_id, turn, path): turns from a thread's first message down to this one, by
    doubling, for messages that answer another."""
    state = checkpoint(links.select("conv_id", "turn", F.col("reply_to").alias("top"), F.array("reply_to", "turn").alias("path")))
    for _ in range(max_rounds):
        above = state.select("conv_id", F.col("turn").alias("top"), F.col("top").alias("higher"), F.col("path").alias("upper"))
        joined = state.join(above, ["conv_id", "top"], "left")
        if joined.filter("higher is not null").isEmpty():
            return state.select("conv_id", "turn", "path")
        state = checkpoint(joined.select("conv_id", "turn", F.coalesce("higher", "top").alias("top"), F.when(
            F.col("higher").isNotNull(), F.concat("upper", F.slice("path", 2, F.size("path")))).otherwise(F.col("path")).alias("path")))
    raise RuntimeError(f"reply chains are longer than 2 ** {max_rounds}")


def format_conversations(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text without quotations, reply_to, depth, quote_levels,
    quoted_passages, linked_passages, order_key, formatted."""
    rows = messages.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text")
    parsed = parse(rows)
    links = checkpoint(link_quotations(parsed))
    paths = reply_paths(links).withColumnRenamed("path", "__path")
    found = links.join(paths, ["conv_id", "turn"])
    padded = F.array_join(F.transform(F.coalesce("__path", F.array("turn")), lambda t: F.lpad(t.cast("string"), 19, "0")), ".")
    placed = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    text = F.trim(F.array_join("own", "\n"), F.lit("\n"))
    return (parsed.join(found, ["conv_id", "turn"], "left")
            .select("conv_id", "turn", "role", text.alias("text"), "reply_to",
                    F.when(F.col("__path").isNull(), 0).otherwise(F.size("__path") - 1).alias("depth"),
                    F.coalesce("levels", F.lit(0)).alias("quote_levels"), F.size("passages").alias("quoted_passages"),
                    F.coalesce("linked_passages", F.lit(0)).alias("linked_passages"),
                    F.when(placed, padded).alias("order_key"),
                    F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), text).alias("formatted")))
