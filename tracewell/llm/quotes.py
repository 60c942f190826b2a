"""Conversations without quotations: quoted passages are linked to the messages that they come from. DataFrame functions only.

A line's quote level is the number of '>' marks at its start (blanks between them don't count). Neighbouring lines of one
level form a passage; its words, in ASCII lower case and joined by single spaces, are hashed. A message's own passages
(level 0), their paragraphs and their lines are what others can quote. A quoted passage is joined by its hash to the first
message of the conversation that has it as own text, by turn, where a passage or paragraph goes before a line; failing that,
by the hashes of its paragraphs, then of its lines, so that quotes may be trimmed or answered line by line (of several, the
latest turn counts). What isn't found so goes to the first message of any conversation; single lines only if the
conversation has nothing of the passage. The message answers the latest turn that it quotes at its lowest level; where that is none of an earlier turn, it starts a thread.
Threads are ordered by pointer doubling over these answers: `thread_turn` is the first message, `depth` the number of
answers in between, and `place` the number of the thread's messages before this one when each is followed by the answers to
it, by turn, and all that answers them; so sorting by conversation, thread_turn and place gives reply order. Places are
ranks in the list of the tour that enters and leaves each message, found by doubling too: a message has a few numbers in
each round, at any length of a chain and any number of answers.

Joins carry one row for each hash (the first message that has it), never the pairs of a group; no window runs over a
conversation, so one that holds a third of all messages is dealt like any other. Answers to one message follow each other
by blocks of turns.

Defined results: null and empty texts have an empty body and quote nothing; passages without a word are neither quoted nor
linked; messages with a null conv_id or turn keep their row and body but are neither linked nor linked to; rows that share
conv_id and turn are answered as one message; repeated rows all stay; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewell.llm.common import stored

SIBLINGS = 4096  # turns of a block
QUOTE = r"^[ \t]*((?:>[ \t]*)+)"


def normal_words(text: Column) -> Column:
    """ASCII lower case, words joined by single spaces."""
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(lowered, r"[\x20\x09-\x0D]+", " "))


def with_passages(messages: DataFrame, runs: str = "runs") -> DataFrame:
    """messages with an array of (level, body) for the runs of lines of one quote level, in order."""
    text = F.coalesce(F.col("text"), F.lit(""))
    level = lambda line: F.length(F.regexp_replace(F.regexp_extract(line, QUOTE, 1), r"[ \t]", "")).cast("int")
    # three steps, so that each array is made once and every lambda only looks it up
    lines = F.when(text.rlike("(?m)" + QUOTE), F.split(text, "\r?\n")).otherwise(F.array(text))
    cut = messages.withColumn("_lines", lines).withColumn("_levels", F.transform("_lines", level))
    new = lambda i: (i == 1) | (F.try_element_at("_levels", F.greatest(i - 1, F.lit(1))) != F.element_at("_levels", i))
    cut = cut.withColumn("_starts", F.filter(F.sequence(F.lit(1), F.size("_lines")), new))

    def run(start: Column, k: Column) -> Column:
        past = F.coalesce(F.get("_starts", k + 1), F.size("_lines") + 1)
        bodies = F.transform(F.slice("_lines", start, past - start), lambda line: F.regexp_replace(line, QUOTE, ""))
        return F.struct(F.element_at("_levels", start).alias("level"), F.array_join(bodies, "\n").alias("body"))

    return cut.withColumn(runs, F.transform("_starts", run)).drop("_lines", "_levels", "_starts")


def hashes(passage: Column) -> Column:
    """Array of (part, hash): of a passage as a whole (part 0), of its paragraphs (1) and of its lines (2)."""
    none = F.array().cast("array<string>")
    parts = [F.array(passage), *(F.when(passage.contains("\n"), F.split(passage, by)).otherwise(none) for by in (r"\n[ \t\r]*\n", "\n"))]

    def hashed(texts: Column, part: int) -> Column:
        kept = F.filter(F.transform(texts, normal_words), lambda p: p != "")
        return F.transform(kept, lambda p: F.struct(F.lit(part).alias("part"), F.xxhash64(p, F.length(p)).alias("hash")))

    return F.array_distinct(F.concat(*(hashed(texts, k) for k, texts in enumerate(parts))))


def answers(messages: DataFrame) -> DataFrame:
    """Each row's conv_id, turn, role, body, quotes, linked, and the turn that it answers (null: none)."""
    runs = with_passages(messages.select("conv_id", "turn", "role", "text"))
    own = F.transform(F.filter("runs", lambda r: r["level"] == 0), lambda r: r["body"])
    quoted = F.filter("runs", lambda r: (r["level"] > 0) & (normal_words(r["body"]) != ""))
    rows = runs.select("conv_id", "turn", "role", F.trim(F.array_join(own, "\n"), F.lit(" \t\n")).alias("body"), own.alias("own"), quoted.alias("quoted"))
    rows = stored(rows.withColumn("message", F.monotonically_increasing_id()), "messages")

    placed = rows.where("conv_id is not null and turn is not null")
    own_hashes = F.transform(F.flatten(F.transform("own", hashes)), lambda h: F.struct((h["part"] == 2).alias("line"), h["hash"].alias("hash")))
    texts = placed.select("conv_id", "turn", F.explode(F.array_distinct(own_hashes)).alias("h")).select("conv_id", "turn", "h.*")
    asked = placed.where(F.size("quoted") > 0).select("message", "conv_id", "turn", F.posexplode("quoted").alias("n", "q"))
    asked = asked.select("message", "conv_id", "turn", "n", F.col("q.level").alias("level"), F.explode(hashes(F.col("q.body"))).alias("h")).select("*", "h.*").drop("h")
    # stored, so that Spark knows its size and only shuffles the hashes of all texts where much is quoted
    wanted = stored(asked.select("hash").distinct(), "quoted-hashes")
    # one row for each quoted hash and conversation, and one for each hash: the first message that has it as a passage, and at all
    texts = texts.join(wanted, "hash", "left_semi")
    here = texts.groupBy("hash", "conv_id").agg(F.min(F.when(~F.col("line"), F.col("turn"))).alias("whole"), F.min("turn").alias("here"))
    first = lambda turn: F.min(F.when(F.col(turn).isNotNull(), F.struct("conv_id", F.col(turn).alias("turn"))))
    anywhere = here.groupBy("hash").agg(F.coalesce(first("whole"), first("here")).alias("anywhere"))
    found = asked.join(here, ["hash", "conv_id"], "left").join(anywhere, "hash", "left")
    as_whole = F.coalesce(F.col("whole") < F.col("turn"), F.lit(False))
    earlier = F.when(as_whole, F.col("whole")).when(F.col("here") < F.col("turn"), F.col("here"))
    rank = 2 * F.col("part") + ((F.col("part") < 2) & ~as_whole).cast("int")
    outside = F.col("whole").isNull() & earlier.isNull() & (F.col("anywhere.conv_id") != F.col("conv_id"))
    found = found.groupBy("message", "n", "level").agg(
        F.max(F.col("here").isNotNull()).alias("known"),
        F.max(F.col("anywhere").isNotNull()).alias("linked"),
        F.min(F.when(earlier.isNotNull(), F.struct(rank.alias("rank"), (-earlier).alias("back")))).alias("near"),
        F.min(F.when(outside, F.struct("part", "anywhere"))).alias("far"),
    )
    found = found.groupBy("message").agg(
        F.count("*").alias("n_quotes"),
        F.count_if("linked").alias("n_linked"),
        F.max(F.when(F.col("near").isNotNull(), F.struct((-F.col("level")).alias("nearness"), (-F.col("near.back")).alias("turn")))).alias("best"),
        F.min(F.when((F.col("far.part") < 2) | ~F.col("known"), F.col("far.anywhere"))).alias("elsewhere"),
    )
    joined = rows.join(found, "message", "left")
    return joined.select("message", "conv_id", "turn", "role", "body", F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), F.col("best.turn").alias("reply_to"), F.col("elsewhere.conv_id").alias("quotes_conv_id"), F.col("elsewhere.turn").alias("quotes_turn"))


def followed(nodes: DataFrame) -> DataFrame:
    """nodes (conv_id, turn, up) with `sibling`, the next turn that answers the same message."""
    blocks = nodes.withColumn("block", F.floor(F.col("turn") / SIBLINGS))
    inside = F.lead("turn").over(Window.partitionBy("conv_id", "up", "block").orderBy("turn"))
    firsts = blocks.groupBy("conv_id", "up", "block").agg(F.min("turn").alias("head"))
    later = firsts.withColumn("next_head", F.lead("head").over(Window.partitionBy("conv_id", "up").orderBy("block"))).drop("head")
    return blocks.withColumn("inside", inside).join(later, ["conv_id", "up", "block"]).select("conv_id", "turn", "up", F.coalesce("inside", "next_head").alias("sibling"))


def places(nodes: DataFrame) -> DataFrame:
    """conv_id, turn and place of all messages of threads but their first ones, from nodes (conv_id, turn, up)."""
    members = stored(followed(nodes), "siblings")
    child = members.groupBy("conv_id", "up").agg(F.min("turn").alias("child")).select("conv_id", F.col("up").alias("turn"), "child")
    heads = child.join(members, ["conv_id", "turn"], "left_anti").select("conv_id", "turn")
    known = members.unionByName(heads, allowMissingColumns=True).join(child, ["conv_id", "turn"], "left")
    # each step of the tour leads from (from_turn, entered or left) to (turn, entering or leaving)
    step = lambda turn, leaving: F.struct(turn.alias("turn"), F.lit(leaving).alias("leaving"))
    own, sibling, above, down = (F.col(c) for c in ("turn", "sibling", "up", "child"))
    entered = known.select("conv_id", step(own, False).alias("before"), F.when(down.isNotNull(), step(down, False)).otherwise(step(own, True)).alias("at"))
    left = known.select("conv_id", step(own, True).alias("before"), F.when(sibling.isNotNull(), step(sibling, False)).when(above.isNotNull(), step(above, True)).alias("at")).where("at is not null")
    tour = entered.unionByName(left).select("conv_id", "at.turn", "at.leaving", F.col("before.turn").alias("to"), F.col("before.leaving").alias("to_leaving"), F.when(F.col("before.leaving"), 0).otherwise(1).cast("long").alias("place"))
    tour = stored(tour, "tour")
    while not tour.where("to is not null").isEmpty():
        # each place points twice as far back as before, and to another one than all others do
        far = tour.select("conv_id", F.col("turn").alias("to"), F.col("leaving").alias("to_leaving"), F.col("to").alias("further"), F.col("to_leaving").alias("further_leaving"), F.col("place").alias("more"))
        jumped = tour.where("to is not null").join(far, ["conv_id", "to", "to_leaving"], "left")
        jumped = jumped.select("conv_id", "turn", "leaving", F.col("further").alias("to"), F.col("further_leaving").alias("to_leaving"), (F.col("place") + F.coalesce("more", F.lit(0))).alias("place"))
        tour = stored(tour.where("to is null").unionByName(jumped), "tour")
    return tour.where("not leaving").select("conv_id", "turn", "place")


def threads(messages: DataFrame) -> DataFrame:
    """Messages without quotations, with what they answer and their place in reply order."""
    rows = stored(answers(messages), "answers")
    # a message of several rows answers the latest turn that any of them answers; pointers only lead to earlier turns
    links = stored(rows.where("reply_to is not null").groupBy("conv_id", "turn").agg(F.max("reply_to").alias("up")), "links")
    nodes = links.withColumn("depth", F.lit(1).cast("long"))
    while True:
        above = nodes.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("further"), F.col("depth").alias("more"))
        jumped = nodes.join(above, ["conv_id", "up"], "left")
        nodes = stored(jumped.select("conv_id", "turn", F.coalesce("further", "up").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("further").isNotNull().alias("moved")), "pointers")
        if nodes.where("moved").isEmpty():
            break
        nodes = nodes.drop("moved")
    placed = rows.join(nodes.select("conv_id", "turn", F.col("up").alias("first"), "depth"), ["conv_id", "turn"], "left").join(places(links), ["conv_id", "turn"], "left")
    none = F.lit(0).cast("long")
    return placed.select("conv_id", "turn", "role", "body", "n_quotes", "n_linked", "reply_to", "quotes_conv_id", "quotes_turn", F.coalesce("first", "turn").cast("long").alias("thread_turn"), F.coalesce("depth", none).alias("depth"), F.coalesce("place", none).alias("place"))


def conversations(messages: DataFrame) -> DataFrame:
    """threads() in reply order: sorted by conversation, thread and place."""
    return threads(messages).orderBy(F.col("conv_id").asc_nulls_first(), "thread_turn", "place", "role", "body")
