"""Line dedup by a fixed-depth template tree, in DataFrame operations only.

A line's tokens are what single spaces separate; tokens with a digit are variable fields at once (``<*>``). A
line goes to the leaf of its token count and its first ``DEPTH`` tokens. A leaf's different lines are one group at
first. In a group, a position is constant if one token has ``SIMILARITY`` percent of the group's documents there.
If so many percent of the positions are constant, the group has a template, whose other positions are variable: the
lines that agree with so many percent of the constants are its members, the rest make a new group. Any other group
is split at one position, that of the commonest token, not a constant one if possible (the first of several): lines
with a token there that ``MIN_DOCS`` documents or more have make a group for each such token, the rest make one
more; and so on with these groups. Groups that can't get a template so are given up: their lines are templates of
their own. A template found in ``MIN_DOCS`` documents or more is dropped from all of them but the first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

DEPTH, SIMILARITY, MIN_DOCS = 2, 70, 10
#: Tables of lines or groups are broadcast up to so many rows (some 100 bytes each), and shuffled beyond it.
BROADCAST_ROWS = 200_000
#: So many common places of a group travel with each of its lines at most.
PLACES = 1000


def masked(text: Column) -> Column:
    """The text with each token that has a digit as ``<*>``."""
    return F.when(text.rlike(r"\p{N}"), F.regexp_replace(text, r"(?<![^ \n])[^ \n\p{N}]*+\p{N}[^ \n]*+", "<*>")).otherwise(text)


def _lines(text: Column) -> Column:
    """The lines of a text, trimmed and with variable fields masked, as an array."""
    return F.transform(F.split(masked(text), "\n", -1), lambda x: F.trim(x))


def _leaf(line: Column, depth: int) -> Column:
    tokens = F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit("")))
    return F.xxhash64(tokens, F.substring_index(line, " ", depth))


def _key(line: Column) -> Column:
    """What a line is known by, in 16 bytes; null for a blank line, which is no line at all."""
    return F.when(line != "", F.unhex(F.md5(line)))


def line_table(docs: DataFrame, depth: int) -> DataFrame:
    """A row for each document (doc_id) and different line: leaf and key."""
    own = common.own_columns(docs, "doc_id", "text").where("text is not null").select("doc_id", F.explode(_lines(F.col("text"))).alias("line")).where("line <> ''")
    return own.select("doc_id", _leaf(F.col("line"), depth).alias("leaf"), _key(F.col("line")).alias("key")).distinct()


def _sieve(rows: DataFrame, chosen: DataFrame, n: int) -> DataFrame:
    """The rows whose (key, doc_id) may be a (_key, first) of the n chosen: all that are, and a sixteenth of the others at most.

    A hash of both is looked up in a broadcast bit field of 16 to 32 bits a chosen row, in pieces of 64 longs.
    """
    bits = 1 << (16 * n - 1).bit_length()
    slot = lambda *of: F.xxhash64(*of).bitwiseAND(F.lit(bits - 1))
    words = chosen.select(slot("_key", "first").alias("slot")).groupBy(F.expr("slot div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(slot % 64 as int)))").alias("bits"))
    pieces = words.groupBy(F.expr("word div 64").alias("_piece")).agg(F.map_from_entries(F.collect_list(F.struct((F.col("word") % 64).cast("int").alias("at"), "bits"))).alias("some"))
    pieces = common.cut(pieces.select("_piece", F.expr("transform(sequence(0, 63), x -> coalesce(try_element_at(some, x), 0L))").alias("field")))
    rows = rows.withColumn("slot", slot("key", "doc_id")).join(F.broadcast(pieces), F.expr("slot div 4096") == F.col("_piece"))
    return rows.where("getbit(get(field, cast((slot div 64) % 64 as int)), cast(slot % 64 as int)) = 1").drop("slot", "_piece", "field")


def _texts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """group, key, n, total and tokens of the chosen lines. Each is read from one document, so a line that many have stays one row."""
    chosen = common.cut(chosen.select(F.col("key").alias("_key"), F.col("leaf").alias("group"), "n", "first", "total"))
    own = common.own_columns(docs, "doc_id", "text").where("text is not null").select("doc_id", F.explode(_lines(F.col("text"))).alias("line")).where("line <> ''").withColumn("key", _key(F.col("line")))
    if (n := chosen.count()) > BROADCAST_ROWS:
        own = _sieve(own, chosen, n)
    else:
        chosen = F.broadcast(chosen)
    found = own.join(chosen, (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("first")))
    return found.groupBy("group", "key").agg(F.first("n").alias("n"), F.first("total").alias("total"), F.min("line").alias("line")).select("group", "key", "n", "total", F.split("line", " ").alias("tokens"))


def templates(docs: DataFrame, lines: DataFrame, similarity: int, min_docs: int) -> DataFrame:
    """key and group of each line that is a member of a template.

    Each round judges all open groups at once: one with a template loses members (the constants' shares make sure
    that there is one), one without is split, so there are as many rounds as the deepest chain of these.

    A place is a token at a position. Only places with the similarity's share of ``min_docs`` documents can become
    constants. They fill that share, squared, of some line of any group with a template, so a group without such a line is
    given up at once: neither it nor a part of it can get one. Lines are held against the places of the group that they
    were in a round before; if these are more than ``PLACES``, the lines count as such lines unseen.
    """
    counts = common.cut(lines.groupBy("leaf", "key").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")))
    leaves = counts.groupBy("leaf").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).where((F.col("kinds") > 1) & (F.col("total") >= min_docs)).select("leaf", "total")
    lines = common.cut_anew(_texts(docs, counts.join(common.cut(leaves), "leaf")))
    mostly = lambda part, whole: part * 100 >= whole * similarity
    done = []
    while True:
        tokens = lines.select("group", "n", "total", F.size("tokens").alias("size"), F.posexplode("tokens").alias("at", "token"))
        tokens = tokens.groupBy("group", "at", "token").agg(F.sum("n").alias("top"), F.max("total").alias("total"), F.max("size").alias("size")).where(mostly(F.col("top"), F.lit(min_docs)))
        common_here = F.collect_list(F.xxhash64("at", "token")).alias("places")
        places = tokens.groupBy("group", "at").agg(F.max("top").alias("top"), F.max_by("token", "top").alias("token"), F.max("total").alias("total"), F.max("size").alias("size"), F.count("*").alias("n_places"), common_here)
        places = places.withColumn("fixed", mostly(F.col("top"), F.col("total")))
        splits = F.max(F.when((F.col("top") >= min_docs) & (F.col("top") < F.col("total")), F.struct((~F.col("fixed")).alias("loose"), "top", (-F.col("at")).alias("at"))))
        constants = F.collect_list(F.when(F.col("fixed"), F.struct("at", "token")))
        groups = places.groupBy("group").agg(
            F.max("size").alias("size"), F.count_if("fixed").alias("constant"), F.count("*").alias("possible"), splits.alias("split"), constants.alias("template"),
            F.sum("n_places").alias("n_places"), F.flatten(F.collect_list(F.when(F.col("n_places") <= PLACES, F.col("places")))).alias("places"),
        )
        judged = groups.where(mostly(F.col("possible"), F.col("size"))).withColumn("likely", mostly(F.col("constant"), F.col("size")))
        judged = judged.where("likely or split is not null").select(F.col("group").alias("_group"), "likely", "constant", (-F.col("split.at")).alias("split"), F.when(F.col("likely"), F.col("template")).alias("template"), F.when(F.col("n_places") <= PLACES, F.col("places")).alias("places"))
        judged = common.cut(judged)
        agree = F.size(F.filter("template", lambda x: F.get("tokens", x["at"]) == x["token"]))
        own = F.transform("tokens", lambda x, i: F.xxhash64(i, x))
        rich = F.col("places").isNull() | (F.size(F.array_intersect(own, "places")) * 10_000 >= F.size("tokens") * similarity * similarity)
        here = lines.join(judged, F.col("group") == F.col("_group")).withColumn("member", F.col("likely") & mostly(agree, F.col("constant"))).withColumn("rich", rich)
        # The next group is a key of its own: by group and token, Spark would keep the join's partitioning, and couldn't split a hot group.
        here = here.withColumn("next", F.when(~F.col("likely"), F.xxhash64("group", "split", F.get("tokens", F.col("split")))))
        frequent = common.cut(here.where("not likely").groupBy("next").agg(F.sum("n").alias("total")).where(F.col("total") >= min_docs).select(F.col("next").alias("_next")))
        placed = here.join(frequent, F.col("next") == F.col("_next"), "left")
        into = F.when(F.col("member"), F.col("group")).when(F.col("likely"), F.xxhash64("group")).otherwise(F.coalesce("_next", F.xxhash64("group", "split")))
        placed = common.cut_anew(placed.select(into.alias("group"), "key", "n", "tokens", "member", "rich"))
        done.append(placed.where("member").select("key", "group"))
        lines = placed.where("not member").drop("member")
        still = common.cut(lines.groupBy("group").agg(F.sum("n").alias("total"), F.max("rich").alias("rich")).where((F.col("total") >= min_docs) & F.col("rich")).select(F.col("group").alias("_group"), "total"))
        if still.isEmpty():
            break
        lines = lines.join(still, F.col("group") == F.col("_group")).select("group", "key", "n", "total", "tokens")
    return reduce(DataFrame.union, done)


def recurring_lines(docs: DataFrame, depth: int = DEPTH, similarity: int = SIMILARITY, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id and key of each line that is to be dropped."""
    lines = common.cut(line_table(docs, depth))
    shared = common.cut(templates(docs, lines, similarity, min_docs).select(F.col("key").alias("k"), F.unhex(F.lpad(F.hex("group"), 16, "0")).alias("shared")))
    placed = lines.join(shared, F.col("key") == F.col("k"), "left").select("doc_id", "key", F.coalesce("shared", "key").alias("template"))
    placed = common.cut(placed)
    # Stored, so that both sides of the join below come straight from an exchange, whose hot keys can be split.
    found = common.cut(placed.select("template", "doc_id").distinct().groupBy("template").agg(F.count("*").alias("n"), F.min("doc_id").alias("keeper")).where(F.col("n") >= min_docs).select(F.col("template").alias("t"), "keeper"))
    return placed.join(found, F.col("template") == F.col("t")).where(~F.col("doc_id").eqNullSafe(F.col("keeper"))).select("doc_id", "key")


def drop_recurring_lines(docs: DataFrame, depth: int = DEPTH, similarity: int = SIMILARITY, min_docs: int = MIN_DOCS) -> DataFrame:
    """All columns and rows of ``docs``, ``text`` without its recurring lines, and n_lines, n_dropped.

    n_lines counts the text's lines that aren't blank, n_dropped those dropped. Blank lines stay, but for a
    text that loses all its other lines, which becomes empty. A null text stays null with no lines. Rows of
    one id (or of none) count as one document; the first is that of the smallest id (none is the smallest).
    Where tokens tie at a position, neither is constant; where positions tie, the first is split at. Columns of ``docs`` called n_lines or n_dropped give way. An
    empty table gives an empty one. Texts and lines of any length are handled whole.
    """
    gone = recurring_lines(docs, depth, similarity, min_docs).groupBy("doc_id").agg(F.collect_set("key").alias("__loom_gone")).withColumnRenamed("doc_id", "__loom_id")
    rest = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_dropped", "__loom_id", "__loom_gone")))
    joined = rest.join(gone, F.col("doc_id").eqNullSafe(F.col("__loom_id")), "left")
    plain = F.split(F.col("text"), "\n", -1)
    pairs = F.arrays_zip(plain.alias("line"), F.transform(_lines(F.col("text")), _key).alias("key"))
    marked = joined.withColumn("__loom_lines", F.when(F.col("__loom_gone").isNotNull(), F.filter(pairs, lambda x: x["key"].isNull() | ~F.array_contains(F.col("__loom_gone"), x["key"]))))
    solid = lambda lines: F.size(F.filter(lines, lambda x: F.trim(x) != ""))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(solid(plain)).cast("long")
    left = F.size(F.filter("__loom_lines", lambda x: x["key"].isNotNull())).cast("long")
    text = F.when(F.col("__loom_lines").isNull(), F.col("text")).when(left == 0, F.lit("")).otherwise(F.array_join(F.col("__loom_lines.line"), "\n"))
    n_dropped = F.when(F.col("__loom_lines").isNull(), F.lit(0)).otherwise(n_lines - left).cast("long")
    return marked.select(*(text.alias(c) if c == "text" else F.col(f"`{c}`") for c in rest.columns), n_lines.alias("n_lines"), n_dropped.alias("n_dropped"))
