"""Benchmark decontamination by canonical templates, in DataFrame operations only.

A text's tokens are its runs of letters, marks and digits, in lower case. It has up to three forms of the same
tokens: its own, one with typed placeholders for numbers and for units behind numbers, and one with names
(capitalised words within a sentence) as placeholders, too. So a question with other numbers, units or names
has the same template, and a copy in other case or with other line breaks has the same numbers' template.

Every window of ``WINDOW`` tokens of every document, in each form, is joined by its hash with the windows of the
benchmark. A window of the item agrees if the document has its own tokens somewhere, or its template with
consistent slots: at a place of the document, one value of the item always stands against one value of the
document. Windows travel with their own few tokens, so no text is moved or read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

WINDOW = 5
#: An item is found if so many of its windows agree, or this share of them.
MIN_WINDOWS, MIN_SHARE = 9, 0.8
#: Items of fewer tokens say too little without their own values: they are found by their own tokens only.
MIN_TOKENS = 2 * WINDOW - 1
#: Benchmark keys are broadcast up to this number (some 24 bytes each), and shuffled beyond it.
BROADCAST_WINDOWS = 500_000

#: Placeholders; none of them can stand in a token otherwise. A unit's is its number's and this letter.
NUMBER, UNIT, NAME = "#", "#u", "\ue000"

#: Fixed list of units, longest first where one begins another.
UNITS = ("kilometers", "kilometres", "kilograms", "centimeters", "meters", "metres", "grams", "liters", "litres", "miles", "pounds", "dollars", "euros", "percent", "degrees", "hours", "minutes", "seconds", "days", "weeks", "months", "years", "inches", "feet", "km", "kg", "cm", "mm", "mg", "ml", "lb", "oz", "ft", "mph", "kmh", "min", "hr", "gb", "mb", "kb", "m", "g", "l", "s", "h")

_SLOT = f"[{NUMBER}{NAME}]"
_NAME = r"\p{Lu}(?<=[\p{Ll}\p{N},;:] .)\p{Ll}++(?![\p{L}\p{N}\p{M}])"
#: What tells documents and items apart; ids may be missing or repeated.
_DOC, _ITEM = ["doc_id", "s1", "s2"], ["item_id", "form"]


def _plain(text: Column) -> Column:
    """The lower-case tokens with one blank between two."""
    return F.trim(F.regexp_replace(F.lower(text), rf"[^\p{{L}}\p{{N}}\p{{M}}{NAME}]+", " "))


def _typed(plain: Column) -> Column:
    """Numbers and units behind them as placeholders."""
    units = F.regexp_replace(plain, rf"\p{{N}}++(?<gap> ?)(?:{'|'.join(UNITS)})(?![^ ])", f"{NUMBER}${{gap}}{UNIT}")
    return F.regexp_replace(units, r"\p{N}++", NUMBER)


def with_forms(rows: DataFrame) -> DataFrame:
    """``rows`` with ``text`` replaced by ``forms``: two or three token arrays of one length, the text's own first.

    A form that can't differ from the one before it is left out. A text without a token has one empty token.
    """
    own = rows.withColumn("text", F.translate("text", NAME, " ")).withColumn("plain", _plain(F.col("text")))
    own = own.withColumn("named", F.when(F.col("text").rlike(_NAME), _plain(F.regexp_replace("text", _NAME, NAME)))).drop("text")
    numbers = F.col("plain").rlike(r"\p{N}")
    raw, typed, named = (F.split(c, " ", -1) for c in (F.col("plain"), _typed(F.col("plain")), _typed(F.col("named"))))
    forms = F.when(numbers & F.col("named").isNotNull(), F.array(raw, typed, named)).when(numbers, F.array(raw, typed)).when(F.col("named").isNotNull(), F.array(raw, named)).otherwise(F.array(raw))
    return own.withColumn("forms", forms).drop("plain", "named")


def windows(rows: DataFrame) -> DataFrame:
    """A row for each form and window: ``kind`` (0 for the text's own tokens), ``at``, ``key``; forms stays.

    A text of fewer than ``WINDOW`` tokens has one window, all of it, which no longer text has.
    """
    counted = rows.withColumn("n_windows", F.greatest(F.size(F.get("forms", F.lit(0))) - (WINDOW - 1), F.lit(1)))
    each = counted.select("*", F.explode(F.sequence(F.lit(0), F.size("forms") * F.col("n_windows") - 1)).alias("nth"))
    each = each.select("*", F.floor(F.col("nth") / F.col("n_windows")).cast("int").alias("kind"), (F.col("nth") % F.col("n_windows")).alias("at")).drop("nth")
    key = lambda form: F.xxhash64(*(F.get(F.get("forms", form), F.col("at") + k) for k in range(WINDOW)))
    # A window without a value is the same in each form.
    return each.select("*", key(F.col("kind")).alias("key")).where((F.col("kind") == 0) | (F.col("key") != key(F.lit(0))))


def _cut(form: Column) -> Column:
    return F.slice(F.get("forms", form), F.col("at") + 1, WINDOW)


def item_windows(benchmark: DataFrame, id_col: str, text_col: str, min_windows: int, min_share: float) -> DataFrame:
    """The windows that items are looked for by, with their own tokens and their template.

    Templates count where they have a token that is no placeholder and stand once in the item; a table of
    numbers is thus known by its numbers. ``seed`` marks the rarest windows of an item, so many that a
    document without any of them can't have enough of the others.
    """
    own = benchmark.select(F.col(f"`{id_col}`").alias("item_id"), F.col(f"`{text_col}`").alias("text")).where("item_id is not null and text is not null").distinct()
    own = with_forms(own.withColumn("form", F.xxhash64("text"))).where(F.get(F.get("forms", F.lit(0)), F.lit(0)) != "")
    each = windows(own).select(*_ITEM, "n_windows", "kind", F.col("at").alias("w"), "key", _cut(F.lit(0)).alias("own"), _cut(F.col("kind")).alias("template"))
    once = F.count("*").over(Window.partitionBy(*_ITEM, "kind", "key")) == 1
    word = F.exists("template", lambda x: ~x.rlike(_SLOT))
    each = each.withColumn("once", once).where((F.col("kind") == 0) | (word & F.col("once") & (F.col("n_windows") > MIN_TOKENS - WINDOW))).drop("once")
    each = common.cut(each)
    spread = each.select(*_ITEM, "key").distinct().groupBy("key").agg(F.count("*").alias("n_items"))
    rare = each.join(spread, "key").groupBy(*_ITEM, "n_windows", "w").agg(F.max("n_items").alias("n_items"))
    need = F.least(F.lit(min_windows), F.ceil(F.col("n_windows") * min_share - 1e-9))
    rank = F.row_number().over(Window.partitionBy(*_ITEM).orderBy("n_items", "w"))
    seeds = rare.select(*_ITEM, "w", (rank <= F.col("n_windows") - need + 1).alias("seed"))
    return common.cut(each.join(seeds, [*_ITEM, "w"]))


def found_rows(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, min_windows: int, min_share: float) -> DataFrame:
    """doc_id, s1 and s2 (hashes of the text), item_id, n_windows, item_windows, n_slots: one row per text and item found in it."""
    items = item_windows(benchmark, id_col, text_col, min_windows, min_share)
    keys = items.select("key").distinct()
    if keys.count() <= BROADCAST_WINDOWS:
        keys = F.broadcast(keys)
    texts = common.own_columns(docs, "doc_id", "text").where("text is not null").select("doc_id", *text_hashes(F.col("text")), "text")
    hits = windows(with_forms(texts)).join(keys, "key", "left_semi").select(*_DOC, "key", "kind", "at", _cut(F.lit(0)).alias("tokens"))
    # The text's own tokens need no place.
    value = lambda c: F.when(F.col("kind") > 0, F.col(c)).alias(c)
    hits = common.written(hits.select(*_DOC, "key", (F.col("kind") > 0).alias("typed"), value("at"), value("tokens")).distinct(), "windows")

    same_doc = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _DOC]
    wanted = items.select(*_ITEM, "n_windows", "w", F.col("key").alias("_key"), (F.col("kind") > 0).alias("_typed"), "own", "template", "seed")
    matched = (F.col("key") == F.col("_key")) & (F.col("typed") == F.col("_typed"))
    columns = [*_DOC, *_ITEM, "n_windows", "w", "typed", "at", "tokens", "own", "template"]
    first = common.written(hits.join(wanted.where("seed"), matched).select(*columns), "seeds")
    likely = first.select(*(F.col(c).alias(f"_{c}") for c in _DOC), *_ITEM).distinct()
    others = likely.join(wanted.where("not seed"), _ITEM)
    agreed = first.unionByName(hits.join(others, [matched, *same_doc]).select(*columns))

    slots = F.filter(F.arrays_zip("own", "tokens", "template"), lambda x: x["template"].rlike(_SLOT))
    place = [*_DOC, *_ITEM, "shift"]
    typed = agreed.where("typed").select(*_DOC, *_ITEM, "n_windows", "w", (F.col("at") - F.col("w")).alias("shift"), F.explode(slots).alias("slot"))
    typed = typed.select(*place, "n_windows", "w", F.col("slot.own").alias("own"), F.col("slot.tokens").alias("other")).distinct().repartition(*place)
    over = Window.partitionBy(*place, "own")
    typed = typed.withColumn("one", F.min("other").over(over) == F.max("other").over(over)).withColumn("fits", F.bool_and("one").over(Window.partitionBy(*place, "w"))).where("fits")
    typed = typed.withColumn("n_slots", F.size(F.collect_set("own").over(Window.partitionBy(*place))))
    both = agreed.where("not typed").select(*_DOC, *_ITEM, "n_windows", "w", F.lit(0).alias("n_slots")).unionByName(typed.select(*_DOC, *_ITEM, "n_windows", "w", "n_slots"))
    each = both.groupBy(*_DOC, *_ITEM, "n_windows", "w").agg(F.max("n_slots").alias("n_slots"))
    total = each.groupBy(*_DOC, *_ITEM, F.col("n_windows").cast("long").alias("item_windows")).agg(F.count("*").alias("n_windows"), F.max("n_slots").cast("long").alias("n_slots"))
    return total.where((F.col("n_windows") >= min_windows) | (F.col("n_windows") / F.col("item_windows") >= min_share)).drop("form")


def text_hashes(text: Column) -> tuple[Column, Column]:
    """s1 and s2, which together with the id tell texts apart."""
    return F.xxhash64(text).alias("s1"), F.xxhash64(F.lit(1), text).alias("s2")


def contaminated(docs: DataFrame, benchmark: DataFrame, min_windows: int = MIN_WINDOWS, min_share: float = MIN_SHARE, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, n_windows, item_windows, share, n_slots.

    n_windows counts the item's windows that agree with the document at one place or another, item_windows
    all of the item's; n_slots is the most of the item's values that have a stand-in at one place. An item of
    fewer than ``MIN_TOKENS`` tokens is found by its own words and numbers only, one of fewer than ``WINDOW``
    only if it is the whole document. Null and empty texts and items hold nothing. Each row of ``docs`` is
    searched by itself, rows of null doc_id too; of the rows of one doc_id, and of the texts of one item_id,
    the pair of the highest share counts (then of the most windows). Repeated rows count once. An empty table
    on either side gives an empty result. Other columns are ignored. Texts of any length are searched whole.
    """
    rows = found_rows(docs, benchmark, id_col, text_col, min_windows, min_share)
    best = rows.groupBy("doc_id", "item_id").agg(F.max(F.struct((F.col("n_windows") / F.col("item_windows")).alias("share"), "n_windows", "item_windows", "n_slots")).alias("best"))
    return best.select("doc_id", "item_id", "best.n_windows", "best.item_windows", "best.share", "best.n_slots")


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, in which no item is found; rows of one id are judged one by one."""
    bad = found_rows(docs, benchmark, "item_id", "text", MIN_WINDOWS, MIN_SHARE).select(*(F.col(c).alias(f"__loom_{c}") for c in _DOC)).distinct()
    s1, s2 = text_hashes(docs["text"])
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col("__loom_doc_id")) & (s1 == F.col("__loom_s1")) & (s2 == F.col("__loom_s2")), "left_anti")
