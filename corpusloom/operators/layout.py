"""Which column is which: one profile aggregate over a frame, then a pure decision on its figures."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import NON_LATIN, has_english_word, has_non_latin, strip

#: Header names, normalised (lower case, letters and digits only).
ID_NAMES = frozenset(("id", "sn", "sno", "serial", "serialno", "index", "idx", "no", "num", "number", "rowid", "row", "sr", "srno", "key", "uid"))
ENGLISH_NAMES = frozenset(("english", "en", "eng", "source", "src", "sourcetext", "englishtext", "englishsentence", "sentence", "text", "sourcesentence", "input", "l1"))
TARGET_NAMES = frozenset(("target", "tgt", "translation", "translate", "translated", "targettext", "targetsentence", "output", "l2", "trg"))
LANGUAGE_NAMES = frozenset(("nepali", "nep", "ne", "hindi", "hi", "bengali", "bangla", "bn", "urdu", "ur", "tamil", "ta", "telugu", "te", "marathi", "mr", "gujarati", "gu", "kannada", "kn", "malayalam", "ml", "punjabi", "pa", "odia", "oriya", "assamese", "as", "sinhala", "si", "maithili", "bhojpuri", "newari", "arabic", "ar", "persian", "farsi", "fa", "hebrew", "he", "chinese", "zh", "mandarin", "japanese", "ja", "korean", "ko", "thai", "th", "vietnamese", "vi", "russian", "ru", "ukrainian", "uk", "greek", "el", "amharic", "am", "swahili", "sw", "french", "fr", "spanish", "es", "portuguese", "pt", "german", "de", "italian", "it", "turkish", "tr", "indonesian", "id2", "malay", "ms", "tagalog", "filipino", "burmese", "my", "khmer", "km", "lao", "lo", "tibetan", "dzongkha", "devanagari"))
ANY_TARGET = TARGET_NAMES | LANGUAGE_NAMES

#: Above the one share a column is the target side, below the other the English side; least
#: lead in English-ness; values sampled; longest id; longest header.
FOREIGN_FROM, LATIN_TO, ENGLISH_LEAD, SAMPLE, LONGEST_ID, LONGEST_HEADER = 0.5, 0.1, 0.25, 500, 32, 60


class DetectionError(ValueError):
    """The layout is ambiguous: refusing is better than pairing the wrong columns."""


@dataclass(frozen=True)
class Profile:
    """What is known of a column: its type's kind, and figures of its first non-blank values."""

    name: str
    is_text: bool
    is_number: bool
    n: int = 0
    non_latin: float = 0.0
    english: float = 0.0
    longest: int = 0
    unique: bool = False

    @property
    def looks_like_id(self) -> bool:
        return self.is_number or (self.n > 0 and self.longest <= LONGEST_ID and self.unique)


def normal(name: object) -> str:
    return re.sub("[^a-z0-9]", "", str(name).lower())


def headerless(names: list[str]) -> bool:
    """Whether the header row is data: no names at all, or one that is prose or in another script.

    A single known alias in the row says it is a header, so a native-script name beside it doesn't count.
    """
    if all(n.startswith(("Unnamed:", "_c")) for n in names):
        return True
    if any(normal(n) in ENGLISH_NAMES | ANY_TARGET | ID_NAMES for n in names):
        return False
    return any(len(n) > LONGEST_HEADER or NON_LATIN.search(n) for n in names)


def sampled(df: DataFrame, columns: list[str], order: str, n: int = SAMPLE) -> DataFrame:
    """column, value: the first ``n`` non-blank values of each column, in the order given.

    The rank window prunes within each task first (a top-n per column), so no task gets a whole column.
    """
    long = df.select(F.col(order).alias("_at"), F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns))).alias("x"))
    values = long.select("_at", "x.column", strip(F.col("x.value")).alias("value")).where("value <> ''")
    return values.withColumn("_n", F.row_number().over(Window.partitionBy("column").orderBy("_at", "value"))).where(F.col("_n") <= n).select("column", "value")


def profile_table(df: DataFrame, columns: list[str], order: str, n: int = SAMPLE) -> DataFrame:
    """One row per column that has a value: n, non_latin, english, longest, distinct."""
    return (
        sampled(df, columns, order, n)
        .groupBy("column")
        .agg(
            F.count("*").alias("n"),
            F.avg(has_non_latin(F.col("value")).cast("double")).alias("non_latin"),
            F.avg(has_english_word(F.col("value")).cast("double")).alias("english"),
            F.max(F.length("value")).cast("long").alias("longest"),
            F.countDistinct("value").alias("distinct_values"),
        )
    )


def profiles(df: DataFrame, order: str) -> list[Profile]:
    """A profile of each column but ``order``, in the frame's order, from one job."""
    fields = [f for f in df.schema.fields if f.name != order]
    got = {r["column"]: r for r in profile_table(df, [f.name for f in fields], order).collect()}
    out = []
    for f in fields:
        number = isinstance(f.dataType, T.NumericType)
        text = not number and not isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType))
        r = got.get(f.name)
        out.append(Profile(f.name, text, number, r.n, r.non_latin, r.english, r.longest, r.distinct_values == r.n) if r else Profile(f.name, text, number))
    return out


def resolve(columns: list[Profile]) -> dict[str, str | None]:
    """The names of the id (or None), English and target columns.

    Headers settle it if they name both sides; what a header says is never overruled. Then script: a column
    mostly in another script is the target, one hardly so the English side. Then, with two candidates left,
    which reads clearly more like English. Then position, if the headers or scripts show that this is a
    parallel file at all. Columns that look like ids are no candidates while two others are left.
    """
    named = lambda names: next((c.name for c in columns if normal(c.name) in names), None)
    id_col, english, target = named(ID_NAMES), named(ENGLISH_NAMES), named(ANY_TARGET)

    def answer(english: str, target: str, id_col: str | None) -> dict[str, str | None]:
        rest = [c for c in columns if c.name not in (english, target)]
        if id_col is None and len(rest) == 1 and rest[0].looks_like_id:
            id_col = rest[0].name
        return {"id": id_col, "english": english, "target": target}

    if english is not None and target is not None and english != target:
        return answer(english, target, id_col)
    texts = [c for c in columns if c.is_text and c.name != id_col]
    # Short sentences are short and unique too: another script or English words tell them from ids.
    prose = [c for c in texts if not c.looks_like_id or c.non_latin > FOREIGN_FROM or c.english >= ENGLISH_LEAD or c.name in (english, target)]
    candidates = prose if len(prose) >= 2 else texts
    foreign, latin = [c for c in candidates if c.non_latin > FOREIGN_FROM], [c for c in candidates if c.non_latin < LATIN_TO]
    by_header = english is not None or target is not None
    if target is not None and english is None:
        english = next((c.name for c in latin if c.name != target), None) if len([c for c in latin if c.name != target]) == 1 or foreign else None
    elif english is not None and target is None:
        target = next((c.name for c in foreign if c.name != english), None)
        others = [c for c in candidates if c.name != english]
        if target is None and len(others) == 1:
            target = others[0].name
    elif len(foreign) == 1 and latin:
        target, english = foreign[0].name, latin[0].name
    if not by_header and (english is None or target is None) and len(candidates) == 2:
        less, more = sorted(candidates, key=lambda c: c.english)
        if more.english - less.english >= ENGLISH_LEAD:
            english, target = more.name, less.name
    if english is not None and target is not None and english != target:
        return answer(english, target, id_col)
    if foreign or by_header:
        rest = [c for c in columns if c.name != id_col]
        if len(rest) == 2:
            first, second = rest
            # A first column in another script is the target, whatever the usual order.
            swap = (first.non_latin > FOREIGN_FROM and second.non_latin < LATIN_TO) or normal(first.name) in ANY_TARGET or normal(second.name) in ENGLISH_NAMES
            return {"id": id_col, "english": (second if swap else first).name, "target": (first if swap else second).name}
        if id_col is None and len(columns) == 3:
            return {"id": columns[0].name, "english": columns[1].name, "target": columns[2].name}
    seen = ", ".join(f"{c.name} (non-Latin {c.non_latin:.0%}, English {c.english:.0%})" for c in columns)
    raise DetectionError(f"can't tell English from its translation among {seen}; name the columns english and target")


def resolve_columns(df: DataFrame, order: str) -> dict[str, str | None]:
    return resolve(profiles(df, order))
