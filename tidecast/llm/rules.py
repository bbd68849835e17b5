"""Quality rules, line first, in DataFrame functions only.

Every line with a word is judged by rules for punctuation (it ends with an end mark, or is cut off
behind one; words do not carry doubled marks), navigation (few words between separators, short calls to click on) and
boilerplate (licences, cookie notices, terms). Lines that fail are removed; a document that loses
more than ``max_lost`` percent of its word characters is rejected. Counts over the whole text come
first and reject on their own: too few words, or too many words in repeated windows.

Repeated windows of three words are found inside the row: windows are hashed with their places,
sorted, and compared with their neighbours, so a text costs n log n and no shuffle of words. All
of this is one pass over the table without any exchange: skew of sources, copies or ids has no
effect, and a row needs memory in proportion to its own text (about 100 bytes a word).

Defined cases: a null text is an empty text; an empty text has no words, fails and is not kept;
blank lines are neither judged nor counted and stay; lines are equal if all their characters are;
fewer than three words have no window; repeated rows and null ids are judged each; columns of
other names are kept by ``clean_lines`` whatever they are called (a column named like one of its
results is replaced); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
SEPARATORS = "|»›•·"
WINDOW = 3

# Marks that end a sentence, marks that are not doubled in prose, phrases of pages.
END_OF_LINE = r"[.!?:;…]['\"”’»)\]]*" + BLANK + r"*\z"
END_INSIDE = r"[.!?…]" + BLANK
DOUBLED = r"[!?#*$%&<>|=~^_]{2,}"
CALLS = (
    "read more",
    "click here",
    "back to top",
    "skip to content",
    "next page",
    "previous page",
    "sign in",
    "log in",
    "sign up",
    "contact us",
    "about us",
    "site map",
)
BOILERPLATE = (
    "all rights reserved",
    "privacy policy",
    "cookie policy",
    "use cookies",
    "uses cookies",
    "terms of use",
    "terms of service",
    "terms and conditions",
    "javascript",
    "lorem ipsum",
    "licensed under",
    "released under the",
    "copyright",
    "©",
    "subscribe to our",
    "powered by",
)


@dataclass(frozen=True)
class Rules:
    """Limits; shares are percentages."""

    min_words: int = 50
    max_repeated: int = 50
    max_lost: int = 30
    max_doubled: int = 20
    least_separators: int = 25
    call_words: int = 8


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def _any(text: Column, parts: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(p) for p in parts])


def has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACE)) != ""


def signs(text: Column) -> dict[str, Column]:
    """What a whole text holds: a text without doubled marks, say, has no line that fails for
    them, so its lines need not be searched."""
    lower = F.lower(text)
    return {
        "doubled": text.rlike(DOUBLED),
        "separators": _any(text, SEPARATORS),
        "calls": _any(lower, CALLS),
        "boilerplate": _any(lower, BOILERPLATE),
    }


def failing_rule(
    line: Column, rules: Rules = Rules(), found: dict[str, Column] | None = None
) -> Column:
    """Name of the first rule that a line fails; null if it passes or is blank. ``found`` are the
    ``signs`` of the whole text, if they are at hand."""
    found = found or dict.fromkeys(("doubled", "separators", "calls", "boilerplate"), F.lit(True))
    words = _count(line, WORD)
    separators = _count(line, f"[{SEPARATORS}]")
    ends = line.endswith(".") | line.rlike(END_OF_LINE) | line.rlike(END_INSIDE)
    return (
        F.when(~has_word(line), F.lit(None).cast("string"))
        .when(~ends, "no_end")
        .when(found["doubled"] & (_count(line, DOUBLED) * 100 > words * rules.max_doubled), "doubled")
        .when(
            found["separators"]
            & (separators > 0)
            & (separators * 100 >= words * rules.least_separators),
            "navigation",
        )
        .when(
            found["calls"] & _any(F.lower(line), CALLS) & (words <= rules.call_words), "navigation"
        )
        .when(found["boilerplate"] & _any(F.lower(line), BOILERPLATE), "boilerplate")
    )


def _windows(words: Column) -> Column:
    """Hash and place of every window of three words."""
    places = F.when(F.size(words) >= WINDOW, F.sequence(F.lit(0), F.size(words) - WINDOW))
    window = lambda i: F.struct(
        F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))).alias("hash"), i.alias("place")
    )
    return F.transform(F.coalesce(places, F.array().cast("array<int>")), window)


def _repeated(windows: Column) -> Column:
    """Places of windows that occur again, in order; ``windows`` are sorted."""
    last = F.size(windows) - 1
    steps = F.when(last >= 1, F.sequence(F.lit(0), last - 1))
    equal = lambda i: F.get(windows, i)["hash"] == F.get(windows, i + 1)["hash"]
    pairs = F.filter(F.coalesce(steps, F.array().cast("array<int>")), equal)
    place = lambda k: F.transform(pairs, lambda i: F.get(windows, i + k)["place"])
    return F.sort_array(F.array_union(place(0), place(1)))


def _covered(places: Column) -> Column:
    """Words covered by windows at these places."""
    own = F.transform(
        places,
        lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(places, i + 1) - p, F.lit(WINDOW))),
    )
    return F.aggregate(own, F.lit(0).cast("long"), lambda total, n: total + n)


#: Columns that ``clean_lines`` adds.
COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_failed_lines",
    "lost_chars",
)


def _fresh(columns: list[str], name: str) -> str:
    while name in columns:
        name += "_"
    return name


def clean_lines(docs: DataFrame, rules: Rules = Rules(), text: str = "text") -> DataFrame:
    """``docs`` with counts of the whole text, ``base_failed``, ``kept`` and ``clean_text``."""
    made = [*COUNTS, "base_failed", "kept", "clean_text"]
    own = [c for c in docs.columns if c not in made]
    raw, words, lines, windows, failed, places, found = (
        _fresh(own, n) for n in ("raw", "words", "lines", "windows", "failed", "places", "found")
    )
    spaced = reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(" ")), SPACE[1:], F.col(raw))
    df = docs.select(*(F.col(f"`{c}`") for c in own), F.coalesce(F.col(text), F.lit("")).alias(raw))
    has = {k: F.col(found)[k] for k in ("doubled", "separators", "calls", "boilerplate")}
    df = df.withColumns(
        {
            words: F.array_remove(F.split(spaced, " "), ""),
            lines: F.filter(F.split(F.col(raw), "\n"), has_word),
            found: F.struct(*(c.alias(k) for k, c in signs(F.col(raw)).items())),
        }
    ).withColumns(
        {
            windows: F.sort_array(_windows(F.col(words))),
            failed: F.filter(F.col(lines), lambda x: failing_rule(x, rules, has).isNotNull()),
        }
    )
    df = df.withColumn(places, _repeated(F.col(windows)))
    df = df.withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "word_chars": F.length(F.array_join(words, "")).cast("long"),
            "n_symbols": _count(F.col(raw), f"[{SYMBOLS}]").cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(F.col(lines)))).cast("long"),
            "n_repeat_words": _covered(F.col(places)),
            "n_lines": F.size(lines).cast("long"),
            "n_failed_lines": F.size(failed).cast("long"),
            "lost_chars": F.length(
                F.regexp_replace(F.array_join(failed, ""), BLANK + "+", "")
            ).cast("long"),
        }
    )
    few = F.col("n_words") < rules.min_words
    repeated = F.col("n_repeat_words") * 100 > F.col("n_words") * rules.max_repeated
    lost = F.col("lost_chars") * 100 > F.col("word_chars") * rules.max_lost
    stays = F.filter(F.split(F.col(raw), "\n"), lambda x: failing_rule(x, rules, has).isNull())
    return df.withColumn("base_failed", few | repeated).select(
        *(F.col(f"`{c}`") for c in own),
        *COUNTS,
        "base_failed",
        (~F.col("base_failed") & ~lost).alias("kept"),
        F.array_join(stays, "\n").alias("clean_text"),
    )
