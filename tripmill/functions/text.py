"""Portuguese name casing, driver labels and label wrapping."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words that stay lower case unless they open a name, the name of an unnamed
# driver, and the label length before wrapping.
PARTICLES = ("da", "de", "do", "das", "dos", "e", "di", "du", "del", "van", "von", "d")
UNNAMED_DRIVER = "não definido"
LABEL_WIDTH = 25

# Every Unicode blank, with the four ASCII separators that the regex class leaves out.
BLANK = r"(?U)[\s\x1c-\x1f]"


def fill_text(value: Column) -> Column:
    """Value as text, blank for null."""
    return F.coalesce(value.cast("string"), F.lit(""))


def dash_if_blank(value: Column) -> Column:
    return F.when(value != "", value).otherwise("-")


def strip(value: Column) -> Column:
    """Text without blanks at either end."""
    return F.regexp_replace(value, rf"{BLANK}+$|^{BLANK}+", "")


def words(value: Column) -> Column:
    """The blank-separated words of a text."""
    pieces = F.split(F.regexp_replace(value, rf"{BLANK}+", " "), " ")
    return F.filter(pieces, lambda w: w != "")


def _upper_first(part: Column) -> Column:
    return F.concat(F.upper(F.substring(part, 1, 1)), part.substr(F.lit(2), F.length(part)))


def _upper_after_d(part: Column) -> Column:
    """``d'ávila`` to ``d'Ávila``; other parts as usual."""
    elided = F.concat(
        F.lit("d'"),
        F.upper(F.substring(part, 3, 1)),
        part.substr(F.lit(4), F.length(part)),
    )
    return F.when(part.startswith("d'") & (F.length(part) > 2), elided).otherwise(
        _upper_first(part)
    )


def _cased(value: Column, part_case: Callable[[Column], Column]) -> Column:
    def word_case(word: Column, position: Column) -> Column:
        parts = F.transform(F.split(word, "-"), part_case)
        keep_lower = (position > 0) & word.isin(*PARTICLES)
        return F.when(keep_lower, word).otherwise(F.array_join(parts, "-"))

    lowered = words(F.lower(fill_text(value)))
    return F.array_join(F.transform(lowered, word_case), " ")


def titlecase(value: Column) -> Column:
    """Portuguese title case of a name; blank for null."""
    return _cased(value, _upper_after_d)


def titlecase_card(value: Column) -> Column:
    """Title case as printed on KPI cards, where ``d'ávila`` becomes ``D'ávila``."""
    return _cased(value, _upper_first)


def driver_label_table(driver: Column) -> Column:
    """Driver label of the display table, which groups by it.

    Only null and the empty text count as unnamed; a blank-only name ends up as an empty label.
    """
    name = fill_text(driver)
    return titlecase(F.when(name == "", UNNAMED_DRIVER).otherwise(name))


def driver_label_series(driver: Column) -> Column:
    """Driver label of the chart, put on after grouping; any blank name counts as unnamed.

    The name is cased twice: a capital of two letters (of a sharp s) changes once more.
    """
    name = fill_text(driver)
    return titlecase(titlecase(F.when(strip(name) == "", UNNAMED_DRIVER).otherwise(name)))


def wrap_label(label: Column, width: int = LABEL_WIDTH) -> Column:
    """Break a label longer than ``width`` into two lines, or shorten a single word.

    Line one takes every word that still fits, in order, also after one that did not fit. The fold
    carries the positions taken (at most ``width`` of them), so its cost is linear in the words.
    """
    start = F.struct(
        F.lit(-1).alias("used"), F.array().cast("array<int>").alias("taken"), F.lit(0).alias("at")
    )

    def step(state: Column, word: Column) -> Column:
        reach = state["used"] + 1 + F.length(word)
        fits = reach <= width
        return F.struct(
            F.when(fits, reach).otherwise(state["used"]).alias("used"),
            F.when(fits, F.array_append(state["taken"], state["at"]))
            .otherwise(state["taken"])
            .alias("taken"),
            (state["at"] + 1).alias("at"),
        )

    def broken(every: Column) -> Column:
        def two_lines(state: Column) -> Column:
            # Built in the fold's last step, where the positions are a bound value; outside it they
            # would be folded anew for every word.
            first = F.filter(every, lambda _, i: F.array_contains(state["taken"], i))
            second = F.filter(every, lambda _, i: ~F.array_contains(state["taken"], i))
            return F.concat(F.array_join(first, " "), F.lit("\n"), F.array_join(second, " "))

        shortened = F.concat(F.substring(label, 1, width - 3), F.lit("..."))
        return F.when(F.size(every) > 1, F.aggregate(every, start, step, two_lines)).otherwise(shortened)

    # The words are split once, as the bound value of a list of one.
    long = F.transform(F.array(words(label)), broken)[0]
    return F.when(F.length(label) <= width, label).otherwise(long)
