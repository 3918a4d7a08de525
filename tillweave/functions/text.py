"""Text cleaning as Column expressions.

Blanks and word characters are meant in the Unicode sense, so the blanks are spelled out here and made plain
spaces by ``translate`` before anything else looks for them.

A CASE that tests a text and returns it evaluates the text twice. Plans that apply a chain of these functions therefore
put the links into columns of their own (see ``staging.clean_product_cells``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillweave.vocabulary import MISSING_TEXT, NAME_SEPARATOR, SYSTEM_GROUP

# The characters that count as blank.
BLANKS = (
    "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_TO_SPACES = (BLANKS.replace(" ", ""), " " * (len(BLANKS) - 1))
_HEATED = ("C_", "C-", "c_", "c-")


def quoted(name: str) -> Column:
    """Column by its literal name, whatever characters the name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def null_if_empty(text: Column) -> Column:
    return F.when(text != "", text)


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(BLANKS))


def squeeze(text: Column) -> Column:
    """Strip, and make every run of blanks one space."""
    return F.trim(F.regexp_replace(F.translate(text, *_TO_SPACES), " {2,}", " "))


def tidy(text: Column) -> Column:
    """STR-10: squeezed text, empty becomes null."""
    return null_if_empty(squeeze(text))


def without_placeholders(text: Column) -> Column:
    return F.when(~text.isin(*MISSING_TEXT), text)


def clean_basic(text: Column) -> Column:
    """STR-1."""
    return without_placeholders(squeeze(text))


def has_heated_mark(squeezed: Column) -> Column:
    return F.coalesce(F.substring(squeezed, 1, 2).isin(*_HEATED), F.lit(False))


def without_heated_mark(squeezed: Column) -> Column:
    """Rest of a squeezed code after one heated mark; null for a placeholder."""
    return (
        F.when(squeezed.isin(*MISSING_TEXT), None)
        .when(has_heated_mark(squeezed), F.ltrim(F.substring(squeezed, 3, 2**31 - 1)))
        .otherwise(squeezed)
    )


def is_heated(code: Column) -> Column:
    """STR-2: the code is marked as a heated sale."""
    return has_heated_mark(strip(code))


def clean_code(code: Column) -> Column:
    """STR-3: cleaned code without one heated mark."""
    return without_placeholders(without_heated_mark(squeeze(code)))


def recipe_or_null(stripped: Column) -> Column:
    return F.when((stripped != "") & (F.upper(stripped) != "NA"), stripped)


def clean_recipe(recipe: Column) -> Column:
    """STR-5."""
    return recipe_or_null(strip(recipe))


def work_key(recipe: Column, report_date: Column, code: Column) -> Column:
    """STR-6: per-recipe key, else per-day key of the code."""
    day = F.coalesce(F.date_format(report_date, "dd_MM_yy"), F.lit("NO_DATE"))
    by_day = F.concat_ws("_", day, F.coalesce(code, F.lit("NO_CODE")))
    return F.when(recipe.isNotNull(), F.concat(F.lit("RECIPE_"), recipe)).otherwise(by_day)


# The format of product codes, in the two functions that follow.
def category_of_code(code: Column) -> Column:
    """``CAT<digits>`` at the start of a code, else empty."""
    return category_of_upper(F.upper(strip(code)))


def category_of_upper(upper: Column) -> Column:
    """The same of a stripped code in upper case. Most codes have no such start, and are not matched."""
    found = F.regexp_extract(upper, r"\A(?:C[_-])?(CAT\p{Nd}+)", 1)
    return F.when(F.contains(upper, F.lit("CAT")), found).when(upper.isNotNull(), "")


def words_of_code(code: Column) -> Column:
    """The words of a code without its ``-X-…-…`` part and digits, joined by underscores."""
    return _words(F.upper(strip(code)), squeeze)


def words_of_upper(upper: Column) -> Column:
    """The same of a squeezed code in upper case, whose blanks are plain spaces."""
    return _words(upper, lambda rest: F.trim(F.regexp_replace(rest, " {2,}", " ")))


def _words(upper: Column, squeezed: Callable[[Column], Column]) -> Column:
    rest = F.when(F.contains(upper, F.lit("-X-")), F.regexp_replace(upper, r"-X-[^-]+-[^-]+", "")).otherwise(upper)
    rest = F.regexp_replace(F.replace(rest, F.lit("-"), F.lit(" ")), r"\p{Nd}+", "")
    return F.replace(squeezed(rest), F.lit(" "), F.lit("_"))


def group_from(category: Column, words: Column) -> Column:
    return F.when(category != "", category).otherwise(null_if_empty(words))


def group_of_code(code: Column) -> Column:
    """STR-7: product group read from a cleaned code."""
    return group_from(category_of_code(code), words_of_code(code))


def is_system(group: Column) -> Column:
    return F.coalesce(group == SYSTEM_GROUP, F.lit(False))


def is_short_name(name: Column, group: Column) -> Column:
    """STR-9: name of at most six characters on a product that is not technical."""
    return F.coalesce(F.length(strip(name)) <= 6, F.lit(False)) & ~is_system(group)


def normalized_name(name: Column) -> Column:
    """STR-11: lower-case words joined by underscores."""
    text = F.regexp_replace(squeeze(F.lower(name)), r"[^\p{L}\p{N}_ ]", "")
    return null_if_empty(F.regexp_replace(F.translate(text, " ", "_"), r"\A_+|_+\z", ""))


def identity_name(name: Column) -> Column:
    """STR-12: form of a name used for exact matching."""
    return tidy(F.lower(name))


def split_names(joined: Column) -> Column:
    """STR-13: names of a joined string, stripped, without empty ones."""
    return F.filter(F.transform(F.split(joined, r"\|"), strip), lambda part: part != "")


def join_names(names: Column) -> Column:
    return F.array_join(names, NAME_SEPARATOR)
