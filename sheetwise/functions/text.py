"""Cell text and number expressions. All take and return Columns; nulls count as empty cells unless said otherwise."""

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a float literal may look like once blanks are stripped; underscores only between digits.
FLOAT = r"^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$"

#: What most of them look like.
PLAIN = r"^-?\d+(\.\d+)?$"

#: Words of printable ASCII between single blanks.
CLEAN = r"^[!-~]++( [!-~]++)*+\z"


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def clean_cell(c: Column) -> Column:
    """Null becomes empty; white space runs become one blank, none at the ends. What is clean already is seen at a glance."""
    return F.when(c.rlike(CLEAN), c).otherwise(strip(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " ")))


def normal_text(c: Column) -> Column:
    """Lower case, single blanks, without .,;:!? (blanks that these leave behind stay)."""
    return F.regexp_replace(F.regexp_replace(F.lower(strip(F.coalesce(c, F.lit("")))), r"(?U)\s+", " "), r"[.,;:!?]", "")


def number_in(c: Column) -> Column:
    """The number that digits, signs, dots and e/E of a cell spell, or null."""
    return F.regexp_replace(c, r"[^\d.\-+eE]", "").try_cast("double")


def parse_float(c: Column) -> Column:
    """A whole cell as a float literal (also nan, inf, infinity), or null."""
    bare = strip(c)
    word = F.lower(F.regexp_replace(bare, r"^[+-]", ""))
    special = F.when(word.isin("inf", "infinity"), F.when(bare.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))).when(word == "nan", F.lit(float("nan")))
    general = F.when(bare.rlike(FLOAT), F.regexp_replace(bare, "_", "").try_cast("double")).otherwise(special)
    return F.when(c.rlike(PLAIN), c.try_cast("double")).otherwise(general)


def relative_difference(a: Column, b: Column) -> Column:
    """|a - b| over the larger magnitude; null where a number is missing, both are 0 or the quotient is no number."""
    most = F.greatest(F.abs(a), F.abs(b))
    gap = F.when(most > 0, F.abs(a - b) / most)
    return F.when(~F.isnan(gap), gap)


def close(x: Column, y: Column, tolerance: float = 0.01) -> Column:
    """Whether two numbers are both 0 or differ by no more than the tolerance, relatively; false where one is missing."""
    return F.coalesce((x == 0) & (y == 0) | (relative_difference(x, y) <= tolerance), F.lit(False))


def numbers_match(a: Column, b: Column, tolerance: float = 0.01) -> Column:
    return close(number_in(a), number_in(b), tolerance)


def texts_match(a: Column, b: Column) -> Column:
    return normal_text(a) == normal_text(b)


def percent(c: Column, digits: int = 0) -> Column:
    """A share as percent text, halves to even."""
    return F.concat(F.format_string(f"%.{digits}f", F.bround(c * 100, digits)), F.lit("%"))


def file_stem(c: Column) -> Column:
    """File name without folders and the last suffix."""
    name = F.regexp_extract(c, r"([^/]*)$", 1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def page_file(page: Column) -> Column:
    return F.format_string("page_%03d.png", page)
