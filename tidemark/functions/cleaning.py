"""Column functions that clean raw text fields: keys, numbers, months, sentinels, identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A project key: ten or eleven upper-case letters or digits.
KEY_PATTERN = r"^[0-9A-Z]{10,11}$"

# Spanish month names and their three-letter forms, in calendar order.
MONTHS = (
    ("ene", "enero"), ("feb", "febrero"), ("mar", "marzo"), ("abr", "abril"), ("may", "mayo"), ("jun", "junio"),
    ("jul", "julio"), ("ago", "agosto"), ("sep", "septiembre"), ("oct", "octubre"), ("nov", "noviembre"), ("dic", "diciembre"),
)

#: Text that a CSV reader takes for a missing value.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

_NUMBER = r"^[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|inf|infinity)$"
#: Two-digit years below this belong to the 2000s.
CENTURY_PIVOT = 70


def clean_key(c: Column) -> Column:
    """Trimmed, without any leading apostrophes, upper case."""
    return F.upper(F.regexp_replace(F.trim(c.cast("string")), r"^'+", ""))


def is_key(c: Column) -> Column:
    """Whether a cleaned key has the shape of one; null is not a key."""
    return F.coalesce(c.rlike(KEY_PATTERN), F.lit(False))


def missing_to_null(c: Column) -> Column:
    """Null for any spelling of a missing value."""
    return F.when(~c.isin(*MISSING), c)


def parse_number(c: Column) -> Column:
    """A double from text with thousands commas, else null; unlike a plain cast, no type suffixes pass."""
    text = F.trim(F.regexp_replace(c.cast("string"), ",", ""))
    return F.when(F.lower(text).rlike(_NUMBER), text.try_cast("double"))


def zero_to_null(c: Column) -> Column:
    """Null for the sentinel 0."""
    return F.when(c != 0, c)


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def parse_month(c: Column) -> Column:
    """The first day of the month that a text names, as a date.

    Four dialects: ``2003-01-01 00:00:00``, ``01/12/2002``, ``mar-06`` and ``Enero/2001``. Anything else,
    an impossible month included, is null.
    """
    text = F.lower(F.trim(c.cast("string")))
    names = F.create_map(*[F.lit(v) for i, pair in enumerate(MONTHS) for name in dict.fromkeys(pair) for v in (name, i + 1)])
    part = lambda pattern, g: F.regexp_extract(text, pattern, g)
    # The four dialects' formats.
    iso, dmy = r"^(\d{4})-(\d{1,2})-\d{1,2}", r"^\d{1,2}/(\d{1,2})/(\d{4})$"
    short, full = r"^([a-záéíóúñ]{3})-(\d{2})$", r"^([a-záéíóúñ]+)/(\d{4})$"
    two = part(short, 2).try_cast("int")
    year = (
        F.when(text.rlike(iso), part(iso, 1).try_cast("int"))
        .when(text.rlike(dmy), part(dmy, 2).try_cast("int"))
        .when(text.rlike(short), F.when(two < CENTURY_PIVOT, two + 2000).otherwise(two + 1900))
        .when(text.rlike(full), part(full, 2).try_cast("int"))
    )
    month = (
        F.when(text.rlike(iso), part(iso, 2).try_cast("int"))
        .when(text.rlike(dmy), part(dmy, 1).try_cast("int"))
        .when(text.rlike(short), F.try_element_at(names, part(short, 1)))
        .when(text.rlike(full), F.try_element_at(names, part(full, 1)))
    )
    return F.when(year.between(1678, 2261) & month.between(1, 12), F.make_date(year, month, F.lit(1)))


def header_text(columns: list[str]) -> str:
    """The text whose sha256 identifies a file's layout: its names in order, joined by commas."""
    return ",".join(columns)


def sha256_hex(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def slug(url: Column) -> Column:
    """A URL's file name without extension, lower case, each other character an underscore; never empty."""
    name = F.substring_index(F.substring_index(url, "/", -1), "?", 1)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    bare = F.regexp_replace(F.regexp_replace(stem, r"[^\p{L}\p{N}]", "_"), r"^_+|_+$", "")
    return F.lower(F.when(bare == "", "archivo").otherwise(bare))


def snapshot_id(year: Column, quarter: Column, sha256: Column, url: Column) -> Column:
    """``2020Q3_1a2b3c4d``, ``2020_anual_1a2b3c4d`` without a quarter, ``aux_slug_1a2b3c4d`` without a year."""
    short = F.substring(sha256, 1, 8)
    return (
        F.when(year.isNull(), F.concat(F.lit("aux_"), slug(url), F.lit("_"), short))
        .when(quarter.isNull(), F.concat(year.cast("string"), F.lit("_anual_"), short))
        .otherwise(F.concat(year.cast("string"), F.lit("Q"), quarter.cast("string"), F.lit("_"), short))
    )


def order_index(year: Column, quarter: Column) -> Column:
    """Readable order of quarters, 20203 for the third of 2020; not for subtraction."""
    return year * 10 + quarter


def linear_index(year: Column, quarter: Column) -> Column:
    """Quarters on one line, so that a difference is a number of quarters."""
    return year * 4 + quarter


def bronze_name(year: Column, quarter: Column, sha256: Column, ext: Column, url: Column) -> Column:
    """A content-addressed file name: the same bytes for the same cut always have the same one."""
    cut = (
        F.when(year.isNull(), F.concat(F.lit("aux_"), slug(url)))
        .when(quarter.isNull(), F.concat(year.cast("string"), F.lit("_anual")))
        .otherwise(F.concat(year.cast("string"), F.lit("_"), quarter.cast("string")))
    )
    return F.concat(F.lit("opa_"), cut, F.lit("_"), F.substring(sha256, 1, 8), F.lit("."), F.regexp_replace(F.lower(ext), r"^\.+", ""))


def point_size(amount: Column, largest_root: Column) -> Column:
    """Marker size between 3 and 31 by the cube root of an amount, relative to the largest root."""
    return F.cbrt(F.greatest(F.coalesce(amount, F.lit(1.0)), F.lit(1.0))) / largest_root * 28 + 3


#: Where a word may be broken: behind a hyphen between letters, two of them on each side or a further hyphen.
_HYPHEN = r"(?:(?<=\p{L}{2}-)|(?<=\p{L}-\p{L}-))(?=\p{L}-?\p{L})"


def wrap(text: Column, width: int, line_end: str = "<br>") -> Column:
    """A label in lines of at most ``width`` characters, filled word by word; longer words get a line of their own.

    White space counts as one space; hyphenated words may be broken behind the hyphen. A fold over the words
    carries the text so far and the length of its last line, so this is for labels, not for long texts. Null
    stays null, a blank text becomes empty.
    """
    words = F.filter(F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " "), lambda w: w != "")
    pieces = F.flatten(F.transform(words, lambda w: F.transform(F.split(w, _HYPHEN), lambda p, i: F.struct(p.alias("piece"), (i == 0).alias("spaced")))))

    def add(state: Column, x: Column) -> Column:
        n, gap = F.char_length(x["piece"]), F.when(x["spaced"], 1).otherwise(0)
        fits = state["length"] + gap + n <= width
        glue = F.when(state["length"] == 0, "").when(~fits, line_end).when(x["spaced"], " ").otherwise("")
        length = F.when((state["length"] > 0) & fits, state["length"] + gap).otherwise(0) + n
        return F.struct(F.concat(state["text"], glue, x["piece"]).alias("text"), length.alias("length"))

    folded = F.aggregate(pieces, F.struct(F.lit("").alias("text"), F.lit(0).alias("length")), add)
    return F.when(text.isNotNull(), folded["text"])
