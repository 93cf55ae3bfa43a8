"""Text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from activity_lake import schemas
from activity_lake.functions.dates import _named

# Accented letters and separators with what replaces them.
ACCENTED = "àãáâéèêëîïùüûôö-/"
PLAIN = "aaaaeeeeiiuuuoo  "
# Texts of the comment format.
DEFAULT_COMMENT_PREFIX = "Bypass IA : "
NO_COMMENT = "No comment"

# White space as Python sees it. The regex class needs (?U) to know Unicode and
# the four separators it leaves out.
WHITE_SPACE = "".join(chr(c) for c in range(0x10000) if chr(c).isspace())
_WORD = r"(?U)[^\s\x1C-\x1F]+"


def strip(c: Column | str) -> Column:
    """Text without white space on either end."""
    return F.btrim(_named(c), F.lit(WHITE_SPACE))


def words(c: Column | str) -> Column:
    """Number of white-space separated words, in one pass."""
    return F.regexp_count(_named(c), F.lit(_WORD))


def normalize_text(c: Column | str) -> Column:
    """Stripped, lower case, listed accents removed, separators as spaces."""
    return F.translate(F.lower(strip(c)), ACCENTED, PLAIN)


def display_name(first: Column | str, last: Column | str) -> Column:
    """First name and the initial of the last name, if there is one."""
    initial = F.left(_named(last), F.lit(1))
    return F.concat(
        _named(first),
        F.when(F.length(initial) > 0, F.concat(F.lit(" "), initial, F.lit("."))).otherwise(""),
    )


def first_char(c: Column | str) -> Column:
    return F.left(_named(c), F.lit(1))


def _kilometres(meters: Column) -> Column:
    """Kilometres with one decimal, rounding the double ``meters / 1000``.

    Only a remainder of exactly 50 m is a tie in decimal. There the double is
    compared with the tie without rounding error (its float part times 20 is
    exact), so the result equals a correctly rounded binary value; true binary
    ties go to the even digit.
    """
    quotient = meters / F.lit(1000.0)
    coarse = quotient.cast("float").cast("double")
    tie = (F.floor(meters / 100) * 2 + 1).cast("double")
    above = (coarse * 20 - tie) + (quotient - coarse) * 20
    tenths = F.floor(meters / 100)
    rest = meters % 100
    up = (rest > 50) | ((rest == 50) & ((above > 0) | ((above == 0) & (tenths % 2 == 1))))
    rounded = tenths + up.cast("int")
    return F.concat(F.floor(rounded / 10).cast("string"), F.lit("."), (rounded % 10).cast("string"))


def format_performance(distance_meters: Column | str, duration_sec: Column | str) -> Column:
    """``D km en HhMM`` or ``D km en M min``; no distance part when null or 0."""
    meters, seconds = _named(distance_meters), _named(duration_sec)
    hours = F.floor(seconds / 3600)
    minutes = F.floor(seconds % 3600 / 60)
    length = F.when(
        F.coalesce(meters, F.lit(0)) != 0, F.concat(_kilometres(meters), F.lit(" km en "))
    ).otherwise("")
    time = F.when(
        hours > 0,
        F.concat(hours.cast("string"), F.lit("h"), F.lpad(minutes.cast("string"), 2, "0")),
    ).otherwise(F.concat(minutes.cast("string"), F.lit(" min")))
    return F.concat(length, time)


def clean_comment(c: Column | str) -> Column:
    """Comment fit for a quoted message; null reads as empty."""
    return strip(F.replace(F.coalesce(_named(c), F.lit("")), F.lit('"'), F.lit("'")))


def clean_markup(c: Column | str) -> Column:
    return F.replace(_named(c), F.lit("&nbsp;"), F.lit(" "))


def default_comment(situation: Column | str) -> Column:
    """Comment made without a model."""
    told = F.nullif(_named(situation), F.lit(""))
    return F.concat(F.lit(DEFAULT_COMMENT_PREFIX), F.coalesce(told, F.lit(NO_COMMENT)))


def first_filled(*cols: Column | str, default: str | None = None) -> Column:
    """First of the columns that is neither null nor empty."""
    filled = [F.nullif(_named(c), F.lit("")) for c in cols]
    return F.coalesce(*filled, F.lit(default))


def prompt_tokens(c: Column | str) -> Column:
    """Estimated tokens of a prompt: 1.3 per character."""
    return F.floor(F.length(_named(c)) * F.lit(1.3))


def answer_tokens(c: Column | str) -> Column:
    """Estimated tokens of an answer: 1.3 per word."""
    return F.floor(words(c) * F.lit(1.3))


def digest(*parts: Column) -> Column:
    """MD5 over the parts, each with its length, so that no two lists collide."""
    marked = [
        F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-"))
        for p in (part.cast("string") for part in parts)
    ]
    return F.md5(F.concat_ws("|", *marked))


def activity_key(ts: Column | str, *cols: Column | str) -> Column:
    """Key text ``ACT-yymmdd-HHMM-nnnnn``; the number comes from the row itself."""
    number = F.conv(F.left(digest(*[_named(c) for c in cols]), F.lit(8)), 16, 10).cast("long")
    return F.concat(
        F.lit("ACT-"), F.date_format(_named(ts), "yyMMdd-HHmm"), F.lit("-"),
        F.lpad((number % 100_000).cast("string"), 5, "0"),
    )


def parse_answer(c: Column | str) -> Column:
    """Model answer as a struct; code fences around it are removed."""
    bare = strip(F.regexp_replace(_named(c), "```(json)?", ""))
    return F.from_json(bare, schemas.ANSWER)


def record_text(*cols: str) -> Column:
    """A row as readable ``name=value`` text for audit trails."""
    shown = [
        F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("null"))) for c in cols
    ]
    return F.concat_ws(", ", *shown)
