"""Text forms of timestamps and long texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Longest compact text, its cut mark, and the length of a one-line text.
COMPACT_CHARS = 240
CUT_MARK = "…"
ONE_LINE_CHARS = 220
# White space as Python's str.split sees it, without and with the plain blank.
OTHER_SPACE = (
    r"\x{09}-\x{0D}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
WHITE_SPACE = rf"[\x{{20}}{OTHER_SPACE}]+"
# Only runs that are not one plain blank already, which most are.
SPACE_RUN = rf"[{OTHER_SPACE}][\x{{20}}{OTHER_SPACE}]*|\x{{20}}[\x{{20}}{OTHER_SPACE}]+"


def iso_text(ts: Column) -> Column:
    """ISO-8601 text; the fraction is left out when it is zero."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.when(micros == "000000", whole).otherwise(F.concat(whole, F.lit("."), micros))


def millis_text(ts: Column) -> Column:
    """Date and time with three fraction digits, cut and not rounded."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS")


def iso_records(df: DataFrame) -> DataFrame:
    """Timestamps as ISO text; all other columns as they are."""
    stamps = (T.TimestampType, T.TimestampNTZType)
    return df.select(
        *[iso_text(F.col(f.name)).alias(f.name) if isinstance(f.dataType, stamps) else F.col(f.name)
          for f in df.schema.fields]
    )


def compact_text(text: Column, max_chars: int = COMPACT_CHARS) -> Column:
    """White space collapsed and trimmed; a longer text is cut and marked."""
    one = F.trim(F.regexp_replace(text, SPACE_RUN, " "))
    return F.when(F.length(one) > max_chars, F.concat(F.left(one, F.lit(max_chars)), F.lit(CUT_MARK))).otherwise(one)


def one_line(text: Column, max_chars: int = ONE_LINE_CHARS) -> Column:
    """Line breaks as blanks, first characters only."""
    return F.translate(F.left(text, F.lit(max_chars)), "\r\n", "  ")
