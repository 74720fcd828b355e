"""Text helpers."""

import contextlib

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from logweir.model import TOKEN_PATTERN

# Everything up to and including the blank counts as an edge to cut.
_EDGE_CHARS = "".join(chr(c) for c in range(0x21))


def edge_trim(text: Column) -> Column:
    """Cut blanks and control characters (U+0000 to U+0020) at both ends."""
    return F.btrim(text, F.lit(_EDGE_CHARS))


def value_tokens(text: Column) -> Column:
    """All `$...$` tokens from left to right, wrapped as found."""
    found = F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))
    return F.when(F.contains(text, F.lit("$")), found).otherwise(
        F.array().cast("array<string>")
    )


def without_tokens(text: Column) -> Column:
    return F.when(
        F.contains(text, F.lit("$")), F.regexp_replace(text, TOKEN_PATTERN, "")
    ).otherwise(text)


def token_text(token: Column) -> Column:
    """The trimmed text between the two dollar signs."""
    return edge_trim(F.btrim(token, F.lit("$")))


def bare_content(content: Column) -> Column:
    """Content without its tokens and edges."""
    return edge_trim(without_tokens(content))


def single_spaced(text: Column) -> Column:
    """Every run of two or more white spaces becomes one blank; a lone tab stays."""
    return F.when(text.rlike(r"\s\s"), F.regexp_replace(text, r"\s{2,}", " ")).otherwise(text)


_UTF8 = ("UTF-8", "UTF8")
_CHARSET_SETTINGS = ("spark.sql.legacy.javaCharsets", "spark.sql.legacy.codingErrorAction")


@contextlib.contextmanager
def charset(spark: SparkSession, encoding: str):
    """Inside the block, `decoded` may name any charset of the JVM; bad bytes become U+FFFD.

    Spark allows these charsets by a setting that an expression takes in when it is built. The
    setting is put back after the block, and the expressions built inside keep it. Raises
    ValueError for a charset that the JVM lacks or that does not write a line feed as one byte.
    """
    if encoding.upper() in _UTF8:
        yield
        return
    charsets = spark._jvm.java.nio.charset.Charset
    if not charsets.isSupported(encoding) or charsets.forName(encoding).encode("\n").remaining() != 1:
        raise ValueError(f"lines cannot be read as {encoding}")
    before = {name: spark.conf.get(name) for name in _CHARSET_SETTINGS}
    try:
        for name in _CHARSET_SETTINGS:
            spark.conf.set(name, "true")
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def decoded(value: Column, encoding: str = "UTF-8") -> Column:
    """Text of a line as read by the text source, which hands over the bytes unchecked.

    In UTF-8, ill-formed bytes become U+FFFD. The text source cuts lines at single line feed
    and carriage return bytes, so only encodings that contain ASCII make sense here. Other
    encodings than Spark's own few need `charset` around the select.
    """
    if encoding.upper() in _UTF8:
        return F.make_valid_utf8(value)
    return F.decode(value.cast("binary"), encoding)
