"""String and byte column expressions (all evaluated in the JVM)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: prompt template, end marker, whitespace set ---------------
TEMPLATE_HEAD = "<s>\n### Instruction:\n"
TEMPLATE_MIDDLE = "\n\n### Response:\n"
END_MARK = "</s>"
SPACE_CLASS = (
    r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
# -----------------------------------------------------------------------------
STRIP_PATTERN = rf"^{SPACE_CLASS}+|{SPACE_CLASS}+$"


def as_col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip(col: Column | str) -> Column:
    """Remove all leading and trailing Unicode white space; ``trim`` only removes spaces."""
    return F.regexp_replace(as_col(col), STRIP_PATTERN, "")


def join_input(instruction: Column | str, extra: Column | str) -> Column:
    """Instruction, then the input on a new line when there is one."""
    instruction, extra = as_col(instruction), as_col(extra)
    return F.when(F.length(extra) > 0, F.concat(instruction, F.lit("\n"), extra)).otherwise(instruction)


def format_example(instruction: Column | str, response: Column | str) -> Column:
    return F.concat(
        F.lit(TEMPLATE_HEAD), strip(instruction), F.lit(TEMPLATE_MIDDLE), strip(response), F.lit(END_MARK)
    )


def format_prompt(instruction: Column | str) -> Column:
    """The template with an empty response and every end marker removed."""
    return F.replace(format_example(instruction, F.lit("")), F.lit(END_MARK), F.lit(""))


def normalize(col: Column | str) -> Column:
    """Lower-case ASCII letters and digits separated by single spaces."""
    return F.trim(F.regexp_replace(F.lower(as_col(col)), "[^a-z0-9]+", " "))


def words(col: Column | str) -> Column:
    return F.filter(F.split(normalize(col), " "), lambda w: w != "")


def latin_bytes(col: Column | str) -> Column:
    """UTF-8 bytes as a string with one Latin-1 character per byte."""
    return F.decode(F.encode(as_col(col), "UTF-8"), "ISO-8859-1")


def char_list(col: Column | str) -> Column:
    """Characters of a string; an empty string gives an empty array."""
    col = as_col(col)
    return F.when(F.length(col) == 0, F.array().cast("array<string>")).otherwise(F.split(col, ""))


def byte_ids(col: Column | str) -> Column:
    """UTF-8 bytes as an array of ints 0..255."""
    return F.transform(char_list(latin_bytes(col)), lambda c: F.ascii(c))


def ids_to_latin(ids: Column | str) -> Column:
    return F.array_join(F.transform(as_col(ids), lambda i: F.chr(i)), "")


def bytes_to_text(latin: Column | str, replacement: str = "") -> Column:
    """Decode bytes held as Latin-1 characters; invalid UTF-8 becomes ``replacement``.

    A real U+FFFD is the byte run EF BF BD, which is a valid character wherever
    it stands, so the text is cut there first and only the U+FFFD that
    repairing adds are replaced.
    """
    real = "ï¿½"
    pieces = F.transform(
        F.split(as_col(latin), real),
        lambda p: F.replace(
            F.make_valid_utf8(F.encode(p, "ISO-8859-1").cast("string")), F.lit("�"), F.lit(replacement)
        ),
    )
    return F.array_join(pieces, "�")


def byte_text(ids: Column | str) -> Column:
    """Byte ids back to text, dropping bytes that are not valid UTF-8."""
    return bytes_to_text(ids_to_latin(ids))


def uniform(*parts: Column | str) -> Column:
    """Reproducible number in [0, 1) from the md5 of the joined parts."""
    text = F.concat_ws("-", *[as_col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def hash_key(*parts: Column | str) -> Column:
    """60-bit sort key from the md5 of the joined parts."""
    text = F.concat_ws("-", *[as_col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")
