"""String helpers as Column expressions (no UDFs)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.isspace() accepts below U+FFFF.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a Java regex character class.
SPACE_CLASS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# Line boundaries of str.splitlines().
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
# Fixed value: string.punctuation.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

#: Characters of a text that are searched before the whole of it.
HEAD = 400


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a costly value that it names several times; branches of a ``when`` would work it out for each."""
    return F.get(F.transform(F.array(value), use), 0)


def strip(value: Column | str) -> Column:
    """Unicode strip; ``F.trim`` alone only removes U+0020."""
    return F.trim(_col(value), F.lit(SPACE_CHARS))


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(_col(value), F.lit(""))


def strip_to_null(value: Column | str) -> Column:
    return blank_to_null(strip(value))


def collapse_whitespace(value: Column | str) -> Column:
    """Every whitespace run becomes one space, ends stripped, null becomes ''."""
    text = F.coalesce(_col(value), F.lit(""))
    return F.trim(F.regexp_replace(text, SPACE_CLASS + "+", " "))


def words(value: Column | str) -> Column:
    """Whitespace tokens of a text, none of them empty."""
    return F.filter(F.split(_col(value), SPACE_CLASS + "+", -1), lambda w: w != "")


def token_count(value: Column | str) -> Column:
    return F.size(words(value))


def sentences(value: Column | str, first: int | None = None) -> Column:
    """Split after ``.``, ``!`` or ``?`` followed by whitespace; never empty for non-blank text.

    With ``first`` the split ends behind so many sentences; what follows them is one piece more.
    """
    # every piece but the last ends with a mark, so none of them is blank
    pieces = F.split(_col(value), r"(?<=[.!?])" + SPACE_CLASS + "+", -1 if first is None else first + 1)
    return F.filter(F.transform(pieces, strip), lambda s: s != "")


def truncate_at_space(value: Column | str, limit: int = 512) -> Column:
    """Cut to ``limit`` characters, then back to the last space inside the cut."""
    text = _col(value)
    cut = F.substring(text, 1, limit)
    return F.when(F.length(text) > limit, F.regexp_replace(cut, r" [^ ]*\z", "")).otherwise(text)


def title_like(value: Column | str, max_chars: int = 120, max_spaces: int = 15) -> Column:
    text = _col(value)
    spaces = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))
    return (F.length(text) <= max_chars) & (spaces <= max_spaces)


def lines_without_blanks(value: Column | str) -> Column:
    text = _col(value)
    single = F.filter(F.array(text), lambda line: strip(line) != "")
    several = F.filter(F.split(text, LINE_BREAK, -1), lambda line: strip(line) != "")
    return F.when(text.rlike(LINE_BREAK), several).otherwise(single)


def strip_tags(value: Column | str) -> Column:
    """Replace every markup tag by a space."""
    return F.regexp_replace(_col(value), "<[^>]+>", " ")


def leading_keywords(value: Column | str, min_chars: int = 6, limit: int = 5) -> Column:
    """First distinct long tokens in text order, outer punctuation removed, lower case.

    The head of a text mostly holds enough of them; the whole text is read only where it does not.
    """
    text = _col(value)

    def found(tokens: Column) -> Column:
        # stripping makes no token longer, so short ones need none
        long = F.filter(tokens, lambda w: F.length(w) >= min_chars)
        bare = F.transform(long, lambda w: F.trim(w, F.lit(PUNCTUATION)))
        kept = F.filter(bare, lambda w: F.length(w) >= min_chars)
        return F.slice(F.array_distinct(F.transform(kept, F.lower)), 1, limit)

    head = words(F.substring(text, 1, HEAD))
    # the last token may be cut
    first = found(F.slice(head, 1, F.greatest(F.size(head) - 1, F.lit(0))))
    return F.when(F.size(first) >= limit, first).otherwise(found(words(text)))


def sorted_keywords(value: Column | str, limit: int = 10) -> Column:
    """Alphabetically first distinct ASCII words of six letters or more."""
    found = F.regexp_extract_all(_col(value), F.lit("([A-Za-z]{6,})"), F.lit(1))
    return F.slice(F.array_sort(F.array_distinct(F.transform(found, F.lower))), 1, limit)


def key_value_text(name: Column | str, value: Column | str) -> Column:
    """``name: value`` with a missing value shown as empty, stripped."""
    return strip(F.concat(_col(name), F.lit(": "), F.coalesce(_col(value), F.lit(""))))


# part name of a bundle's own document; stored rows show it as a null part id
ROOT = "root"


def block_id(part: Column | str, kind: str, ordinal: Column | str) -> Column:
    """Block identifier of the zero-based ``ordinal`` inside a part."""
    return F.concat(_col(part), F.lit(f"-{kind}-"), (_col(ordinal) + 1).cast("string"))


def child_part(part: Column | str, ordinal: Column | str) -> Column:
    return F.concat(_col(part), F.lit(".attachment-"), (_col(ordinal) + 1).cast("string"))


def part_id(part: Column | str) -> Column:
    return F.nullif(_col(part), F.lit(ROOT))


def file_extension(path: Column | str) -> Column:
    """Extension without the dot; dot-files and paths without one give ''."""
    return F.regexp_extract(_col(path), r"(?s)(?:^|/)\.*[^./][^/]*\.([^./]*)\z", 1)


def object_uri(bucket: Column | str, key: Column | str) -> Column:
    """``s3://bucket/key`` where both exist, else null."""
    bucket, key = blank_to_null(bucket), blank_to_null(key)
    return F.concat(F.lit("s3://"), bucket, F.lit("/"), key)


def attachment_uri(source_uri: Column | str, file_name: Column | str) -> Column:
    return F.concat(_col(source_uri), F.lit("#attachment/"), _col(file_name))
