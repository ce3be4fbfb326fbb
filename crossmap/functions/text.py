"""Text and identifier columns of requirements, pairs and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space, the lengths at which
# texts are cut, and the wording of a pair block.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
ELLIPSIS = "…"
TITLE_LENGTH = 120
SENTENCE_LENGTH = 200
DESCRIPTION_LENGTH = 300
SLUG_LENGTH = 30
SHEET_PART_LENGTH = 12
SHEET_LENGTH = 31
TAGS_SHOWN = 3
PAIR_HEADING = "--- Paire %d ---"
NO_DESCRIPTION = "(sans description)"


def strip(text: Column) -> Column:
    """Text without white space at both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def clean_text(text: Column) -> Column:
    """Text with every run of white space turned into one space, stripped.

    The pattern is only run on texts that hold two spaces in a row.
    """
    other = WHITESPACE.replace(" ", "")
    spaced = F.translate(text, other, " " * len(other))
    single = F.when(F.contains(spaced, F.lit("  ")), F.regexp_replace(spaced, "  +", " ")).otherwise(spaced)
    return F.btrim(single)


def clean_id(raw: Column) -> Column:
    """Identifier without non-ASCII characters, outer dots and spaces."""
    return F.btrim(F.regexp_replace(raw, r"[^\x00-\x7F]", ""), F.lit(". "))


def framework_name(path: Column) -> Column:
    """Framework name from a plain file path: no extension, no trailing number."""
    stem = F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"(?<=.)\.[^.]*$", "")
    return F.translate(F.regexp_replace(stem, r"[-_]\d+$", ""), "- ", "__")


def title_and_description(label: Column, desc: Column, keep: bool = True) -> tuple[Column, Column]:
    """Title and description; a missing label is filled from the start of the description.

    A description that is the whole title is emptied; one that is longer stays
    whole beside it, unless `keep` is off.
    """
    label, desc = strip(label), strip(desc)
    use_desc = (label == "") & (desc != "")
    cut = F.rtrim(F.substring(desc, 1, TITLE_LENGTH), F.lit(WHITESPACE))
    mark = F.when(F.length(desc) > TITLE_LENGTH, ELLIPSIS).otherwise("")
    title = F.when(use_desc, F.concat(cut, mark)).otherwise(label)
    repeated = use_desc & (F.length(desc) <= TITLE_LENGTH) if keep else use_desc
    description = F.when(repeated, "").otherwise(desc)
    return clean_text(title), clean_text(description)


def requirement_id(own: Column, inherited: Column, n: Column) -> Column:
    """The item's own identifier, else its place below the inherited one."""
    own = strip(own)
    numbered = F.concat_ws(".", inherited, n.cast("string"))
    return clean_id(F.when(own != "", own).otherwise(numbered))


def embedding_text(tags: Column, title: Column, description: Column, sentence_length: int | None = None) -> Column:
    """Text that is encoded: last tag, title and description.

    With a sentence length, only the first sentence up to it instead of the description.
    """
    if sentence_length is not None:
        description = F.substring(strip(F.substring_index(description, ".", 1)), 1, sentence_length)
    content = F.when(description != "", F.concat(title, F.lit(": "), description)).otherwise(title)
    return F.when(
        F.size(tags) > 0, F.concat_ws(" | ", F.try_element_at(tags, F.lit(-1)), content)
    ).otherwise(content)


def truncate(text: Column, length: int = DESCRIPTION_LENGTH) -> Column:
    """Text cut at a length, with a mark where something was cut."""
    cut = F.concat(F.substring(text, 1, length), F.lit(ELLIPSIS))
    return F.when(F.length(text) > length, cut).otherwise(text)


def slug(name: Column) -> Column:
    return F.substring(F.regexp_replace(F.lower(name), "[^a-z0-9]", "_"), 1, SLUG_LENGTH)


def pair_slug(framework_a: Column, framework_b: Column) -> Column:
    """File-name key of a framework pair."""
    return F.concat(slug(framework_a), F.lit("__"), slug(framework_b))


def sheet_name(framework_a: Column, framework_b: Column) -> Column:
    """Report sheet of a framework pair."""
    part_a = F.substring(framework_a, 1, SHEET_PART_LENGTH)
    part_b = F.substring(framework_b, 1, SHEET_PART_LENGTH)
    return F.substring(F.concat(part_a, F.lit(" "), part_b), 1, SHEET_LENGTH)


def side_text(framework: Column, tags: Column, title: Column, description: Column, tags_shown: int | None = None, length: int | None = None) -> Column:
    """Text of one requirement of a pair, without the letter of its side."""
    shown = F.array_join(tags if tags_shown is None else F.slice(tags, 1, tags_shown), ", ")
    context = F.when(F.size(tags) > 0, F.concat(F.lit(" ["), shown, F.lit("]"))).otherwise("")
    body = description if length is None else truncate(description, length)
    body = F.when(body == "", NO_DESCRIPTION).otherwise(body)
    return F.concat(F.lit("("), framework, context, F.lit("): "), title, F.lit("\n"), body)


def pair_of_sides(number: Column, side_a: Column, side_b: Column) -> Column:
    """Text of one numbered pair, from the texts of both sides."""
    return F.concat(F.format_string(PAIR_HEADING, number), F.lit("\nA "), side_a, F.lit("\n\nB "), side_b)


def pair_block(
    number: Column, suffix_a: str = "_A", suffix_b: str = "_B", tags_shown: int | None = None, length: int | None = None
) -> Column:
    """Text of one numbered pair, from the columns of both requirements.

    Tags and descriptions are shown whole unless a number of tags or a length is given.
    """
    names = ("framework", "tags", "title", "description")
    sides = (side_text(*(F.col(name + suffix) for name in names), tags_shown, length) for suffix in (suffix_a, suffix_b))
    return pair_of_sides(number, *sides)


def escape_html(text: Column) -> Column:
    """Text safe to place in a page; the ampersand goes first."""
    for plain, escaped in (
        ("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"),
    ):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def score_label(semantic: Column, cov_a: Column, cov_b: Column) -> Column:
    """Short score text of a review row, two digits each."""
    shown = [F.format_number(score, 2) for score in (semantic, cov_a, cov_b)]
    return F.concat(shown[0], F.lit(" → "), shown[1], F.lit("/"), shown[2])


def terms(text: Column) -> Column:
    """Lower-case words of a text, with repeats."""
    words = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.filter(words, lambda word: word != "")


def section_keys(requirement: Column) -> tuple[Column, Column, Column]:
    """Number of dotted parts, first part and first two parts of an identifier."""
    parts = F.split(requirement, r"\.")
    first = F.element_at(parts, 1)
    return F.size(parts), first, F.array_join(F.slice(parts, 1, 2), ".")
