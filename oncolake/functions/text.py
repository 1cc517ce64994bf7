"""Column expressions for identifiers, numbers and labels. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal text that counts as a number at ingest. Digits may be grouped by single
# underscores; a type suffix as in `1d` or `1.5f`, which a cast would take, is no number.
# Nothing is tried twice: a long line that is no number costs one look at each character.
_DIGITS = r"\d++(?:_\d++)*+"
_NUMBER = (
    rf"\s*+[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?"
    r"|inf(?:inity)?|nan)\s*+"
)


def strip_version(gene_id: Column) -> Column:
    """`G00000007080.9` -> `G00000007080`."""
    return F.substring_index(gene_id, ".", 1)


def is_number(text: Column) -> Column:
    return text.rlike(f"(?i)^{_NUMBER}$")


def is_number_field(field: Column) -> Column:
    """Whether a field of a text table, quoted or not, holds a number."""
    return field.rlike(f'(?i)^(?:{_NUMBER}|"{_NUMBER}")$')


def number_of_field(field: Column) -> Column:
    """The value of a field that is known to hold a number; null for a signed nan."""
    return F.replace(F.btrim(field, F.lit('"')), F.lit("_"), F.lit("")).try_cast("double")


def parse_double(text: Column) -> Column:
    """The number in `text`, or null where it is none."""
    value = F.replace(text, F.lit("_"), F.lit("")).try_cast("double")
    # A signed nan passes the pattern but not the cast.
    return F.when(is_number(text), F.coalesce(value, F.lit(float("nan"))))


def is_positive(value: Column) -> Column:
    """True above zero. Spark orders NaN above every number, so it is replaced first."""
    return F.nanvl(value, F.lit(-1.0)) > 0


def unquote(text: Column) -> Column:
    """Drop one pair of surrounding double quotes; doubled quotes inside become single."""
    quote = F.lit('"')
    inner = F.replace(F.substring(text, F.lit(2), F.length(text) - 2), F.lit('""'), quote)
    quoted = F.startswith(text, quote) & F.endswith(text, quote) & (F.length(text) > 1)
    return F.when(quoted, inner).otherwise(text)


# Parts the groups of one search. Texts that hold it are searched for each group.
_MARK = "\x01"


def regex_extract(text: Column, pattern: str) -> Column:
    """First group of the first match, ignoring case; empty text where nothing matches."""
    return F.regexp_extract(text, f"(?iu){pattern}", 1)


def regex_extract_groups(text: Column, pattern: str, groups: int) -> Column:
    """Groups 1..n of the first match, ignoring case; an empty array where nothing matches."""
    caseless = f"(?iu){pattern}"
    # One search: the match, and all before and behind it, give way to the groups.
    marks = _MARK + "".join(f"${g}{_MARK}" for g in range(1, groups + 1))
    replaced = F.regexp_replace(text, rf"(?iu)^[\s\S]*?(?:{pattern})[\s\S]*$", marks)
    found = F.when(
        F.startswith(replaced, F.lit(_MARK)),
        F.slice(F.split(replaced, _MARK, -1), F.lit(2), F.lit(groups)),
    )
    searched = F.when(
        text.rlike(caseless),
        F.array(*[F.regexp_extract(text, caseless, g) for g in range(1, groups + 1)]),
    )
    marked = F.contains(text, F.lit(_MARK))
    nothing = F.array().cast("array<string>")
    return F.coalesce(F.when(marked, searched).otherwise(found), nothing)


def glue(ids: Column) -> Column:
    """All ids of an array as one text, without a separator; a null array gives ''."""
    return F.concat_ws("", ids)


def file_path(path: Column, filename: Column) -> Column:
    """Directory and file name as one path; null when either is null."""
    return F.concat(path, F.lit("/"), filename)


def compact_name(name: Column) -> Column:
    """A disease name without blanks."""
    return F.replace(name, F.lit(" "), F.lit(""))


def gene_label(gene_name: Column, info: Column) -> Column:
    """Gene name, a line break, and the description up to its source note."""
    return F.concat(gene_name, F.lit("<br />"), F.substring_index(info, "[", 1))


_GLOB = {"*": "[^/]*", "?": "[^/]", "{": "(?:", "}": ")", ",": "|"}


def folder_pattern(glob: str) -> str:
    """A regular expression for the paths below the folders that a file pattern names."""
    out, depth, inside = [], 0, False
    for c in glob.strip("/"):
        if inside:
            inside = c != "]"
            out.append("^" if c in "^!" and out[-1] == "[" else c)
        elif c == "[":
            inside = True
            out.append(c)
        elif c in "{}*?" or (c == "," and depth):
            depth += (c == "{") - (c == "}")
            out.append(_GLOB[c])
        else:
            out.append(c if c.isalnum() or c in "_/" else "\\" + c)
    return "^" + "".join(out) + "/"
