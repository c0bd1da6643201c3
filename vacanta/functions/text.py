"""Text predicates and conversions as column expressions."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Numbers as a float parser reads them: no digit separators, no type suffixes.
NUMBER_PATTERN = (
    r"(?i)^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity|nan)\s*$"
)
# The characters that stripping a text removes.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def has_ink(text: Column) -> Column:
    """True when the text is more than white space.

    Trimming stops at the first other character; a pattern would first decode
    the whole text.
    """
    return F.ltrim(text, F.lit(BLANKS)) != ""


def contains_ci(text: Column, word: str, rare_pair: str | None = None) -> Column:
    """Case-insensitive substring test; ``word`` is given in lower case.

    Lowering a long non-ASCII text costs several times a plain search. With
    ``rare_pair``, two letters of ``word`` that few texts contain side by side,
    only texts with the pair in some case are lowered.
    """
    found = F.contains(F.lower(text), F.lit(word))
    if rare_pair:
        if rare_pair not in word:
            raise ValueError(f"{rare_pair!r} is not part of {word!r}")
        cases = {a + b for a in (rare_pair[0], rare_pair[0].upper())
                 for b in (rare_pair[1], rare_pair[1].upper())}
        pairs = [F.contains(text, F.lit(pair)) for pair in sorted(cases)]
        found = reduce(Column.__or__, pairs) & found
    return found


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def to_number(text: Column) -> Column:
    """Text as double, NULL where the text is no plain number."""
    return F.when(text.rlike(NUMBER_PATTERN), F.trim(text).try_cast("double"))


def is_bad_number(text: Column) -> Column:
    """True for text that is neither missing, empty nor a plain number."""
    return F.coalesce(text != "", F.lit(False)) & to_number(text).isNull()


def list_as_text(value: Column) -> Column:
    """A VARIANT list as comma text, any other value as its text.

    NULL list elements are skipped, an empty list gives ``''``, and JSON null
    gives NULL.
    """
    return F.coalesce(
        F.array_join(F.try_variant_get(value, "$", "array<string>"), ","),
        F.try_variant_get(value, "$", "string"),
    )
