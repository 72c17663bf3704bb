"""Text functions of the line parser, as column expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space characters of Unicode.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000"
)


def is_blank(col: Column) -> Column:
    """NULL, empty or only white space."""
    return col.isNull() | ~col.rlike(r"(?U)\S")


def strip_space(col: Column) -> Column:
    """Leading and trailing white space removed."""
    return F.btrim(col, F.lit(WHITE_SPACE))


# A field and the comma after it, from the end of the last match: pairs of quotes hide the commas
# between them. In a line with an odd number of quotes the first one stands alone. The quantifiers
# are possessive, so a line is gone through once, after a look at its quotes.
_ODD = r'(?:^(?=[^"]*+"(?:[^"]*+"[^"]*+")*+[^"]*+\z)[^"]*+")?+'
FIELD_TEXT = rf'\G({_ODD}[^",]*+(?:"[^"]*+"[^",]*+)*+),'


def split_fields(line: Column) -> Column:
    """Split at the commas that an even number of quotes follows (S2). Linear in the length of
    the line."""
    quoted = F.regexp_extract_all(F.concat(line, F.lit(",")), F.lit(FIELD_TEXT), F.lit(1))
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.split(line, ","))


def trim_field(field: Column) -> Column:
    """Spaces and quotes off both ends, in any mix. Most fields have none, which costs less to see."""
    loose = [test(field, F.lit(c)) for test in (F.startswith, F.endswith) for c in ' "']
    return F.when(reduce(or_, loose), F.btrim(field, F.lit(' "'))).otherwise(field)


def trim_fields(fields: Column) -> Column:
    """Spaces and quotes off both ends of every field, in any mix (S3)."""
    return F.transform(fields, trim_field)


def header_names(fields: Column) -> Column:
    """Column names of a header line.

    A blank name becomes ``Column_n``; a name already taken, case ignored, gets its position
    as a suffix. A name still taken after that stays double: see :func:`has_name_clash`.
    """

    def taken(names: Column, name: Column) -> Column:
        return F.exists(names, lambda n: F.upper(n) == F.upper(name))

    def add(names: Column, raw: Column) -> Column:
        n = F.size(names)
        name = F.when(is_blank(raw), F.concat(F.lit("Column_"), (n + 1).cast("string"))).otherwise(
            raw
        )
        suffixed = F.concat(name, F.lit("_"), n.cast("string"))
        return F.concat(names, F.array(F.when(taken(names, name), suffixed).otherwise(name)))

    return F.aggregate(fields, F.array().cast("array<string>"), add)


def has_name_clash(names: Column) -> Column:
    """Whether two names are equal, case ignored."""
    upper = F.transform(names, F.upper)
    return F.size(F.array_distinct(upper)) < F.size(upper)


def align_fields(fields: Column, n: int) -> list[Column]:
    """The first ``n`` fields; NULL where the row is short, the rest cut."""
    return [F.get(fields, F.lit(i)) for i in range(n)]
