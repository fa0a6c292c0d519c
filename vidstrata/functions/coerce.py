"""Coercion of loosely typed JSON values.

Three cases must stay apart: a field that is absent, a field that holds JSON ``null``, and a field
with a value that counts as false. ``from_json`` merges the first two, so lines are parsed to
``variant`` and each field is carried as its own JSON text: NULL when absent, ``null`` for null, in
quotes for a string. The first character then tells the kind, and all rules are plain string
expressions, much cheaper per row than casting variants.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

END = "end of line"
# What separates comments, what stands for a backslash, and digits as text may hold them.
SEPARATOR = " - "
ASIDE = "\x01"
QUOTED_DIGITS = r'^"\s*[+-]?\d+\s*"$'
OPTIONS = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def parse_line(text: Column, schema: str) -> Column:
    """A line that holds one JSON object, read by ``schema``; NULL for anything else.

    The parser stops after the first complete value and accepts whatever follows. Wrapped in an
    array with an end mark, anything left over moves or breaks the mark.
    """
    marked = schema[: schema.rindex(">")] + ", _end: string>"
    wrapped = F.concat(F.lit("["), text, F.lit(f',{{"_end":"{END}"}}]'))
    items = F.from_json(wrapped, f"array<{marked}>", OPTIONS)
    return F.when((F.size(items) == 2) & (items[1]["_end"] == END), items[0])


def is_json(text: Column) -> Column:
    wrapped = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{END}"]')))
    return F.coalesce(F.try_variant_get(wrapped, "$[1]", "string") == END, F.lit(False))


def has_field(text: Column, name: str) -> Column:
    """Whether the JSON object in ``text`` holds the field, with any value."""
    return F.try_variant_get(F.try_parse_json(text), f"$.{name}", "variant").isNotNull()


def plain_text(json: Column) -> Column:
    """A JSON value as text: strings without quotes and escapes, all else as written.

    Escaped quotes and backslashes are replaced; a parser, which costs much more, reads strings with other escapes only.
    """
    unescaped = F.get_json_object(F.concat(F.lit('{"t":'), json, F.lit("}")), "$.t")
    inner = F.substring(json, F.lit(2), F.length(json) - 2)
    # backslashes are set aside first, as a character that JSON strings never hold as it is
    plain = F.replace(F.replace(inner, F.lit("\\\\"), F.lit(ASIDE)), F.lit('\\"'), F.lit('"'))
    string = (
        F.when(~json.contains("\\"), inner)
        .when(plain.contains("\\"), unescaped)
        .otherwise(F.replace(plain, F.lit(ASIDE), F.lit("\\")))
    )
    return F.when(json.startswith('"'), string).otherwise(json)


def number_of(json: Column, unwrap: bool = False) -> Column:
    """A JSON value as whole number, fractions cut towards zero; NULL where it is none.

    Digits in quotes count, true and false are 1 and 0. With ``unwrap`` the number is looked up in
    ``$numberInt``, ``$numberLong`` and ``$date`` objects too.
    """
    scientific = json.contains("e") | json.contains("E")
    # Text is matched before it is cast: a cast that fails costs an exception, even in try_cast.
    digits = F.trim(F.btrim(json, F.lit('"')))
    number = (
        # numbers are the only JSON values that start with a character from - to 9
        F.when(
            (json >= "-") & (json < ":"),
            F.when(scientific, json.try_cast("double").try_cast("bigint")).otherwise(
                F.substring_index(json, ".", 1).try_cast("bigint")
            ),
        )
        .when(json.rlike(QUOTED_DIGITS), digits.try_cast("bigint"))
        .when(json == "true", F.lit(1).cast("bigint"))
        .when(json == "false", F.lit(0).cast("bigint"))
    )
    if not unwrap:
        return number
    wrapped = [
        F.get_json_object(json, path)
        for path in ("$['$numberInt']", "$['$numberLong']", "$['$date']['$numberLong']")
    ]
    inner = F.coalesce(*wrapped).try_cast("bigint")
    return F.when(json.startswith("{"), inner).otherwise(number)


class Loose:
    """Column expressions over one field's JSON text.

    Each rule names the plain text or number once, so that a row computes it once. A NULL number
    means: refuse the document.
    """

    def __init__(self, json: Column, unwrap: bool = False):
        self.json = json
        self.text = plain_text(json)
        self.number = number_of(json, unwrap)
        self.absent = json.isNull()
        self.null = F.coalesce(json == "null", F.lit(False))
        self.is_text = F.coalesce(json.startswith('"'), F.lit(False))
        self.is_object = F.coalesce(json.startswith("{"), F.lit(False))
        self.is_bool = json.isin("true", "false")

    @property
    def empty(self) -> Column:
        """Absent, null, false, zero, or an empty string, list or object."""
        return self.absent | json_empty(self.json)

    def text_or(self, default: str) -> Column:
        """``default`` when absent, the word None for null, True/False for booleans."""
        return (
            F.when(self.absent, F.lit(default))
            .when(self.null, F.lit("None"))
            .when(self.is_bool, F.initcap(self.json))
            .otherwise(self.text)
        )

    def filled_text_or(self, default: str) -> Column:
        """Like :meth:`text_or`, with ``default`` for every empty value."""
        return F.when(self.empty, F.lit(default)).otherwise(self.text_or(default))

    def whole(self) -> Column:
        """0 when empty."""
        return F.when(self.empty, F.lit(0).cast("bigint")).otherwise(self.number)

    def small(self) -> Column:
        return self.whole().try_cast("int")

    def strict(self) -> Column:
        """0 when absent; null and empty text are refused."""
        return F.when(self.absent, F.lit(0).cast("bigint")).otherwise(self.number)

    def not_text(self) -> Column:
        """0 when empty; any other text is refused, digits too."""
        return F.when(self.empty, F.lit(0).cast("bigint")).when(~self.is_text, self.number)

    def parts(self) -> Column:
        """Number of parts of a text, 0 for empty text and null; NULL for any other value.

        Escapes neither hold nor make a separator, so it is counted in the JSON text.
        """
        none = self.absent | self.null | (self.json == '""')
        return F.when(none, F.lit(0)).when(self.is_text, separators(self.json) + 1)


def json_empty(json: Column) -> Column:
    # fixed values: JSON forms that count as false
    return json.isin("null", "false", '""', "[]", "{}", "0", "-0", "0.0", "-0.0")


def separators(text: Column) -> Column:
    """How often the separator is in a text; a split by it would compile a pattern for each row."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(SEPARATOR), F.lit("")))) / len(SEPARATOR)).cast("int")


def part_count(text: Column, separator: str = SEPARATOR) -> Column:
    """Number of separated parts; 0 for NULL and for empty text."""
    return F.when(text.isNull() | (text == ""), F.lit(0)).otherwise(
        F.size(F.split(text, separator))
    )
