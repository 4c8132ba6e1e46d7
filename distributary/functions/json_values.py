"""JSON documents held as VARIANT: strict parsing, kinds and pointers; and values as they were written.

VARIANT sorts the keys of objects and keeps numbers by value. Where the text of a value matters, it is cut out of the
document itself: Spark's JSON reader hands over the text of a field with its keys in order and without blanks, and
numbers it would rewrite (``1.10``, ``1e3``, ``-0``) are made strings beforehand, with a mark, and numbers again
afterwards.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER_KINDS = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL\(.*)"
TEXT_MAP = "map<string,string>"

# The mark is no character (U+FDD0): ``n`` follows it before a number, ``u`` where a document has it itself.
MARK = "\ufdd0"
HAS_MARK = r"\x{FDD0}|\\u[fF][dD][dD]0"
ESCAPED_MARK = r"((?<!\\)(?:\\\\)*)\\u[fF][dD][dD]0"
REWRITTEN = r"[0-9][.eE]|-0"
STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
# From the end of the last match on: whatever is no number to mark, whole strings included, then such a number.
NUMBER_TO_MARK = (
    rf'\G((?:[^"0-9-]++|{STRING}|-(?![0-9])|(?!-0(?![0-9.eE]))-?[0-9]++(?![0-9.eE]))*+)'
    r"(-0(?![0-9.eE])|-?[0-9]++[.eE][0-9.eE+-]*+)"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``, also inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def boxed_document(text: Column) -> Column:
    """List whose first member is the one JSON document in ``text``; NULL where there is not exactly one.

    ``try_parse_json`` stops after the first value. The text is parsed as the first member of a list whose
    second member is a hash of the text: whatever follows the document pushes the hash out of its place.
    """
    seal = F.xxhash64(text)
    boxed = F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), seal.cast("string"), F.lit("]")))
    in_place = F.try_variant_get(boxed, "$[1]", "bigint") == seal
    return F.when(in_place & F.try_variant_get(boxed, "$[2]", "variant").isNull(), boxed)


def parse_document(text: Column) -> Column:
    """The one JSON document in ``text`` as VARIANT, NULL where there is not exactly one."""
    return F.try_variant_get(boxed_document(text), "$[0]", "variant")


def kind_of(value: Column) -> Column:
    """JSON kind of a VARIANT: STRING, BOOLEAN, BIGINT, DECIMAL(p,s), DOUBLE, ARRAY<..>, OBJECT<..>.

    NULL for a missing value and for JSON null, which load in the same way.
    """
    return F.nullif(F.schema_of_variant(value), F.lit("VOID"))


def is_number(kind: Column) -> Column:
    return kind.rlike(NUMBER_KINDS)


def fields_of(value: Column) -> Column:
    """Fields of a JSON object by name; NULL for any other kind."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def walk(value: Column, steps: Column) -> Column:
    """Value under an array of field names, NULL where a step is missing."""
    return F.aggregate(steps, value, lambda node, step: fields_of(node)[step])


def get_path(value: Column, steps: list[str | int]) -> Column:
    """Value of a JSON pointer: text steps are object fields, whole numbers are list positions."""
    for step in steps:
        if isinstance(step, bool) or not isinstance(step, (str, int)):
            raise ValueError(f"{step!r} is a step of a schema, not of data")
        if isinstance(step, str):
            value = fields_of(value)[step]
        else:
            value = F.get(F.try_variant_get(value, "$", "array<variant>"), F.lit(step))
    return value


def json_text(value: Column) -> Column:
    """Compact JSON of a VARIANT, object keys in order of name."""
    return F.to_json(value)


def plain_text(value: Column) -> Column:
    """Content of a JSON string, compact JSON of anything else; NULL for JSON null."""
    return value.cast("string")


def marked(text: Column) -> Column:
    """A document whose numbers all survive the JSON reader."""
    own = F.regexp_replace(F.regexp_replace(text, MARK, f"{MARK}u"), ESCAPED_MARK, f"$1{MARK}u")
    safe = F.when(text.rlike(HAS_MARK), own).otherwise(text)
    return F.when(text.rlike(REWRITTEN), F.regexp_replace(safe, NUMBER_TO_MARK, f'$1"{MARK}n$2"')).otherwise(safe)


def unmarked(text: Column) -> Column:
    numbers = F.regexp_replace(text, f'"?{MARK}n([0-9.eE+-]+)"?', "$1")
    return F.when(text.contains(MARK), F.regexp_replace(numbers, f"{MARK}u", MARK)).otherwise(text)


def written_field(text: Column, name: Column | str) -> Column:
    """Marked text of a field of a marked object; of equal keys the last one counts, as in VARIANT."""
    key = F.replace(F.lit(name) if isinstance(name, str) else name, F.lit(MARK), F.lit(f"{MARK}u"))
    named = F.map_values(F.map_filter(F.from_json(text, TEXT_MAP), lambda k, _: k == key))
    return F.try_element_at(named, F.lit(-1))


def written_at(text: Column, steps: Column) -> Column:
    """JSON under an array of field names of a marked object, as it was written but for blanks; strings lose their quotes."""
    return unmarked(F.aggregate(steps, text, lambda node, step: written_field(node, step)))
