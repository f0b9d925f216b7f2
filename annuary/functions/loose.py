"""Values as they come from a free source: numbers as text, single values in place of lists, texts in place of records.

The columns are variants, which keep the type a value was written in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from annuary.functions.people import coerce_year


def kind_of(v: Column) -> Column:
    """The sort of a variant: STRING, OBJECT, ARRAY, VOID for a null that was written, or a number's type."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def field(v: Column, name: str) -> Column:
    """The field of an object as a variant; null if it is missing or v is no object."""
    return F.try_variant_get(v, f"$.{name}", "variant")


def text(v: Column) -> Column:
    """The value as text; what is no scalar as JSON. Null for a missing or null value."""
    return F.try_variant_get(v, "$", "string")


def flag(v: Column) -> Column:
    """True or false, also as text or 1 and 0; what is neither, as any other number, counts as false."""
    return F.coalesce(text(v).try_cast("boolean"), F.lit(False))


def year(v: Column) -> Column:
    """A number without its fraction; of a text the first four digits, or else the first two, expanded; else null."""
    return F.when(kind_of(v) == "STRING", coerce_year(text(v))).otherwise(F.try_variant_get(v, "$", "int"))


def items(v: Column) -> Column:
    """array<variant> of a list without its null entries; a single value counts as a list of one.

    A missing value is an empty list, a null that was written stays null.
    """
    kind = kind_of(v)
    many = F.try_variant_get(v, "$", "array<variant>")
    kept = F.filter(many, lambda x: x.isNotNull() & ~F.is_variant_null(x))
    return F.when(v.isNull(), F.array().cast("array<variant>")).when(kind == "ARRAY", kept).when(kind != "VOID", F.array(v))


def records(v: Column, bare: str, fields: dict[str, Callable[[Column], Column]]) -> Column:
    """array<struct> of a list of records; an entry that is no record fills the field named by bare, as text.

    Empty if v is missing, null for null. fields gives, for each field of the struct, how its value is read.
    """

    def record(x: Column) -> Column:
        whole = kind_of(x) == "OBJECT"
        pairs = []
        for name, read in fields.items():
            value = F.when(whole, read(field(x, name))).otherwise(F.lit(False) if read is flag else F.lit(None))
            pairs += [F.lit(name), F.coalesce(value, F.when(~whole, text(x))) if name == bare else value]
        return F.named_struct(*pairs)

    return F.transform(items(v), record)


def texts(v: Column) -> Column:
    """array<string> of a list of texts; of a record the values that say something, joined by '; '.

    Empty if v is missing, null for null. The values of a record come in the order of their names.
    """

    def one(x: Column) -> Column:
        values = F.map_values(F.try_variant_get(x, "$", "map<string, string>"))
        said = F.filter(values, lambda s: s.isNotNull() & ~s.isin("", "0", "false"))
        return F.when(kind_of(x) == "OBJECT", F.array_join(said, "; ")).otherwise(text(x))

    return F.transform(items(v), one)
