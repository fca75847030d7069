"""Column expressions for reading loosely typed JSON held as VARIANT.

Two kinds of "missing" are kept apart throughout:
  * an absent key is SQL NULL,
  * a present JSON null is a VARIANT that is not SQL NULL.
Fallback chains go by truthiness, so 0, false, "", [] and {} fall through as well.

`Fields` is the fast way to read several keys of one object: their texts are extracted in
one projection, and everything else is decided on plain strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How the falsy JSON values other than "" and null print. The same text can
# also be a (truthy) JSON string, which only the quotes of its JSON form tell apart.
_FALSY_TEXTS = ("0", "0.0", "false", "[]", "{}")


def field(node: Column, name: str) -> Column:
    """Child by key: SQL NULL when absent or when `node` is not an object."""
    return F.try_variant_get(node, f"$['{name}']", "variant")


def field_text(node: Column, name: str) -> Column:
    return F.try_variant_get(node, f"$['{name}']", "string")


def has_items(node: Column, name: str) -> Column:
    """The child is a list with at least one element."""
    return F.try_variant_get(node, f"$['{name}'][0]", "variant").isNotNull()


def text(node: Column) -> Column:
    """Scalar as text, container as compact JSON, JSON null as NULL."""
    return F.try_variant_get(node, "$", "string")


def number(node: Column) -> Column:
    """Numbers, numeric text and booleans as double; anything else is NULL."""
    return F.try_variant_get(node, "$", "double")


def flag(node: Column) -> Column:
    return F.try_variant_get(node, "$", "boolean")


def elements(node: Column) -> Column:
    """array<variant> when `node` is a list, else NULL."""
    return F.try_variant_get(node, "$", "array<variant>")


def members(node: Column) -> Column:
    """map<string,variant> when `node` is an object, else NULL."""
    return F.try_variant_get(node, "$", "map<string,variant>")


def field_elements(node: Column, name: str) -> Column:
    return F.try_variant_get(node, f"$['{name}']", "array<variant>")


def field_members(node: Column, name: str) -> Column:
    return F.try_variant_get(node, f"$['{name}']", "map<string,variant>")


def _is_type(node: Column, prefix: str) -> Column:
    return F.coalesce(F.schema_of_variant(node).startswith(prefix), F.lit(False))


def is_object(node: Column) -> Column:
    """The schema is only worked out for what prints like an object."""
    return F.coalesce(text(node).startswith("{"), F.lit(False)) & _is_type(node, "OBJECT")


def is_text(node: Column) -> Column:
    return _is_type(node, "STRING")


def non_null(node: Column) -> Column:
    """Turn a JSON null into SQL NULL, leave the rest."""
    return F.when(~F.is_variant_null(node), node)


def truthy_text(shown: Column, node: Column) -> Column:
    """`shown`, the text of `node`, if the value is truthy. `node` itself is looked at only
    when the text leaves it open."""
    return F.when(
        shown.isin(*_FALSY_TEXTS), F.when(F.to_json(node).startswith('"'), shown)
    ).when(shown != "", shown)


def is_truthy(node: Column) -> Column:
    return truthy_text(text(node), node).isNotNull()


# Keys searched, in this order, when a label arrives as an object.
LABEL_KEYS = ("value", "name", "id", "text")


def _texts_of(node: Column, path: str, names: tuple[str, ...]) -> Column:
    """Struct with the texts of several children, NULL unless the node is an object."""
    return F.try_variant_get(node, path, f"struct<{','.join(f'{n}:string' for n in names)}>")


def label(node: Column, keys: tuple[str, ...] = LABEL_KEYS) -> Column:
    """A label that is either a scalar or an object carrying it under one of `keys`; an
    object with none of them gives its JSON."""
    inner = _texts_of(node, "$", keys)
    return F.coalesce(*[inner.getField(key) for key in keys], text(node))


class Fields:
    """Children of an object column, each extracted once.

    `df, offer = Fields.read(df, "offer", "offerId", ..., layout=("id", "name"))` adds a
    struct of texts to `df`, read by a single cast, and one for each child that may itself
    be an object; the methods then build expressions over plain strings.
    """

    def __init__(self, node: str, objects: dict[str, tuple[str, ...]]) -> None:
        self.node, self.objects = node, objects

    @classmethod
    def read(
        cls, df: DataFrame, node: str, *names: str, **objects: tuple[str, ...]
    ) -> tuple[DataFrame, Fields]:
        fields = cls(node, objects)
        parent = F.col(node)
        columns = {fields._texts: _texts_of(parent, "$", (*names, *objects))}
        for name, keys in objects.items():
            columns[fields._inner(name)] = _texts_of(parent, f"$['{name}']", keys)
        return df.withColumns(columns), fields

    @property
    def _texts(self) -> str:
        return f"_{self.node}_texts"

    def _inner(self, name: str) -> str:
        return f"_{self.node}_{name}"

    def shown(self, name: str) -> Column:
        return F.col(f"{self._texts}.`{name}`")

    def child(self, name: str) -> Column:
        return field(F.col(self.node), name)

    def truthy(self, *names: str) -> Column:
        """Text of the first child, in the given order, that is present and truthy."""
        return F.coalesce(*[truthy_text(self.shown(n), self.child(n)) for n in names])

    def truthy_number(self, *names: str) -> Column:
        """The first truthy child as a number; a truthy child that is none gives NULL."""
        found = F.lit(None).cast("double")
        for name in reversed(names):
            shown = self.shown(name)
            value = F.when(shown == "true", number(self.child(name))).otherwise(
                shown.try_cast("double")
            )
            is_set = truthy_text(shown, self.child(name)).isNotNull()
            found = F.when(is_set, value).otherwise(found)
        return found

    def flag(self, name: str) -> Column:
        return self.shown(name).try_cast("boolean")

    def is_object(self, name: str) -> Column:
        return F.col(self._inner(name)).isNotNull()

    def label(self, name: str) -> Column:
        """Scalar text, or the first of the object's keys that is not null, or its JSON."""
        inner = [F.col(f"{self._inner(name)}.`{key}`") for key in self.objects[name]]
        return F.coalesce(*inner, self.shown(name))

    def truthy_label(self, name: str) -> Column:
        """Scalar text, or the first truthy of the object's keys, or NULL."""
        found = [
            truthy_text(F.col(f"{self._inner(name)}.`{key}`"), field(self.child(name), key))
            for key in self.objects[name]
        ]
        return F.when(self.is_object(name), F.coalesce(*found)).otherwise(self.shown(name))


def explode_node(df: DataFrame, node: str, key: str, item: str) -> DataFrame:
    """One row per element of a list or member of an object; `key` is NULL for lists."""
    pieces = df.sparkSession.tvf.variant_explode(F.col(node).outer())
    return df.lateralJoin(pieces.select(F.col("key").alias(key), F.col("value").alias(item)))


def objects_in(items: Column) -> Column:
    return F.filter(items, is_object)
