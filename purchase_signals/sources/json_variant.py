"""JSON lines of any shape: parsed once into a variant, typed by what all of them hold."""

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean_json_line

LINE, DOCUMENT = "line", "_document"


def variant_lines(spark: SparkSession, path) -> DataFrame:
    """``line`` and ``_document`` of the lines of JSON array files that are neither blank nor brackets.

    ``line`` is stripped of white space and one comma at its end, ``_document`` a variant,
    null where the line is not exactly one JSON object.
    """
    line = clean_json_line(F.col("value"))
    # What is cleaned above is not cleaned once more for the condition if it shows without.
    kept = F.startswith(F.ltrim("value"), F.lit("{")) | ~line.isin("", "[", "]")
    return parsed_lines(spark.read.text(path).where(kept).select(line.alias(LINE)))


def parsed_lines(lines: DataFrame) -> DataFrame:
    """``lines`` with the variant ``_document`` of their cleaned ``line``."""
    # Parsing stops at the end of the first value and ignores what follows. Inside an array
    # with a closing null, anything but a single whole value changes the number of elements
    # or breaks the array.
    held = lines.withColumn("_held", F.try_parse_json(F.concat(F.lit("["), LINE, F.lit(",null]"))))
    item = [F.try_variant_get("_held", f"$[{i}]", "variant") for i in range(3)]
    single = F.startswith(LINE, F.lit("{")) & F.is_variant_null(item[1]) & item[2].isNull()
    return held.withColumn(DOCUMENT, F.when(single, item[0])).drop("_held")


# A place within documents: names of fields, and ITEM for the items of a list.
ITEM = None
Place = tuple[str | None, ...]


def _storable(kind: T.DataType, place: Place, mixed: dict[Place, T.DataType]) -> T.DataType:
    """A type that all values at ``place`` fit, whatever files they are written to.

    Where values come in several types it is the one that ``mixed`` has; places it lacks are
    added, as text.
    """
    if isinstance(kind, T.VariantType):
        return mixed.setdefault(place, T.StringType())
    if isinstance(kind, T.StructType) and kind.fields:
        return T.StructType(
            [T.StructField(f.name, _storable(f.dataType, (*place, f.name), mixed)) for f in kind]
        )
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_storable(kind.elementType, (*place, ITEM), mixed))
    if isinstance(kind, T.DecimalType) and kind.scale:
        return T.DoubleType()
    # Objects without fields and fields that are always null.
    return T.StringType() if isinstance(kind, T.StructType | T.NullType) else kind


def _is_number(value: Column, place: Place) -> Column:
    """Whether all that ``value`` holds at ``place`` are numbers, if anything."""
    if not place:
        kind = F.schema_of_variant(value)
        return F.coalesce(F.rlike(kind, F.lit("^(BIGINT|FLOAT|DOUBLE|DECIMAL.*|VOID)$")), F.lit(True))
    if place[0] is not ITEM:
        return _is_number(_field(value, place[0]), place[1:])
    items = F.try_variant_get(value, "$", "array<variant>")
    return F.coalesce(F.forall(items, lambda item: _is_number(item, place[1:])), F.lit(True))


def inferred_schema(parsed: DataFrame) -> tuple[T.StructType, list[str]]:
    """The fields of all documents, and the names of those that come in several types.

    One aggregation: tasks send a schema each. A field whose values do not have one type is
    kept as JSON text, also inside objects and lists; whole numbers and fractions are one
    type. A field that is always null is text. Where types differ numbers of several kinds are told from
    the rest: in the same aggregation where a first look at some documents shows the place, else
    by reading the documents once more.
    """
    # Null documents count for nothing in any of these; a filter on them would parse lines twice.
    schema = F.schema_of_variant_agg(DOCUMENT)

    def alike(places: list[Place]) -> list[Column]:
        return [F.bool_and(_is_number(F.col(DOCUMENT), p)) for p in places]

    looked = list(_mixed(parsed.limit(LOOK).agg(schema).first()[0])[1])
    text, *numbers = parsed.agg(schema, *alike(looked)).first()
    fields, mixed = _mixed(text)
    numbers = dict(zip(looked, numbers, strict=True))
    missed = [p for p in mixed if p not in numbers]
    if missed:
        numbers |= dict(zip(missed, parsed.agg(*alike(missed)).first(), strict=True))
    mixed |= {p: T.DoubleType() for p in mixed if numbers[p]}
    texts = [p for p, kind in mixed.items() if isinstance(kind, T.StringType)]
    names = [".".join("[]" if n is ITEM else n for n in p) for p in texts]
    return (_storable(fields, (), mixed) if fields.names else fields), names


# Documents of a task that are looked at before all of them are.
LOOK = 1_000


def _mixed(text: str) -> tuple[T.StructType, dict[Place, T.DataType]]:
    """The fields that a variant's schema names, and the places where types differ."""
    if not text.startswith("OBJECT<") or text == "OBJECT<>":
        return T.StructType([]), {}
    # Names in back quotes may hold anything.
    ddl = re.sub(r"`(?:[^`]|``)*`|OBJECT<>|OBJECT<", lambda m: _DDL.get(m[0], m[0]), text)
    fields, mixed = T.DataType.fromDDL(ddl), {}
    _storable(fields, (), mixed)
    return fields, mixed


_DDL = {"OBJECT<>": "VOID", "OBJECT<": "STRUCT<"}


def _field(value: Column, name: str) -> Column:
    """The variant of one field; null where the object does not have it."""
    for quote in "'\"":
        if quote not in name:
            return F.try_variant_get(value, f"$[{quote}{name}{quote}]", "variant")
    return F.try_variant_get(value, "$", "map<string,variant>")[name]


def _cast(value: Column, field: T.StructField) -> Column:
    """One field in its declared type, without its variant in between where a path can name it."""
    kind = field.dataType.simpleString()
    for quote in "'\"":
        if quote not in field.name:
            return F.try_variant_get(value, f"$[{quote}{field.name}{quote}]", kind)
    return F.try_variant_get(_field(value, field.name), "$", kind)


def _is_misfit(value: Column, kind: T.DataType) -> Column:
    """Whether ``value`` holds anything, itself or within, that cannot be cast to ``kind``."""
    there = value.isNotNull() & ~F.coalesce(F.is_variant_null(value), F.lit(True))
    if isinstance(kind, T.StringType):
        return F.lit(False)
    if isinstance(kind, T.ArrayType):
        items = F.try_variant_get(value, "$", "array<variant>")
        within = F.exists(items, lambda item: _is_misfit(item, kind.elementType))
        return there & F.coalesce(within, F.lit(True))
    if isinstance(kind, T.StructType):
        is_object = F.startswith(F.schema_of_variant(value), F.lit("OBJECT<"))
        within = F.lit(False)
        for field in kind:
            within |= _is_misfit(_field(value, field.name), field.dataType)
        return there & (~is_object | within)
    return there & F.try_variant_get(value, "$", kind.simpleString()).isNull()


def typed_fields(schema: T.StructType) -> tuple[dict[str, Column], dict[str, Column]]:
    """For each field its value in the declared type, and whether there is one that does not fit.

    A value is cast where it can be. One that cannot be cast comes as null, as do absent
    fields; only the former is a misfit, also inside objects and lists. Text fits everything.
    """
    values, misfits = {}, {}
    for field in schema:
        values[field.name] = _cast(F.col(DOCUMENT), field)
        if not isinstance(field.dataType, T.StringType):
            held = _field(F.col(DOCUMENT), field.name)
            misfits[field.name] = _is_misfit(held, field.dataType)
            if not isinstance(field.dataType, T.ArrayType | T.StructType):
                # Only what comes as null is looked at again.
                misfits[field.name] = values[field.name].isNull() & misfits[field.name]
    return values, misfits
