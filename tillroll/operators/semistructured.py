"""JSON text as typed columns for what most rows have, and the rest as it is."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_SHARE = 0.1
MOST_FIELDS = 64

#: Types that a field can be given, from narrow to wide, and what they take; text takes texts.
_WIDTH = {"boolean": {"BOOLEAN"}, "bigint": {"BIGINT"}, "double": {"BIGINT", "DOUBLE"}}


@dataclass(frozen=True)
class Field:
    name: str
    kind: str


def _parsed(rows: DataFrame, column: str) -> DataFrame:
    return rows.withColumn("_variant", F.try_parse_json(F.col(column)))


def field_types(rows: DataFrame, column: str) -> DataFrame:
    """``field``, ``type``, ``rows``: the top-level fields of the objects in ``column`` and the
    types that they have, with how many rows have each. Decimals count as DOUBLE, objects and
    arrays as such, JSON null as VOID."""
    variants = _parsed(rows, column).select("_variant").where("_variant IS NOT NULL")
    entries = variants.lateralJoin(
        rows.sparkSession.tvf.variant_explode(F.col("_variant").outer())
    ).where(F.col("key").isNotNull())
    kind = F.schema_of_variant("value")
    coarse = (
        F.when(kind.startswith("DECIMAL") | (kind == "FLOAT"), "DOUBLE")
        .when(kind.startswith("OBJECT"), "OBJECT")
        .when(kind.startswith("ARRAY"), "ARRAY")
        .otherwise(kind)
    )
    return entries.groupBy(F.col("key").alias("field"), coarse.alias("type")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def choose_fields(
    rows: DataFrame, column: str, least_share: float = LEAST_SHARE, most: int = MOST_FIELDS
) -> list[Field]:
    """The fields worth a column: those that at least ``least_share`` of the readable rows have,
    the most frequent ``most`` of them, each with the narrowest type that takes the most values.
    Only fields above the share reach the driver, at most ``1 / least_share`` times
    the fields of a row, and never more than ``most`` names."""
    readable = _parsed(rows, column).where("_variant IS NOT NULL").count()
    types = field_types(rows, column)
    frequent = (
        types.groupBy("field")
        .agg(
            F.sum("rows").alias("n"),
            F.map_from_entries(F.collect_list(F.struct("type", "rows"))).alias("kinds"),
        )
        .where(F.col("n") >= F.lit(max(1.0, least_share * readable)))
        # Fields without a name, or with both quotes in it, have no path and stay in the rest.
        .where("field <> '' AND NOT (contains(field, chr(39)) AND contains(field, chr(34)))")
        .orderBy(F.desc("n"), "field")
        .limit(most)
    )
    chosen = []
    for row in frequent.collect():
        chosen.append(Field(row["field"], _kind_for(row["kinds"])))
    return chosen


def _kind_for(kinds: dict[str, int]) -> str:
    """The type that takes most values; numbers are only whole if all of them are."""
    taken = {kind: sum(kinds.get(t, 0) for t in takes) for kind, takes in _WIDTH.items()}
    taken["string"] = kinds.get("STRING", 0)
    most = max(taken.values())
    return next(kind for kind, n in taken.items() if n == most) if most else "string"


def shred(rows: DataFrame, column: str, fields: list[Field]) -> DataFrame:
    """``rows`` without ``column``, with a typed column for each field, ``rest`` and
    ``unreadable``.

    ``rest`` maps the names of all other fields, and of those whose value does not have the
    column's type, to their JSON text (texts without quotes); null where nothing is left. JSON
    null counts as a missing value of a field. ``unreadable`` is true where the text is not JSON
    or no object; then the typed columns are null. A null text is readable and has no fields.
    All of this is in the scan's own stage: nothing is shuffled.
    """
    is_object = F.schema_of_variant("_variant").startswith("OBJECT")
    parsed = _parsed(rows, column).withColumn(
        "_entries",
        F.when(is_object, F.from_json(F.col(column), "map<string,string>")),
    )
    typed = []
    for field in fields:
        path = _path(field.name)
        value = F.try_variant_get("_variant", path, "variant")
        shape = F.schema_of_variant(value)
        if field.kind == "string":
            fits = shape == "STRING"
        elif field.kind == "double":
            fits = shape.isin("BIGINT", "DOUBLE", "FLOAT") | shape.startswith("DECIMAL")
        else:
            fits = shape == field.kind.upper()
        typed.append((field, F.when(fits, F.try_variant_get("_variant", path, field.kind))))
    known = {field.name: f"_typed{i}" for i, (field, _) in enumerate(typed)}
    parsed = parsed.withColumns({f"_typed{i}": c for i, (_, c) in enumerate(typed)})
    left = F.map_filter(
        "_entries", lambda name, text: text.isNotNull() & _unplaced(name, known)
    )
    return parsed.select(
        *(f"`{c}`" for c in rows.columns if c != column),
        *(F.col(alias).alias(name) for name, alias in known.items()),
        F.when(F.size(left) > 0, left).alias("rest"),
        (F.col(column).isNotNull() & ~F.coalesce(is_object, F.lit(False))).alias("unreadable"),
    )


def _path(name: str) -> str:
    """The path to a top-level field; paths know no escapes, so one kind of quote must do."""
    quote = '"' if "'" in name else "'"
    if not name or quote in name:
        raise ValueError(f"no path leads to the field {name!r}")
    return f"$[{quote}{name}{quote}]"


def _unplaced(name, known: dict[str, str]):
    """Whether a field has no column, or its column could not take the value."""
    test = F.lit(True)
    for field, alias in known.items():
        test = F.when(name == field, F.col(alias).isNull()).otherwise(test)
    return test
