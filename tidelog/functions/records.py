"""Column expressions that shape change records and messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.functions.patterns import ROW_EVENTS, _as_column


def classify_op(event_type: Column | str = "event_type", query: Column | str | None = None) -> Column:
    """INSERT, UPDATE or DELETE for row events, QUERY where a statement is given, else null."""
    kind = _as_column(event_type)
    op = F.when(F.lit(False), F.lit(None).cast("string"))
    for label, events in ROW_EVENTS.items():
        op = op.when(kind.isin(*events), label)
    if query is not None:
        op = op.when(_as_column(query).isNotNull(), "QUERY")
    return op


# Operation codes.
OPERATION_CODES = {
    "INSERT": 1,
    "DELETE": 2,
    "UPDATE": 3,
    "UPSERT": 4,
    "SELECT FOR UPDATE": 5,
    "BEFORE UPDATE": 6,
    "AFTER UPDATE": 7,
}


def op_code(label: Column | str) -> Column:
    codes = F.create_map(*[F.lit(x) for pair in OPERATION_CODES.items() for x in pair])
    return F.coalesce(codes[_as_column(label)], F.lit(-1))


def op_label(code: Column | str) -> Column:
    labels = F.create_map(*[F.lit(x) for label, n in OPERATION_CODES.items() for x in (n, label)])
    return labels[_as_column(code)]


def op_label_from_text(code: Column | str) -> Column:
    """Label of a code held as text; text that is no number fails the job."""
    text = _as_column(code)
    number = text.try_cast("int")
    return F.when(
        text.isNotNull() & number.isNull(),
        F.raise_error(F.concat(F.lit("operation code must be numeric but was: "), text)).cast("string"),
    ).otherwise(op_label(number))


# Column types with the Spark type their values are read as.
MYSQL_TYPES = {
    "decimal": "decimal(38,18)",
    "tinyint": "int",
    "smallint": "int",
    "mediumint": "int",
    "float": "float",
    "double": "double",
    "timestamp": "timestamp",
    "bigint": "bigint",
    "int": "int",
    "date": "date",
    "time": "string",
    "datetime": "timestamp",
    "year": "int",
    "varchar": "string",
    "char": "string",
    "bit": "boolean",
    "enum": "int",
    "set": "bigint",
    "tinyblob": "binary",
    "mediumblob": "binary",
    "longblob": "binary",
    "blob": "binary",
    "text": "string",
    "tinytext": "string",
    "mediumtext": "string",
    "longtext": "string",
    "unsupported": "string",
}


def normalize_type(name: Column | str) -> Column:
    """Type name without its arguments; a name outside the table becomes ``unsupported``."""
    base = F.lower(F.substring_index(_as_column(name), "(", 1))
    return F.when(base.isin(*MYSQL_TYPES), base).otherwise("unsupported")


def spark_type(mysql_type: str) -> str:
    """Spark type of a column type; decimals keep the precision they are declared with, as text beyond 38 digits."""
    base, paren, args = mysql_type.lower().partition("(")
    if base == "decimal":
        # without arguments it is ten whole digits
        digits = [int(a) for a in args.split(")")[0].split(",")] if paren else [10]
        return f"decimal({digits[0]},{digits[1] if len(digits) > 1 else 0})" if digits[0] <= 38 else "string"
    return MYSQL_TYPES.get(base, "string")


def cast_image(image: Column | str, columns: list[tuple[str, str]]) -> Column:
    """Typed struct of a text image, one field per ``(column, type)``; ``image_misfits`` names the values that do not fit and are null here."""
    values = _as_column(image)
    return F.struct(*[values[name].try_cast(spark_type(kind)).alias(name) for name, kind in columns])


def image_misfits(image: Column | str, columns: list[tuple[str, str]]) -> Column:
    """Names of the columns whose text is there but does not fit their type."""
    values = _as_column(image)
    wrong = [F.when(values[name].isNotNull() & values[name].try_cast(spark_type(kind)).isNull(), F.lit(name)) for name, kind in columns]
    return F.array_compact(F.array(*wrong)) if wrong else F.array().cast("array<string>")


def zip_columns(included: Column | str, names: Column | str, values: Column | str) -> Column:
    """Map of the included columns; ``values`` is dense, so the n-th value belongs to the n-th included ordinal."""
    ordinals, columns = _as_column(included), _as_column(names)
    picked = F.transform(
        ordinals, lambda i: F.coalesce(F.get(columns, i), F.concat(F.lit("col_"), i.cast("string")))
    )
    return F.map_from_arrays(picked, _as_column(values))


def ordinals_of_mask(mask: Column | str, n_columns: Column | int) -> Column:
    """Ordinals of the set bits, for tables of up to 63 columns."""
    m = _as_column(mask)
    n = F.lit(n_columns) if isinstance(n_columns, int) else n_columns
    ordinals = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(ordinals, lambda i: F.getbit(m, i) == 1)


def before_after(
    op: Column | str,
    names: Column | str,
    included_before: Column | str,
    before: Column | str,
    included: Column | str,
    after: Column | str,
) -> tuple[Column, Column]:
    """(Data, OldData): inserts have only Data, deletes only OldData, updates both."""
    kind = _as_column(op)
    data = F.when(kind.isin("INSERT", "UPDATE"), zip_columns(included, names, after))
    old = F.when(kind.isin("UPDATE", "DELETE"), zip_columns(included_before, names, before))
    return data, old


# Names of the record and message fields.
HEADER_FIELDS = (
    "Type",
    "Database",
    "Table",
    "Offset",
    "ServerId",
    "Timestamp",
    "BinLogFilename",
    "BinLogPosition",
    "GTID",
    "SeqNo",
)


def message_envelope(data: Column | str | None = "Data") -> Column:
    """JSON text of a message; a record without images has no Data member."""
    fields = [F.col(c) for c in ("Type", "Database", "Table", "Timestamp")]
    if data is not None:
        fields.append(_as_column(data).alias("Data"))
    return F.to_json(F.struct(*fields))


def message_key(database: Column | str = "Database", table: Column | str = "Table") -> Column:
    return F.concat(_as_column(database), F.lit("."), _as_column(table))


def message_time(millis: Column | str = "Timestamp") -> Column:
    return F.timestamp_millis(F.coalesce(_as_column(millis).cast("bigint"), F.lit(0).cast("bigint")))


# Prefix of header attributes that stay out of listings.
RESERVED_PREFIX = "_."


def attribute_values(attributes: Column | str) -> Column:
    return F.map_filter(_as_column(attributes), lambda k, _: ~k.startswith(RESERVED_PREFIX))


def attribute_names(attributes: Column | str) -> Column:
    return F.map_keys(attribute_values(attributes))


def _open_name(name: str) -> str:
    if name.startswith(RESERVED_PREFIX):
        raise ValueError(f"header attributes cannot start with {RESERVED_PREFIX!r}")
    return name


def get_attribute(attributes: Column | str, name: str) -> Column:
    return _as_column(attributes)[_open_name(name)]


def delete_attribute(attributes: Column | str, name: str) -> Column:
    _open_name(name)
    return F.map_filter(_as_column(attributes), lambda k, _: k != name)


def set_attribute(attributes: Column | str, name: str, value: Column) -> Column:
    return F.map_concat(delete_attribute(attributes, name), F.create_map(F.lit(name), value))


def lineage(stage: str, source_id: Column | str, path: Column | str, tracking_id: Column | str) -> dict[str, Column]:
    """New stage path, tracking id and previous tracking id after a record passed ``stage``."""
    new_path = F.concat_ws(":", _as_column(path), F.lit(stage))
    old_id = _as_column(tracking_id)
    return {
        "stage_path": new_path,
        "tracking_id": F.concat(_as_column(source_id), F.lit("::"), new_path),
        "previous_tracking_id": old_id,
    }
