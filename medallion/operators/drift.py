"""Messages without a given schema: one is inferred, grows with new fields, and messages that contradict it are set aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from medallion.functions.columns import require_absent

#: Stands for a schema where documents bring their own.
EVOLVE = "evolve"


def infer_schema(decoded: DataFrame, document: str = "document") -> T.StructType:
    """The fields of ``VARIANT`` documents, one aggregate over all of them.

    Whole numbers are ``BIGINT`` (longer ones ``DECIMAL(38,0)``), other numbers ``DOUBLE``. A field that is always null is left out
    until it has a value; one that has several types within these documents stays ``VARIANT``.
    """
    found = decoded.agg(F.schema_of_variant_agg(document).alias("s")).first().s
    if not found.startswith("OBJECT<"):
        return T.StructType([])
    return _plain(T._parse_datatype_string(found.replace("OBJECT<", "STRUCT<"))) or T.StructType([])


def _plain(kind: T.DataType) -> T.DataType | None:
    """The type documents are kept in; None for nothing but nulls."""
    if isinstance(kind, T.StructType):
        fields = [(f.name, _plain(f.dataType)) for f in kind.fields]
        fields = [T.StructField(n, k) for n, k in fields if k is not None]
        return T.StructType(fields) if fields else None
    if isinstance(kind, T.ArrayType):
        inner = _plain(kind.elementType)
        return T.ArrayType(inner) if inner is not None else None
    if isinstance(kind, T.DecimalType):
        return T.DoubleType() if kind.scale else T.DecimalType(38, 0)
    if isinstance(kind, T.FloatType):
        return T.DoubleType()
    return None if isinstance(kind, T.NullType) else kind


def merge_schemas(stored: T.StructType, found: T.StructType) -> T.StructType:
    """``stored`` with the fields it lacks; its own types stay."""
    fields = {f.name: f.dataType for f in stored.fields}
    for f in found.fields:
        have = fields.get(f.name)
        if isinstance(have, T.StructType) and isinstance(f.dataType, T.StructType):
            fields[f.name] = merge_schemas(have, f.dataType)
        else:
            fields.setdefault(f.name, f.dataType)
    return T.StructType([T.StructField(n, k) for n, k in fields.items()])


def conform(decoded: DataFrame, schema: T.StructType, document: str = "document", valid: str = "valid", drift: str = "drift") -> DataFrame:
    """Documents as structs of ``schema``. A message with a value of another type is not valid; ``drift`` names the fields.

    An absent field and a JSON null are null. Elements of arrays are cast.
    """
    require_absent(decoded, drift)
    wrong: list[Column] = []
    made = _read(F.col(document), schema, "$", wrong)
    names = F.array_compact(F.array(*wrong)) if wrong else F.array().cast("array<string>")
    found = decoded.withColumn(drift, F.when(F.col(valid), F.array_join(names, ", ")))
    clean = F.col(valid) & (F.col(drift) == "")
    return found.withColumns({document: F.when(clean, made), valid: F.coalesce(clean, F.lit(False)), drift: F.nullif(drift, F.lit(""))})


def _read(document: Column, kind: T.StructType, path: str, wrong: list[Column]) -> Column:
    columns = []
    for f in kind.fields:
        here = path + _step(f.name)
        value = F.try_variant_get(document, here, "variant")
        present = value.isNotNull() & ~F.is_variant_null(value)
        if isinstance(f.dataType, T.StructType):
            ok = F.schema_of_variant(value).startswith("OBJECT")
            made = F.when(present & ok, _read(document, f.dataType, here, wrong))
        else:
            made = value if isinstance(f.dataType, T.VariantType) else F.try_variant_get(document, here, f.dataType.simpleString())
            ok = _fits(F.schema_of_variant(value), f.dataType, made)
        wrong.append(F.when(present & ~ok, F.lit(here)))
        columns.append(made.alias(f.name))
    return F.struct(*columns)


def _fits(kind: Column, wanted: T.DataType, made: Column) -> Column:
    """Whether a value of JSON type ``kind`` is one of ``wanted`` without loss."""
    if isinstance(wanted, T.VariantType):
        return F.lit(True)
    if isinstance(wanted, T.ArrayType):
        return kind.startswith("ARRAY") & made.isNotNull()
    if isinstance(wanted, T.DoubleType):
        return kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$")
    if isinstance(wanted, T.DecimalType):
        return kind.rlike(r"^(BIGINT|DECIMAL\(\d+,0\))$")
    return kind == wanted.simpleString().upper()


def _step(name: str) -> str:
    if "'" not in name:
        return f"['{name}']"
    if '"' in name:
        raise ValueError(f"a field name with both kinds of quotes cannot be read: {name}")
    return f'["{name}"]'
