"""Rules from a declared record schema: types, required fields, ranges, enumerations, known fields.

Records are checked as they were written, before any type is put on them: a reader with a schema
turns text in a numeric field into a null, and with it a broken record into a good one. A record is
held as a variant, so every rule is a column expression and each broken rule names its field.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from stridelake.operators import quality

BROKEN = "record is no JSON object"
# Kinds that a variant names for the JSON values that a type takes.
_WHOLE = r"^(BIGINT|INT|SMALLINT|TINYINT)$"
_NUMBER = r"^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL.*)$"


@dataclass(frozen=True)
class Spec:
    """What records must look like. Fields are named by their path, with dots."""

    schema: T.StructType
    required: tuple[str, ...] = ()
    ranges: dict[str, tuple[float | None, float | None]] = field(default_factory=dict)
    enums: dict[str, tuple[str, ...]] = field(default_factory=dict)
    exclusive: tuple[tuple[str, ...], ...] = ()  # at most one of each group may be there
    closed: bool = True  # no fields but those of the schema


def _kind(kind: T.DataType) -> tuple[str, str]:
    """The name of a type in messages, and the pattern of the variants that it takes."""
    match kind:
        case T.StructType():
            return "an object", "^OBJECT"
        case T.ArrayType():
            return "a list", "^ARRAY"
        case T.BooleanType():
            return "true or false", "^BOOLEAN$"
        case T.LongType() | T.IntegerType() | T.ShortType():
            return "a whole number", _WHOLE
        case T.DoubleType() | T.FloatType() | T.DecimalType():
            return "a number", _NUMBER
        case T.TimestampType():
            return "a time", "^STRING$"
        case T.DateType():
            return "a date", "^STRING$"
        case T.StringType():
            return "text", "^STRING$"
    raise TypeError(f"no rule for {kind}")


class Compiler:
    """Column rules over a variant column."""

    def __init__(self, spec: Spec, record: str = "record") -> None:
        self.spec, self.record = spec, F.col(record)

    def _at(self, path: str) -> Column:
        steps = "".join(f"['{step}']" for step in path.split("."))
        return F.try_variant_get(self.record, f"${steps}", "variant")

    def _there(self, path: str) -> Column:
        found = self._at(path)
        return found.isNotNull() & ~F.is_variant_null(found)

    def _text(self, path: str) -> Column:
        return F.try_variant_get(self._at(path), "$", "string")

    def _types(self, schema: T.StructType, prefix: str) -> list[quality.Rule]:
        rules = []
        for f in schema:
            path = prefix + f.name
            name, pattern = _kind(f.dataType)
            fits = F.schema_of_variant(self._at(path)).rlike(pattern)
            if isinstance(f.dataType, T.TimestampType):
                fits &= F.try_to_timestamp(self._text(path)).isNotNull()
            elif isinstance(f.dataType, T.DateType):
                fits &= self._text(path).try_cast("date").isNotNull()
            rules.append((f"{path} is not {name}", ~self._there(path) | fits))
            if isinstance(f.dataType, T.ArrayType):
                _, inner = _kind(f.dataType.elementType)
                items = F.try_variant_get(self._at(path), "$", "array<variant>")
                rules.append((
                    f"{path} holds other items",
                    ~self._there(path) | F.coalesce(F.forall(
                        items, lambda x: F.schema_of_variant(x).rlike(inner)), F.lit(True))))
            elif isinstance(f.dataType, T.StructType):
                rules += self._types(f.dataType, f"{path}.")
        if self.spec.closed:
            inner = self.record if not prefix else self._at(prefix[:-1])
            keys = F.json_object_keys(F.to_json(inner))
            known = F.array(*[F.lit(f.name) for f in schema])
            rules.append((
                f"{prefix.rstrip('.') or 'record'} has unknown fields",
                F.coalesce(F.size(F.array_except(keys, known)) == 0, F.lit(True))))
        return rules

    def rules(self) -> list[quality.Rule]:
        spec = self.spec
        made = self._types(spec.schema, "")
        made += [(f"{path} is required", self._there(path)) for path in spec.required]
        for path, (low, high) in spec.ranges.items():
            value = F.try_variant_get(self._at(path), "$", "double")
            within = F.lit(True)
            if low is not None:
                within &= value >= low
            if high is not None:
                within &= value <= high
            made.append((f"{path} is out of range", value.isNull() | within))
        for path, values in spec.enums.items():
            made.append((
                f"{path} is unknown", ~self._there(path) | self._text(path).isin(*values)))
        for group in spec.exclusive:
            held = sum((self._there(path).cast("int") for path in group), F.lit(0))
            made.append((f"more than one of {', '.join(group)}", held <= 1))
        return made


def check(records: DataFrame, spec: Spec, text: str = "text") -> DataFrame:
    """``records`` with ``violations``: the broken rules of the JSON object in ``text``."""
    # As an element of a list the variant is made once a record. A filter on the violations would
    # else take it along, and parse the text again for every rule.
    parsed = records.withColumn("record", F.explode(F.array(F.try_parse_json(text))))
    is_object = F.coalesce(
        F.schema_of_variant("record").startswith("OBJECT"), F.lit(False))
    checked = quality.apply_rules(
        parsed, [(BROKEN, is_object)], Compiler(spec).rules())
    return checked.drop("record")


def read_checked(
    records: DataFrame, spec: Spec, text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """The good records with the columns of the schema, and the bad ones with ``violations``.

    Columns beside ``text`` are kept in both.
    """
    good, bad = quality.split_ok(check(records, spec, text))
    others = [c for c in records.columns if c != text]
    typed = F.from_json(F.col(text), spec.schema)
    return good.select(*others, typed.alias("_row")).select(*others, "_row.*"), bad
