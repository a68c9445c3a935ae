"""Reading JSON text into columns: a quick typed reader and a lenient one.

The typed reader fits well-formed text. The lenient reader gives every leaf as a VARIANT, in
which "missing" (NULL) and "JSON null" differ, and the functions below turn such a node into
a value: a number may be a JSON number, numeric text or a boolean, anything else counts as 0,
and fractions are cut toward zero. A typed schema cannot express that: it turns numeric text
and fractions into NULL.

Lenient expressions are long, and a whole stage compiled around them would grow past what the
JVM optimizes. They therefore run inside ``transform``, and only for texts that need them.
Expressions are SQL text, which Spark takes in one call each; a streaming job builds them anew
for every micro-batch.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"

# Only what standard JSON allows, so that both readers accept the same texts.
STANDARD_JSON = {
    "columnNameOfCorruptRecord": CORRUPT,
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}

# Text read by the typed reader that starts like this may be a number, object or array.
_NOT_PLAIN_TEXT = ", ".join(f"'{c}'" for c in [*"0123456789", "-", "{", "["])

# A node n as BIGINT. NULL when it is missing, or a number that 64 bits cannot hold.
_WHOLE_NUMBER = """
coalesce(
  try_variant_get(n, '$', 'bigint'),
  CASE WHEN n IS NULL THEN NULL
       WHEN NOT isnan(try_variant_get(n, '$', 'double'))
            AND abs(try_variant_get(n, '$', 'double')) >= 9223372036854775808D THEN NULL
       ELSE coalesce(try_cast(try_variant_get(n, '$', 'double') AS BIGINT), 0L) END)
"""

# A node n as text: scalars as they are, JSON null as "null", objects and arrays as "",
# fractions in their shortest form, missing as NULL.
_TEXT = r"""
CASE WHEN n IS NULL THEN NULL
     WHEN is_variant_null(n) THEN 'null'
     WHEN startswith(schema_of_variant(n), 'OBJECT')
          OR startswith(schema_of_variant(n), 'ARRAY') THEN ''
     WHEN startswith(schema_of_variant(n), 'DOUBLE')
          OR (startswith(schema_of_variant(n), 'DECIMAL')
              AND NOT endswith(schema_of_variant(n), ',0)'))
          THEN CAST(try_variant_get(n, '$', 'double') AS STRING)
     ELSE try_variant_get(n, '$', 'string') END
"""


def _marked(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def _loose(kind: T.DataType) -> T.DataType:
    if not isinstance(kind, T.StructType):
        return T.VariantType()
    return T.StructType([T.StructField(f.name, _loose(f.dataType)) for f in kind.fields])


def read_typed(text: str, schema: T.StructType) -> Column:
    """The text as the schema; ``_corrupt`` is set when anything did not fit."""
    return F.from_json(text, _marked(schema), STANDARD_JSON)


def read_loose(text: str, schema: T.StructType) -> Column:
    """The same shape with VARIANT leaves; ``_corrupt`` is set for anything but an object."""
    return F.from_json(text, _marked(_loose(schema)), STANDARD_JSON)


def plain_text(path: str) -> str:
    """True when text from the typed reader was surely a JSON string (or true/false)."""
    return f"substring({path}, 1, 1) NOT IN ({_NOT_PLAIN_TEXT})"


def present(path: str) -> str:
    return f"{path} IS NOT NULL"


def fits_int(number: str) -> str:
    return f"{number} BETWEEN -2147483648 AND 2147483647"


def whole_numbers(*nodes: str) -> Column:
    return F.expr(f"transform(array({', '.join(nodes)}), n -> {_WHOLE_NUMBER})")


def texts(*nodes: str) -> Column:
    return F.expr(f"transform(array({', '.join(nodes)}), n -> {_TEXT})")


def all_of(*conditions: str) -> Column:
    """Every condition holds; an unknown one counts as failed."""
    return F.expr(f"coalesce({' AND '.join(conditions)}, false)")


def computed_once(**columns: str) -> Column:
    """The columns as one generated struct.

    A filter moves below a projection and would repeat the parse there; it does not move
    below a generator. Wrapping the parsed columns in a one-element array keeps the parse at
    once per message.
    """
    fields = ", ".join(f"'{name}', {text}" for name, text in columns.items())
    return F.expr(f"explode(array(named_struct({fields})))")
