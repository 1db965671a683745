"""XML dumps: one row element per line, its attributes as columns.

The columns of a dump without a schema are learned by one aggregation over its lines: each attribute
of each row gives a bit for the kind of its value, the bits of a name are united within tasks and then
over them, and the narrowest type that takes all kinds of a name is its column's type. Rows are parsed
to text by Spark's own XML reader and then cast, so that an empty attribute of a column that is not
text is NULL.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string

PREFIX = "_"
# Stands for text and elements inside a row among the names of its attributes.
CONTENT = ">"
# One attribute: its name and its quoted value. Each value is taken whole, so what looks like an
# attribute within a value is none.
ATTRIBUTE = r"""([^\s="'<>/]+)\s*=\s*("[^"]*+"|'[^']*+')"""
# Kinds of values from narrow to wide, each with the pattern that tells it.
KINDS: dict[str, str] = {
    "long": r"[+-]?\d{1,18}",
    "double": r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d{1,3})?",
    "boolean": r"(?i)true|false",
    "date": r"\d{4}-\d{2}-\d{2}",
    "timestamp_ntz": r"\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?",
    "timestamp": r"\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})",
}
EMPTY, TEXT = 1 << len(KINDS), 1 << (len(KINDS) + 1)
PAIRS = "array<struct<name: string, quoted: string>>"
# What a column of several kinds becomes; all other mixtures are text.
MIXED = {
    frozenset(("long", "double")): "double",
    frozenset(("date", "timestamp_ntz")): "timestamp_ntz",
}


def start_tag(line: str | Column, row_tag: str) -> Column:
    """The attributes of a line's row element, as written; empty without such an element."""
    inside = r"""((?:[^"'>]++|"[^"]*+"|'[^']*+')*+)"""
    return F.regexp_extract(line, rf"<{row_tag}(?=[\s/>]){inside}>", 1)


def kind_bit(value: Column) -> Column:
    """A bit for the narrowest kind of a value; a value that only looks like its kind is text."""
    chosen = F.when(value == "", F.lit(EMPTY))
    for place, (kind, pattern) in enumerate(KINDS.items()):
        fits = F.rlike(value, F.lit(rf"^(?:{pattern})$")) & value.try_cast(kind).isNotNull()
        chosen = chosen.when(fits, F.lit(1 << place))
    return chosen.otherwise(F.lit(TEXT))


def attribute_kinds(lines: DataFrame, row_tag: str) -> DataFrame:
    """``name`` and ``kinds``: the united kinds of each attribute of the rows in ``value``.

    Rows with text or elements inside give the name ``>`` as well. Results of parts of a dump can be united again in the same way.
    """
    tag = start_tag("value", row_tag)
    pairs = F.arrays_zip(
        F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(1)).alias("name"),
        F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(2)).alias("quoted"),
    )
    inside = F.when(_has_content("value"), F.array(F.struct(F.lit(CONTENT).alias("name"), F.lit('""').alias("quoted"))))
    found = lines.select(F.inline(F.concat(pairs, F.coalesce(inside, F.array().cast(PAIRS))))).select(
        "name", F.trim(F.expr("substring(quoted, 2, length(quoted) - 2)")).alias("text")
    )
    return found.groupBy("name").agg(F.bit_or(kind_bit(F.col("text"))).alias("kinds"))


def type_of(kinds: int) -> str:
    """The narrowest type that takes values of all given kinds; text where all values are empty."""
    named = frozenset(kind for place, kind in enumerate(KINDS) if kinds & 1 << place)
    if kinds & TEXT or not named:
        return "string"
    return next(iter(named)) if len(named) == 1 else MIXED.get(named, "string")


def _has_content(line: str) -> Column:
    return ~F.rlike(line, F.lit(r"/>\s*$"))


def _names(line: str, row_tag: str) -> Column:
    return F.regexp_extract_all(start_tag(line, row_tag), F.lit(ATTRIBUTE), F.lit(1))


def _row_lines(spark: SparkSession, path: str, root_tag: str, row_tag: str) -> DataFrame:
    """The lines that hold one whole row each; any other line that belongs to a row fails the job."""
    opened = F.regexp_count("value", F.lit(f"<{row_tag}[\\s/>]"))
    whole = F.rlike("value", F.lit(f"^\\s*<{row_tag}[\\s/>].*(/>|</{row_tag}>)\\s*$"))
    other = F.rlike("value", F.lit(f"^\\s*(<[?!].*|</?{root_tag}(\\s[^>]*)?>)?\\s*$"))
    broken = F.raise_error(F.concat(F.lit("not one XML row per line: "), F.substring("value", 1, 200)))
    is_row = (
        F.when((opened == 1) & whole, F.lit(True))
        .when((opened == 0) & other, F.lit(False))
        .otherwise(broken.cast("boolean"))
    )
    return spark.read.text(path).where(is_row)


def _children(spark: SparkSession, path: str, root_tag: str, row_tag: str, known: Mapping) -> list[StructField]:
    """Fields of elements and text inside the rows, as Spark infers them."""
    reader = spark.read.format("xml").option("rootTag", root_tag).option("rowTag", row_tag)
    # Lines outside of rows, such as the root tag, are no rows to learn from.
    whole = reader.option("multiLine", "false").option("mode", "DROPMALFORMED").load(path).schema
    return [field for field in whole.fields if field.name.removeprefix(PREFIX) not in known]


def infer_types(lines: DataFrame, row_tag: str) -> Mapping[str, str]:
    """The type of each attribute's column, by name; as many as the rows have different attributes."""
    return {r["name"]: type_of(r["kinds"]) for r in attribute_kinds(lines, row_tag).orderBy("name").collect()}


def read_xml(
    spark: SparkSession,
    path: str,
    root_tag: str,
    row_tag: str = "row",
    schema: StructType | str | None = None,
    sampling_ratio: float = 1.0,
    row_per_line: bool = True,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Rows of an XML file; attributes become columns named ``_Attribute``.

    Without a schema all rows are read to find one, or a share of them; then a row with an attribute
    which that share did not show fails the job, and so does a value that does not fit what it showed.
    An empty attribute is NULL unless its column is text. With a schema, a value which does not fit its
    type fails the job, unless a column is named which keeps such rows as text. Dumps hold one row per
    line, so a large file is split among tasks; a line which breaks this rule fails the job. Other
    files need ``row_per_line=False``, which reads each file in one task. A dump without rows and
    without a schema has no columns.
    """
    if not row_per_line:
        return _read_whole_files(spark, path, root_tag, row_tag, schema, sampling_ratio, corrupt_column)
    lines = _row_lines(spark, path, root_tag, row_tag)
    options = {"rowTag": row_tag, "mode": "FAILFAST"}
    if corrupt_column is not None:
        options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_column}
    corrupt = [] if corrupt_column is None else [StructField(corrupt_column, StringType())]
    if schema is not None:
        given = _parse_datatype_string(schema) if isinstance(schema, str) else schema
        return lines.select(F.from_xml("value", _ddl([*given.fields, *corrupt]), options).alias("row")).select("row.*")
    sampled = lines
    if sampling_ratio < 1:
        # By a hash, so that a repeated read learns from the same rows.
        sampled = lines.where(F.pmod(F.xxhash64("value"), F.lit(1_000_000)) < int(1_000_000 * sampling_ratio))
    types = dict(infer_types(sampled, row_tag))
    content = types.pop(CONTENT, None) is not None
    children = _children(spark, path, root_tag, row_tag, types) if content else []
    if sampling_ratio < 1:
        seen = F.array(*[F.lit(n) for n in [*types, *[CONTENT] * content]]).cast("array<string>")
        names = F.concat(_names("value", row_tag), F.when(_has_content("value"), F.array(F.lit(CONTENT))).otherwise(F.array()))
        unseen = F.array_except(names, seen)
        error = F.raise_error(F.concat(F.lit("attributes outside the sample: "), F.array_join(unseen, ", ")))
        lines = lines.where(F.when(F.size(unseen) > 0, error.cast("boolean")).otherwise(F.lit(True)))
    fields = [*(StructField(PREFIX + name, StringType()) for name in types), *children, *corrupt]
    if not types and not children:
        # Nothing to parse; the check of the lines still runs.
        return lines.select()
    parsed = lines.select(F.from_xml("value", _ddl(fields), options).alias("row"))
    return parsed.select(
        *(_typed(PREFIX + name, kind) for name, kind in types.items()),
        *(F.col("row").getField(f.name).alias(f.name) for f in [*children, *corrupt]),
    )


def _typed(name: str, kind: str) -> Column:
    text = F.col("row").getField(name)
    return (text if kind == "string" else F.nullif(text, F.lit("")).cast(kind)).alias(name)


def _ddl(fields: list[StructField]) -> str:
    return StructType(fields).toDDL()


def _read_whole_files(spark, path, root_tag, row_tag, schema, sampling_ratio, corrupt_column) -> DataFrame:
    """Each file by Spark's reader, in one task."""
    reader = spark.read.format("xml").option("rootTag", root_tag).option("rowTag", row_tag)
    if schema is None:
        reader = reader.option("samplingRatio", sampling_ratio).option("inferSchema", "true")
    else:
        reader = reader.schema(schema)
    if corrupt_column is None:
        return reader.option("mode", "FAILFAST").load(path)
    return reader.option("columnNameOfCorruptRecord", corrupt_column).load(path)
