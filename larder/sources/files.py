"""Tolerant loading of landing files: good rows out, bad rows reported with reasons.

Every reader takes text columns only and casts afterwards, so a bad value is a
fact about a row and not a failed job, and the same scan serves both halves.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column as Expr, DataFrame, SparkSession, Window, functions as F, types as T

from larder.schemas import TABLES, Column, Table

CORRUPT = "_corrupt_record"
ERRORS = "line_error"
SOURCE = "_source_file"
# where a record is: the byte at which its split of the file starts, and its number among the task's records
BLOCK, ROW = "_block_start", "_row"

# Options of the three file formats and the texts that mean NULL.
CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
}
TSV_OPTIONS = {
    "header": "true",
    "sep": "\t",
    "quote": "",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
}
NULL_TEXTS = ("", "NULL")
DATE_PATTERNS = ("yyyy-M-d", "M/d/yyyy", "d-MMM-yyyy")
_PLAIN_DAY = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"


@dataclass(frozen=True)
class Loaded:
    """Outcome of a load. Both frames are lazy and come from the same scan."""

    good: DataFrame
    rejects: DataFrame


def list_stage(spark: SparkSession, folder: str) -> DataFrame:
    """Files under a landing folder. Contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", "length", "modificationTime")
        .orderBy("path")
    )


def _fields(raw: DataFrame, table: Table, *others: Expr | str) -> DataFrame:
    """The table's text columns, trimmed and with NULL texts applied, and others as they are.

    Two projections, so that a text is trimmed once and not for every use.
    """
    trimmed = raw.withColumns({n: F.trim(n) for n in table.names})
    return trimmed.select(*[F.when(~F.col(n).isin(*NULL_TEXTS), F.col(n)).alias(n) for n in table.names], *others)


def to_date(c: Expr) -> Expr:
    """The day that a text names in one of ``DATE_PATTERNS``; a cast reads the plain form of the first many times faster."""
    return F.coalesce(F.when(c.rlike(_PLAIN_DAY), c.try_cast("date")), *[F.try_to_date(c, p) for p in DATE_PATTERNS])


def typed(column: Column) -> Expr:
    """The stored value of a text column; NULL where the text does not fit the type."""
    c = F.col(column.name)
    if column.type == "date":
        return to_date(c)
    if column.parse_as:
        # through a decimal: whole-number columns round 4.5 to 5 and reject text
        return c.try_cast(column.parse_as).try_cast(column.type)
    return c


def _stored(column: Column) -> str:
    """Where the value is that a column stores: beside its text, which may not fit, or the text itself."""
    return column.name if column.type == "string" else f"_stored_{column.name}"


def _faults(table: Table) -> list[tuple[Expr, str]]:
    """Every possible fault: whether it applies, or NULL, and its message."""
    found = []
    for column in table.columns:
        c = F.col(column.name)
        if column.type != "string":
            found.append((c.isNotNull() & F.col(_stored(column)).isNull(), f"{column.name}: not a valid {column.type}"))
        if column.max_length:
            found.append((F.length(c) > column.max_length, f"{column.name}: longer than {column.max_length}"))
        if column.name in table.primary_key:
            found.append((c.isNull(), f"{column.name}: missing key"))
    return found


def _split(rows: DataFrame, table: Table, broken: Expr | None = None) -> Loaded:
    """Cast the good rows; list raw text and reasons of the others.

    ``broken`` is the reason why a record as a whole cannot be read, else NULL.
    Reasons are listed for rejected rows alone; good rows are told by plain
    conditions on values that were cast once.
    """
    cast = [typed(c).alias(_stored(c)) for c in table.columns if c.type != "string"]
    # as rows of a generator: through a projection, conditions would move down and repeat the casts
    judged = rows.select(F.inline(F.array(F.struct(*rows.columns, *cast))))
    faults = _faults(table)
    wrong = [condition for condition, _ in faults] + ([broken.isNotNull()] if broken is not None else [])
    rejected = F.coalesce(reduce(or_, wrong), F.lit(False))
    good = judged.filter(~rejected).select(*[F.col(_stored(c)).alias(c.name) for c in table.columns])
    reasons = F.array_compact(F.array(*[F.when(condition, F.lit(message)) for condition, message in faults]))
    if broken is not None:
        # the fields of such a record are shifted or missing: report only that
        reasons = F.when(broken.isNotNull(), F.array(broken)).otherwise(reasons)
    as_line = F.to_csv(F.struct(*table.names))
    raw = F.coalesce(F.col(CORRUPT), as_line) if broken is not None else as_line
    places = [c for c in (SOURCE, BLOCK, ROW) if c in rows.columns and ROW in rows.columns]
    rejects = judged.filter(rejected).select(raw.alias("raw"), reasons.alias(ERRORS), *places)
    return Loaded(good, rejects)


def _place() -> list[Expr]:
    return [
        F.col("_metadata.file_path").alias(SOURCE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(ROW),
    ]


def csv_text(reader, path: str, table: Table, place: bool = False, **options) -> DataFrame:
    """All fields as text, trimmed, with NULL texts applied, plus the raw line of broken rows.

    ``reader`` is ``spark.read`` or ``spark.readStream``. Column pruning is off
    for this scan: with it, Spark judges the number of fields on the columns a
    query happens to use. Large files split over many tasks; a feed with line
    breaks inside quotes needs ``multiLine=True``, which reads each file in one
    task.
    """
    schema = T.StructType([*table.text_schema.fields, T.StructField(CORRUPT, T.StringType())])
    raw = (
        reader.options(**(CSV_OPTIONS | options))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", False)
        .schema(schema)
        .csv(path)
    )
    return _fields(raw, table, CORRUPT, *(_place() if place else ()))


def tsv_text(reader, path: str, table: Table, place: bool = False, **options) -> DataFrame:
    """Tab-separated text without quoting; short rows are padded with NULL, long ones cut."""
    raw = reader.options(**(TSV_OPTIONS | options)).schema(table.text_schema).csv(path)
    return _fields(raw, table, *(_place() if place else ()))


def json_text(reader, path: str, table: Table, place: bool = False, **options) -> DataFrame:
    """One object, or one array of objects, per line; fields as text, plus what does not parse.

    Large files split over many tasks. An array over several lines needs
    ``multiLine=True``: each file is then one record, read by one task, and if
    any of it does not parse the whole file is.
    """
    schema = T.StructType([*table.text_schema.fields, T.StructField(CORRUPT, T.StringType())])
    raw = (
        reader.options(**options)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .schema(schema)
        .json(path)
    )
    return raw.select(*table.names, CORRUPT, *(_place() if place else _place()[:1]))


_TEXT = {"csv": csv_text, "tsv": tsv_text, "json": json_text}


def judge_csv(rows: DataFrame, table: Table) -> Loaded:
    return _split(rows, table, F.when(F.col(CORRUPT).isNotNull(), F.lit("wrong number of fields")))


def judge_reviews(rows: DataFrame, table: Table) -> Loaded:
    """Text in a number field counts as missing, timestamps are cut to their day.

    A number too large for its column, a bad date or a missing id still rejects
    the row.
    """

    def number_or_null(name: str) -> Expr:
        return F.when(F.col(name).try_cast("decimal(38,0)").isNotNull(), F.col(name))

    eased = rows.withColumns(
        {
            "review_id": number_or_null("review_id"),
            "rating": number_or_null("rating"),
            "review_date": F.substring("review_date", 1, 10),
        }
    )
    return _split(eased, table)


def judge_json(rows: DataFrame, table: Table) -> Loaded:
    """Numbers written as text are accepted, numeric postal codes become text.

    What does not parse is one reject, with the file it is in; none of its fields is stored.
    """
    broken = F.when(F.col(CORRUPT).isNotNull(), F.concat(F.lit("not valid JSON: "), SOURCE))
    return _split(rows, table, broken)


_JUDGE = {"csv": judge_csv, "tsv": judge_reviews, "json": judge_json}


def _table(table: Table | str) -> Table:
    return TABLES[table] if isinstance(table, str) else table


def text_rows(reader, path: str, table: Table, format: str | None = None, **options) -> DataFrame:
    return _TEXT[format or table.format](reader, path, table, **options)


def judged(rows: DataFrame, table: Table, format: str | None = None) -> Loaded:
    return _JUDGE[format or table.format](rows, table)


def load_csv(spark: SparkSession, path: str, table: Table | str, **options) -> Loaded:
    table = _table(table)
    return judge_csv(csv_text(spark.read, path, table, **options), table)


def load_reviews_tsv(spark: SparkSession, path: str, **options) -> Loaded:
    table = TABLES["product_reviews"]
    return judge_reviews(tsv_text(spark.read, path, table, **options), table)


def load_json(spark: SparkSession, path: str, table: Table | str, **options) -> Loaded:
    table = _table(table)
    return judge_json(json_text(spark.read, path, table, **options), table)


def load(spark: SparkSession, path: str, table: Table | str, **options) -> Loaded:
    """Load a file by the format its table declares."""
    table = _table(table)
    return judged(text_rows(spark.read, path, table, **options), table)


def validate_load(spark: SparkSession, path: str, table: Table | str, **options) -> DataFrame:
    """Dry run: only the rows a load would reject, nothing is stored."""
    return load(spark, path, table, **options).rejects


def validate_located(spark: SparkSession, path: str, table: Table | str, **options) -> DataFrame:
    """Dry run with places: raw, line_error, file, block_start, record_in_block, record of every rejected row.

    ``record`` counts the file's records from 1, the header and blank lines left
    out; with neither line breaks in quotes nor blank lines it is the line less
    the header's. ``block_start`` is the byte at which the record's split
    begins. No order over the whole file is formed: a task numbers its own
    records, and the records of each split are counted, one small row a split.
    """
    table = _table(table)
    rows = text_rows(spark.read, path, table, place=True, **options)
    splits = rows.groupBy(SOURCE, BLOCK).agg(F.count("*").alias("n"), F.min(ROW).alias("first"))
    earlier = Window.partitionBy(SOURCE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    within = F.col(ROW) - F.col("first") + 1
    return (
        judged(rows, table)
        .rejects.join(splits, [SOURCE, BLOCK])
        .select(
            "raw", ERRORS, F.col(SOURCE).alias("file"), F.col(BLOCK).alias("block_start"),
            within.alias("record_in_block"), (within + F.col("before")).alias("record"),
        )
    )


# an element of an array of flat objects: from its bracket up to the next one outside quotes, which end with the line
_ELEMENT = r'\{(?:[^{"]++|"(?:[^"\\\n]++|\\.)*+"?)*+'


def load_json_elements(spark: SparkSession, path: str, table: Table | str, **options) -> Loaded:
    """Files that are arrays of objects, each element judged by itself.

    A file that parses is taken as it is. One that does not is one record, read
    by one task; it is cut into its elements, each of which is parsed, cast and
    taken or rejected alone. What stands between elements and is no object is a
    reject of its own. The reason names the file and the element, from 1.
    """
    table = _table(table)
    rows = json_text(spark.read, path, table, multiLine=True, **options)
    text = F.col(CORRUPT)
    chunks = F.concat(
        F.array(F.regexp_extract(text, r"^[\s\[]*+([^{]*)", 1)), F.regexp_extract_all(text, F.lit(_ELEMENT), F.lit(0))
    )
    pieces = F.flatten(
        F.transform(
            chunks,
            lambda c: F.array(F.regexp_extract(c, r"(?s)^(\{.*\})", 1), F.regexp_replace(c, r"(?s)^\{.*\}", "")),
        )
    )
    bare = F.filter(F.transform(pieces, lambda p: F.regexp_replace(p, r"^[\s,\]]+|[\s,\]]+$", "")), lambda p: p != "")
    # an object of a file that parses is one element without a text, so that one scan serves both kinds
    unparsed = F.when(text.isNull(), F.array(F.lit(None).cast("string"))).otherwise(bare)
    schema = T.StructType([*table.text_schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json("element", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    fields = F.when(F.col("element").isNull(), F.struct(*table.names, CORRUPT)).otherwise(parsed)
    place = F.when(F.col("element").isNotNull(), F.concat_ws(" element ", SOURCE, F.col("at") + 1)).otherwise(F.col(SOURCE))
    elements = (
        rows.select("*", F.posexplode(unparsed).alias("at", "element"))
        # as rows of a generator: a projection would be repeated for every use of a field, and the element parsed each time
        .select(place.alias(SOURCE), F.inline(F.array(fields)))
    )
    return judge_json(elements, table)


def read_text_fields(
    spark: SparkSession, path: str, table: Table | str, format: str | None = None, **options
) -> DataFrame:
    """A file read in place: positional fields under the table's names, all text."""
    table = _table(table)
    return text_rows(spark.read, path, table, format, **options).select(*table.names)


def preview_file(
    spark: SparkSession, path: str, table: Table | str, format: str | None = None, limit: int = 5
) -> DataFrame:
    return read_text_fields(spark, path, table, format).limit(limit)


def reconcile_load(spark: SparkSession, path: str, table: Table | str, loaded: DataFrame, **options) -> DataFrame:
    """One row: records in the file, rows stored, and the difference.

    ``options`` are those of the load, so that both cut the file into the same records.
    """
    table = _table(table)
    # every field takes part, so the reader cannot skip parsing the records
    fields = F.struct(*table.names)
    readable = read_text_fields(spark, path, table, **options).agg(F.count(fields).alias("raw_rows"))
    stored = loaded.agg(F.count("*").alias("loaded_rows"))
    sides = readable.select("raw_rows", F.lit(0).cast("bigint").alias("loaded_rows")).unionByName(
        stored.select(F.lit(0).cast("bigint").alias("raw_rows"), "loaded_rows")
    )
    return sides.agg(F.sum("raw_rows").alias("raw_rows"), F.sum("loaded_rows").alias("loaded_rows")).withColumn(
        "rejected_rows", F.col("raw_rows") - F.col("loaded_rows")
    )
