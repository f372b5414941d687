"""File sources (S1-S6, S9-S11): JSON/CSV/Parquet with declared schemas,
recursive ingest with rejects, partitioned-table scans, purchase-order
documents in both formats.  Every reader returns a lazy DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from replenix import DEFAULT_PERIOD, schemas
from replenix.functions.exprs import file_stem, parent_folder
from replenix.session import scratch_path
from replenix.sinks.writers import remove_folder
from replenix.sources import json_split

CORRUPT = json_split.CORRUPT

# fixed values: accepted input extensions (matched case-insensitively)
EXTENSIONS = (".json", ".csv", ".parquet")


def read_json(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """JSON files: a top-level array gives one row per element, an object one row."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line, values typed by the declared schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_any(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Dispatch on the file extension (S1-S3); anything else is an error."""
    low = path.lower()
    if low.endswith(".json"):
        return read_json(spark, path, schema)
    if low.endswith(".csv"):
        return read_csv(spark, path, schema)
    if low.endswith(".parquet"):
        return spark.read.schema(schema).parquet(path)
    raise ValueError(f"unsupported input format: {path}")


def glob_any_case(ext: str) -> str:
    """'.json' -> '*.[jJ][sS][oO][nN]' (case-insensitive suffix match as a glob)."""
    return "*." + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in ext.lstrip("."))


# a whole folder name that is a date (or key=date); the last one of a path counts, so that a dated
# export folder above the feed is not taken for the data's date; ++ gives nothing back, as no shorter name precedes a =
DATE_FOLDER = r"^.*/(?:[^/=]++=)?(\d{4}-\d{2}-\d{2})/"


def store_of(path, date_pattern: str = DATE_FOLDER) -> Column:
    """The store a file was delivered by: the first folder below the date folder (``store=X`` or
    ``X``), or the file's stem when it lies in the date folder itself (S11)."""
    below = F.regexp_replace(path, date_pattern, "")
    first = F.regexp_replace(F.regexp_extract(below, r"^([^/]+)/", 1), "^store=", "")
    return F.when(below.contains("/"), first).otherwise(file_stem(path))


# a longer line is not read as one: its file is cut by its brackets (json_split)
LONGEST_LINE = 64 << 20


def _lines(spark: SparkSession, roots: list[str], ext: str) -> DataFrame:
    """Text lines of the files: value (trimmed), path, octets with the line end, and ``at``, which orders them within
    a file.  Lines beyond ``LONGEST_LINE`` are left out."""
    text = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob_any_case(ext))
            .option("lineSep", "\n").option("mapreduce.input.linerecordreader.line.maxlength", LONGEST_LINE).text(roots))
    return text.select(
        F.btrim("value", F.lit(" \t\r")).alias("value"), F.col("_metadata.file_path").alias("path"),
        (F.octet_length("value") + 1).cast("long").alias("octets"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id")).alias("at"))


def _complete(value) -> Column:
    """A line that is a JSON value of its own."""
    v = F.col(value)
    return (v.startswith("{") & v.endswith("}")) | (v.startswith("[") & v.endswith("]"))


def _heads(lines: DataFrame) -> DataFrame:
    """One row per file: path, the place of its first line and the signs it begins and ends with (``signs``, see
    ``_is_document``), how many lines, how many of them complete JSON values, its octets.

    Whole numbers alone are compared and added per line, so that the lines are hashed and not sorted: a line's signs
    are the last digits of its number, and the byte ranges of a file, whose order the numbers do not tell, meet after."""
    some, value = F.length("value") > 0, F.col("value")
    signs = value.startswith("[").cast("long") + 2 * value.startswith("{").cast("long") + 4 * value.endswith("]").cast("long")
    ranges = (lines.select("path", "octets", F.col("at").getField("block").alias("block"), some.alias("some"),
                           _complete("value").alias("complete"), (F.col("at").getField("id") * 8 + signs).alias("numbered"))
              .groupBy("path", "block").agg(F.min(F.when(F.col("some"), F.col("numbered"))).alias("numbered"),
                                            F.count_if("some").alias("n"), F.count_if("complete").alias("n_complete"),
                                            F.sum("octets").alias("octets")))
    first = F.when(F.col("numbered").isNotNull(), F.struct("block", "numbered"))
    files = ranges.groupBy("path").agg(F.min(first).alias("first"), F.sum("n").alias("n"),
                                       F.sum("n_complete").alias("n_complete"), F.sum("octets").alias("octets"))
    return files.select("path", F.struct(F.col("first.block").alias("block"), F.shiftright("first.numbered", 3).alias("id")).alias("first_at"),
                        F.col("first.numbered").bitwiseAND(F.lit(7)).alias("signs"), "n", "n_complete", "octets")


def _is_document() -> Column:
    """A file holding one JSON value over several lines, told by its lines: an array opened but not
    closed on the first line, or an object without any complete line.  All else is read line by line."""
    array, object_, closed = (F.col("signs").bitwiseAND(F.lit(k)) > 0 for k in (1, 2, 4))
    return ((array & ((F.col("n") == 1) | ~closed))
            | (object_ & (F.col("n_complete") == 0) & (F.col("n") > 1)))


def _headers(lines: DataFrame, staging: str) -> DataFrame:
    """A written table, one row per file: path, the place of its first line, and that line (``first``)."""
    found = _written(_heads(lines).select("path", "first_at"), f"{staging}/places")
    first = lines.join(found, "path").where("at = first_at").select("path", "first_at", F.col("value").alias("first"))
    return _written(first, f"{staging}/heads")


def _json_kinds(spark: SparkSession, roots: list[str], ext: str) -> DataFrame:
    """Per file: path, and whether it is one document: by its lines, or because one of them is too long to be read (the
    lines that were read do not make up the file; a byte order mark is no part of them)."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob_any_case(ext))
              .load(roots).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
              .where("size > 0"))
    whole = (F.coalesce("octets", F.lit(0)) - F.col("size")).isin(0, 1, -3, -2)
    return listed.join(_heads(_lines(spark, roots, ext)), "path", "left").select(
        "path", (~whole | F.coalesce(_is_document(), F.lit(False))).alias("document"))


def _json_by_content(spark: SparkSession, roots: list[str], schema: T.StructType, ext: str, staging: str,
                     named: dict[str, Column]) -> DataFrame:
    """Array files and JSON Lines files side by side, told apart per file by a table (path, kind) that meets the lines:
    no file name goes through the driver, and no record of a JSON Lines file is lost to an array reader.  ``named``,
    what a file's path says of its records, is in that table: found once per file."""
    kinds = _written(_json_kinds(spark, roots, ext).withColumns(named), f"{staging}/kinds")
    lines = _lines(spark, roots, ext).where(F.length("value") > 0).join(kinds.where("not document"), "path")
    value = F.col("value")
    elements = F.when(value.startswith("["), F.from_json("value", "array<string>"))
    records = lines.select(*named, F.explode(F.coalesce(elements, F.array("value"))).alias("record"))
    if not kinds.where("document").isEmpty():
        documents = json_split.json_records(spark, roots, glob_any_case(ext), kinds.where("document"), f"{staging}/documents")
        records = records.union(documents.join(kinds, "path").select(*named, "record"))
    return json_split.parsed(records, schema)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _reader(spark: SparkSession, schema: T.StructType):
    return (spark.read.schema(T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())]))
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT))


def _with_path(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name) for f in schema.fields], CORRUPT, F.col("_metadata.file_path").alias("_path"))


def _nothing(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType()),
                                                                   T.StructField("_path", T.StringType())]))


_END = "\x01"   # put behind a CSV line, so that its place tells how many values the line has


def _values(line, width: int) -> tuple[Column, Column]:
    """(values of a CSV line, how many; below 0 where the line does not end as it should)."""
    names = [f"c{k}" for k in range(width + 1)]
    row = F.from_csv(F.concat(line, F.lit("," + _END)), ", ".join(f"{n} string" for n in names))
    values = F.array(*[row[n] for n in names])
    return values, F.array_position(values, _END) - 1


def _csv_by_header(spark: SparkSession, roots: list[str], schema: T.StructType, ext: str, staging: str,
                   named: dict[str, Column]) -> DataFrame:
    """CSV files whose header names the columns, in any order and with further ones: a table (path, places of the
    columns, ``named``) meets the lines, and every line is read by the places that its file's header gives.  Lines with
    more or fewer values than the header, values that are not of their type, and all lines of a file that lacks a
    declared column are rejected."""
    lines = _lines(spark, roots, ext).where(F.length("value") > 0)
    heads = _headers(lines, staging)
    width = heads.agg(F.max(F.size(F.split("first", ",")))).first()[0] or 1   # of the widest header
    header, n = _values(F.col("first"), width)
    names = F.transform(F.slice(header, 1, F.greatest(n, F.lit(0)).cast("int")), lambda v: F.btrim(v, F.lit(" \ufeff")))
    absent = F.array_except(F.array(*[F.lit(f.name) for f in schema.fields]), "_names")
    places = [f"_at{k}" for k in range(len(schema.fields))]   # in the header, from 0; -1 where it lacks the column
    files = heads.select("path", "first_at", names.alias("_names")).withColumns(named).select(
        "path", "first_at", *named, F.size("_names").alias("_width"), (F.size(absent) > 0).alias("_lacks"),
        *[(F.array_position("_names", f.name) - 1).cast("int").alias(p) for p, f in zip(places, schema.fields)])
    files = _written(files, f"{staging}/files")
    values, n = _values(F.col("value"), width)
    rows = (lines.join(files, "path").where("at <> first_at or _lacks")
            .select(*named, "value", *places, "_width", "_lacks", values.alias("_values"), n.alias("_n")))
    rows = rows.select(*named, "value", *[F.get("_values", F.col(p)).alias(f.name) for p, f in zip(places, schema.fields)],
                       ((F.col("_n") == F.col("_width")) & ~F.col("_lacks")).alias("_whole"))
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    right = F.col("_whole")
    for name, value in typed.items():
        right = right & (F.col(name).isNull() | value.isNotNull())
    return rows.select(*[v.alias(n) for n, v in typed.items()], F.when(~right, F.col("value")).alias(CORRUPT), *named)


def ingest_directory(spark: SparkSession, root: str | list[str], schema: T.StructType, fmt: str = "json",
                     period: str = DEFAULT_PERIOD, date_pattern: str = DATE_FOLDER, multi_line: bool | None = None,
                     ext: str | None = None, staging: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Walk ``root`` recursively and read every ``.<fmt>`` file.

    Returns (rows, rejects).  Rows carry the period taken from the folder path (``date_pattern``'s
    first group; the folder date, never the event time) and ``source_file`` (file stem).  Records that
    do not parse, and records of files without a date folder, go to ``rejects`` with their file instead
    of failing the run or vanishing.

    JSON files are read as their content asks (``multi_line`` None): documents (an array, or one
    pretty-printed object) in byte ranges, JSON Lines line by line; True or False skips that look.  CSV
    columns are found by header name.  Parquet files need no rejects.

    The files are parsed once and the parse is staged as a Parquet table in the shared checkpoint
    folder (``staging``; compressed and columnar, unlike an RDD checkpoint): rows and rejects are two
    reads of the same result, and Spark does not allow a raw scan that only asks for the corrupt-record
    column.  The caller removes the folder when both have been used.
    """
    roots = [root] if isinstance(root, str) else list(root)
    suffix = ext or "." + fmt
    staged = staging or scratch_path(spark, "ingest")
    look = staged.rstrip("/") + "-look"   # tables (path, layout) of the files, and pieces of documents
    if fmt not in ("json", "csv", "parquet"):
        raise ValueError(f"unsupported input format: {fmt}")

    def of_path(path: str) -> dict[str, Column]:
        return {period: F.regexp_extract(path, date_pattern, 1), "source_file": file_stem(path)}

    if not roots:
        df = _nothing(spark, schema)
    elif fmt == "json" and multi_line is None:
        df = _json_by_content(spark, roots, schema, suffix, f"{look}/json", of_path("path"))
    elif fmt == "json":
        df = _with_path(_reader(spark, schema).option("recursiveFileLookup", True)
                        .option("pathGlobFilter", glob_any_case(suffix)).option("multiLine", multi_line).json(roots), schema)
    elif fmt == "csv":
        df = _csv_by_header(spark, roots, schema, suffix, f"{look}/csv", of_path("path"))
    else:
        read = (spark.read.schema(schema).option("recursiveFileLookup", True)
                .option("pathGlobFilter", glob_any_case(suffix)).parquet(*roots))
        df = _with_path(read.withColumn(CORRUPT, F.lit(None).cast("string")), schema)
    if "_path" in df.columns:
        df = df.withColumns(of_path("_path"))
    df = df.select(*[f.name for f in schema.fields], CORRUPT, period, "source_file")
    df.write.mode("overwrite").parquet(staged)
    remove_folder(spark, look)
    df = spark.read.schema(df.schema).parquet(staged)
    dated = F.col(period) != ""
    good = df.where(F.col(CORRUPT).isNull() & dated).drop(CORRUPT)
    record = F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*[f.name for f in schema.fields])))
    bad = df.where(F.col(CORRUPT).isNotNull() | ~dated).select(period, "source_file", record.alias("record"))
    return good, bad


def ingest_any(spark: SparkSession, root: str | list[str], schema: T.StructType, period: str = DEFAULT_PERIOD,
               date_pattern: str = DATE_FOLDER) -> tuple[DataFrame, DataFrame]:
    """One walk over mixed formats (S4): ``.json``, ``.csv`` and ``.parquet`` files together.

    A file with any other extension is a reject of its own (its name as the record)."""
    found = [ingest_directory(spark, root, schema, fmt=e[1:], period=period, date_pattern=date_pattern)
             for e in EXTENSIONS if _any_file(spark, root, e)]
    p = F.col("path")
    others = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
              .where(~F.lower(p).rlike("(" + "|".join(e.replace(".", r"\.") for e in EXTENSIONS) + ")$"))
              .select(F.regexp_extract(p, date_pattern, 1).alias(period), file_stem(p).alias("source_file"),
                      p.alias("record")))
    rows, rejects = None, others
    for good, bad in found:
        rows = good if rows is None else rows.unionByName(good)
        rejects = rejects.unionByName(bad)
    if rows is None:
        rows = _nothing(spark, schema).drop(CORRUPT, "_path").withColumns({period: F.lit(""), "source_file": F.lit("")})
    return rows, rejects


def _any_file(spark: SparkSession, root, ext: str) -> bool:
    return not (spark.read.format("binaryFile").option("recursiveFileLookup", True)
                .option("pathGlobFilter", glob_any_case(ext)).load(root).select("path").isEmpty())


def list_files(spark: SparkSession, root: str | list[str], ext: str, period: str = DEFAULT_PERIOD,
               date_pattern: str = DATE_FOLDER) -> DataFrame:
    """The files below ``root`` with the extension ``ext`` (case-insensitive) -> period
    (from the folder path), file_stem, store (see ``store_of``), path (S11).  Only the listing is
    used: the file contents are never read (the content column is pruned)."""
    roots = [root] if isinstance(root, str) else list(root)
    if not roots:
        return spark.createDataFrame([], f"`{period}` string, file_stem string, store string, path string")
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
          .option("pathGlobFilter", glob_any_case(ext)).load(roots))
    p = F.col("path")
    return df.select(F.regexp_extract(p, date_pattern, 1).alias(period), file_stem(p).alias("file_stem"),
                     store_of(p, date_pattern).alias("store"), p)


def read_partition(spark: SparkSession, base: str, period: str, value, schema: T.StructType | None = None
                   ) -> DataFrame:
    """Scan of a Hive-style ``period=value`` table restricted to one value.

    The filter is on the partition column, so only that folder is listed and read.
    """
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(base).where(F.col(period) == F.lit(value))


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Master data from a relational database (S7), read in ``num_partitions`` parallel slices of a
    numeric key between ``lower`` and ``upper``.  Needs the driver's JDBC jar on the classpath."""
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=properties)
    if None in (lower, upper, num_partitions):
        raise ValueError("a sliced read needs lower, upper and num_partitions")
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                           numPartitions=num_partitions, properties=properties)


# --- purchase-order documents (S9) ----------------------------------------------

def parse_order_documents(texts: DataFrame, value: str = "value", folder: str = "date_folder",
                          stem: str = "file_stem", doc_schema: T.StructType = schemas.ORDER_DOCUMENT
                          ) -> DataFrame:
    """Purchase-order JSON text in either format -> one row per ordered item.

    * object with ``items`` (current): ids and dates from the document, falling
      back to the file name / folder;
    * top-level list of {sku, quantity} (legacy): supplier = file name,
      dates = folder, costs 0.
    The format is told by the first non-blank character (an object parsed with
    the list schema would give one all-null row).  Output columns: date,
    data_date, supplier_id, supplier_name, sku, product_name, quantity,
    unit_cost, total_cost, order_total_cost.
    """
    item_t = doc_schema["items"].dataType.elementType
    legacy_t = T.ArrayType(T.StructType([T.StructField("sku", item_t["sku"].dataType),
                                         T.StructField("quantity", item_t["quantity"].dataType)]))
    is_list = F.ltrim(F.col(value)).startswith("[")
    doc = F.from_json(F.col(value), doc_schema)
    legacy = F.from_json(F.col(value), legacy_t)
    zero = F.lit(0.0)

    def cur_item(it):
        return F.struct(F.coalesce(it["sku"], F.lit("")).alias("sku"),
                        F.coalesce(it["product_name"], it["sku"], F.lit("")).alias("product_name"),
                        F.coalesce(it["quantity"], F.lit(0)).alias("quantity"),
                        F.coalesce(it["unit_cost"], zero).alias("unit_cost"),
                        F.coalesce(it["total_cost"], zero).alias("total_cost"))

    def old_item(it):
        return F.struct(F.coalesce(it["sku"], F.lit("")).alias("sku"),
                        F.coalesce(it["sku"], F.lit("")).alias("product_name"),
                        F.coalesce(it["quantity"], F.lit(0)).alias("quantity"),
                        zero.alias("unit_cost"), zero.alias("total_cost"))

    sup = F.coalesce(doc["supplier_id"], F.col(stem))
    parsed = texts.select(
        F.when(is_list, F.col(folder)).otherwise(F.coalesce(doc["order_date"], F.col(folder))).alias("date"),
        F.when(is_list, F.col(folder)).otherwise(F.coalesce(doc["data_date"], F.col(folder))).alias("data_date"),
        F.when(is_list, F.col(stem)).otherwise(sup).alias("supplier_id"),
        F.when(is_list, F.col(stem)).otherwise(F.coalesce(doc["supplier_name"], sup)).alias("supplier_name"),
        F.when(is_list, zero).otherwise(F.coalesce(doc["total_estimated_cost"], zero)).alias("order_total_cost"),
        F.when(is_list, F.transform(legacy, old_item)).otherwise(F.transform(doc["items"], cur_item)).alias("_items"))
    return parsed.select("date", "data_date", "supplier_id", "supplier_name", "order_total_cost",
                         F.explode("_items").alias("_it")).select(
        "date", "data_date", "supplier_id", "supplier_name", "_it.sku", "_it.product_name", "_it.quantity",
        "_it.unit_cost", "_it.total_cost", "order_total_cost")


def split_order_documents(spark: SparkSession, path: str, doc_schema: T.StructType = schemas.ORDER_DOCUMENT
                          ) -> tuple[DataFrame, DataFrame]:
    """Purchase orders below ``path`` (recursive, ``.json`` only) -> (items, rejects).

    Read by content: the record lines this package writes (``order`` and ``item`` rows), one document
    per line, or one pretty-printed document per file as exported per supplier; a document spread over
    lines is put together again per file.  Text that is none of them goes to ``rejects`` (date_folder,
    file_stem, record).
    """
    lines = _lines(spark, [path], ".json").where(F.length("value") > 0)
    kinds = _heads(lines).select("path", _is_document().alias("document"))
    lines = lines.join(kinds, "path")
    whole = (lines.where("document").groupBy("path")
             .agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("l"))
             .select("path", F.array_join(F.transform("l", lambda x: x["value"]), "\n").alias("value")))
    single = lines.where("not document").select("path", "value")
    kind = F.get_json_object("value", "$.record")
    texts = single.where(kind.isNull()).union(whole)
    p = F.col("path")
    texts = texts.select("value", parent_folder(p).alias("date_folder"), file_stem(p).alias("file_stem"))
    broken = ~F.coalesce(F.json_object_keys("value").isNotNull() | F.json_array_length("value").isNotNull(), F.lit(False))
    records = single.where(kind.isNotNull()).select(F.from_json("value", schemas.ORDER_RECORD).alias("r")).select("r.*")
    order = (records.where("record = 'order'")
             .select("data_date", "supplier_id", F.col("total_estimated_cost").alias("order_total_cost")))
    own = (records.where("record = 'item'").join(order, ["data_date", "supplier_id"], "left")
           .select(F.col("order_date").alias("date"), "data_date", "supplier_id", "supplier_name", "sku", "product_name",
                   "quantity", "unit_cost", "total_cost", "order_total_cost"))
    items = parse_order_documents(texts.where(~broken), doc_schema=doc_schema).unionByName(own)
    return items, texts.where(broken).select("date_folder", "file_stem", F.col("value").alias("record"))


def read_order_documents(spark: SparkSession, path: str, doc_schema: T.StructType = schemas.ORDER_DOCUMENT
                         ) -> DataFrame:
    """The items of all purchase orders below ``path``, in any layout (see ``split_order_documents``)."""
    return split_order_documents(spark, path, doc_schema)[0]
