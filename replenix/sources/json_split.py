"""JSON documents of any size read in many tasks (S1, S9): one array of objects, one object, or objects in a row.

A file is cut by Spark's text reader at every ``}``, in byte ranges like any splittable text, so no task reads a whole
file and no code point is ever cut (``}`` is one byte that no other character contains).  What a piece does to the
state of the text, being inside a string and how deep in brackets, depends only on whether it begins inside a string;
both answers are measured per piece and summed up within its range.  A prefix sum over the few ranges of a file then
gives every range its true beginning, and so every piece its own.  A record ends at a bracket outside strings that
leads back to the depth of the records: one in a file that begins with ``[``, none otherwise.

Pieces of one record lie side by side; records within a range are put together there, those that a range end cuts in
one small aggregate.  The text is written once, as read, and dealt by ranges once; all that is found out about the
ranges before comes from numbers beside it.  A range has a bounded number of pieces, and tasks as many as their number
and their text ask for, so no task sorts more when the files grow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from replenix.session import scratch_path

CORRUPT = "_corrupt_record"
_BLANK = r"[\s\uFEFF]"
_STRINGS = r'(?s)"[^"]*("|$)'
RANGE_BITS = 14         # a range has 2 ** RANGE_BITS pieces at most
TASK_PIECES = 1 << 19   # pieces, and bytes of text, that a task sorts, about
TASK_BYTES = 32 << 20


def _earlier(partition: list[str], order: str):
    return Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _count(text, signs: str) -> Column:
    """How often any of ``signs`` stands in the text."""
    return F.length(text) - F.length(F.translate(text, signs, ""))


def _pieces(spark: SparkSession, roots: list[str], glob: str | None, only: DataFrame | None) -> DataFrame:
    """What lies between the ``}`` of the files, in ranges (``block``: byte range and part of it); ``id`` orders the pieces
    of a range.

    Of every piece: its first sign, the parity of its quotes, and the change of depth when it begins outside (d0) or
    inside (d1) a string, without the bracket that ends it.  What is outside in one case is inside in the other."""
    read = spark.read.option("recursiveFileLookup", True).option("lineSep", "}")
    text = (read.option("pathGlobFilter", glob) if glob else read).text(roots)
    file = F.col("_metadata")
    pieces = text.select(file.file_path.alias("path"), file.file_block_start.alias("start"), file.file_size.alias("size"),
                         F.monotonically_increasing_id().alias("id"), "value")
    if only is not None:
        pieces = pieces.join(only.select("path"), "path", "left_semi")
    # escaped signs neither open nor close anything
    plain = F.when(F.col("value").contains("\\"), F.regexp_replace("value", r"(?s)\\(.|$)", "")).otherwise(F.col("value"))
    pieces = pieces.withColumn("plain", plain).withColumn("outside", F.regexp_replace("plain", _STRINGS, ""))
    sign = F.regexp_extract("value", rf"(?s)^{_BLANK}*(.)", 1)
    return pieces.select(
        "path", F.struct("start", F.shiftright("id", RANGE_BITS).alias("part")).alias("block"), "size", "id", "value",
        F.octet_length("value").cast("long").alias("octets"), F.nullif(sign, F.lit("")).alias("sign"),
        (_count(F.col("plain"), '"') % 2).alias("quotes"), _depth("outside").alias("d0"), (_depth("plain") - _depth("outside")).alias("d1"))


def _depth(text: str) -> Column:
    return _count(F.col(text), "{[") - _count(F.col(text), "]")


def _inside(entry, *toggles: str) -> Column:
    """1 inside a string, 0 outside, after so many quotes from ``entry`` on."""
    return sum((F.col(t) for t in toggles), entry) % 2


def _summed(pieces: DataFrame) -> DataFrame:
    """Adds ``before``, the parity of the quotes before a piece in its range, and the depth behind it, counted from the
    range's beginning, when the range begins outside (depth0) or inside (depth1) a string."""
    def change(entry: int) -> Column:
        return (F.when(_inside(F.lit(entry), "before") == 0, F.col("d0")).otherwise(F.col("d1"))
                - F.when(_inside(F.lit(entry), "before", "quotes") == 0, 1).otherwise(0))

    up_to = Window.partitionBy("path", "block").orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = pieces.withColumn("before", F.coalesce(F.sum("quotes").over(_earlier(["path", "block"], "id")), F.lit(0)) % 2)
    return before.select(*pieces.columns, "before", F.sum(change(0)).over(up_to).alias("depth0"), F.sum(change(1)).over(up_to).alias("depth1"))


def _ranges(summed: DataFrame) -> DataFrame:
    """Per range: whether it begins inside a string, at which depth, the depth of its file's records, and the file's
    last piece, if no bracket ends it."""
    ranges = summed.groupBy("path", "block").agg(
        F.max("size").alias("size"), (F.sum("octets") + F.count("*")).alias("octets"), (F.sum("quotes") % 2).alias("quotes"),
        F.max_by("depth0", "id").alias("total0"), F.max_by("depth1", "id").alias("total1"),
        F.min_by("sign", "id").alias("sign"), F.max("id").alias("last"))
    file = Window.partitionBy("path")
    earlier = _earlier(["path"], "block")
    whole = file.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranges = ranges.withColumn("inside", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    change = F.when(F.col("inside") == 0, F.col("total0")).otherwise(F.col("total1"))
    # every piece is followed by its bracket but, maybe, the last one; a byte order mark (3 bytes) is not read
    beyond = F.sum("octets").over(file) - F.max("size").over(file)
    open_end = beyond.isin(1, -2) & (F.col("block") == F.max("block").over(file))
    return ranges.select("path", "block", "inside", F.coalesce(F.sum(change).over(earlier), F.lit(0)).alias("depth"),
                         F.when(F.first("sign", ignorenulls=True).over(whole) == "[", 1).otherwise(0).alias("base"),
                         F.when(open_end, F.col("last")).alias("open"))


def _cut(summed: DataFrame, ranges: DataFrame) -> DataFrame:
    """Adds ``last``, whether no bracket follows the piece, and ``cut``, 1 where a record ends."""
    joined = summed.join(ranges, ["path", "block"])
    last = F.coalesce(F.col("id") == F.col("open"), F.lit(False))
    depth = F.col("depth") + F.when(F.col("inside") == 0, F.col("depth0")).otherwise(F.col("depth1"))
    ends = ~last & (_inside(F.col("inside"), "before", "quotes") == 0) & (depth == F.col("base"))
    return joined.withColumns({"last": last, "cut": ends.cast("int")})


def _put_together(order: str) -> Column:
    return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, "text"))), lambda p: p["text"]), "").alias("text")


def _staged(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def json_records(spark: SparkSession, roots: str | list[str], glob: str | None = None, only: DataFrame | None = None,
                 staging: str | None = None) -> DataFrame:
    """(path, record): the text of every record of the JSON documents below ``roots``.

    ``glob`` filters file names; ``only`` is a table whose ``path`` column names the files to take.  Text that belongs
    to no whole record (a document that was cut short) comes as a record of its own, which does not parse.  Pieces are
    staged below ``staging`` (default: a new folder of the shared scratch space).
    """
    staging = staging or scratch_path(spark, "json-pieces")
    pieces = _staged(_pieces(spark, [roots] if isinstance(roots, str) else list(roots), glob, only), f"{staging}/pieces")
    size = pieces.agg(F.count("*").alias("n"), F.coalesce(F.sum("octets"), F.lit(0)).alias("octets")).first()
    tasks = 1 + max(size.n // TASK_PIECES, size.octets // TASK_BYTES)

    def dealt(*columns: str) -> DataFrame:
        return pieces.select("path", "block", "id", "quotes", "d0", "d1", *columns).repartition(tasks, "path", "block")

    ranges = _staged(_ranges(_summed(dealt("size", "octets", "sign"))), f"{staging}/ranges")
    cuts = _cut(_summed(dealt()), ranges).groupBy("path", "block").agg(F.sum("cut").alias("cuts"))
    # the range whose last record goes on in this one
    chain = F.last(F.when(F.col("cuts") > 0, F.col("block")), ignorenulls=True).over(_earlier(["path"], "block"))
    ranges = _staged(ranges.join(cuts.withColumn("chain", chain), ["path", "block"]), f"{staging}/cuts")

    text = F.when(F.col("last"), F.col("value")).otherwise(F.concat("value", F.lit("}")))
    k = F.coalesce(F.sum("cut").over(_earlier(["path", "block"], "id")), F.lit(0))
    numbered = _cut(_summed(dealt("value")), ranges).select("path", "block", "id", text.alias("text"), "cuts", "chain", k.alias("k"))

    def runs(those: str) -> DataFrame:
        return numbered.where(those).groupBy("path", "block", "k", "chain").agg(_put_together("id"))

    whole = runs("k > 0 and k < cuts").select("path", "text")
    parts = runs("k = 0 or k = cuts").withColumn("chain", F.when(F.col("k") > 0, F.col("block")).otherwise(F.col("chain")))
    record = F.regexp_replace("text", rf"^({_BLANK}|[,\[\]])+", "")
    return (whole.union(parts.groupBy("path", "chain").agg(_put_together("block")).select("path", "text"))
            .select("path", record.alias("record")).where(F.length("record") > 0))


def parsed(records: DataFrame, schema: T.StructType, record: str = "record") -> DataFrame:
    """The records as columns, with the text of those that do not parse in the corrupt-record column; other columns stay."""
    whole = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    fields = F.from_json(record, whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    others = [c for c in records.columns if c != record]
    return records.select(*others, fields.alias("_fields")).select(*others, "_fields.*")


def read_json_split(spark: SparkSession, path: str | list[str], schema: T.StructType, glob: str | None = None) -> DataFrame:
    """The records of JSON documents with the columns of ``schema``, read in byte ranges; damaged ones are null."""
    return parsed(json_records(spark, path, glob), schema).select([f.name for f in schema.fields])
