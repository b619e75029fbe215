"""Readers for the JSON-lines inputs. Every one has a fixed schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kinseek import schemas

LINE = "struct<file: string, start: bigint, row: bigint>"


def parse_notes(lines: DataFrame, column: str = "value") -> DataFrame:
    """`lines` with the fields of a note in place of `column`, and `parses`.

    A line parses when it is one JSON object and nothing else. A field of another kind than
    the schema's is null; it does not cost the line.
    """
    note = F.from_json(column, schemas.NOTES, {"mode": "PERMISSIVE"})
    others = [c for c in lines.columns if c != column]
    read = lines.select(*others, note.alias("_note"), _one_object(F.col(column)).alias("parses"))
    read = read.withColumn("_note", F.when(F.col("parses"), F.col("_note")))
    return read.select(*others, "_note.*", "parses")


def _one_object(line: Column) -> Column:
    """Whether a line holds a single JSON object.

    The parser stops after the first value, so the line is read as the only element of a
    list and as the only value of an object: what follows the object breaks one or the other.
    """
    strict = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}
    listed = F.from_json(F.concat(F.lit("["), line, F.lit("]")), "array<map<string,string>>", strict)
    held = F.from_json(F.concat(F.lit('{"v":'), line, F.lit("}")), "map<string,string>", strict)
    return F.coalesce((F.size(listed) == 1) & F.get(listed, F.lit(0)).isNotNull() & held.isNotNull(), F.lit(False))


def line_order() -> Column:
    """The place of a line: its file, its split of the file, its row in the split."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )


def _raw_notes(spark: SparkSession, folder: str) -> DataFrame:
    lines = spark.read.option("pathGlobFilter", "*.jsonl").text(folder)
    return parse_notes(lines.select("value", line_order().alias("line")).where("trim(value) <> ''"))


def read_notes(spark: SparkSession, folder: str, with_order: bool = False) -> DataFrame:
    """All *.jsonl directly in `folder`, without the lines that do not parse.

    `with_order` keeps `line`, the order of files and of lines in them, to pass to
    `resolve(order_by=["line"])`. A missing folder raises.
    """
    notes = _raw_notes(spark, folder).where("parses").drop("parses")
    return notes if with_order else notes.drop("line")


def note_line_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Lines read, lines that do not parse, and parsed lines without a uid."""
    good = F.col("parses")
    return _raw_notes(spark, folder).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(~good).alias("bad_lines"),
        F.count_if(good & (F.coalesce("uid", F.lit("")) == "")).alias("without_uid"),
    )


def read_jsonl(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Strict: a line that does not parse raises, blank lines are skipped."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Chunks from one file of any name, or from every chunks.jsonl below a folder.

    `chunk_date` is the yyyy-mm-dd folder a file lies in, empty where there is none. The
    last record of a chunk id wins: latest date, then last file name, then last line.
    """
    reader = spark.read.schema(schemas.CHUNKS).option("mode", "FAILFAST")
    if not _is_file(spark, path):
        reader = reader.option("recursiveFileLookup", True).option(
            "pathGlobFilter", "chunks.jsonl"
        )
    file = F.col("_metadata.file_path")
    return latest_chunks(
        reader.json(path).select(
            "*",
            F.regexp_extract(file, r"/(\d{4}-\d{2}-\d{2})/", 1).alias("chunk_date"),
            line_order().alias("_line"),
        ),
        order=("chunk_date", "_line"),
    ).drop("_line")


def _is_file(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.exists(target) and files.getFileStatus(target).isFile()


def latest_chunks(chunks: DataFrame, order: tuple[str, ...] = ("chunk_date",)) -> DataFrame:
    """One row per chunk id, the last in `order`. Earlier copies are pruned map-side."""
    last_first = Window.partitionBy("chunk_id").orderBy(*[F.col(c).desc() for c in order])
    return (
        chunks.withColumn("_place", F.row_number().over(last_first))
        .where("_place = 1")
        .drop("_place")
    )


def chunk_column(chunks: DataFrame, chunk_id: str, column: str = "text") -> str:
    """One field of one chunk, "" where it is null; an unknown chunk raises KeyError."""
    rows = chunks.where(F.col("chunk_id") == chunk_id).select(column).take(1)
    if not rows:
        raise KeyError(f"chunk {chunk_id!r} not found")
    return rows[0][0] or ""


def read_chunk_links(spark: SparkSession, path: str | None, with_order: bool = False) -> DataFrame:
    """Chunk-to-patient links with both keys; no path gives an empty table.

    `with_order` keeps `line`, the order of files and of lines in them, by which
    `latest_links` and `attach_patients` take the last link of a chunk.
    """
    if path is None:
        links = spark.createDataFrame([], schemas.CHUNK_LINKS)
        return links.withColumn("line", F.lit(None).cast(LINE)) if with_order else links
    links = spark.read.schema(schemas.CHUNK_LINKS).option("mode", "PERMISSIVE").json(path)
    return complete_links(links.select("*", line_order().alias("line")) if with_order else links)


def complete_links(links: DataFrame) -> DataFrame:
    return links.where("chunk_id <> '' AND patient_uid <> ''")


def latest_links(links: DataFrame, order: str = "line", key: str = "chunk_id") -> DataFrame:
    """One patient per key: the last in `order`, which is the order of lines unless given."""
    return links.groupBy(key).agg(F.max_by("patient_uid", order).alias("patient_uid"))


def read_whole_report(spark: SparkSession, root: str, run_date: str, fmt: str = "json") -> tuple[DataFrame, DataFrame]:
    """The stored report of a run and all of its conflicts, however many there are.

    The report's own row lists the first few; the run's conflict table has every one.
    """
    report = read_report(spark, f"{root}/identity/run_date={run_date}")
    conflicts = spark.read.schema(schemas.CONFLICTS).format(fmt).load(f"{root}/conflicts/run_date={run_date}")
    return report, conflicts


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.REPORT).option("multiLine", True).json(path)
