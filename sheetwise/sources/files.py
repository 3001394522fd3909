"""Sources and sinks: pages of files, stored documents, and the export formats."""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.naming import diagram_type, maker_in_text, part_in_text
from ..functions.text import file_stem

PAGE = "doc_id string, page_num int, text string, tables array<array<array<string>>>, width double, height double, error string"
RENDERED = "doc_id string, page_num int, image binary, width int, height int, dpi int"
RESULT = (
    "metadata struct<source_file: string, mpn: string, manufacturer: string, extraction_method: string>, verification struct<status: string, confidence: double, resolution_method: string, conflict_count: int>, "
    "tables array<struct<table_id: string, title: string, headers array<string>, rows array<map<string,string>>, confidence: double>>, parameters map<string,string>"
).replace("headers array", "headers: array").replace("rows array", "rows: array")


#: Rows, and bytes of images, of a batch that is handed back.
ROWS, BYTES = 1000, 16 << 20


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """path and content of each file."""
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
            yield path.as_py(), content.as_py()


def list_files(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """path, length and content of the files of one folder (not of folders in it)."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "false").load(folder).select("path", "length", "content")


def read_pages(files: DataFrame, parse: Callable[[bytes], Iterator[dict]], attempts: int = 3) -> DataFrame:
    """One row for each page of each file (path, content), numbered from 1.

    `parse` yields dicts with text, tables, width and height; it runs on the executors. A file that
    raises is read again from its start, `attempts` times in all; what the last time raises
    becomes a row with `error` after the pages that came before.
    """

    schema = to_arrow_schema(StructType.fromDDL(PAGE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = []
        for path, content in _contents(batches):
            for again in range(max(attempts, 1), 0, -1):
                rows, n = [], 0
                try:
                    for n, p in enumerate(parse(content), 1):
                        rows.append((path, n, p.get("text") or "", p.get("tables") or [], p.get("width"), p.get("height"), None))
                    break
                except Exception as e:  # a bad file must not end the job
                    if again == 1:
                        rows.append((path, n + 1, "", [], None, None, f"{type(e).__name__}: {e}"))
            done += rows
            if len(done) >= ROWS:
                yield _batch(done, schema)
                done = []
        if done:
            yield _batch(done, schema)

    return files.select("path", "content").mapInArrow(run, PAGE)


def render_pages(files: DataFrame, render: Callable[[bytes, int, int], tuple[bytes, int, int] | None], dpi: int = 150, first: int = 1, last: int | None = None, count: Callable[[bytes], int] | None = None) -> DataFrame:
    """Images of the pages first to last of each file, by default to the end as `count` tells it; pages that `render` can't do are left out, and so are files that `count` can't do."""
    if last is None and count is None:
        raise ValueError("render_pages needs the last page or a function that counts pages")

    schema = to_arrow_schema(StructType.fromDDL(RENDERED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, held = [], 0
        for path, content in _contents(batches):
            try:
                end = count(content) if last is None else last
            except Exception:  # as if there were no pages
                end = 0
            for n in range(first, end + 1):
                try:
                    got = render(content, n, dpi)
                except Exception:  # as if there were no such page
                    got = None
                if got:
                    done.append((path, n, *got, dpi))
                    held += len(got[0] or b"")
                if len(done) >= ROWS or held >= BYTES:
                    yield _batch(done, schema)
                    done, held = [], 0
        if done:
            yield _batch(done, schema)

    return files.select("path", "content").mapInArrow(run, RENDERED)


def crop_images(images: DataFrame, crop: Callable[[bytes, tuple], bytes]) -> DataFrame:
    """Adds `cropped`, the part of `image` inside the struct `bbox` (x0, y0, x1, y1); null where that fails."""

    made = images.withColumn("cropped", F.lit(None).cast("binary")).schema
    at = [c.lower() for c in made.names].index("cropped")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = []
            for image, bbox in zip(batch.column("image"), batch.column("bbox"), strict=True):
                try:
                    box = bbox.as_py()
                    cut.append(crop(image.as_py(), tuple(box[k] for k in ("x0", "y0", "x1", "y1"))))
                except Exception:  # an image that can't be read has no crop
                    cut.append(None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(cut, pa.binary()), *batch.columns[at + 1 :]], made.names)

    return images.mapInArrow(run, made)


def table_regions(pages: DataFrame) -> DataFrame:
    """A placeholder box for each grid of more than one row of a page, one below the other by its place."""
    grids = pages.select("doc_id", "page_num", F.posexplode("tables").alias("i", "grid")).where(F.size("grid") > 1)
    y = F.lit(100.0) + F.col("i") * 200.0
    return grids.select("doc_id", "page_num", F.format_string("table_%d_%d", "page_num", "i").alias("region_id"), F.struct(F.lit(50.0).alias("x0"), y.alias("y0"), F.lit(550.0).alias("x1"), (y + 200).alias("y1")).alias("bbox"), F.lit("table").alias("region_type"))


DIAGRAM = "diagram_id string, page_num int, caption string, diagram_type string, nodes array<struct<id: string, label: string, type: string>>, edges array<struct<`from`: string, `to`: string, label: string, type: string>>, bbox array<double>"


def diagram_pages(pages: DataFrame) -> DataFrame:
    """doc_id, page_num and diagram_type of the pages whose text names a diagram."""
    return pages.select("doc_id", "page_num", diagram_type(F.col("text")).alias("diagram_type")).where("diagram_type IS NOT NULL")


def extract_diagrams(pages: DataFrame, ask: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Diagrams of the pages that name one, as `ask` (diagram pages -> doc_id and the columns of DIAGRAM) finds them; none without it."""
    if ask is None:
        return pages.sparkSession.createDataFrame([], f"doc_id string, {DIAGRAM}")
    return ask(diagram_pages(pages))


def page_documents(pages: DataFrame, tables: DataFrame, diagrams: DataFrame | None = None, version: str = "0.3") -> DataFrame:
    """One document for each file of a page scan: doc_id, metadata, tables, diagrams, parameters. Errors of pages are not in it.

    Part number and maker come from the text of page 1. A file without a table or a diagram has empty lists.
    """
    first = pages.groupBy("doc_id").agg(F.max_by("text", F.when(F.col("page_num") == 1, 1)).alias("text"), F.count_if(F.col("error").isNull()).alias("n"))
    table = F.struct("table_id", "page_num", "title", "headers", "rows", "confidence", "extraction_method", "raw_data")
    place = lambda x: x["page_num"] * 1_000_000 + F.coalesce(x["table_idx"], F.lit(999_999))
    order = lambda a, b: F.signum(place(a) - place(b)).cast("int")
    number = F.col("table_idx") if "table_idx" in tables.columns else F.lit(0)
    listed = tables.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(F.col("page_num").cast("long").alias("page_num"), number.alias("table_idx"), table.alias("t"))), order).alias("l")).select("doc_id", F.transform("l", lambda x: x["t"]).alias("tables"))
    drawn = diagrams if diagrams is not None else extract_diagrams(pages)
    drawn = drawn.groupBy("doc_id").agg(F.collect_list(F.struct("diagram_id", "page_num", "caption", "diagram_type", "nodes", "edges")).alias("diagrams"))
    joined = first.join(listed, "doc_id", "left").join(drawn, "doc_id", "left")
    text = F.coalesce("text", F.lit(""))
    about = F.struct(F.col("doc_id").alias("source_file"), part_in_text(text).alias("mpn"), maker_in_text(text).alias("manufacturer"), F.col("n").cast("int").alias("total_pages"), F.lit(version).alias("extractor_version"))
    kinds = dict(joined.dtypes)
    empty = lambda c: F.coalesce(c, F.array().cast(kinds[c])).alias(c)
    return joined.select("doc_id", about.alias("metadata"), empty("tables"), empty("diagrams"), F.create_map().cast("map<string,string>").alias("parameters"))


def prototype_documents(tables: DataFrame, diagrams: DataFrame, source: str) -> DataFrame:
    """The prototype's document: metadata with source and extractor, tables and diagrams, of one file."""
    about = F.struct(F.lit(source).alias("source"), F.lit("prototype").alias("extractor"))
    listed = lambda df, name: df.agg(F.collect_list(F.struct(*df.columns)).alias(name)).withColumn("one", F.lit(1))
    return listed(tables, "tables").join(listed(diagrams, "diagrams"), "one").select(about.alias("metadata"), "tables", "diagrams")


def json_text(df: DataFrame) -> DataFrame:
    """doc_id and the document as indented JSON text; null fields are left out."""
    return df.select("doc_id", F.to_json(F.struct(*[c for c in df.columns if c != "doc_id"]), {"pretty": "true"}).alias("json"))


def write_documents(df: DataFrame, path: str, mode: str = "overwrite", name: Column | None = None) -> None:
    """One JSON file for each document, in a folder named by its file's stem, or by `name` of its doc_id."""
    named = json_text(df).select((file_stem(F.col("doc_id")) if name is None else name).alias("name"), "json")
    named.repartition("name").write.mode(mode).partitionBy("name").option("lineSep", "\n").text(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Stored document results, one JSON document a file."""
    return spark.read.schema(RESULT).option("multiLine", "true").json(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; empty strings stay empty."""
    df.write.mode(mode).option("header", "true").option("emptyValue", "").csv(path)


def write_report(lines: DataFrame, path: str) -> None:
    """The report's lines in order, as one text file: it has one line for each file of the batch."""
    lines.orderBy("ord").select("line").coalesce(1).write.mode("overwrite").text(path)
