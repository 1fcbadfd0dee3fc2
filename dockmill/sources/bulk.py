"""Bulk CSV of submissions: scan, rename, pack, attachments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockmill.functions.text import extension, basename, given, leading_int

# CSV columns and the attributes they become.
FIELDS = {
    "Document ID": "id",
    "Agency ID": "agencyId",
    "Docket ID": "docketId",
    "Document Type": "documentType",
    "Title": "title",
    "Posted Date": "postedDate",
    "Comment": "comment",
    "First Name": "firstName",
    "Last Name": "lastName",
    "Organization Name": "organization",
    "Submitter Representative": "submitterRep",
    "Category": "category",
    "State/Province": "stateProvinceRegion",
    "Country": "country",
    "Received Date": "receiveDate",
    "Page Count": "pageCount",
}


def scan_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a CSV with quoted line breaks, numbered in file order (``ord`` from 1).

    Several files count in the order of their names.  A multi-line file is one
    split, so the row ids of one file are consecutive; the offset of each file
    comes from a count per file, which reads the files once more.
    """
    raw = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)
    numbered = raw.select("*", F.col("_metadata.file_path").alias("__p")).withColumn("__i", F.monotonically_increasing_id())
    first = numbered.groupBy("__p").agg(F.min("__i").alias("__m"), F.count("*").alias("__c"))
    from pyspark.sql.window import Window

    before = first.withColumn("__b", F.coalesce(F.sum("__c").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # a row a file
    return numbered.join(before, "__p").withColumn("ord", F.col("__b") + F.col("__i") - F.col("__m") + 1).drop("__p", "__i", "__m", "__c", "__b")


def comments_from_csv(rows: DataFrame) -> DataFrame:
    """(``id``, ``ord``, ``attributes_json``): known columns renamed, empty cells dropped."""
    cells = []
    for source, name in FIELDS.items():
        if source in rows.columns:
            cell = given(F.col(f"`{source}`"))
            cells.append((leading_int(cell) if name == "pageCount" else cell).alias(name))
    shown = [display_properties(F.col("`Display Properties (Name, Label, Tooltip)`")).alias("displayProperties")] if "Display Properties (Name, Label, Tooltip)" in rows.columns else []
    id_ = F.coalesce(given(F.col("`Document ID`")), F.concat(F.lit("row"), F.col("ord").cast("string")))
    return rows.select(id_.alias("id"), "ord", F.to_json(F.struct(*cells, *shown)).alias("attributes_json"))


def display_properties(x: Column) -> Column:
    """``name,label,tooltip`` triples between semicolons."""
    parts = F.filter(F.transform(F.split(x, ";"), F.trim), lambda s: s != "")

    def triple(s: Column) -> Column:
        p = F.transform(F.split(s, ","), F.trim)
        return F.struct(F.get(p, F.lit(0)).alias("name"), F.get(p, F.lit(1)).alias("label"), F.get(p, F.lit(2)).alias("tooltip"))

    return F.when(given(x).isNotNull(), F.transform(parts, triple))


def attachment_urls(*cells: Column) -> Column:
    """URLs of cells that list them between white space, commas, semicolons or bars."""
    return F.filter(F.split(F.concat_ws(";", *cells), r"[\s;,|]+"), lambda u: u != "")


def attachments_from_csv(rows: DataFrame, id_: Column, *cells: Column) -> DataFrame:
    """A row per attachment URL: id ``<comment>-att<i>``, format by extension, base name."""
    urls = rows.select(id_.alias("comment_id"), F.posexplode(attachment_urls(*cells)).alias("i", "url"))
    return urls.select(
        F.concat("comment_id", F.lit("-att"), (F.col("i") + 1).cast("string")).alias("id"),
        "comment_id",
        extension(F.col("url")).alias("format"),
        basename(F.col("url")).alias("file_name"),
        "url",
    )


def is_file(source: str) -> bool:
    """Whether a source names a file rather than a document to fetch."""
    return "/" in source or source.lower().endswith(".csv")
