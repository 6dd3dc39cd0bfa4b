"""Readers with explicit schemas: annotation CSVs, JSON lines, COCO documents, label texts, file listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions.scalar import MISSING
from orrery.operators.relations import last_per_key, require_columns

BREAST = "study_id string, series_id string, image_id string, laterality string, view_position string, height int, width int, breast_birads string, breast_density string, split string"
FINDINGS = BREAST + ", finding_categories string, finding_birads string, xmin double, ymin double, xmax double, ymax double"


def read_csv(spark: SparkSession, path: str, schema: str, required: set[str] = frozenset()) -> DataFrame:
    """A headed CSV by its column names (trimmed), each cast to its schema type; absent columns are null."""
    raw = spark.read.option("header", True).csv(path)
    raw = raw.toDF(*[c.strip() for c in raw.columns])
    require_columns(raw, set(required), path)
    fields = spark.createDataFrame([], schema).schema
    cols = []
    for f in fields:
        c = F.col(f.name) if f.name in raw.columns else F.lit(None)
        cols.append((c if f.dataType.simpleString() == "string" else F.when(~F.lower(F.trim(c)).isin(*MISSING), F.trim(c)).try_cast(f.dataType)).alias(f.name))
    return raw.select(*cols, *[c for c in raw.columns if c not in fields.names])


def read_manifest(spark: SparkSession, path: str, schema: str, key: str, position: str) -> DataFrame:
    """JSON lines, broken lines left out, the last row of each key by its position column."""
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    return last_per_key(rows, [key], [position])


def read_coco_boxes(spark: SparkSession, path: str) -> DataFrame:
    """A row an annotation of COCO documents, with its image's name and size (null where it has none)."""
    schema = "images array<struct<id:long,file_name:string,width:int,height:int>>, annotations array<struct<id:long,image_id:long,category_id:int,bbox:array<double>,area:double>>"
    doc = spark.read.schema(schema).option("multiLine", True).json(path).withColumn("file", F.col("_metadata.file_path"))
    a = doc.select("file", F.explode("annotations").alias("a")).select("file", "a.*")
    i = doc.select("file", F.explode("images").alias("i")).select("file", F.col("i.id").alias("image_id"), "i.file_name", "i.width", "i.height")
    out = a.join(i, ["file", "image_id"], "left")
    return out.withColumns({n: F.get("bbox", F.lit(k)) for k, n in enumerate(("x", "y", "w", "h"))}).drop("bbox")


def read_yolo_boxes(spark: SparkSession, path: str, width: int, height: int) -> DataFrame:
    """Boxes in pixels from label texts, a row a line of five numbers."""
    p = F.transform(F.split(F.trim("value"), r"\s+"), lambda x: x.try_cast("double"))
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), p.alias("p")).where((F.size("p") >= 5) & F.forall(F.slice("p", 1, 5), lambda x: x.isNotNull()))
    cx, cy, w, h = (F.get("p", F.lit(k)) for k in range(1, 5))
    return rows.select("file", F.get("p", F.lit(0)).cast("int").alias("category"), ((cx - w / 2) * width).alias("x0"), ((cy - h / 2) * height).alias("y0"), ((cx + w / 2) * width).alias("x1"), ((cy + h / 2) * height).alias("y1"))


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, name, stem, size) of all files below a folder, contents unread."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    name = F.regexp_extract("path", "([^/]+)$", 1)
    return f.select("path", name.alias("name"), F.regexp_replace(name, r"(.)\.[^.]+$", "$1").alias("stem"), F.col("length").alias("size"))
