"""Writers: partitioned tables, label texts, nested annotation documents. Spark's commit protocol makes them whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def yolo_line(b: list[Column], width: Column, height: Column, digits: int = 8, category: int = 0) -> Column:
    """'class cx cy w h' relative to the image."""
    f = f"%.{digits}f"
    return F.format_string(f"{category} {f} {f} {f} {f}", (b[0] + b[2]) / 2 / width, (b[1] + b[3]) / 2 / height, (b[2] - b[0]) / width, (b[3] - b[1]) / height)


def yolo_texts(df: DataFrame, keys: list[str], line: Column, order: list[str]) -> DataFrame:
    """One label text an image, lines in order; images without boxes have no row."""
    rows = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*order, line.alias("line")))).alias("rows"))
    return rows.select(*keys, F.array_join(F.transform("rows", lambda r: r["line"]), "\n").alias("text"))


def coco_documents(images: DataFrame, annotations: DataFrame, scope: str) -> DataFrame:
    """One JSON document a scope with nested images and annotations; the result is one document by its nature."""
    i = images.groupBy(scope).agg(F.array_sort(F.collect_list(F.struct(*[c for c in images.columns if c != scope]))).alias("images"))
    a = annotations.groupBy(scope).agg(F.array_sort(F.collect_list(F.struct(*[c for c in annotations.columns if c != scope]))).alias("annotations"))
    both = i.join(a, scope, "left")
    return both.select(scope, F.to_json(F.struct("images", F.coalesce("annotations", F.array().cast(a.schema["annotations"].dataType)).alias("annotations"))).alias("document"))


def write_partitioned(df: DataFrame, path: str, by: list[str], kind: str = "parquet", overwrite: bool = False) -> None:
    """A folder a value of ``by``; an existing output is refused unless overwrite."""
    writer = df.write.mode("overwrite" if overwrite else "errorifexists").partitionBy(*by)
    getattr(writer.option("header", True) if kind == "csv" else writer, kind)(path)


def upsert_latest(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both, the new one where a key is in both."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)
