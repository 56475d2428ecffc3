"""Sinks: tables, reports, and exports of images' labels and boxes."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import even_positions, yolo_line


def write_parquet(df: DataFrame, path: str, *partition_by: str) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A small file by any path that Spark can write."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def write_json(spark: SparkSession, report, path: str) -> None:
    write_text(spark, json.dumps(report, indent=2, sort_keys=True, default=str) + "\n", path)


def yolo_labels(labels_2d: DataFrame, samples: DataFrame) -> DataFrame:
    """A row for each image of a ready sample: split, image, and its label lines in the order of the boxes' tokens."""
    line = yolo_line(F.col("class_id"), F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"), F.col("img_w"), F.col("img_h"))
    lines = labels_2d.groupBy("sample_token").agg(F.array_sort(F.collect_list(F.struct("annotation_token", line.alias("line")))).alias("l"))
    ready = samples.where("ml_ready").select("sample_token", "scene_name", "split", "filename", "tags", "in_regression_set")
    return ready.join(lines, "sample_token", "left").select("*", F.concat_ws("\n", F.transform(F.coalesce("l", F.array().cast("array<struct<annotation_token:string,line:string>>")), lambda x: x["line"])).alias("labels")).drop("l")


def export_yolo(spark: SparkSession, labels: DataFrame, classes: list[str], images_root: str, out: str) -> None:
    """Images and label files by split, the index, and ``data.yaml``.

    Each task copies its own images and writes their labels; a repeated task
    writes the same files again.
    """
    index = labels.withColumn("image", F.element_at(F.split("filename", "/"), -1))
    index.drop("labels").write.mode("overwrite").parquet(f"{out}/index.parquet")

    def copy(rows) -> None:
        from pyarrow import fs

        src, src_root = fs.FileSystem.from_uri(images_root) if "://" in images_root else (fs.LocalFileSystem(), images_root)
        dst, dst_root = fs.FileSystem.from_uri(out) if "://" in out else (fs.LocalFileSystem(), out)
        for r in rows:
            for kind in ("images", "labels"):
                dst.create_dir(f"{dst_root}/{kind}/{r.split}", recursive=True)
            with src.open_input_stream(f"{src_root}/{r.filename}") as f, dst.open_output_stream(f"{dst_root}/images/{r.split}/{r.image}") as g:
                g.write(f.read())
            with dst.open_output_stream(f"{dst_root}/labels/{r.split}/{r.image.rsplit('.', 1)[0]}.txt") as g:
                g.write((r.labels + "\n" if r.labels else "").encode())

    index.foreachPartition(copy)
    names = "".join(f"  {i}: {c}\n" for i, c in enumerate(classes))
    write_text(spark, f"path: .\ntrain: images/train\nval: images/val\ntest: images/test\nnames:\n{names}", f"{out}/data.yaml")


def submission(boxes: DataFrame) -> DataFrame:
    """One JSON text per sample: its boxes with rounded fields and no velocity."""
    num = lambda c, n=3: F.transform(F.col(c), lambda v: F.round(v, n))
    box = F.struct(
        F.col("sample_token"), num("center").alias("translation"), num("size").alias("size"), F.array(F.round(F.cos(F.col("yaw") / 2), 6), F.lit(0.0), F.lit(0.0), F.round(F.sin(F.col("yaw") / 2), 6)).alias("rotation"),
        F.array(F.lit(0.0), F.lit(0.0)).alias("velocity"), F.col("cls").alias("detection_name"), F.round("score", 4).alias("detection_score"), F.lit("").alias("attribute_name"),
    )
    return boxes.groupBy("sample_token").agg(F.to_json(F.sort_array(F.collect_list(box), asc=False)).alias("boxes"))


def demo_samples(samples: DataFrame, n: int) -> DataFrame:
    """``n`` evenly spaced ready samples of the test split, with seconds since their scene's first."""
    from pyspark.sql import Window

    test = samples.where("split = 'test' AND ml_ready")
    w = Window.partitionBy(F.lit(0))  # the test split's ready samples
    ranked = test.withColumns({"_pos": F.row_number().over(w.orderBy("scene_name", "sample_timestamp", "sample_token")).cast("long") - 1, "_n": F.count(F.lit(1)).over(w), "seconds": F.round((F.col("sample_timestamp") - F.min("sample_timestamp").over(Window.partitionBy("scene_name"))) / 1e6, 1)})
    return ranked.where(F.array_contains(even_positions(F.col("_n"), n), F.col("_pos"))).drop("_pos", "_n")


def bars(title: str, values: dict[str, float]) -> str:
    """A panel of labelled horizontal bars, longest first."""
    from html import escape

    top = max(values.values(), default=0) or 1
    rows = "".join(f"<tr><td>{escape(k)}</td><td><div style='background:#4878a8;height:1em;width:{300 * v / top:.0f}px'></div></td><td>{v:g}</td></tr>" for k, v in sorted(values.items(), key=lambda kv: (-kv[1], kv[0])))
    return f"<h1>{escape(title)}</h1><table>{rows}</table>"


def html_report(kpis: dict, coverage: list[dict]) -> str:
    """A static page: coverage by place and condition, frames by channel, issues by check and severity, training boxes by class, and every number of the report."""
    from html import escape

    from ..operators.store import flatten

    cells: dict[tuple[str, str], int] = {}
    for r in coverage:
        for c in ("time_of_day", "weather"):
            cells[r["location"], r[c]] = cells.get((r["location"], r[c]), 0) + r["samples"]
    conditions, most = ["day", "night", "clear", "rain"], max(cells.values(), default=0) or 1
    head = "<tr><th>location</th>" + "".join(f"<th>{c}</th>" for c in conditions) + "</tr>"
    cell = lambda n: f"<td style='background:rgba(72,120,168,{n / most:.2f})'>{n}</td>"
    body = "".join(f"<tr><td>{escape(p)}</td>" + "".join(cell(cells.get((p, c), 0)) for c in conditions) + "</tr>" for p in sorted({p for p, _ in cells}))
    panels = (
        bars("Frames by channel", {k: v["frames"] for k, v in kpis.get("volume", {}).items()})
        + "".join(bars(f"Issues: {s}", {k.rsplit(".", 1)[0]: n for k, n in kpis.get("issues", {}).items() if k.endswith(f".{s}")}) for s in sorted({k.rsplit(".", 1)[1] for k in kpis.get("issues", {})}))
        + bars("Training boxes by class", {k: v["boxes"] for k, v in kpis.get("train_balance", {}).items()})
    )
    rows = "".join(f"<tr><td>{escape(k)}</td><td>{v:g}</td></tr>" for k, v in sorted(flatten(kpis).items()))
    return f"<!doctype html><meta charset='utf-8'><title>KPIs</title><h1>Coverage</h1><table>{head}{body}</table>{panels}<h1>Metrics</h1><table>{rows}</table>\n"
