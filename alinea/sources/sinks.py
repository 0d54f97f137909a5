"""Results as files: CSV, appended batches, one JSON document per record, an index, sheets."""

from __future__ import annotations

import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alinea.operators.annotate import todo


def write_csv(df: DataFrame, path: str, mark: bool = True) -> None:
    """CSV with a header, quoted line breaks and, with ``mark``, a byte order mark at the start of each file."""
    first = df.columns[0]
    out = df.withColumnRenamed(first, "﻿" + first) if mark else df
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}  # texts keep theirs
    out.write.mode("overwrite").option("header", True).option("escape", '"').options(**blanks).csv(path)


def append_batch(df: DataFrame, path: str, batch_id: str) -> None:
    """Add a batch of results; writing the same batch again replaces it, so a repeated run adds nothing."""
    df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def remaining(spark: SparkSession, df: DataFrame, path: str, key: str, but_batch: str | None = None) -> DataFrame:
    """Rows without a result in the batches under ``path``, or in any but ``but_batch``; all rows if there are none yet."""
    if not exists(spark, path):
        return df
    done = spark.read.schema(T.StructType([df.schema[key], T.StructField("batch_id", T.StringType())])).parquet(path)
    return todo(df, done.filter(F.col("batch_id") != but_batch) if but_batch else done, key)


def write_version(df: DataFrame, path: str, version: str) -> str:
    """A new version beside the old ones; what is being read is never overwritten."""
    out = f"{path}/version={version}"
    df.write.mode("errorifexists").parquet(out)
    return out


def write_documents(df: DataFrame, key: str, path: str) -> None:
    """One compact JSON document per record under ``path/<key>=<value>/``, nulls written out."""
    json = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    df.select(F.col(key).alias("key"), json.alias("value")).repartition("key").write.mode("overwrite").partitionBy("key").text(path)


def write_lines(df: DataFrame, path: str) -> None:
    """The search index as JSON lines, in as many files as there are partitions."""
    df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def _cell(v: object) -> str:
    if v is None:
        return "<c/>"
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return f"<c><v>{v}</v></c>"
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'


def _head(v: str) -> str:
    return f'<c t="inlineStr" s="1"><is><t>{escape(v)}</t></is></c>'


def write_workbook(sheets: dict[str, DataFrame], path: str, most_rows: int = 1_048_575) -> None:
    """A workbook with one sheet per table: bold header, first row frozen, widths by header.

    A sheet holds at most ``most_rows`` rows by its format; a larger table raises an error before
    anything is written. Rows are streamed to the file partition by partition.
    """
    for name, df in sheets.items():
        if df.count() > most_rows:
            raise ValueError(f"sheet {name} would have more than {most_rows} rows")
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    pkg = "http://schemas.openxmlformats.org/package/2006"
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    n = len(sheets)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kind}.worksheet+xml"/>' for i in range(1, n + 1))
        z.writestr("[Content_Types].xml", f'{head}<Types xmlns="{pkg}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{kind}.styles+xml"/>{parts}</Types>')
        z.writestr("_rels/.rels", f'{head}<Relationships xmlns="{pkg}/relationships"><Relationship Id="r1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        names = "".join(f'<sheet name="{escape(s[:31])}" sheetId="{i}" r:id="r{i}"/>' for i, s in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{names}</sheets></workbook>')
        links = "".join(f'<Relationship Id="r{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, n + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="{pkg}/relationships">{links}<Relationship Id="s" Type="{rel}/styles" Target="styles.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'{head}<styleSheet xmlns="{main}"><fonts count="2"><font/><font><b/></font></fonts><fills count="2"><fill/><fill><patternFill patternType="solid"><fgColor rgb="FFD9E2F3"/></patternFill></fill></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf/><xf fontId="1" fillId="1" applyFont="1" applyFill="1"/></cellXfs></styleSheet>')
        for i, df in enumerate(sheets.values(), 1):
            with z.open(f"xl/worksheets/sheet{i}.xml", "w") as f:
                widths = "".join(f'<col min="{k}" max="{k}" width="{max(12, len(c) + 4)}" customWidth="1"/>' for k, c in enumerate(df.columns, 1))
                f.write(f'{head}<worksheet xmlns="{main}"><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" state="frozen"/></sheetView></sheetViews><cols>{widths}</cols><sheetData><row>{"".join(map(_head, df.columns))}</row>'.encode())
                for row in df.toLocalIterator():
                    f.write(f"<row>{''.join(map(_cell, row))}</row>".encode())
                f.write(b"</sheetData></worksheet>")
