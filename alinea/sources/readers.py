"""Files of the pipeline as typed DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alinea.functions.clean import null_if_blank


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, allow_missing: bool = False) -> DataFrame:
    """CSV with a header, a byte order mark or none, quoted line breaks and doubled quotes.

    Words for "no value" and blanks become null in text columns. A missing or empty file gives an
    empty table if ``allow_missing``, else an error when read.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if allow_missing and not _has_data(spark, path):
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').option("enforceSchema", True).csv(path)
    return df.select(*(null_if_blank(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in schema))


def _has_data(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getContentSummary(p).getLength() > 0


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad lines): blank lines are skipped, lines that aren't JSON are kept apart."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    # Reading the lines as text first lets a later count of bad lines alone be planned.
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = lines.select(F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("x"), "value")
    good = parsed.filter(F.col("x._bad").isNull()).select(*(F.col(f"x.{f.name}").alias(f.name) for f in schema))
    return good, parsed.filter(F.col("x._bad").isNotNull()).select(F.col("value").alias("line"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, payload): each file as one text, for the nested layouts."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("payload"))


def count_lines(spark: SparkSession, path: str) -> int:
    return spark.read.text(path).count()


GRAPH_NODE = "identifier string, labels array<string>, properties map<string,string>"
GRAPH_EDGE = "identifier string, label string, source_identifier string, source_labels array<string>, target_identifier string, target_labels array<string>, properties map<string,string>"


def graph_nodes(nodes: DataFrame, standard_label: str, component_label: str, jurisdiction: str) -> tuple[DataFrame, DataFrame]:
    """(standards of the jurisdiction, components); a node with both labels only counts as a standard."""
    has = lambda label: F.array_contains("labels", label)
    is_standard = F.coalesce(has(standard_label), F.lit(False))
    p = lambda key, default="": property_or(F.col("properties"), key, default)
    standards = nodes.filter(is_standard & (F.col("properties")["jurisdiction"] == jurisdiction)).select(
        "identifier", p("caseIdentifierUUID").alias("case_uuid"), p("statementCode").alias("statement_code"), p("description").alias("description"),
        p("academicSubject").alias("academic_subject"), p("gradeLevel").alias("grade_level"), p("statementType").alias("statement_type"),
    )
    components = nodes.filter(~is_standard & F.coalesce(has(component_label), F.lit(False))).select("identifier", p("name").alias("name"), p("description").alias("description"))
    return standards.dropDuplicates(["identifier"]), components.dropDuplicates(["identifier"])


def property_or(properties: Column, key: str, default: str) -> Column:
    """A property; the default only if the key is absent, not if its value is null."""
    return F.when(F.map_contains_key(properties, key), properties[key]).otherwise(F.lit(default))


def known_ends(edges: DataFrame, left: DataFrame, right: DataFrame, source: str = "source_identifier", target: str = "target_identifier") -> DataFrame:
    """Edges whose ends are both known ids."""
    a, b = left.select(F.col("identifier").alias(source)), right.select(F.col("identifier").alias(target))
    return edges.join(a, source, "left_semi").join(b, target, "left_semi")
