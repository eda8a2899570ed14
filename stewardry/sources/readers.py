"""Readers; every one names its schema."""

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from stewardry import schemas


def csv_table(spark, path, schema):
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def parquet_table(spark, path, schema=None):
    reader = spark.read
    return (reader.schema(schema) if schema else reader).parquet(path)


def policies(spark, path):
    """Policy documents as JSON rows (converted from their authoring format outside)."""
    return spark.read.schema(schemas.POLICY).json(path)


def catalog_docs(spark, path):
    return spark.read.schema(schemas.CATALOG_DOC).json(path)


def catalog_columns(docs, default_database, default_schema):
    """Tables to columns; a table without its own database or schema inherits the default."""
    return docs.select(
        F.coalesce("database", F.lit(default_database)).alias("database"),
        F.coalesce("schema", F.lit(default_schema)).alias("schema"),
        F.col("name").alias("table"),
        F.col("description").alias("table_description"),
        F.explode_outer("columns").alias("c"),
    ).select(
        "database", "schema", "table", "table_description",
        F.col("c.name").alias("column"), "c.data_type", "c.nullable", "c.description",
        "c.classification.data_type_id", "c.classification.sensitivity", "c.classification.is_pii",
        "c.classification.source",
    )


def change_sets(spark, path, one_per_file=False):
    """Changes of change-set documents: an object with ``changes`` or a raw array."""
    raw = spark.read.text(path, wholetext=one_per_file)
    text = F.trim("value")
    is_array = text.startswith("[")
    doc = F.from_json(text, schemas.CHANGE_SET)
    changes = F.when(is_array, F.from_json(text, ArrayType(schemas.CHANGE))).otherwise(doc["changes"])
    return raw.select(
        F.coalesce(F.when(~is_array, doc["change_set_id"]), F.lit("ad-hoc")).alias("change_set_id"),
        F.explode(changes).alias("c"),
    ).select("change_set_id", "c.*")


def manifests(spark, path, one_per_file=False):
    raw = spark.read.text(path, wholetext=one_per_file)
    return raw.select(F.from_json("value", schemas.MANIFEST).alias("m")).select("m.*")


def manifest_nodes(docs):
    """Nodes and exposures of project manifests, one row each."""

    def side(field, group):
        return docs.select(
            "project", F.lit(group).alias("node_group"), F.explode(field).alias("unique_id", "node")
        )

    return side("nodes", "node").unionByName(side("exposures", "exposure"))


def changed_files(spark, path):
    """A newline list of changed paths: trimmed, blanks dropped."""
    return (
        spark.read.text(path).select(F.trim("value").alias("path")).filter(F.col("path") != "").distinct()
    )


def recorded_answers(spark, path, indented=False):
    """A folder of nested answers with the file each came from.

    One answer per line, or with ``indented`` one document (or array of documents) per file, over as many lines as it likes.
    """
    return spark.read.schema(schemas.RECORDED_ANSWER).json(path, multiLine=indented).withColumn("file", F.input_file_name())
