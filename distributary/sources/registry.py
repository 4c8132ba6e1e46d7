"""Schema registry as a table: one row per schema document."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from distributary.functions.errors import settled
from distributary.functions.json_values import fields_of, parse_document
from distributary.functions.schema_uri import KEY_COLUMNS, URI_PREFIX, parse_uri


def read_registry(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Schemas of the files under ``paths``; an earlier path wins over a later one."""
    files = [
        spark.read.option("recursiveFileLookup", True)
        .text(path, wholetext=True)
        .select(F.lit(priority).alias("priority"), F.col("value").alias("document"))
        for priority, path in enumerate(paths)
    ]
    return pick_by_priority(schemas_from(reduce(DataFrame.unionByName, files)))


def schemas_from(documents: DataFrame, column: str = "document") -> DataFrame:
    """Key and body of self-describing schema documents; documents without a key are left out."""
    parsed = documents.withColumn("schema_json", parse_document(F.col(column)))
    about = {
        name: F.try_variant_get("schema_json", f"$.self.{name}", "string")
        for name in ("vendor", "name", "format", "version")
    }
    uri = F.concat(
        F.lit(URI_PREFIX),
        F.concat_ws("/", about["vendor"], about["name"], about["format"], about["version"]),
    )
    others = [c for c in documents.columns if c != column]
    keyed = settled(parsed.select(*others, column, parse_uri(uri).alias("key")))
    return keyed.where("key is not null").select(*others, "key.*", column)


def with_validity(schemas: DataFrame) -> DataFrame:
    """Add ``valid``: the document is a JSON object and its keywords have the shape of a schema."""
    value, type_kw = F.col("schema_json"), F.col("type_kw")
    properties = F.try_variant_get(value, "$.properties", "variant")
    valid = (
        fields_of(value).isNotNull()
        & (type_kw.isNull() | F.schema_of_variant(type_kw).rlike("^(STRING$|ARRAY)"))
        & (properties.isNull() | fields_of(properties).isNotNull())
    )
    parsed = schemas.withColumn("schema_json", parse_document(F.col("document")))
    typed = parsed.withColumn("type_kw", F.try_variant_get(value, "$.type", "variant"))
    checked = typed.withColumn("valid", F.coalesce(valid, F.lit(False)))
    return settled(checked.drop("schema_json", "type_kw"))


def pick_by_priority(schemas: DataFrame, repositories: DataFrame | None = None) -> DataFrame:
    """One document per schema key, from the repository that comes first.

    ``repositories`` (``repository``, ``priority``, ``vendor_prefixes``) puts repositories that claim the
    vendor before the others; without it the ``priority`` column of ``schemas`` decides.
    """
    if repositories is not None:
        schemas = schemas.join(repositories, "repository")
        claimed = F.exists("vendor_prefixes", lambda prefix: F.col("vendor").startswith(prefix))
        rank = F.struct((~claimed).alias("unclaimed"), "priority", "repository")
    else:
        rank = F.struct("priority")
    others = [c for c in schemas.columns if c not in [*KEY_COLUMNS, "priority", "vendor_prefixes"]]
    return (
        schemas.groupBy(*KEY_COLUMNS)
        .agg(F.min_by(F.struct(*others), rank).alias("first"))
        .select(*KEY_COLUMNS, "first.*")
    )
