"""Spark views of the estate: facts derived from the given tables."""

import os
import re

from pyspark.sql import functions as F

from stewardry import schemas
from stewardry.operators import resolve
from stewardry.plans import estate
from stewardry.sources import readers

BASE = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def spread(rows, *keys):
    """Short rows that grow into long documents: dealt by their keys, as a small file is read in few tasks."""
    return rows.repartition(2 * rows.sparkSession.sparkContext.defaultParallelism, *keys)


class Workload:
    """Lazily derived views over one data folder."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder

    def table(self, name):
        return self.spark.read.parquet(os.path.join(self.folder, f"{name}.parquet"))

    def sql(self, text, **frames):
        text = re.sub(r"@TS\(('[^']*')\)", r"TIMESTAMP_NTZ \1", text).replace("VARCHAR(20)", "STRING")
        for name in re.findall(r"\{(\w+)\}", text):
            frames.setdefault(name, self.table(name) if name in BASE else None)
        return self.spark.sql(text, **frames)

    def _asset_columns(self, df):
        return df.withColumnsRenamed({"db": "database", "sch": "schema", "tbl": "table", "col": "column"})

    def requests(self):
        return self._asset_columns(self.sql(estate.REQUESTS))

    def rules(self):
        return self.spark.createDataFrame(estate.instruction_rows(), schemas.INSTRUCTION)

    def table_facts(self):
        rows = [(*asset.split("."), *facts) for asset, *facts in estate.TABLE_FACTS]
        return self.spark.createDataFrame(
            rows, "database string, schema string, table string, sensitivity string, category string, pii boolean"
        )

    def catalog(self):
        rows = [
            (*asset.split("."), *column) for asset, columns in estate.CATALOG.items() for column in columns
        ]
        return self.spark.createDataFrame(
            rows,
            "database string, schema string, table string, column string, data_type string, "
            "data_type_id string, sensitivity string, is_pii boolean",
        )

    def query_refs(self):
        refs = self.sql(estate.QUERY_REFS)
        anchor = F.coalesce("as_of", "requested_at")
        return (
            refs.withColumn("columns", F.filter(F.split("columns", ","), lambda c: c != ""))
            .withColumn("ctes", F.filter(F.split("ctes", ","), lambda c: c != ""))
            .withColumn("window_upper", F.when(F.col("window_days").isNotNull(), anchor))
            .withColumn("window_lower", F.col("window_upper") - F.make_dt_interval(F.col("window_days")))
        )

    def customers(self):
        return self.sql(estate.CUSTOMER_TABLE)

    def payments(self):
        return self.sql(estate.PAYMENT_TABLE)

    def processor(self):
        return self.sql(estate.PROCESSOR_TABLE)

    def network(self):
        return self.sql(estate.NETWORK_TABLE)

    def catalog_tables(self):
        """Catalog at scale: one row per cataloged table with its tags array."""
        return self.sql(estate.CATALOG_TABLES, part=spread(self.table("part"), "p_partkey", "p_name"))

    def catalog_docs(self):
        """Nested catalog documents, database and schema absent where inherited."""
        columns = []
        for name, kind, type_id, sensitivity, pii in estate.COLUMN_TEMPLATE:
            type_col = F.col("custom_type") if type_id == "*" else F.lit(type_id).cast("string")
            columns.append(
                F.struct(
                    F.lit(name).alias("name"),
                    F.lit(kind).alias("data_type"),
                    F.lit(name != "id").alias("nullable"),
                    F.lit(f"The {name} column").alias("description"),
                    F.array(F.col("tag")).alias("tags"),
                    F.struct(
                        type_col.alias("data_type_id"),
                        F.lit(sensitivity).alias("sensitivity"),
                        F.lit(pii).alias("is_pii"),
                        F.lit("pattern").alias("source"),
                    ).alias("classification"),
                )
            )
        return self.catalog_tables().select(
            "name", "description", F.col("raw_db").alias("database"), F.col("raw_sch").alias("schema"),
            F.array("tag").alias("tags"), F.array(*columns).alias("columns"),
        )

    def catalog_columns(self):
        return readers.catalog_columns(self.catalog_docs(), "master", "public")

    def scoped_tables(self):
        return self.catalog_tables().select(
            F.col("db").alias("database"), F.col("sch").alias("schema"), F.col("name").alias("table"),
            F.array("tag").alias("tags"),
        )

    def dispositions(self):
        return self.spark.createDataFrame(
            list(estate.DISPOSITIONS),
            "authored_entry string, resolved_key string, resolved_category string, do_not_map boolean, ruled_kind string",
        )

    def instructions(self, part=None, paths=True):
        """Policies at scale (those in ``part``, where given) resolved against the catalog at scale."""
        policies = self.policies()
        return resolve.instructions(
            policies.where(part) if part else policies, self.scoped_tables(), self.catalog_columns(), self.collections(), paths
        )

    def collections(self):
        return self.catalog_tables().select(
            F.col("collection").alias("collection_id"), F.col("name").alias("member_table")
        )

    def policies(self):
        """Policy documents at scale, in the nested shape a policy file carries."""
        raw = self.sql(estate.POLICIES, customer=spread(self.table("customer"), "c_custkey", "c_name"))
        fam, sel, k = F.col("family_no"), F.col("selector_no"), F.col("k")

        def only(number, value):
            return F.when(fam == number, value)

        def pick(number, value):
            return F.when(sel == number, F.array(value))

        def words(*values):
            return F.array(*[F.lit(v) for v in values])

        null_words = F.lit(None).cast("array<string>")

        def text(prefix, size):
            return F.concat(F.lit(prefix), F.floor(k / size).cast("string"))

        shape = schemas.POLICY_SPEC
        null = {f.name: F.lit(None).cast(f.dataType) for f in shape.fields}
        selector = F.struct(
            F.when(F.col("only_db").isNotNull(), F.array("only_db")).alias("databases"),
            F.when(F.col("only_sch").isNotNull(), F.array("only_sch")).alias("schemas"),
            F.when(
                sel == 0, F.array(F.concat(F.lit("t"), k.cast("string")), F.concat(F.lit("t"), (k + 1).cast("string")))
            )
            .when((sel == 4) & (k % 2 == 0), F.array(F.concat(F.lit("t"), k.cast("string"))))
            .alias("tables"),
            pick(1, F.concat(F.col("target_path"), F.lit(".contact_email"))).alias("columns"),
            pick(2, text("custom.type", 8)).alias("taxonomy_types"),
            pick(3, text("c", 5)).alias("collections"),
            pick(4, text("tag", 4)).alias("tags"),
        )
        contested = F.concat(F.lit("outreach_"), F.floor(k / 50).cast("string"))
        fields = dict(
            null,
            enforcement_mode=F.when(k % 6 == 0, "monitor").otherwise("enforce"),
            priority=F.col("priority").cast("int"),
            selector=selector,
            sensitivity=F.lit("confidential"),
            category=F.lit("pii"),
            permitted_uses=F.when(fam == 0, words("analytics", "ai.inference", "legacy_reporting")).when(
                fam == 1, F.array(contested)
            ),
            prohibited_uses=F.when(fam == 0, words("marketing", "sharing.external")).when(
                fam == 2, F.array(contested)
            ),
            ai=only(
                3,
                F.struct(
                    (k % 20 < 10).alias("allow_training"),
                    F.when(k % 40 < 20, F.lit(True)).alias("allow_inference"),
                    F.lit(True).alias("requires_anonymization"),
                    F.array(F.lit("Human in the loop.")).alias("restrictions"),
                ),
            ),
            allowed_roles=only(4, words("HR_ADMIN", "PEOPLE_OPS")),
            denied_roles=only(4, words("PUBLIC")),
            masking=F.when(
                fam.isin(5, 6),
                F.struct(
                    F.when(k % 40 < 8, "partial").when(k % 40 < 16, "hash").when(k % 40 < 24, "custom.vault")
                    .when(k % 40 < 32, "tokenize").otherwise("redact").alias("method"),
                    F.array(F.lit("DATA_STEWARD")).alias("exempt_roles"),
                ),
            ),
            retention=only(
                7, F.struct(F.lit("7 years").alias("period"), F.lit("closed").alias("trigger"), F.lit("delete").alias("action"))
            ),
            row_filter=F.when(
                k % 20 == 8,
                F.struct(words("ANALYST", "AUDITOR").alias("roles"), F.concat(F.lit("nation = "), F.col("nation")).alias("expression")),
            ),
            transfer=F.when(
                k % 20 == 18,
                F.struct(
                    F.when(k % 40 == 18, "deny").otherwise("conditional").alias("default_effect"),
                    F.array(
                        F.struct(
                            F.lit("conditional").alias("effect"), words("export").alias("operations"),
                            words("INTERNAL_WAREHOUSE").alias("systems"), null_words.alias("dest_jurisdictions"),
                            null_words.alias("consumer_jurisdictions"), F.lit(True).alias("requires_approval"),
                            (k % 40 == 18).alias("requires_anonymization"), F.lit(None).cast("string").alias("required_role"),
                        )
                    ).alias("rules"),
                ),
            ),
            window=F.when(
                k % 20 == 9,
                F.struct(
                    words("ANALYST").alias("actor_roles"), F.lit("updated_at").alias("time_column"),
                    F.array(
                        F.struct(
                            F.lit("research.general").alias("purpose"), F.lit("rolling").alias("type"),
                            (30 + k % 3 * 30).cast("int").alias("lookback_days"),
                        )
                    ).alias("rules"),
                ),
            ),
            consent=F.when(
                k % 20 == 19,
                F.array(
                    F.struct(
                        F.lit("marketing.personalization").alias("purpose"), F.lit("consent_personalization").alias("basis_column"),
                        F.lit("An opt-in is needed.").alias("requirement"),
                    )
                ),
            ),
            regulations=only(8, words("GDPR", "HIPAA")),
            business_context=only(9, F.lit("customer domain")),
            effective_from=F.when(k % 4 == 1, F.lit("2024-01-10T00:00:00Z")),
            effective_until=F.when(k % 4 == 2, F.lit("2024-01-20T00:00:00Z")),
        )
        spec = F.struct(*[fields[f.name].cast(f.dataType).alias(f.name) for f in shape.fields])
        mapped = F.when(
            fam == 0,
            F.create_map(
                F.lit(estate.USAGE_NO),
                F.struct(F.lit("purpose.prohibited_use").alias("scenario_key"), F.lit("user_confirmed").alias("source")),
            ),
        )
        return raw.select(
            "policy_id", "name", F.lit(1).alias("version"), F.lit(True).alias("approved"),
            F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("published_at"),
            spec.alias("spec"), mapped.cast(schemas.POLICY["scenario_map"].dataType).alias("scenario_map"),
        )
