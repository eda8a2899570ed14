"""Which resources of a project manifest a change touches, and which can be gated."""

from pyspark.sql import functions as F

from stewardry import vocab
from stewardry.functions.scale import reference_join


def merged_meta(node):
    """Annotations under the node and under its config; config wins."""
    empty = F.create_map().cast("map<string,string>")
    outer = F.coalesce(node["meta"], empty)
    inner = F.coalesce(node["config"]["meta"], empty)
    kept = F.map_filter(outer, lambda k, v: ~F.map_contains_key(inner, k))
    return F.map_concat(kept, inner)


def sql_of(node):
    """First non-blank SQL field over the manifest versions."""
    fields = ("compiled_code", "compiled_sql", "raw_code", "raw_sql")
    return F.coalesce(*[F.nullif(F.trim(node[f]), F.lit("")) for f in fields])


def paths_of(node):
    """Original and patch path, project scheme stripped."""
    found = F.array_compact(F.array(node["original_file_path"], node["patch_path"]))
    return F.array_distinct(F.transform(F.filter(found, lambda p: p != ""), lambda p: F.substring_index(p, "://", -1)))


def models(rows):
    return rows.filter((F.col("node_group") == "node") & (F.col("node.resource_type") == "model"))


def exposures(rows):
    return rows.filter(F.col("node_group") == "exposure")


def model_skip_reason(node):
    meta = merged_meta(node)
    return (
        F.when(~F.coalesce(node["config"]["enabled"], F.lit(True)), "model is disabled")
        .when(F.lower(node["config"]["materialized"]) == "ephemeral", "ephemeral model")
        .when(F.try_element_at(meta, F.lit("skip")) == "true", "opted out")
        .when(sql_of(node).isNull(), "model without SQL")
    )


def exposure_skip_reason(node):
    meta = merged_meta(node)
    kind = F.try_element_at(meta, F.lit("kind"))
    return (
        F.when(F.try_element_at(meta, F.lit("skip")) == "true", "opted out")
        .when(F.size(meta) == 0, "exposure without an annotation")
        .when(~F.coalesce(kind.isin(*vocab.USE_KINDS), F.lit(False)), "unsupported kind")
        .when(F.try_element_at(meta, F.lit("asset")).isNull(), "annotation without an asset")
    )


def gateable_models(rows, default_scenario="purpose.allowed_use"):
    node = F.col("node")
    meta = merged_meta(node)
    return (
        models(rows)
        .filter(model_skip_reason(node).isNull())
        .select(
            "project", "unique_id",
            F.concat(F.lit("model-"), node["name"]).alias("change_id"),
            F.lit("sql_model").alias("kind"),
            sql_of(node).alias("sql"),
            F.coalesce(F.try_element_at(meta, F.lit("scenario_key")), F.lit(default_scenario)).alias("scenario_key"),
            F.try_element_at(meta, F.lit("purpose_key")).alias("purpose_key"),
            F.map_contains_key(meta, "purpose_key").alias("purpose_declared"),
        )
    )


def gateable_exposures(rows):
    node = F.col("node")
    meta = merged_meta(node)
    return (
        exposures(rows)
        .filter(exposure_skip_reason(node).isNull())
        .select(
            "project", "unique_id",
            F.concat(F.lit("exposure-"), node["name"]).alias("change_id"),
            meta["kind"].alias("kind"), meta["asset"].alias("asset"),
            F.try_element_at(meta, F.lit("purpose_key")).alias("purpose_key"),
            F.map_contains_key(meta, "purpose_key").alias("purpose_declared"),
        )
    )


def skip_report(rows):
    """Considered but not gated, with the reason."""
    node = F.col("node")
    both = models(rows).withColumn("reason", model_skip_reason(node)).unionByName(
        exposures(rows).withColumn("reason", exposure_skip_reason(node))
    )
    return both.filter("reason IS NOT NULL").select("project", "unique_id", "reason")


def _content(node):
    return F.sha2(F.to_json(node), 256)


def changed_by_checksum(current, previous):
    """New or checksum-changed models; new or changed exposures."""
    stamp = F.when(F.col("node_group") == "node", F.col("node.checksum.checksum")).otherwise(_content(F.col("node")))
    before = previous.select("unique_id", stamp.alias("before"), F.lit(True).alias("known"))
    after = models(current).unionByName(exposures(current)).select("unique_id", "node_group", stamp.alias("after"))
    joined = after.join(before, "unique_id", "left")
    return joined.filter(F.col("known").isNull() | ~F.col("before").eqNullSafe(F.col("after"))).select(
        "unique_id", "node_group"
    )


def changed_by_upstream(current, changed):
    """Exposures whose own text is unchanged but one of whose models changed (one hop)."""
    edges = exposures(current).join(changed.select("unique_id"), "unique_id", "left_anti").select(
        "unique_id", F.explode("node.depends_on.nodes").alias("upstream")
    )
    models_changed = changed.filter("node_group = 'node'").select(F.col("unique_id").alias("upstream"))
    met = reference_join(
        edges, models_changed, ["upstream"], "left_semi", spread_by=["unique_id"], derived="changed-models"
    )
    return met.select("unique_id").distinct()


def changed_by_files(current, files):
    paths = models(current).unionByName(exposures(current)).select(
        "unique_id", F.explode(paths_of(F.col("node"))).alias("path")
    )
    return reference_join(paths, files, ["path"], "left_semi", spread_by=["unique_id"]).select("unique_id").distinct()
