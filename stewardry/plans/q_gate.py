"""Queries for change gates, change selection, sources, exceptions and reviews."""

from pyspark.sql import functions as F

from stewardry import schemas, vocab
from stewardry.operators import compose, exceptions, gate, select, validate
from stewardry.plans.estate import div, pick
from stewardry.plans.q_authorize import authorized
from stewardry.plans.q_validate import refs as refs_of
from stewardry.plans.registry import cte, query
from stewardry.session import materialize, scratch_dir
from stewardry.sources import readers, sinks

KINDS = (
    "sql_model", "export_job", "migration_sql", "ai_training_job", "ad_hoc_sql", "tool_use", "data_job", "mystery",
)
CHANGES = f"""
SELECT 'cs-' || CAST({div('event_id', 5)} AS VARCHAR(20)) AS change_set_id, 'chg-' || CAST(event_id AS VARCHAR(20)) AS change_id,
  {pick(f"({div('event_id', 3)} % 8)", KINDS)} AS kind, event_id AS query_id, event_id AS request_id,
  'models/' || event_type || '.sql' AS source_path
FROM {{events}}
"""
cte("changes", CHANGES)


def changes(w):
    return w.sql(CHANGES)


def results(w):
    sql_changes, use_changes = gate.split(changes(w).select(*gate.CHANGE, "query_id", "request_id"))
    refs = refs_of(w).join(sql_changes.drop("request_id"), "query_id")
    found = validate.findings(validate.expand_star(refs, w.catalog()), w.rules())
    requests = w.requests().join(use_changes.drop("query_id"), "request_id")
    return gate.evaluate(
        gate.validation_answers(found, "pub-1"), compose.authorize(requests, w.rules(), "pub-1")
    )


SQLK = "('sql_model', 'migration_sql', 'ad_hoc_sql')"
USEK = "('export_job', 'ai_training_job', 'tool_use', 'data_job')"


def _case(column, mapping, default):
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {column} {arms} ELSE {default} END"


cte(
    "gated",
    f"""
SELECT change_set_id, change_id, kind, query_id AS id, 'validation' AS route, state, verdict AS outcome, CAST(NULL AS VARCHAR) AS scenario
  FROM changes JOIN vverdicts USING (query_id) WHERE kind IN {SQLK}
UNION ALL SELECT change_set_id, change_id, kind, request_id, 'authorization', state, decision, scenario
  FROM changes JOIN answers USING (request_id) WHERE kind IN {USEK}
""",
    "changes", "vverdicts", "answers",
)
cte(
    "gates",
    """
SELECT *, CASE WHEN state <> 'answered' THEN state ELSE outcome END AS label,
  CASE WHEN state <> 'answered' THEN 'needs_review' WHEN outcome IN ('pass', 'allow', 'log_only', 'retain') THEN 'pass'
    WHEN outcome IN ('warn', 'conditional', 'mask_full', 'mask_partial') THEN 'needs_controls' ELSE 'fail' END AS gate
FROM gated
""",
    "gated",
)
_DENY = _case("scenario", vocab.DENY_CODES, "'USE_DENIED'")
_VDENY = _case("rule_scenario", vocab.DENY_CODES, "'USE_DENIED'")
cte(
    "codes",
    f"""
SELECT change_id, code, min(pos) AS pos FROM (
  SELECT change_id, 'NO_PUBLISHED_STATE' AS code, ref_no * 100 AS pos FROM gates g JOIN vfindings f ON f.query_id = g.id
    WHERE route = 'validation' AND NOT governed
  UNION ALL SELECT change_id, CASE WHEN v.decision = 'deny' THEN {_VDENY} ELSE 'MASKING_REQUIRED' END, ref_no * 100 + rk
    FROM gates g JOIN vranked v ON v.query_id = g.id WHERE route = 'validation' AND v.decision IN ('deny', 'mask_full', 'mask_partial')
  UNION ALL SELECT change_id, {_DENY}, 0 FROM gates WHERE route = 'authorization' AND outcome = 'deny'
  UNION ALL SELECT change_id, 'TRANSFER_CONDITIONAL', 1 FROM gates
    WHERE route = 'authorization' AND outcome = 'conditional' AND scenario = 'residency.cross_border_transfer'
  UNION ALL SELECT change_id, CASE c.kind WHEN 'ai_restriction' THEN 'AI_RESTRICTION' WHEN 'anonymize_first' THEN 'ANONYMIZATION_REQUIRED'
      WHEN 'approval_required' THEN 'APPROVAL_REQUIRED' ELSE 'ROLE_RESTRICTED' END,
      CASE c.kind WHEN 'ai_restriction' THEN 2 WHEN 'anonymize_first' THEN 3 WHEN 'approval_required' THEN 4 ELSE 5 END
    FROM gates g JOIN conditions c ON c.request_id = g.id
    WHERE route = 'authorization' AND c.kind IN ('ai_restriction', 'anonymize_first', 'approval_required', 'role_restricted')
  UNION ALL SELECT change_id, 'MASKING_REQUIRED', 6 FROM gates g JOIN obligations o ON o.request_id = g.id
    WHERE route = 'authorization' AND o.type = 'mask')
GROUP BY 1, 2
""",
    "gates", "vfindings", "vranked", "conditions", "obligations",
)
cte(
    "controls",
    """
SELECT change_id, control, min(pos) AS pos, min(sort_text) AS sort_text FROM (
  SELECT change_id, 'Mask or drop ' || coalesce(rule_col, 'the flagged columns') || ' before shipping this query.' AS control,
    ref_no * 100 + rk AS pos, '' AS sort_text FROM gates g JOIN vranked v ON v.query_id = g.id
    WHERE route = 'validation' AND v.decision IN ('mask_full', 'mask_partial') AND gate <> 'pass'
  UNION ALL SELECT change_id, requirement, 0, c.kind || requirement FROM gates g JOIN conditions c ON c.request_id = g.id
    WHERE route = 'authorization' AND gate <> 'pass'
  UNION ALL SELECT change_id, 'Mask ' || target || ' (' || method || ').', 1, target FROM gates g JOIN obligations o ON o.request_id = g.id
    WHERE route = 'authorization' AND gate <> 'pass' AND o.type = 'mask')
GROUP BY 1, 2
""",
    "gates", "vranked", "conditions", "obligations",
)


@query(
    "gate_route_kind",
    f"SELECT change_id, kind, CASE WHEN kind IN {SQLK} THEN 'validation' WHEN kind IN {USEK} THEN 'authorization' ELSE 'unsupported' END AS route FROM changes",
    ["changes"],
)
def gate_route_kind(w):
    return changes(w).select("change_id", "kind", gate.route(F.col("kind")).alias("route"))


@query("gate_map", "SELECT change_id, label AS decision, gate FROM gates", ["gates"])
def gate_map(w):
    return results(w).select("change_id", "decision", "gate")


@query(
    "gate_reason_codes",
    """SELECT g.change_id, coalesce(c.codes, CASE WHEN outcome = 'pass' AND route = 'validation' THEN 'NO_RESTRICTED_USE_DETECTED'
      WHEN outcome IN ('allow', 'log_only', 'retain') THEN 'PERMITTED_USE' ELSE '' END) AS reason_codes
    FROM gates g LEFT JOIN (SELECT change_id, string_agg(code, ',' ORDER BY pos, code) AS codes FROM codes GROUP BY 1) c USING (change_id)""",
    ["gates", "codes"],
)
def gate_reason_codes(w):
    return results(w).select("change_id", F.concat_ws(",", "reason_codes").alias("reason_codes"))


@query(
    "gate_required_controls",
    """SELECT g.change_id, coalesce(c.controls, '') AS required_controls
    FROM gates g LEFT JOIN (SELECT change_id, string_agg(control, ' | ' ORDER BY pos, sort_text) AS controls FROM controls GROUP BY 1) c USING (change_id)""",
    ["gates", "controls"],
)
def gate_required_controls(w):
    return results(w).select("change_id", F.concat_ws(" | ", "required_controls").alias("required_controls"))


cte(
    "vreasons",
    """
SELECT query_id, arg_min(reason, CASE WHEN decision = 'deny' THEN 0 ELSE 100000 END + ref_no * 100 + rk) AS rationale FROM (
  SELECT *, policy || ': ' || ikey || ' → ' || decision AS reason FROM vranked WHERE decision IN ('deny', 'mask_full', 'mask_partial'))
GROUP BY 1
""",
    "vranked",
)
cte(
    "first_policy",
    """SELECT request_id, arg_min(policy, rk) AS policy, arg_min(version, rk) AS version, arg_min(ikey, rk) AS ikey FROM (
  SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY CASE WHEN rule_col IS NULL THEN 1 ELSE 0 END,
    band DESC, weight DESC, sev, policy, rule_id) AS rk FROM ranked) GROUP BY 1""",
    "ranked",
)


@query(
    "gate_rationale",
    """SELECT change_id, coalesce(CASE WHEN route = 'validation' THEN v.rationale ELSE p.policy END, '') AS rationale
    FROM gates g LEFT JOIN vreasons v ON v.query_id = g.id LEFT JOIN first_policy p ON p.request_id = g.id""",
    ["gates", "vreasons", "first_policy"],
)
def gate_rationale(w):
    return results(w).select("change_id", "rationale")


@query(
    "gate_evidence",
    """SELECT change_id, CASE WHEN route = 'authorization' AND state <> 'not_enough_published_state' THEN 'decision' ELSE 'pub-1' END AS evidence
    FROM gates""",
    ["gates"],
)
def gate_evidence(w):
    evidence = F.when(F.length("evidence_id") == 64, "decision").otherwise(F.col("evidence_id"))
    return results(w).select("change_id", evidence.alias("evidence"))


_COUNT = "CAST(count(*) FILTER (WHERE gate = '{}') AS BIGINT) AS {}"
cte(
    "summaries",
    "SELECT change_set_id, count(*) AS total, "
    + ", ".join(
        _COUNT.format(g, n)
        for g, n in (("pass", "passed"), ("needs_controls", "needs_controls"), ("fail", "failed"), ("needs_review", "needs_review"))
    )
    + " FROM gates GROUP BY 1",
    "gates",
)


@query("gate_summary", "SELECT *, failed = 0 AND needs_review = 0 AS release_allowed FROM summaries", ["summaries"])
def gate_summary(w):
    return gate.summary(results(w))


@query(
    "gate_worst",
    """SELECT change_set_id, CASE WHEN failed > 0 THEN 'fail' WHEN needs_review > 0 THEN 'needs_review'
    WHEN needs_controls > 0 THEN 'needs_controls' ELSE 'pass' END AS worst_gate FROM summaries""",
    ["summaries"],
)
def gate_worst(w):
    return gate.worst(results(w))


@query(
    "sink_gate_report",
    "SELECT change_set_id, total, passed, failed, failed = 0 AND needs_review = 0 AS release_allowed, total AS n_results FROM summaries",
    ["summaries"],
)
def sink_gate_report(w):
    path = scratch_dir(w.spark, "gate-report")
    judged = materialize(results(w), "gate-results")
    sinks.gate_report(judged, gate.summary(judged), path)
    schema = (
        "change_set_id string, piece int, total bigint, passed bigint, failed bigint, release_allowed boolean, "
        "results array<struct<change_id:string,gate:string>>"
    )
    back = w.spark.read.schema(schema).json(path)
    return back.groupBy("change_set_id", "total", "passed", "failed", "release_allowed").agg(
        F.sum(F.size("results")).cast("long").alias("n_results")
    )


# --- project manifests ---------------------------------------------------------------------

NODES = """
SELECT 'proj' || CAST(CAST(FLOOR(p_partkey / 20) AS BIGINT) AS VARCHAR(20)) AS project, p_partkey AS n,
  'model.m' || CAST(p_partkey AS VARCHAR(20)) AS unique_id, 'm' || CAST(p_partkey AS VARCHAR(20)) AS name,
  CASE WHEN p_partkey % 9 = 0 THEN 'test' ELSE 'model' END AS resource_type,
  'models/m' || CAST(p_partkey AS VARCHAR(20)) || '.sql' AS path,
  'proj://models/m' || CAST(p_partkey AS VARCHAR(20)) || '.yml' AS patch_path,
  CASE WHEN p_partkey % 4 = 0 THEN '  ' WHEN p_partkey % 17 <> 0 THEN 'SELECT ' || p_brand END AS compiled_code,
  CASE WHEN p_partkey % 17 <> 0 THEN ' SELECT raw ' END AS raw_code,
  p_brand || '-' || CAST(p_size AS VARCHAR(20)) AS checksum,
  p_partkey % 11 <> 0 AS enabled,
  CASE WHEN p_size % 7 = 0 THEN 'Ephemeral' ELSE 'table' END AS materialized,
  p_partkey % 13 = 0 AS opted_out,
  CASE WHEN p_partkey % 3 = 0 THEN 'ai.training' END AS node_scenario,
  CASE WHEN p_partkey % 6 = 0 THEN 'access.read' END AS config_scenario,
  p_partkey % 5 = 0 AS has_purpose,
  CASE WHEN p_partkey % 10 = 0 THEN 'analytics.reporting' END AS purpose,
  p_partkey % 6 = 1 AS edited, p_size <> 3 AS existed
FROM {part}
"""
EXPOSURES_M = f"""
SELECT 'proj' || CAST(CAST(FLOOR(c_custkey / 20) AS BIGINT) AS VARCHAR(20)) AS project, c_custkey AS n,
  'exposure.e' || CAST(c_custkey AS VARCHAR(20)) AS unique_id, 'e' || CAST(c_custkey AS VARCHAR(20)) AS name,
  'exposures/e' || CAST(c_custkey AS VARCHAR(20)) || '.yml' AS path,
  {pick('c_custkey % 6', ('export_job', 'tool_use', 'data_job', 'ai_training_job', 'dashboard', None))} AS kind,
  CASE WHEN c_custkey % 7 <> 0 THEN 'master.public.t' || CAST(c_custkey AS VARCHAR(20)) END AS asset,
  c_custkey % 12 = 5 AS bare, c_custkey % 13 = 0 AS opted_out,
  'model.m' || CAST(c_custkey AS VARCHAR(20)) AS up1, 'model.m' || CAST(c_custkey + 1 AS VARCHAR(20)) AS up2,
  c_custkey % 8 = 0 AS edited, c_nationkey <> 4 AS existed
FROM {{customer}}
"""
cte("nodes", NODES)
cte("expo", EXPOSURES_M)


def _map(pairs):
    kept = F.filter(F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value"), on.alias("on")) for k, v, on in pairs]), lambda p: p["on"])
    return F.map_from_entries(F.transform(kept, lambda p: F.struct(p["key"].alias("key"), p["value"].alias("value"))))


def _node(fields):
    shape = schemas.MANIFEST_NODE
    return F.struct(
        *[(fields[f.name] if f.name in fields else F.lit(None)).cast(f.dataType).alias(f.name) for f in shape.fields]
    ).alias("node")


def manifest_rows(w, previous=False):
    """Manifest entries of every project, one row each; the previous one when asked."""
    c = F.col
    yes = F.lit(True)
    nodes, expo = w.sql(NODES), w.sql(EXPOSURES_M)
    if previous:
        nodes, expo = nodes.filter("existed"), expo.filter("existed")
    node_meta = _map([("owner", F.lit("x"), yes), ("scenario_key", c("node_scenario"), c("node_scenario").isNotNull())])
    config_meta = _map(
        [
            ("skip", F.lit("true"), c("opted_out")),
            ("scenario_key", c("config_scenario"), c("config_scenario").isNotNull()),
            ("purpose_key", c("purpose"), c("has_purpose")),
        ]
    )
    checksum = c("checksum") if not previous else F.when(c("edited"), F.lit("old")).otherwise(c("checksum"))
    model = _node(
        dict(
            name=c("name"), resource_type=c("resource_type"), original_file_path=c("path"), patch_path=c("patch_path"),
            compiled_code=c("compiled_code"), raw_code=c("raw_code"),
            checksum=F.struct(checksum.alias("checksum")), meta=node_meta,
            config=F.struct(c("enabled").alias("enabled"), c("materialized").alias("materialized"), config_meta.alias("meta")),
        )
    )
    meta = _map(
        [
            ("skip", F.lit("true"), c("opted_out") & ~c("bare")),
            ("kind", c("kind"), ~c("bare")),
            ("asset", c("asset"), c("asset").isNotNull() & ~c("bare")),
        ]
    )
    text = F.lit("an exposure") if not previous else F.when(c("edited"), "an old exposure").otherwise("an exposure")
    exposure = _node(
        dict(
            name=c("name"), resource_type=F.lit("exposure"), original_file_path=c("path"), description=text, meta=meta,
            depends_on=F.struct(F.array("up1", "up2").alias("nodes")),
        )
    )
    return nodes.select("project", F.lit("node").alias("node_group"), "unique_id", model).unionByName(
        expo.select("project", F.lit("exposure").alias("node_group"), "unique_id", exposure)
    )


@query(
    "src_manifest_nodes",
    """SELECT project, 'node' AS node_group, unique_id, name, checksum FROM nodes
    UNION ALL SELECT project, 'exposure', unique_id, name, NULL FROM expo""",
    ["nodes", "expo"],
)
def src_manifest_nodes(w):
    """Manifests of twenty entries per project written as documents and read back."""
    rows = manifest_rows(w)
    pair = F.struct(F.col("unique_id").alias("key"), F.col("node").alias("value"))

    def side(group):
        return F.map_from_entries(F.collect_list(F.when(F.col("node_group") == group, pair)))

    path = scratch_dir(w.spark, "manifests")
    docs = rows.groupBy("project").agg(side("node").alias("nodes"), side("exposure").alias("exposures"))
    docs.select(F.to_json(F.struct("project", "nodes", "exposures")).alias("value")).write.text(path)
    back = readers.manifest_nodes(readers.manifests(w.spark, path))
    return back.select("project", "node_group", "unique_id", "node.name", F.col("node.checksum.checksum").alias("checksum"))


cte(
    "model_skips",
    """SELECT *, coalesce(config_scenario, node_scenario, 'purpose.allowed_use') AS scenario_key,
  coalesce(nullif(trim(compiled_code), ''), nullif(trim(raw_code), '')) AS sql_text,
  CASE WHEN NOT enabled THEN 'model is disabled' WHEN materialized = 'Ephemeral' THEN 'ephemeral model' WHEN opted_out THEN 'opted out'
    WHEN coalesce(nullif(trim(compiled_code), ''), nullif(trim(raw_code), '')) IS NULL THEN 'model without SQL' END AS reason
FROM nodes WHERE resource_type = 'model'""",
    "nodes",
)
cte(
    "expo_skips",
    """SELECT *, CASE WHEN opted_out AND NOT bare THEN 'opted out' WHEN bare THEN 'exposure without an annotation'
  WHEN kind IS NULL OR kind = 'dashboard' THEN 'unsupported kind' WHEN asset IS NULL THEN 'annotation without an asset' END AS reason FROM expo""",
    "expo",
)


@query(
    "select_gateable_models",
    """SELECT unique_id, 'model-' || name AS change_id, sql_text AS sql, scenario_key, CASE WHEN has_purpose THEN purpose END AS purpose_key,
    has_purpose AS purpose_declared FROM model_skips WHERE reason IS NULL""",
    ["model_skips"],
)
def select_gateable_models(w):
    return select.gateable_models(manifest_rows(w)).select(
        "unique_id", "change_id", "sql", "scenario_key", "purpose_key", "purpose_declared"
    )


@query(
    "select_gateable_exposures",
    "SELECT unique_id, 'exposure-' || name AS change_id, kind, asset FROM expo_skips WHERE reason IS NULL",
    ["expo_skips"],
)
def select_gateable_exposures(w):
    return select.gateable_exposures(manifest_rows(w)).select("unique_id", "change_id", "kind", "asset")


@query(
    "skip_report",
    """SELECT unique_id, reason FROM model_skips WHERE reason IS NOT NULL
    UNION ALL SELECT unique_id, reason FROM expo_skips WHERE reason IS NOT NULL""",
    ["model_skips", "expo_skips"],
)
def skip_report(w):
    return select.skip_report(manifest_rows(w)).select("unique_id", "reason")


cte(
    "changed",
    """SELECT unique_id, 'node' AS node_group FROM nodes WHERE resource_type = 'model' AND (edited OR NOT existed)
UNION ALL SELECT unique_id, 'exposure' FROM expo WHERE edited OR NOT existed""",
    "nodes", "expo",
)


def changed(w):
    return select.changed_by_checksum(manifest_rows(w), manifest_rows(w, previous=True))


@query("changed_by_checksum", "SELECT unique_id, node_group FROM changed", ["changed"])
def changed_by_checksum(w):
    return changed(w)


@query(
    "changed_by_upstream",
    """SELECT unique_id FROM expo WHERE NOT edited AND existed
    AND (up1 IN (SELECT unique_id FROM changed) OR up2 IN (SELECT unique_id FROM changed))""",
    ["expo", "changed"],
)
def changed_by_upstream(w):
    return select.changed_by_upstream(manifest_rows(w), changed(w))


FILES = """
SELECT CASE WHEN o_orderkey % 3 = 0 THEN '  models/m' || CAST(o_orderkey AS VARCHAR(20)) || '.yml '
  WHEN o_orderkey % 3 = 1 THEN 'exposures/e' || CAST(o_orderkey AS VARCHAR(20)) || '.yml' ELSE '  ' END AS line
FROM {orders}
"""
cte("file_lines", FILES)
cte("files", "SELECT DISTINCT trim(line) AS path FROM file_lines WHERE trim(line) <> ''", "file_lines")


def written_files(w):
    path = scratch_dir(w.spark, "changed-files")
    w.sql(FILES).write.text(path)
    return readers.changed_files(w.spark, path)


@query("src_changed_files", "SELECT path FROM files", ["files"])
def src_changed_files(w):
    return written_files(w)


@query(
    "changed_by_files",
    """SELECT unique_id FROM nodes WHERE resource_type = 'model' AND (path IN (SELECT path FROM files) OR replace(patch_path, 'proj://', '') IN (SELECT path FROM files))
    UNION ALL SELECT unique_id FROM expo WHERE path IN (SELECT path FROM files)""",
    ["nodes", "expo", "files"],
)
def changed_by_files(w):
    return select.changed_by_files(manifest_rows(w), written_files(w))


@query(
    "merge_meta",
    """SELECT unique_id, coalesce(config_scenario, node_scenario) AS scenario_key, 'x' AS owner, opted_out AS opted_out FROM nodes""",
    ["nodes"],
)
def merge_meta(w):
    meta = select.merged_meta(F.col("node"))
    return manifest_rows(w).filter("node_group = 'node'").select(
        "unique_id", F.try_element_at(meta, F.lit("scenario_key")).alias("scenario_key"), meta["owner"].alias("owner"),
        F.map_contains_key(meta, "skip").alias("opted_out"),
    )


# --- change sets ---------------------------------------------------------------------------


@query(
    "src_change_set",
    """SELECT CASE WHEN CAST(replace(change_set_id, 'cs-', '') AS BIGINT) % 2 = 0 THEN change_set_id ELSE 'ad-hoc' END AS change_set_id,
    change_id, kind, source_path FROM changes""",
    ["changes"],
)
def src_change_set(w):
    """Sets of five changes as documents: an object for even sets, a raw array for odd."""
    number = F.replace("change_set_id", F.lit("cs-"), F.lit("")).cast("long")
    grouped = changes(w).groupBy("change_set_id").agg(
        F.collect_list(F.struct("change_id", "kind", "source_path")).alias("changes")
    )
    text = F.when(number % 2 == 0, F.to_json(F.struct("change_set_id", "changes"))).otherwise(F.to_json("changes"))
    path = scratch_dir(w.spark, "change-sets")
    grouped.select(text.alias("value")).write.text(path)
    return readers.change_sets(w.spark, path).select("change_set_id", "change_id", "kind", "source_path")


# --- exceptions and reviews ------------------------------------------------------------------

QUEUES = ("privacy-review", "finance-review", "telemetry-review", "support-review", "ml-review", "backup-review")
REVIEWS = f"""
SELECT event_id AS request_id, 'rev-' || CAST(event_id AS VARCHAR(20)) AS review_id,
  'reviewer' || CAST(user_id % 7 AS VARCHAR(20)) AS reviewer,
  {pick(f"({div('event_id', 7)} % 3)", (' Approve', 'reject', 'changes'))} AS review_decision,
  CASE WHEN {div('event_id', 3)} % 2 = 0 THEN 'approval_recorded,anonymization_before_transfer' ELSE 'approval_recorded' END AS attested_text
FROM {{events}} WHERE event_type <> 'error'
"""
cte("reviews", REVIEWS)
REQUIRED = ("approval_recorded", "anonymization_before_transfer")


def reviews(w):
    return w.sql(REVIEWS).withColumn("attested", F.split("attested_text", ","))


def items(w):
    queue = F.element_at(F.array(*[F.lit(q) for q in QUEUES]), (F.col("request_id") % 6 + 1).cast("int"))
    answers = authorized(w).withColumn("queue", queue).withColumn(
        "required_attestations", F.array(*[F.lit(r) for r in REQUIRED])
    )
    return exceptions.items(answers)


cte(
    "xitems",
    f"""
SELECT *, CASE label WHEN 'allow' THEN 'ready_without_exception' WHEN 'log_only' THEN 'ready_without_exception' WHEN 'retain' THEN 'ready_without_exception'
    WHEN 'conditional' THEN 'pending_human_review' WHEN 'mask_full' THEN 'pending_human_review' WHEN 'mask_partial' THEN 'pending_human_review'
    WHEN 'deny' THEN 'blocked_by_policy' ELSE 'needs_policy_review' END AS status,
  CASE WHEN label IN ('conditional', 'mask_full', 'mask_partial') THEN {pick('request_id % 6', QUEUES)} END AS reviewer_queue
FROM (SELECT *, CASE WHEN state <> 'answered' THEN state ELSE decision END AS label FROM answers)
""",
    "answers",
)
cte(
    "reviewed",
    """
SELECT x.* REPLACE (CASE WHEN status = 'pending_human_review' AND review_id IS NOT NULL THEN
    CASE WHEN lower(trim(review_decision)) = 'reject' THEN 'rejected_by_reviewer' WHEN lower(trim(review_decision)) <> 'approve' THEN 'requires_changes'
      WHEN attested_text = 'approval_recorded' THEN 'requires_changes' ELSE 'resumed_with_controls' END ELSE status END AS status),
  status AS initial_status, review_id, review_decision, attested_text
FROM xitems x LEFT JOIN reviews r USING (request_id)
""",
    "xitems", "reviews",
)


def reviewed(w):
    return exceptions.apply_review(items(w), reviews(w))


@query("exception_initial_status", "SELECT request_id, label AS decision, status FROM xitems", ["xitems"])
def exception_initial_status(w):
    return items(w).select("request_id", F.col("label").alias("decision"), "status")


@query(
    "exception_packet",
    f"""SELECT x.request_id, 'exception-' || x.request_id AS packet_id, db || '.' || sch || '.' || tbl AS source, dest_system AS destination,
    coalesce(c.controls, '') AS required_controls, coalesce(o.duties, '') AS obligations, reviewer_queue,
    {_case('status', exceptions.NOTES, 'NULL')} AS reviewer_note, state AS policy_response_state
    FROM xitems x
    LEFT JOIN (SELECT request_id, string_agg(requirement, ' | ' ORDER BY k) AS controls FROM (
      SELECT request_id, requirement, min(kind || requirement) AS k FROM conditions GROUP BY 1, 2) GROUP BY 1) c USING (request_id)
    LEFT JOIN (SELECT request_id, string_agg(CASE WHEN type = 'mask' THEN 'Mask ' || target || ' (' || method || ').' ELSE type || ' ' || target END, ' | ' ORDER BY type, target) AS duties
      FROM obligations GROUP BY 1) o USING (request_id)""",
    ["xitems", "conditions", "obligations"],
)
def exception_packet(w):
    return items(w).select(
        "request_id", "packet_id", "source", "destination", F.concat_ws(" | ", "required_controls").alias("required_controls"),
        F.concat_ws(" | ", "packet_obligations").alias("obligations"), "reviewer_queue", "reviewer_note",
        F.col("state").alias("policy_response_state"),
    )


@query(
    "missing_attestations",
    "SELECT request_id, CASE WHEN attested_text = 'approval_recorded' THEN 'anonymization_before_transfer' ELSE '' END AS missing FROM reviews",
    ["reviews"],
)
def missing_attestations(w):
    missing = exceptions.missing_attestations(F.array(*[F.lit(r) for r in REQUIRED]), F.col("attested"))
    return reviews(w).select("request_id", F.concat_ws(",", missing).alias("missing"))


@query("apply_review", "SELECT request_id, initial_status, status, review_id FROM reviewed", ["reviewed"])
def apply_review(w):
    started = items(w).withColumn("initial_status", F.col("status"))
    return exceptions.apply_review(started, reviews(w)).select("request_id", "initial_status", "status", "review_id")


@query(
    "resume_payload",
    "SELECT request_id, 'resume_controlled_workflow' AS action, review_id, attested_text AS controls_attested, dest_system AS destination FROM reviewed WHERE status = 'resumed_with_controls'",
    ["reviewed"],
)
def resume_payload(w):
    done = reviewed(w).filter("resume_payload IS NOT NULL").select("resume_payload.*")
    return done.select(
        "request_id", "action", "review_id", F.concat_ws(",", "controls_attested").alias("controls_attested"), "destination"
    )


@query(
    "exception_status_counts",
    "SELECT count(*) AS total, "
    + ", ".join(f"CAST(count(*) FILTER (WHERE status = '{s}') AS BIGINT) AS {s}" for s in vocab.EXCEPTION_STATUSES)
    + " FROM reviewed",
    ["reviewed"],
)
def exception_status_counts(w):
    return exceptions.status_counts(reviewed(w))


@query(
    "review_queue_backlog",
    """SELECT reviewer_queue, count(*) AS open_items, strftime(min(requested_at), '%Y-%m-%d %H:%M:%S') AS oldest
    FROM reviewed WHERE status = 'pending_human_review' GROUP BY 1""",
    ["reviewed"],
)
def review_queue_backlog(w):
    return exceptions.backlog(reviewed(w)).withColumn("oldest", F.date_format("oldest", "yyyy-MM-dd HH:mm:ss"))


ACCESS_LOG = """
SELECT user_id * 3 + event_id % 3 AS access_request_id, event_id, ts,
  CASE event_type WHEN 'view' THEN 'open' WHEN 'click' THEN 'in_review' WHEN 'error' THEN 'closed' ELSE 'resolved' END AS status,
  CASE event_type WHEN 'purchase' THEN 'active' WHEN 'signup' THEN 'expired' END AS exception_state
FROM {events}
"""
cte("access_log", ACCESS_LOG)
cte(
    "latest",
    """SELECT access_request_id, status, exception_state FROM (
  SELECT *, row_number() OVER (PARTITION BY access_request_id ORDER BY ts DESC, event_id DESC) AS rn FROM access_log) WHERE rn = 1""",
    "access_log",
)


@query("latest_request_status", "SELECT access_request_id, status, exception_state FROM latest", ["latest"])
def latest_request_status(w):
    return exceptions.latest_status(w.sql(ACCESS_LOG))


@query("retry_eligible", "SELECT access_request_id, status, exception_state FROM latest WHERE exception_state = 'active'", ["latest"])
def retry_eligible(w):
    return exceptions.retry_eligible(w.sql(ACCESS_LOG))


# --- remaining sources and the ledger ----------------------------------------------------------


@query(
    "src_csv_tables",
    "SELECT customer_id, email, region, segment, CAST(arr AS DOUBLE) AS arr, consent_measurement FROM customers",
    ["customers"],
)
def src_csv_tables(w):
    path = scratch_dir(w.spark, "csv")
    fields = ("customer_id", "email", "region", "segment", "arr", "consent_measurement")
    w.customers().select(*fields).write.option("header", True).csv(path)
    schema = "customer_id bigint, email string, region string, segment string, arr decimal(18,2), consent_measurement string"
    return readers.csv_table(w.spark, path, schema).withColumn("arr", F.col("arr").cast("double"))


@query(
    "src_parquet_data",
    "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01' AND l_returnflag = 'R'",
)
def src_parquet_data(w):
    rows = readers.parquet_table(w.spark, f"{w.folder}/lineitem.parquet")
    since = F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
    return rows.filter((F.col("l_shipdate") >= since) & (F.col("l_returnflag") == "R")).select(
        "l_orderkey", "l_linenumber", "l_extendedprice"
    )


@query(
    "src_catalog_columns",
    """SELECT db AS "database", sch AS "schema", tbl AS "table", col AS "column", data_type, data_type_id, sensitivity, is_pii FROM cat_columns""",
    ["cat_columns"],
)
def src_catalog_columns(w):
    path = scratch_dir(w.spark, "catalog")
    w.catalog_docs().write.json(path)
    back = readers.catalog_columns(readers.catalog_docs(w.spark, path), "master", "public")
    return back.select("database", "schema", "table", "column", "data_type", "data_type_id", "sensitivity", "is_pii")


@query(
    "src_policies",
    "SELECT policy_id, name, CAST(priority AS INTEGER) AS priority, family_no IN (5, 6) AS has_masking, family_no = 0 AS has_scenario_map FROM pol",
    ["pol"],
)
def src_policies(w):
    path = scratch_dir(w.spark, "policies")
    w.policies().write.json(path)
    return readers.policies(w.spark, path).select(
        "policy_id", "name", "spec.priority", F.col("spec.masking").isNotNull().alias("has_masking"),
        F.col("scenario_map").isNotNull().alias("has_scenario_map"),
    )


@query(
    "src_recorded_answers",
    "SELECT 'case-' || request_id AS case_id, state, decision, reason_code, (SELECT count(*) FROM ranked r WHERE r.request_id = a.request_id) AS n_instructions FROM answers a",
    ["answers", "ranked"],
)
def src_recorded_answers(w):
    path = scratch_dir(w.spark, "answers")
    authorized(w).select(
        F.concat(F.lit("case-"), F.col("request_id").cast("string")).alias("case_id"), F.lit("authorize").alias("tool"),
        F.struct("state", "decision", "reason_code", "decision_id", "instructions").alias("answer"),
    ).write.json(path)
    return readers.recorded_answers(w.spark, path).select(
        "case_id", "answer.state", "answer.decision", "answer.reason_code",
        F.greatest(F.coalesce(F.size("answer.instructions"), F.lit(0)), F.lit(0)).cast("long").alias("n_instructions"),
    )


@query(
    "sink_ledger",
    "SELECT strftime(requested_at, '%Y-%m-%d') AS eval_date, state, count(*) AS n_receipts FROM answers GROUP BY 1, 2",
    ["answers"],
)
def sink_ledger(w):
    path = scratch_dir(w.spark, "ledger")
    sinks.append_ledger(authorized(w), path)
    back = sinks.read_ledger(w.spark, path)
    return back.groupBy(F.date_format("eval_date", "yyyy-MM-dd").alias("eval_date"), "state").agg(
        F.count("*").alias("n_receipts")
    )
