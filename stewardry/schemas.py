"""Explicit schemas; nothing in the library infers a schema from data."""

from pyspark.sql import types as T

S, L, I, B, D = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType(), T.DoubleType()
TS = T.TimestampNTZType()


def struct(**fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


def array(kind):
    return T.ArrayType(kind, True)


ASSET = struct(database=S, schema=S, table=S, column=S)

TRANSFER_RULE = struct(
    effect=S,
    operations=array(S),
    systems=array(S),
    dest_jurisdictions=array(S),
    consumer_jurisdictions=array(S),
    requires_approval=B,
    requires_anonymization=B,
    required_role=S,
)
WINDOW_RULE = struct(purpose=S, type=S, lookback_days=I)
CONSENT_RULE = struct(purpose=S, basis_column=S, requirement=S)

TRANSFER = struct(default_effect=S, rules=array(TRANSFER_RULE))
WINDOW = struct(actor_roles=array(S), time_column=S, rules=array(WINDOW_RULE))
ROW_FILTER = struct(roles=array(S), expression=S)
RETENTION = struct(period_n=I, period_unit=S, trigger=S, action=S)
MASKING = struct(method=S, exempt_roles=array(S))

# Typed parameters of a served rule: one nullable member per family.
PARAMETERS = dict(
    uses=array(S),
    grant_role=S,
    roles=array(S),
    masking=MASKING,
    transfer=TRANSFER,
    window=WINDOW,
    consent=array(CONSENT_RULE),
    row_filter=ROW_FILTER,
    retention=RETENTION,
    restrictions=array(S),
    regulation=S,
)

# The central fact: one row per rule and scope in a publication.
INSTRUCTION = struct(
    rule_id=L,
    policy=S,
    version=I,
    family=S,
    kind=S,
    instruction_key=S,
    scenario=S,
    database=S,
    schema=S,
    table=S,
    column=S,
    base_decision=S,
    band=I,
    weight=D,
    mode=S,
    conflict_status=S,
    effective_from=TS,
    effective_until=TS,
    **PARAMETERS,
)

REQUEST = struct(
    request_id=L,
    requested_at=TS,
    actor=L,
    role=S,
    database=S,
    schema=S,
    table=S,
    column=S,
    scenario=S,
    purpose=S,
    operation=S,
    dest_system=S,
    dest_jurisdiction=S,
    consumer_jurisdiction=S,
    as_of=TS,
)

SELECTOR = struct(
    databases=array(S),
    schemas=array(S),
    tables=array(S),
    columns=array(S),
    taxonomy_types=array(S),
    collections=array(S),
    tags=array(S),
)
POLICY_SPEC = struct(
    enforcement_mode=S,
    priority=I,
    selector=SELECTOR,
    sensitivity=S,
    category=S,
    permitted_uses=array(S),
    prohibited_uses=array(S),
    ai=struct(allow_training=B, allow_inference=B, requires_anonymization=B, restrictions=array(S)),
    allowed_roles=array(S),
    denied_roles=array(S),
    masking=MASKING,
    row_filter=ROW_FILTER,
    transfer=TRANSFER,
    window=WINDOW,
    consent=array(CONSENT_RULE),
    retention=struct(period=S, trigger=S, action=S),
    regulations=array(S),
    business_context=S,
    effective_from=S,
    effective_until=S,
)
POLICY = struct(
    policy_id=L,
    name=S,
    version=I,
    approved=B,
    published_at=TS,
    spec=POLICY_SPEC,
    scenario_map=T.MapType(S, struct(scenario_key=S, source=S)),
)

CATALOG_COLUMN = struct(
    name=S,
    data_type=S,
    nullable=B,
    description=S,
    tags=array(S),
    classification=struct(data_type_id=S, sensitivity=S, is_pii=B, source=S),
)
CATALOG_DOC = struct(
    name=S, description=S, database=S, schema=S, tags=array(S), columns=array(CATALOG_COLUMN)
)

CHANGE = struct(
    change_id=S,
    kind=S,
    source_path=S,
    description=S,
    sql=S,
    asset=ASSET,
    scenario_key=S,
    purpose_key=S,
)
CHANGE_SET = struct(change_set_id=S, description=S, changes=array(CHANGE))

MANIFEST_NODE = struct(
    name=S,
    resource_type=S,
    original_file_path=S,
    patch_path=S,
    description=S,
    compiled_code=S,
    compiled_sql=S,
    raw_code=S,
    raw_sql=S,
    checksum=struct(checksum=S),
    meta=T.MapType(S, S),
    config=struct(enabled=B, materialized=S, meta=T.MapType(S, S)),
    depends_on=struct(nodes=array(S)),
)
MANIFEST = struct(
    project=S, nodes=T.MapType(S, MANIFEST_NODE), exposures=T.MapType(S, MANIFEST_NODE)
)

CONDITION = struct(kind=S, requirement=S, policy=S, required_role=S)
OBLIGATION = struct(type=S, target=S, method=S, policy=S)

RECORDED_ANSWER = struct(
    case_id=S,
    tool=S,
    answer=struct(
        state=S,
        decision=S,
        reason_code=S,
        decision_id=S,
        instructions=array(struct(instruction_key=S, decision=S, scenario_key=S)),
        conditions=array(CONDITION),
        obligations=array(OBLIGATION),
        findings=array(struct(table=S, column=S, decision=S, severity=S, rationale=S)),
    ),
)
