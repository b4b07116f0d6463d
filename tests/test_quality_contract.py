import json

import pytest
from pyspark.sql import functions as F

from tidewell.operators import quality
from tidewell.operators.quality import EVENT_RULES, QualityCheck, Rule, Severity, apply_rules
from tidewell.sources import contract, readers

EVENT_DDL = (
    "schema_version int, event_id string, event_type string, event_timestamp string, customer_id string, "
    "amount double, usage_gb double"
)
GOOD = (1, "e1", "usage", "2026-01-01T00:00:00Z", "c1", None, 3.0)
EVENTS = [
    GOOD,
    (1, None, "usage", "2026-01-01T00:00:00Z", "c1", None, 1.0),
    (1, "", None, "2026-01-01T00:00:00Z", "c1", None, 1.0),
    (1, "e2", "usage", "2026-01-01T00:00:00Z", "", None, 1.0),
    (1, "e3", "usage", "not a time", "c1", None, 1.0),
    (1, "e4", "usage", "2031-01-01T00:00:00Z", "c1", None, 1.0),
    (1, "e5", "teleportation", "2026-01-01T00:00:00Z", "c1", None, 1.0),
    (1, "e6", None, "2026-01-01T00:00:00Z", "c1", None, 1.0),
    (None, "e7", "payment", "2026-01-01T00:00:00Z", "c1", -5.0, -1.0),
]


@pytest.fixture
def events(spark):
    return spark.createDataFrame(EVENTS, EVENT_DDL)


def sequential(df, rules):
    """The rules one after another, as plain filters: the definition of the counts."""
    out = []
    for r in rules:
        ok = F.coalesce(r.valid(), F.lit(False))
        total, bad = df.count(), df.where(~ok).count()
        out.append((r.name, total, total - bad, bad))
        if r.severity is Severity.QUARANTINE:
            df = df.where(ok)
    return out, df


def test_one_pass_equals_sequential(events):
    want, survivors = sequential(events, EVENT_RULES)
    check = QualityCheck(events, EVENT_RULES, "r", "bronze")
    got = check.metrics().orderBy("rule_order").collect()
    assert [(r.rule_name, r.total_rows, r.passing_rows, r.violating_rows) for r in got] == want
    assert sorted(check.clean().collect(), key=str) == sorted(survivors.collect(), key=str)


def test_rows_are_conserved_and_quarantined_once(events):
    check = QualityCheck(events, EVENT_RULES, "r", "bronze")
    bad = check.quarantine().collect()
    assert check.clean().count() + len(bad) == events.count()
    by_id = {json.loads(r.original_payload).get("event_id"): r.violated_rule for r in bad}
    assert by_id[""] == "event_id_not_null"  # also breaks the type rule, counted under the first
    assert by_id["e6"] == "event_type_in_contract"  # a null predicate is a violation
    assert by_id["e4"] == by_id["e3"] == "event_timestamp_plausible"


def test_fail_rule_raises_in_order(events):
    rules = [EVENT_RULES[0], Rule("has_id", "id must exist", Severity.FAIL, lambda: F.col("event_id").isNotNull())]
    QualityCheck(events, rules).enforce()  # the quarantine rule before it removed the null id
    with pytest.raises(quality.RuleFailed, match="has_id"):
        QualityCheck(events, rules[::-1]).enforce()


def test_apply_rules_writes_both_tables(store, events):
    clean, found = apply_rules(store, events, EVENT_RULES, "run-7", "bronze")
    assert clean.count() == 2
    assert store.read("quarantine").count() == 7
    metrics = store.read("data_quality_metrics")
    assert metrics.count() == len(EVENT_RULES) == len(found)
    assert metrics.columns == [
        "rule_name", "severity", "total_rows", "passing_rows", "violating_rows", "stage", "run_id", "evaluated_at",
    ]


def test_snapshot_rules_quarantine_null_tenure(spark):
    ddl = "customer_id string, churn_label int, senior_citizen int, monthly_charges double, tenure int, total_charges double"
    df = spark.createDataFrame([("a", 1, 0, 1.0, None, 1.0), ("b", 0, 0, 1.0, 0, None), ("c", 2, 0, 1.0, 1, 1.0)], ddl)
    check = QualityCheck(df, quality.SNAPSHOT_RULES)
    assert [r.customer_id for r in check.clean().collect()] == ["b"]
    assert {r.violated_rule for r in check.quarantine().collect()} == {"tenure_valid", "churn_label_valid"}


def test_contract_schema():
    schema = contract.EVENT_CONTRACT.struct_type()
    assert len(schema) == 15
    assert sorted(f.name for f in schema if not f.nullable) == contract.EVENT_CONTRACT.required
    assert schema["amount"].dataType.simpleString() == "double"


def test_contract_messages(spark):
    base = {
        "schema_version": 1, "event_id": "x", "event_type": "usage", "event_timestamp": "t", "event_date": "d",
        "customer_id": "c", "payment_status": None, "complaint_severity": None, "support_topic": None,
    }
    cases = [
        (base, []),
        (base | {"event_id": None}, ["missing required field: event_id"]),
        (base | {"event_type": "teleportation"}, ["invalid event_type: teleportation"]),
        (base | {"payment_status": "maybe"}, ["invalid payment_status: maybe"]),
        (base | {"schema_version": 999}, ["unsupported schema_version: 999"]),
    ]
    ddl = ", ".join(f"{k} {'int' if k == 'schema_version' else 'string'}" for k in base)
    df = spark.createDataFrame([tuple(c.values()) for c, _ in cases], ddl)
    got = [r[0] for r in df.select(contract.violation_messages(contract.EVENT_CONTRACT, base)).collect()]
    assert got == [m for _, m in cases]


def test_unknown_fields_are_reported_and_rescued(spark):
    line = json.dumps({"event_id": "x", "rogue_field": 5})
    raw = spark.createDataFrame([(line,), ("{broken",), (None,)], "value string")
    names = contract.violation_messages(contract.EVENT_CONTRACT, [], contract.raw_field_names(F.col("value")))
    assert "unknown field: rogue_field" in raw.limit(1).select(names).first()[0]
    parsed = contract.parse_with_rescue(raw, contract.EVENT_CONTRACT).collect()
    assert parsed[0].event_id == "x" and json.loads(parsed[0]._rescued_data) == {"rogue_field": "5"}
    assert parsed[1].event_id is None and parsed[1]._rescued_data == "{broken"
    assert parsed[2]._rescued_data is None


def test_a_line_is_parsed_once_for_its_fields_and_once_for_the_others(spark):
    raw = spark.createDataFrame([(json.dumps({"event_id": "x", "rogue": 5}), "f")], "value string, _source_file string")
    parsed = contract.parse_with_rescue(raw, contract.EVENT_CONTRACT)
    assert parsed._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 2
    assert parsed.columns == [*contract.EVENT_CONTRACT.names, "_rescued_data", "_source_file"]


def test_entity_state(spark):
    ddl = (
        "customer_id string, tenure int, monthly_charges double, churn_label int, contract string, "
        "internet_service string, payment_method string, tech_support string"
    )
    rows = [("c1 ", 12, 79.95, 1, " ", "Fiber", None, "No"), (" ", -1, -1.0, 3, "x", "x", "x", "x")]
    good, bad = contract.validate_entity_state(spark.createDataFrame(rows, ddl)).collect()
    assert (good.customer_id, good.contract, good.payment_method, good.state_errors) == ("c1", "Unknown", "Unknown", [])
    assert len(bad.state_errors) == 4


def test_seed_csv(spark, tmp_path):
    path = str(tmp_path / "seed.csv")
    header = ",".join(contract.SEED_COLUMNS)
    (tmp_path / "seed.csv").write_text(header + "\n" + ",".join(f"v{i}" for i in range(21)) + "\n")
    row = readers.read_seed_csv(spark, path).first()
    assert row._source_type == "csv_seed" and row._source_file.endswith("seed.csv") and len(row._record_hash) == 64
    (tmp_path / "empty.csv").write_text(header + "\n")
    with pytest.raises(readers.SourceError, match="empty"):
        readers.read_seed_csv(spark, str(tmp_path / "empty.csv"))
    (tmp_path / "other.csv").write_text("a,b\n1,2\n")
    with pytest.raises(readers.SourceError, match="unexpected CSV columns"):
        readers.read_seed_csv(spark, str(tmp_path / "other.csv"))


def test_required_columns(spark):
    with pytest.raises(readers.SourceError, match=r"\['a', 'z'\]"):
        readers.require_columns(spark.range(1), ["z", "id", "a"])
