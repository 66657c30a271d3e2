import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from claimlake.schemas import CLAIMS, ENTITIES, RISK_ZONES, schema_from_json
from claimlake.sources import messages
from claimlake.sources.csv import read_csv_or_fallback, read_csv_text, read_csv_with_audit, read_text_lines
from claimlake.sources.landing import DATASETS, list_csv_files
from claimlake.sources.rescue import apply_hints

ZONES = "postcode,region_name,wind_risk_band\n0800,Darwin,T-W\n4870,Cairns,B-F\n"


def test_inferred_csv_loses_leading_zero_and_text_keeps_it(spark, tmp_path):
    (tmp_path / "zones.csv").write_text(ZONES)
    inferred = read_csv_with_audit(spark, str(tmp_path))
    assert {r.postcode for r in inferred.collect()} == {800, 4870}
    assert {r.source_file_name for r in inferred.collect()} == {"zones.csv"}
    text = read_csv_text(spark, str(tmp_path), RISK_ZONES.raw_schema())
    assert {r.postcode for r in text.collect()} == {"0800", "4870"}
    assert text.columns[-2:] == ["_ingest_ts", "_source_file"]
    assert text.first()._source_file.endswith("/zones.csv")


def test_fallback_is_used_for_missing_and_for_empty(spark, tmp_path):
    (tmp_path / "b.csv").write_text(ZONES)
    (tmp_path / "empty.csv").write_text("postcode,region_name,wind_risk_band\n")
    second = str(tmp_path / "b.csv")
    for first in ("missing.csv", "empty.csv"):
        assert read_csv_or_fallback(spark, str(tmp_path / first), second).count() == 2
    with pytest.raises(FileNotFoundError):
        read_csv_or_fallback(spark, str(tmp_path / "x.csv"), str(tmp_path / "y.csv"))


def test_csv_files_are_found_whatever_their_case(spark, tmp_path):
    for name in ("a.csv", "B.CSV", "c.txt"):
        (tmp_path / name).write_text(ZONES)
    assert [r.name for r in list_csv_files(spark, str(tmp_path)).collect()] == ["B.CSV", "a.csv"]
    with pytest.raises(FileNotFoundError):
        list_csv_files(spark, str(tmp_path / "none"))


def test_text_lines_drop_blank_ones(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"a":1}\n\n   \n{"a":2}\n')
    assert read_text_lines(spark, str(tmp_path)).count() == 2


def test_rescue_keeps_what_did_not_fit(spark):
    df = spark.createDataFrame(
        [("4870", "Cairns", "T-W"), ("x1", "Darwin", None), (None, None, None)], RISK_ZONES.raw_schema()
    )
    rows = apply_hints(df, RISK_ZONES.hints).orderBy(F.col("region_name").asc_nulls_last()).collect()
    assert rows[0].postcode == 4870 and rows[0]._rescued_data is None
    assert rows[1].postcode is None and json.loads(rows[1]._rescued_data) == {"postcode": "x1"}
    assert rows[2]._rescued_data is None


def test_registry_paths():
    claims = DATASETS[0]
    assert (claims.subdir, claims.table) == ("claims", "bronze_claims_bordereau")
    assert claims.source_path("/land/") == "/land/claims"
    assert claims.schema_path("/state") == "/state/claims/schema"
    assert claims.checkpoint_path("/state//") == "/state/claims/checkpoints"
    assert [d.table for d in DATASETS[1:]] == [
        "bronze_premium_bordereau", "bronze_risk_zone_lookup", "bronze_cyclone_events",
    ]


def test_contract_from_json_text():
    assert schema_from_json(RISK_ZONES.typed_schema().json()) == RISK_ZONES.typed_schema()


PAYLOAD = {
    "claim_id": "CLM-1", "policy_id": "POL-1", "event_id": None, "date_of_loss": "2025-02-10",
    "reported_date": "2025-02-17", "peril_type": "Wind", "claim_status": "Open",
    "incurred_amount": 1000.5, "paid_to_date": 0, "snapshot_date": "2025-02-17",
}


def test_messages_are_parsed_and_errors_named(spark):
    texts = [json.dumps(PAYLOAD), "{not valid", None, "5", json.dumps({**PAYLOAD, "date_of_loss": "soon"})]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "_offset bigint, _raw_value string")
    rows = {r._offset: r for r in messages.parse_json(df, CLAIMS.typed_schema()).collect()}
    assert rows[0]._parse_error is None and rows[0].claim_id == "CLM-1"
    assert rows[0].date_of_loss == dt.date(2025, 2, 10) and str(rows[0].incurred_amount) == "1000.50"
    assert [rows[i]._parse_error for i in (1, 2, 3)] == ["invalid_json", "null_value", "invalid_json"]
    assert rows[1].claim_id is None and rows[0]._topic is None
    assert rows[4]._parse_error is None and rows[4].date_of_loss is None and rows[4].claim_id == "CLM-1"


def test_only_objects_are_messages(spark):
    texts = {
        '{"claim_id":"a","claim_id":"b"}': "b", ' {"claim_id":"s"}': "s", '{"incurred_amount":"many","claim_id":"z"}': "z", "{}": None,
        '[{"claim_id":"a"}]': "bad", '"x"': "bad", "": "bad", "null": "bad", '{"claim_id":"a"': "bad", '{"claim_id":"a",}': "bad",
    }
    df = spark.createDataFrame([(t,) for t in texts], "_raw_value string")
    for row in messages.parse_json(df, CLAIMS.typed_schema()).collect():
        wanted = texts[row._raw_value]
        assert (row._parse_error, row.claim_id) == (("invalid_json", None) if wanted == "bad" else (None, wanted)), row._raw_value


def test_message_reader_contracts(spark):
    with pytest.raises(ValueError, match="_raw_value"):
        messages.parse_json(spark.range(1), CLAIMS.typed_schema())
    with pytest.raises(ValueError, match="unknown dataset"):
        messages.read_messages(spark, "nope")
    with pytest.raises(ValueError, match="messages.bootstrap.servers"):
        messages.read_messages(spark, "claims")
    options = messages.kafka_options("host:1", "claims", jaas="login")
    assert options["kafka.sasl.mechanism"] == "PLAIN" and options["failOnDataLoss"] == "false"
    kafka = spark.createDataFrame(
        [(bytearray(json.dumps(PAYLOAD).encode()), "claims", 3, 7, dt.datetime(2025, 1, 1))],
        "value binary, topic string, partition int, offset bigint, timestamp timestamp",
    )
    row = messages.read_messages(spark, "claims", rows=kafka).first()
    assert (row.claim_id, row._topic, row._partition, row._offset) == ("CLM-1", "claims", 3, 7)
    assert set(ENTITIES) == {"claims", "premiums", "risk_zones", "cyclone_events"}


def test_csv_goes_by_header_and_names_may_not_clash(spark, tmp_path, database):
    from claimlake.schemas import RISK_ZONES
    from claimlake.sinks.tables import ingest_folder
    from claimlake.sources.csv import read_csv_text

    (tmp_path / "Risk Zones.csv").write_text("wind_risk_band,postcode,other\nT-W,4870,x\n")
    row = read_csv_text(spark, str(tmp_path), RISK_ZONES.raw_schema()).first()
    assert (row.postcode, row.wind_risk_band, row.region_name) == ("4870", "T-W", None)
    (tmp_path / "risk-zones.csv").write_text("postcode\n1\n")
    with pytest.raises(ValueError, match="bronze_risk_zones"):
        ingest_folder(spark, str(tmp_path), database)


def test_typed_dates_come_in_several_spellings(spark):
    from claimlake.operators.projection import typed_claims
    from tests.rows import raw

    rows = raw(spark, "claims", {"date_of_loss": "2025/02/08", "reported_date": "02/17/2025"})
    row = typed_claims(rows).first()
    assert (row.date_of_loss, row.reported_date) == (dt.date(2025, 2, 8), dt.date(2025, 2, 17))


def test_shared_folder_is_required_off_one_machine():
    import types

    from claimlake import session

    def fake(master):
        return types.SimpleNamespace(conf=types.SimpleNamespace(get=lambda *a: ""), sparkContext=types.SimpleNamespace(master=master))

    assert session.shared_folder(fake("local[4]"))
    for master in ("local-cluster[2,1,1024]", "spark://host:7077"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.shared_folder(fake(master))
