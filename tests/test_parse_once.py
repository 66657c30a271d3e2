"""A filter on parsed messages does not repeat the parse."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.operators.quality import message_quarantine
from claimlake.sources.messages import parse_json


def test_a_filter_does_not_repeat_the_parse(spark):
    texts = ['{"claim_id": "c"}', '{"claim_id": 1, "n": "x"}', "{broken", "[1]", None, '{"n": 2}']
    rows = spark.createDataFrame([(t,) for t in texts], "_raw_value string").repartition(2)
    parsed = parse_json(rows, T.StructType.fromDDL("claim_id string, n int"))
    bad = message_quarantine(parsed, "claim_id", clock=F.lit("2025-01-01").cast("timestamp"))
    assert bad._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    reasons = {r._raw_value: r.quarantine_reason for r in bad.collect()}
    both = {"{broken": "invalid_json,claim_id_null", "[1]": "invalid_json,claim_id_null", None: "null_value,claim_id_null"}
    assert reasons == both | {'{"n": 2}': "claim_id_null"}
