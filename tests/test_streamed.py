"""The streamed medallion: equal to the batch one, over runs, restarts, repeats and nothing at all."""

import pytest
from pyspark.sql import functions as F

from claimlake.plans.medallion import TableFolders, run_batch
from claimlake.plans.streamed import CURRENT, StreamedTables, run_streamed
from claimlake.sources.tables import stream_folder
from tests.rows import raw


def clock():
    return F.lit("2025-01-01").cast("timestamp")


def arrivals(spark):
    """Rows of each entity in the order of three landings; the second has late and repeated rows, the third nothing new of some."""
    claims = [
        [{"claim_id": "A"}, {"claim_id": "B", "policy_id": "  "}, {"claim_id": None}, {"claim_id": "C", "paid_to_date": "9999"}],
        [{"claim_id": "A", "snapshot_date": "2025-03-01", "paid_to_date": "1000", "claim_status": "Closed"}, {"claim_id": "D", "event_id": None}],
        [{"claim_id": "A", "snapshot_date": "2024-12-01"}, {"claim_id": "D", "event_id": None}],
    ]
    premiums = [[{}], [{"policy_id": None}], []]
    zones = [[{}, {"postcode": " "}], [{"region_name": "Another"}], []]
    events = [[{}], [], [{"event_id": None}]]
    return {n: [raw(spark, n, *part) if part else None for part in parts] for n, parts in zip(
        ("claims", "premiums", "risk_zones", "cyclone_events"), (claims, premiums, zones, events), strict=True)}


def content(df):
    return sorted(str(tuple(r[c] for c in sorted(df.columns))) for r in df.collect())


def test_runs_and_restarts_give_what_one_batch_gives(spark, tmp_path):
    parts = arrivals(spark)
    schemas = {n: p[0].schema for n, p in parts.items()}
    batch = TableFolders(spark, str(tmp_path / "batch"))
    whole = {n: None for n in parts}
    for n, landed in parts.items():
        for df in landed:
            whole[n] = df if whole[n] is None else whole[n] if df is None else whole[n].unionByName(df)
    expected = run_batch(whole, batch, clock=clock())

    landing = {n: str(tmp_path / "landing" / n) for n in parts}
    for step in range(4):  # after the last landing one more run, which finds nothing
        for n, landed in parts.items():
            if step < 3 and landed[step] is not None:
                landed[step].write.mode("append").parquet(landing[n])
        tables = StreamedTables(spark, str(tmp_path / "streamed"), buckets=2)
        before = tables.current.versions()
        found = run_streamed({n: stream_folder(spark, landing[n], schemas[n]) for n in parts}, tables, clock=clock(), compact_after=2)
    assert content(found) == content(expected)
    assert sorted(tables.names) == sorted(batch.names)
    for name in batch.names:
        assert content(tables.read(name)) == content(batch.read(name)), name
    assert tables.read(CURRENT).where("claim_id = 'A'").first().claim_status == "Closed"
    assert tables.current.versions() == before


def test_nothing_landed_gives_empty_tables(spark, tmp_path):
    landing, streams = tmp_path / "landing", {}
    for n, parts in arrivals(spark).items():
        (landing / n).mkdir(parents=True)
        streams[n] = stream_folder(spark, str(landing / n), parts[0].schema)
    tables = StreamedTables(spark, str(tmp_path / "tables"))
    assert {r.row_count for r in run_streamed(streams, tables).collect()} == {0}
    assert tables.read("bronze_claims_bordereau_quarantine").count() == tables.read(CURRENT).count() == 0
    with pytest.raises(ValueError, match="risk_zones"):
        run_streamed({n: s for n, s in streams.items() if n != "risk_zones"}, tables)


def test_a_failed_layer_is_taken_up_again(spark, tmp_path, monkeypatch):
    """The run dies between silver and current claims: the next one merges what silver has and doubles nothing."""
    from claimlake.plans import streamed

    landing, streams = tmp_path / "landing", {}
    for n, parts in arrivals(spark).items():
        parts[0].write.parquet(str(landing / n))
        streams[n] = (str(landing / n), parts[0].schema)
    tables = StreamedTables(spark, str(tmp_path / "tables"), buckets=2)
    opened = lambda: {n: stream_folder(spark, *s) for n, s in streams.items()}

    def dies(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched, pytest.raises(RuntimeError, match="lost"):
        patched.setattr(streamed, "merge_stream", dies)
        run_streamed(opened(), tables, clock=clock())
    again = StreamedTables(spark, str(tmp_path / "tables"), buckets=2)
    found = {r.table_name: r.row_count for r in run_streamed(opened(), again, clock=clock()).collect()}
    assert found["silver_claims_bordereau"] == again.read(CURRENT).count() == 1  # B has no policy, C pays more than it cost
    assert found["bronze_claims_bordereau"] == 2
