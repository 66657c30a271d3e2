"""Kinds of text columns, how they widen, and batches lifted to kinds that came later."""

import datetime
import itertools
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimlake.sources.kinds import OPEN, TEXT, kinds_of, wider
from claimlake.streaming import inferring


def test_kinds_of_columns(spark):
    columns = {
        "a": ["1", "-2", None], "b": ["1", "3000000000", "2"], "c": ["1", "2.50", "-.5"], "d": ["1", "1e3", "2.5"], "e": ["2025-01-31", None, "2024-02-29"],
        "f": ["2025-01-31", "2025-01-31 10:00", "2025-01-31T10:00:00.5"], "g": ["1", "x", "2"], "h": [None, None, None], "i": ["2025-02-30", None, None],
        "j": ["007", " 8 ", "+9"], "k": ["1" * 39, "1", "1"], "l": ["NaN", "1", "2"], "m": ["12345678901234567890", "0.5", "1."], "n o`": ["1", "2", "3"],
    }
    names = [n.replace("`", "") for n in columns]
    df = spark.createDataFrame(list(zip(*columns.values(), strict=True)), ", ".join(f"`{n}` string" for n in names))
    assert list(kinds_of(df, names).values()) == [
        "int", "bigint", "decimal(3,2)", "double", "date", "timestamp", TEXT, OPEN, TEXT, "int", "double", TEXT, "decimal(21,1)", "int"
    ]
    assert kinds_of(df.limit(0), ["a"]) == {"a": OPEN} and kinds_of(df, []) == {}


def test_wider_is_a_lattice():
    kinds = [OPEN, "int", "bigint", "decimal(4,2)", "decimal(38,0)", "decimal(20,10)", "double", "date", "timestamp", TEXT]
    for a, b, c in itertools.product(kinds, repeat=3):
        assert wider(a, b) == wider(b, a) and wider(a, a) == a and wider(a, TEXT) == TEXT and wider(a, OPEN) == a
        assert wider(wider(a, b), c) == wider(a, wider(b, c)), (a, b, c)
    assert wider("int", "decimal(4,2)") == "decimal(12,2)" and wider("decimal(38,0)", "decimal(4,2)") == "double" and wider("int", "date") == TEXT


def test_a_column_turns_from_int_to_text(spark, tmp_path):
    landing, paths = tmp_path / "in", [str(tmp_path / n) for n in ("bronze", "kinds", "check")]
    landing.mkdir()

    def run(name, *lines):
        (landing / name).write_text("\n".join(lines) + "\n")
        inferring.ingest_inferred(spark, str(landing), *paths, hints="w int")
        return inferring.read_inferred(spark, *paths[:2], hints="w int")

    read = run("a.csv", "k,v,day,w,empty", "1,007,2025-01-01,5,", "2, 8,2025-01-02,bad,", "3,9,,,")
    assert dict(read.dtypes) | {"v": "int", "day": "date", "w": "int", "empty": "string"} == dict(read.dtypes)
    assert [r.v for r in read.orderBy("k").collect()] == [7, 8, 9] and '"w":"bad"' in read.where("k = 2").first()._rescued_data
    read = run("b.csv", "v,k,day", "1.50,4,2025-01-03 10:30:00")
    assert dict(read.dtypes)["v"] == "decimal(12,2)" and dict(read.dtypes)["day"] == "timestamp"
    assert [r.v for r in read.orderBy("k").collect()] == [Decimal(7), Decimal(8), Decimal(9), Decimal("1.5")]
    read = run("c.csv", "k,v,empty", "5,x,3", "6,,4")
    rows = {r.k: r for r in read.collect()}
    assert {k: r.v for k, r in rows.items()} == {1: "007", 2: " 8", 3: "9", 4: "1.50", 5: "x", 6: None}
    assert rows[1].day == datetime.datetime(2025, 1, 1) and rows[4].day == datetime.datetime(2025, 1, 3, 10, 30)
    assert rows[1].empty is None and rows[6].empty == 4 and rows[1].w == 5 and rows[5].w is None
    assert run("d.csv", "k,v", "7,8").count() == 7


def test_a_repeated_batch_replaces_what_it_wrote_under_narrower_kinds(spark, tmp_path):
    landing, paths = tmp_path / "in", [str(tmp_path / n) for n in ("bronze", "kinds", "check")]
    landing.mkdir()
    (landing / "a.csv").write_text("k\n1\n2\n")
    inferring.ingest_inferred(spark, str(landing), *paths)
    for commit in (tmp_path / "check" / "commits").iterdir():  # the crash came after the write, before the commit
        commit.unlink()
    inferring.KindLog(spark, paths[1]).extend({"k": TEXT})
    inferring.ingest_inferred(spark, str(landing), *paths)
    assert sorted(r.k for r in inferring.read_inferred(spark, *paths[:2]).collect()) == ["1", "2"]
    with pytest.raises(FileNotFoundError):
        inferring.read_inferred(spark, paths[0], str(tmp_path / "none"))


def test_texts_are_kept_only_where_the_type_prints_another(spark):
    df = spark.createDataFrame([("1", "1.5"), ("01", None), (None, "1.50")], "a string, b string")
    typed = inferring.typed(df, {"a": "int", "b": "decimal(3,2)"})
    assert [r._texts for r in typed.collect()] == [{"b": "1.5"}, {"a": "01"}, None]
    assert typed.where(F.col("a") == 1).count() == 2
