import pytest

from traitweave.sources.writers import flat_csv_frame, write_csv, write_parquet


@pytest.fixture
def df(spark):
    return spark.createDataFrame([(1, True, ["a", None, "b"]), (2, None, [])], "eid int, flag boolean, labels array<string>")


def test_parquet_round_trip(spark, df, tmp_path):
    write_parquet(df, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.schema == df.schema
    assert sorted(back.collect()) == sorted(df.collect())
    with pytest.raises(Exception, match="already exists"):
        write_parquet(df, str(tmp_path / "out"))
    write_parquet(df, str(tmp_path / "out"), mode="append")
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_csv(spark, df, tmp_path):
    write_csv(df, str(tmp_path / "out"), arrays="joined", null_text="~")
    lines = sorted(line for part in (tmp_path / "out").glob("*.csv") for line in part.read_text().splitlines())
    assert set(lines) == {"eid,flag,labels", "1,true,a|~|b", '2,,""'}


def test_flat_frame(df):
    assert [r.labels for r in flat_csv_frame(df, arrays="joined").collect()] == ["a|b", ""]
    assert [r.labels for r in flat_csv_frame(df).collect()] == ['["a",null,"b"]', "[]"]
    with pytest.raises(ValueError, match="arrays"):
        flat_csv_frame(df, arrays="xml")
