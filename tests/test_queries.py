"""Every registered query of the operators against its SQL, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

from neolake.plans import catalogue

DATA = "/root/testdata/sf0.001"


def rows(frame):
    out = []
    for r in frame.astype(object).where(frame.notna(), None).itertuples(index=False):
        out.append(tuple(round(float(v), 9) if isinstance(v, (int, float)) and not isinstance(v, bool) else (str(v) if v is not None else None) for v in r))
    return sorted(out, key=repr)


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    want = con.execute(catalogue.ORACLES[name]).fetchdf()
    got = catalogue.QUERIES[name](spark, DATA).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    assert rows(got[columns]) == rows(want[columns])


def test_stream_of_filters(spark, tmp_path):
    from neolake.operators import filters
    from neolake.schemas import Thresholds
    from neolake.streaming import rows as streaming

    df = spark.createDataFrame([(1, 100.0), (2, 900.0), (3, None)], "id int, `Median MT IC50 Score` double")
    df.write.parquet(str(tmp_path / "in"))
    stream = streaming.epitope_stream(spark, str(tmp_path / "in"), df.schema)
    streaming.start(stream, [lambda d: filters.binding_filter(d, Thresholds())], str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(60)
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 3]
