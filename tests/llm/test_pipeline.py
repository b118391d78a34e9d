"""The corpus pipeline, and the registered queries against their SQL."""

from __future__ import annotations

import zlib
from pathlib import Path

import numpy as np
import pytest

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")


@pytest.mark.parametrize("name", ["op1_mixing", "op2_url_filter", "op7_winnowing"])
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    from neolake.llm import queries

    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    want = con.execute(queries.ORACLES[name]).fetchdf()
    got = queries.QUERIES[name](spark, DATA).toPandas()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    text = lambda df: sorted(tuple(map(str, r)) for r in df[columns].astype(object).where(df[columns].notna(), None).itertuples(index=False))
    assert text(got) == text(want)


def test_stages(spark):
    import corpus_pipeline as pipeline
    from neolake.llm import decontaminate, mixing, simhash, token_output
    from neolake.llm._common import Scratch, table
    from tokenizers import Tokenizer

    scratch = Scratch(spark, "t")
    raw = docs = table(spark, DATA, "documents")
    seen = []
    for name, stage in pipeline.STAGES[:-1]:
        before, docs = docs, scratch.store(stage(spark, docs, DATA), name)
        assert docs.columns == raw.columns
        seen.append((before, docs))
    language, copies, leaks, mix = (after for _, after in seen)
    assert {r.doc_id for r in language.collect()} == {r.doc_id for r in raw.collect() if any(c.isalpha() for c in r.text or "")}
    # one document of each group of equal texts stays, and no two that stay are near copies
    texts = {}
    for r in language.collect():
        texts.setdefault(" ".join(r.text.split()).lower(), []).append(r.doc_id)
    kept = {r.doc_id for r in copies.collect()}
    assert all(sum(i in kept for i in ids) <= 1 for ids in texts.values()) and simhash.near_copies(copies).count() == 0
    bench = table(spark, DATA, "benchmark")
    assert decontaminate.leaks(leaks, bench).count() == 0 and leaks.count() == copies.count() - decontaminate.leaks(copies, bench).select("doc_id").distinct().count()
    times = {r.doc_id: r.taken // r["size"] for r in mixing.mix(leaks).collect() if r["size"]}
    counted = {r.doc_id: r["count"] for r in mix.groupBy("doc_id").count().collect()}
    assert counted == {i: n for i, n in times.items() if n}
    t = Tokenizer.from_file(token_output.default_vocabulary())
    want, start = [], 0
    for r in sorted(mix.collect(), key=lambda r: r.doc_id):
        ids = [*t.encode(r.text, add_special_tokens=False).ids, token_output.END]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, pipeline.STAGES[-1][1](spark, mix, DATA).collect())) == sorted(want)
