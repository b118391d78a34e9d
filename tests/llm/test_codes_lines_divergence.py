"""Vector codes, line dedup and source divergence against plain versions, on awkward tables."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from neolake.llm import divergence, line_dedup, vector_codes
from neolake.llm.line_dedup import Cuckoo, LineIndex

# --- vector codes --------------------------------------------------------------------


def brute_codes(rows, parts=16, entries=64, rounds=2):
    kept = [(i, label, [int(np.floor(256 * x)) for x in v]) for i, v, label in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[2]))
    n = len(kept[0][2]) if kept else 0
    kept = [r for r in kept if len(r[2]) == n]
    w = n // parts
    cut = lambda v: [tuple(v[p * w : (p + 1) * w]) for p in range(parts)]
    pieces = [cut(v) for _, _, v in kept]
    books = [[pieces[i][p] for i in range(min(entries, len(pieces)))] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    assign = lambda: [[min((far(x[p], e), k) for k, e in enumerate(books[p])) for p in range(parts)] for x in pieces]
    for _ in range(rounds):
        at = assign()
        for p in range(parts):
            groups = defaultdict(list)
            for x, a in zip(pieces, at):
                groups[a[p][1]].append(x[p])
            books[p] = [tuple(sum(c) // len(groups[k]) for c in zip(*groups[k])) if k in groups else e for k, e in enumerate(books[p])]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out = [(r[0], "".join(f"{k:02x}" for _, k in a), sum(d for d, _ in a), r[1]) for r, a in zip(kept, assign())]
    by = Counter()
    for _, _, e, label in out:
        by[label] += e
    return sorted(((i, c, e, by[label], sha) for i, c, e, label in out), key=str)


def vectors(rnd, n, width=32):
    out = [(i, [rnd.choice([rnd.gauss(0, 0.3), rnd.randrange(-3, 3) / 256]) for _ in range(width)], rnd.choice([0, 0, 1, None])) for i in range(n)]
    out[3] = (3, out[2][1], 1)  # the same vector again
    out[5] = (5, [0.0] * width, 0)
    out[6] = (6, [-0.001] * width, 0)
    return out


@pytest.mark.parametrize("n", [7, 64, 200])
def test_codes_equal_a_full_search(spark, n):
    rows = vectors(random.Random(n), n)
    rows += [(1000, None, 1), (1001, [None] * 32, 1), (1002, [float("nan")] * 32, 1), (1003, [float("inf")] + [0.0] * 31, 0), (1004, [0.5] * 16, 0), (1005, [], 0), (2, rows[2][1], 0), (None, rows[4][1], None), (1006, [3e38] * 32, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumnsRenamed({}).selectExpr("*", "1 as code", "2 as values", "3 as error")
    got = vector_codes.compress(df.repartition(5)).collect()
    want = brute_codes([r for r in rows if r[0] != 1006 and (r[1] is None or len(r[1]) == 32)])
    assert sorted(map(tuple, got), key=str) == want


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vector_codes.compress(df).collect() == []
    assert vector_codes.compress(spark.createDataFrame([(1, None, 1)], df.schema)).collect() == []


def test_tree_finds_the_nearest_and_the_lowest_of_ties():
    rnd = np.random.default_rng(3)
    for width, spread in ((1, 3), (2, 4), (4, 200), (4, 1 << 24)):
        points = rnd.integers(-spread, spread, (64, width))
        points[40:50] = points[10:20]
        queries = np.concatenate([rnd.integers(-spread, spread, (3000, width)), points])
        square = ((queries[:, None] - points[None]) ** 2).sum(axis=2)
        codes, squares = vector_codes.nearest([vector_codes.Tree(points)], queries)
        assert (codes[:, 0] == square.argmin(axis=1)).all() and (squares[:, 0] == square.min(axis=1)).all()


def test_decode_gives_the_entries(spark):
    rows = vectors(random.Random(1), 100)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    kept = vector_codes.coded_rows(df, vector_codes.Scratch(spark, "t"))
    books = vector_codes.fit(kept, entries=8)
    both = vector_codes.decode(vector_codes.encode(kept, books), books).join(kept.select("vec_id", "values"), "vec_id").collect()
    assert len(both) == 100 and all(sum((a - b) ** 2 for a, b in zip(r.decoded, r["values"])) == r.error for r in both)


# --- line dedup ----------------------------------------------------------------------


def brute_lines(rows, min_chars=20, min_docs=3):
    key = lambda x: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", x).translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        last = lambda k: max((x for x in holders[k] if x is not None), default=None)
        kept = [x for x in lines if not (len(holders.get(key(x), ())) >= min_docs and i != last(key(x)))]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest(), "\n".join(kept)))
    return sorted(out, key=str)


def texts(rnd, n):
    pool = [f"{'Äb ' if k % 3 else 'a '}common line number {k} of all" for k in range(40)] + ["short", "", "x" * 19, "é" * 20, " " * 30]
    dress = lambda x: rnd.choice(["", " ", "\t\x0b", "\r"]) + rnd.choice([x, x.upper() if x.isascii() else x]) + rnd.choice(["", "\r", "  "])
    out = [(i, "\n".join(dress(rnd.choice(pool)) if rnd.random() < 0.6 else f"a line of its own {rnd.random()}" for _ in range(rnd.randrange(1, 12)))) for i in range(n)]
    return out + [(n, None), (n + 1, ""), (n + 2, "\n\n"), (3, out[5][1]), (3, None), (None, out[1][1]), (None, out[2][1]), (n + 3, "\n".join(x for _, x in out) * 3)]


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as hi", "2 as gone", "3 as shard")


@pytest.mark.parametrize("part_rows", [1 << 17, 7])
def test_lines(spark, part_rows, monkeypatch):
    monkeypatch.setattr(line_dedup, "PART_ROWS", part_rows)
    rows = texts(random.Random(2), 60)
    got = line_dedup.dedup_lines(docs_of(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == brute_lines(rows)


def test_lines_of_nothing(spark):
    assert line_dedup.dedup_lines(docs_of(spark, [])).collect() == []
    assert sorted(map(tuple, line_dedup.dedup_lines(docs_of(spark, [(1, None), (2, "a")])).collect())) == brute_lines([(1, None), (2, "a")])


def test_inserted_and_deleted_documents_leave_no_trace(spark, tmp_path):
    rnd = random.Random(8)
    rows = texts(rnd, 50)
    some = [r for r in rows if r[0] is not None and r[0] % 3]
    others = [r for r in rows if r not in some]
    index = LineIndex(spark, shards=3).insert(docs_of(spark, some[::2])).insert(docs_of(spark, some[1::2])).insert(docs_of(spark, others))
    assert sorted(map(tuple, index.apply(docs_of(spark, rows)).collect()), key=str) == brute_lines(rows)
    index.save(str(tmp_path / "index"))
    index = LineIndex.open(spark, str(tmp_path / "index"))
    index.delete(docs_of(spark, [*others, (10**9, "")]))
    kept = [r for r in some if r[0] not in {x[0] for x in others}]
    assert sorted(map(tuple, index.apply(docs_of(spark, kept)).collect()), key=str) == brute_lines(kept)
    alone = LineIndex(spark, shards=3).insert(docs_of(spark, kept))
    assert sorted(index.counts.collect()) == sorted(alone.counts.collect())
    full = lambda x: {r.shard: int((np.frombuffer(r.cells, np.uint16) > 0).sum()) for r in x.filters.collect()}
    assert {k: v for k, v in full(index).items() if v} == {k: v for k, v in full(alone).items() if v}


def test_cuckoo_filter():
    rnd = np.random.default_rng(5)
    names = rnd.integers(-(2**63), 2**63 - 1, 20_000)
    made = Cuckoo.build(names)
    assert made.holds(names).all()
    others = rnd.integers(-(2**63), 2**63 - 1, 100_000)
    assert made.holds(others).mean() < 0.001
    made.delete(names[:15_000])
    assert made.holds(names[15_000:]).all() and made.holds(names[:15_000]).mean() < 0.001
    assert made.insert(names[:15_000]) and made.holds(names).all()
    made.delete(names)
    assert not made.cells.any()
    same = np.full(6, 77, np.int64)  # equal fingerprints fill two buckets
    twice = Cuckoo(np.zeros((16, 4), np.uint16))
    assert twice.insert(same)
    twice.delete(same[:5])
    assert twice.holds(same).all()
    assert not Cuckoo(np.zeros((4, 4), np.uint16)).insert(names[:17])


def test_a_full_filter_is_made_anew(spark):
    few = [(i, "\n".join(f"line of many documents {k}" for k in range(3))) for i in range(4)]
    many = [(i, "\n".join(f"line of other documents {k}" for k in range(300))) for i in range(4, 8)]
    index = LineIndex(spark, shards=1).insert(docs_of(spark, few)).insert(docs_of(spark, many))
    assert sorted(map(tuple, index.apply(docs_of(spark, few + many)).collect()), key=str) == brute_lines(few + many)


# --- divergence ----------------------------------------------------------------------


def brute_audit(rows, min_docs, top):
    rows = [tuple(x or "" for x in r) for r in rows]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = [(lang, source, [x.translate(lower) for x in re.findall(divergence.TERM, text)]) for text, lang, source in rows]
    out = []
    for lang in {r[0] for r in found}:
        df = Counter(t for x, _, ts in found if x == lang for t in set(ts))
        kept = sorted(t for t, n in df.items() if n >= min_docs)
        count = {s: Counter() for x, s, _ in found if x == lang}
        for x, s, ts in found:
            if x == lang:
                count[s].update(t for t in ts if df[t] >= min_docs)
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}
        q = share(sum(count.values(), Counter()))
        p = {s: share(c) for s, c in count.items()}
        for s in count:
            pair = sorted(((sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in count if o != s), key=lambda x: (-x[0], x[1].encode()))
            term = sorted(((p[s][t] - q[t], t) for t in kept if count[s][t] and p[s][t] > q[t]), key=lambda x: (-x[0], x[1].encode()))[:top]
            out += [(lang, s, part, item, value, k + 1) for part, found_ in (("pair", pair), ("term", term)) for k, (value, item) in enumerate(found_)]
    return sorted(out)


@pytest.mark.parametrize(("block", "fan_in", "chunk"), [(256, 64, 1 << 16), (2, 2, 1 << 12)])
def test_divergence(spark, block, fan_in, chunk, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "FAN_IN", fan_in)
    monkeypatch.setattr(divergence, "CHUNK", chunk)
    rnd = random.Random(4)
    pool = [f"Wo{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(120)] + ["Übér", "ß", "日本", "z" * 300, "a"]
    text = lambda: rnd.choice([" ", "1", "\x00", "_"]).join(rnd.choice(pool[: rnd.randrange(5, len(pool))]) for _ in range(rnd.randrange(0, 60)))
    rows = [(rnd.choice([text(), text(), text(), None, ""]), rnd.choice(["en", "en", "en", "de", None]), rnd.choice(["a", "a", "b", "ä", "Z", None])) for _ in range(300)]
    rows += rows[:40] + [("x " * 100_000, "en", "long"), (None, "no", "x"), (None, "no", "y"), ("alone", "one", "only")]
    df = spark.createDataFrame(rows, "text string, lang string, source string").selectExpr("*", "1 as term", "2 as n", "3 as docs")
    got = divergence.audit(df.repartition(6), min_docs=8, top=5).collect()
    assert sorted(map(tuple, got)) == brute_audit(rows, 8, 5)


def test_divergence_of_nothing(spark):
    df = spark.createDataFrame([], "text string, lang string, source string")
    assert divergence.audit(df).collect() == []
    assert divergence.audit(spark.createDataFrame([(None, None, None)], df.schema)).collect() == []


def test_sketch_never_underestimates(spark):
    rnd = random.Random(6)
    rows = [(" ".join(f"t{chr(97 + rnd.randrange(26))}{chr(97 + min(25, int(rnd.expovariate(0.2))))}" for _ in range(50)), "en") for _ in range(200)]
    df = spark.createDataFrame(rows, "text string, lang string")
    cells = divergence.possible(df.repartition(7), 20, 1 << 16, divergence.Scratch(spark, "t"))
    counts = {r.term: r for r in divergence.counted(df.selectExpr("*", "'' as source"), cells, 1 << 16).collect()}
    exact = Counter(t for x, _ in rows for t in set(re.findall(divergence.TERM, x.lower())))
    assert all(counts[t].docs == n for t, n in exact.items() if n >= 20)
    assert len(counts) < len(exact)
