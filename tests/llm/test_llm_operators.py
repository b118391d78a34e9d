"""Each training-data operator against a brute-force version, on small and awkward tables."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from neolake.llm import decontaminate, html_blocks, html_crf, language, mixing, quality, rans, simhash, suffix_dedup, token_output, url_filter, winnowing
from neolake.llm._common import Scratch

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, h long"


def document(rnd, n, words):
    return " ".join(rnd.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def awkward(spark):
    """Null ids and texts, empty and long texts, equal rows, copies, odd characters; columns named like the operators' own."""
    rnd = random.Random(8)
    words = [f"w{i}ord" for i in range(300)]
    base = document(rnd, 120, words)
    rows = [(i, document(rnd, rnd.randint(1, 80), words), "en", rnd.choice(["a", "b", None])) for i in range(20)]
    rows += [(20, base, "en", "a"), (21, base, "en", "a"), (22, base.upper(), "en", "b"), (23, base + " more words here", "en", "c"), (24, None, None, None), (25, "", "en", "a"), (26, "   \n\t", "fr", "b"), (27, "é中🙂 ß", "xx", "c")]
    rows += [(28, document(rnd, 6000, words), "en", "a"), (29, "word", "en", "b"), (None, base, "en", "a"), (20, base, "en", "a"), (-5, base[:200], "en", None), (30, "a" * 500, "en", "a"), (31, "b" + "a" * 400, "en", "a")]
    return [(*r, len(r[1] or ""), 1, 2) for r in rows]


@pytest.fixture(scope="module")
def docs(spark, awkward):
    return spark.createDataFrame(awkward, SCHEMA)


@pytest.fixture(scope="module")
def unique(spark, awkward):
    """The same without null and repeated ids."""
    seen = {}
    for r in awkward:
        if r[0] is not None:
            seen.setdefault(r[0], r)
    return spark.createDataFrame(list(seen.values()), SCHEMA), list(seen.values())


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- 1 -------------------------------------------------------------------------------


def test_mix_is_fair(spark, docs, awkward):
    got = mixing.mix(docs).collect()
    assert len(got) == len(awkward) and all(r.taken <= 3 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0) for r in got)
    assert sum(r.taken for r in got) <= sum(r["size"] for r in got)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(docs.repartition(7)).collect()), key=str)
    assert mixing.mix(empty(spark)).count() == 0
    copies = mixing.mix_documents(docs)
    assert copies.columns == docs.columns and copies.agg(F.sum(F.regexp_count("text", F.lit(mixing.WORD)))).first()[0] >= 0


def test_targets_refill_until_none_is_above(spark):
    for sizes in ({"a": 10, "b": 10, "c": 10}, {"a": 1000, "b": 1, "c": 2, None: 50}, {"x": 0, "y": 5}, {"q": 7}):
        df = spark.createDataFrame([(k, 1, v) for k, v in sizes.items()], "source string, n long, source_size long")
        got = {r.source: r.target for r in mixing.source_targets(df).collect()}
        names = sorted(sizes, key=lambda s: (s is None, s or ""))
        weight = {s: i % 3 + 1 for i, s in enumerate(names)}
        total, open_, want = sum(sizes.values()), set(names), {}
        while open_:
            share = {s: (total - sum(want.values())) * weight[s] / sum(weight[x] for x in open_) for s in open_}
            over = {s for s in open_ if share[s] > 3 * sizes[s]}
            if not over:
                want |= share
                break
            want |= {s: 3.0 * sizes[s] for s in over}
            open_ -= over
        assert got == pytest.approx(want)


# --- 2 -------------------------------------------------------------------------------


def test_url_rules(spark):
    urls = ["http://A.net/x", "http://net/", "http://a.example.net/en/1", "http://xnet/", "https://b.example.com/de/", "https://b.example.com/en", "http://f.org/fr/x?q#z", "http://f.org?x", "nothing", None, "http://a.net", "ftp://x.net#f"]
    df = spark.createDataFrame([(i, u, None, i) for i, u in enumerate(urls)], "page_id long, url string, html string, host int")
    got = {r.page_id: (r.host, r.path, r.rule) for r in url_filter.judge(df, url_filter.rule_table(spark)).collect()}
    assert [got[i] for i in range(len(urls))] == [
        ("a.net", "/x", "net/"), ("net", "/", "net/"), ("a.example.net", "/en/1", "example.net/en/"), ("xnet", "/", None), ("b.example.com", "/de/", "example.com/de/"), ("b.example.com", "/en", None), ("f.org", "/fr/x", "org/fr/"), ("f.org", "", None), ("", "", None), ("", "", None), ("a.net", "", None), ("x.net", "", None),
    ]


def test_link_graph_spreads_distrust_and_trust(spark):
    link = lambda *hs: "".join(f'<a href="http://{h}/">x</a>' for h in hs)
    targets = [f"t{i}.net" for i in range(3)]
    farms = [f"f{i}.biz" for i in range(8)]
    out = {"farm.biz": ["bad.net"], "farm2.biz": ["farm.biz"], "twin.biz": ["bad.net"], "ok.org": ["friend.biz"], "mixed.biz": ["ok.org", "good1.biz", "good2.biz", "bad.net"], **{f: targets for f in farms}}
    urls = {"bad.net": "/a", "ok.org": "/fr/a", **{t: "/" for t in targets}}
    hosts = [*urls, *(h for h in out if h not in urls), "friend.biz", "lone.biz", "good1.biz", "good2.biz"]
    df = spark.createDataFrame([(i, f"http://{h}{urls.get(h, '/x')}", link(*out.get(h, ()))) for i, h in enumerate(hosts)], "page_id long, url string, html string")
    got = {r.host: r for r in url_filter.judge(df, url_filter.rule_table(spark)).collect()}
    d = url_filter.DAMPING
    back = {}
    for s, ts in out.items():
        for t in ts:
            back.setdefault(t, []).append(s)

    def shares(seed, links):
        x, y = ({h: (1 - d) * seed.get(h, 0) for h in hosts}, {h: 1 - d for h in hosts})
        for _ in range(url_filter.ITERATIONS):
            x2, got = {h: (1 - d) * seed.get(h, 0) for h in hosts}, dict.fromkeys(hosts, 0.0)
            for s, ts in links.items():
                for t in ts:
                    x2[t] += d * x[s] / len(ts)
                    got[t] += d * y[s] / len(ts)
            x, y = x2, {h: 1 - d + got[h] for h in hosts}
        whole = {h: got[h] + (1 - d) * (h in urls) for h in hosts}
        return {h: x[h] / whole[h] if whole[h] else 0.0 for h in hosts}

    trust, distrust = shares({"ok.org": 1}, out), shares(dict.fromkeys([h for h in urls if h != "ok.org"], 1), back)
    assert all(got[h].trust == pytest.approx(trust[h]) and got[h].distrust == pytest.approx(distrust[h]) for h in hosts)
    blocked = {h for h in hosts if got[h].verdict == "block"}
    assert blocked == {"bad.net", "farm.biz", "twin.biz", *targets, *farms}  # however many link to a blocked host


def test_urls_of_empty_and_repeated_rows(spark):
    rules = url_filter.rule_table(spark)
    schema = "page_id long, url string, html string, action string"
    assert url_filter.judge(spark.createDataFrame([], schema), rules).count() == 0
    rows = [(1, "http://a.net/x", "", "z"), (1, "http://a.net/x", "", "z"), (2, None, None, None), (None, "http://b.org/fr/", None, None)]
    got = sorted(((r.page_id, r.host, r.rule, r.verdict) for r in url_filter.judge(spark.createDataFrame(rows, schema), rules).collect()), key=str)
    assert got == sorted([(1, "a.net", "net/", "block")] * 2 + [(2, "", None, "allow"), (None, "b.org", "org/fr/", "allow")], key=str)


# --- 3 -------------------------------------------------------------------------------


def test_longest_common_subsequence():
    rnd = random.Random(2)
    for _ in range(100):
        a, b = ([rnd.randint(0, 4) for _ in range(rnd.randint(1, 12))] for _ in "ab")
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert decontaminate.lcs(np.array(a), np.array(b)) == t[-1][-1]


def test_leaks_and_paraphrases_are_found(spark):
    rnd = random.Random(4)
    words = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in "lmnrst"]
    items = [(i, document(rnd, rnd.randint(15, 45), words) + ". " + document(rnd, 6, words) + ".") for i in range(12)]
    texts, want = [], set()
    for d in range(200):
        t = document(rnd, rnd.randint(60, 200), words).split()
        if d % 10 == 0:
            i, item = items[d // 10 % 12]
            p = item.split()
            if d % 20 == 0:  # a paraphrase: some words of the question replaced, the answer kept
                for k in rnd.sample(range(len(p) - 7), (len(p) - 7) // 5):
                    p[k] = "qqq"
            at = rnd.randint(0, len(t))
            t[at:at] = p
            want.add((d, i))
        texts.append((d, " ".join(t), 1))
    texts += [(500, None, 1), (501, "", 1), (None, items[0][1], 1)]
    df, bench = spark.createDataFrame(texts, "doc_id long, text string, item_id int"), spark.createDataFrame([*items, (90, None), (91, "...")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(df, bench).collect()}
    assert got - {(None, 0)} == want and (None, 0) in got
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(df, bench, items_at_once=4).collect()} == got
    kept = decontaminate.decontaminate(df, bench)
    assert kept.count() == len(texts) - len(want) - 1
    assert decontaminate.leaks(df.limit(0), bench).count() == 0 and decontaminate.leaks(df, bench.limit(0)).count() == 0


# --- 4 -------------------------------------------------------------------------------


def test_language_by_held_out_rows(spark, docs):
    rnd = random.Random(1)
    stock = {"en": "the of and to in that it was for with".split(), "de": "der die und ist nicht ein zu den mit auch".split(), "fr": "le la les et des que une dans pour est".split()}
    rows = [(i, " ".join(rnd.choice(stock[x]) for _ in range(rnd.randint(5, 40))), x, i) for i, x in enumerate(random.Random(3).choices(list(stock), k=400))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = {r.doc_id: r for r in language.predict(df, language.fit(df)).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert {r[0] for r in held} == {i for i, r in got.items() if r.held_out}
    assert np.mean([got[i].lang_pred == x for i, _, x, _ in held]) > 0.98 and all(0 <= r.score <= 1 for r in got.values())
    model = language.fit(docs)
    odd = {r.doc_id: r for r in language.predict(docs, model).collect()}
    assert all((odd[i].lang_pred, odd[i].score) == ("und", 0.0) for i in (24, 25, 26))
    assert language.keep_identified(docs, model).columns == docs.columns
    assert language.predict(empty(spark), language.fit(empty(spark))).count() == 0


# --- 5 -------------------------------------------------------------------------------


def brute_repeats(rows, length=50):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        if i is not None:
            for j in range(len(b) - length + 1):
                first[b[j : j + length]] = min(first.get(b[j : j + length], i), i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        if i is not None:
            for j in range(len(b) - length + 1):
                if first[b[j : j + length]] < i:
                    gone[j : j + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((i, len(b), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [50_000, 2])
def test_repeats(spark, docs, awkward, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    got = suffix_dedup.remove_repeats(docs).drop("kept").collect()
    assert sorted(map(tuple, got), key=str) == brute_repeats([r[:2] for r in awkward])
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0


def test_least_holders():
    rnd = np.random.default_rng(1)
    for n in range(30):
        length = [5, 8, 50][n % 3]
        base = bytes(rnd.integers(97, 97 + [2, 4, 20][n % 3], 200, dtype=np.uint8))
        segments = [base[a : a + length + k] for a, k in zip(rnd.integers(0, 120, 20), rnd.integers(0, 25, 20))]
        holders = rnd.integers(0, 50, len(segments))
        got = suffix_dedup.least_holders(np.frombuffer(b"".join(segments), np.uint8), np.r_[0, np.cumsum([len(s) for s in segments])], holders, length)
        least = {}
        for s, h in zip(segments, holders):
            for i in range(len(s) - length + 1):
                least[s[i : i + length]] = min(least.get(s[i : i + length], 99), h)
        assert got.tolist() == [least[s[i : i + length]] for s in segments for i in range(len(s) - length + 1)]


# --- 6 -------------------------------------------------------------------------------


def test_resampling_takes_the_k_largest(spark, docs):
    rnd = random.Random(6)
    good, bad = [f"good{i}" for i in range(40)], [f"junk{i}" for i in range(40)]
    rows = [(i, document(rnd, 30, good if i % 4 else bad + good[:5]), i) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, log_weight int")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(0, 400, 2)] + [(None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.resample(df, labels, 0.75).collect()
    assert len(got) == 300 and np.mean([r.doc_id % 4 > 0 for r in got]) > 0.97
    every = {r.doc_id: r.gumbel_key for r in quality.resample(df, labels, 1.0).collect()}
    assert {r.doc_id for r in got} == set(sorted(every, key=lambda i: (-every[i], i))[:300])
    assert quality.resample(docs, labels.limit(0)).count() == docs.count() and quality.resample(empty(spark), labels).count() == 0 and quality.resample(docs, labels, 0.0).count() == 0


def test_nth_largest_narrows_down(spark, monkeypatch):
    monkeypatch.setattr(quality, "EXACT", 5)
    rnd = random.Random(9)
    rows = [(i, float(rnd.choice([1, 2, 2, 2, 5, rnd.random()]))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, key double")
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    for k in (1, 17, 120, 299):
        assert quality.nth_largest(df, k) == (order[k - 1][1], order[k - 1][0])
    assert quality.nth_largest(df, 300) is None


# --- 7 -------------------------------------------------------------------------------


def brute_fingerprint(text, k=winnowing.K, w=winnowing.W):
    parts = [zlib.crc32(x.encode()) for x in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate({9: 32, 10: 32, 11: 32, 12: 32, 13: 32}).split(" ") if x]
    if not parts:
        return []
    grams = []
    for i in range(max(1, len(parts) - k + 1)):
        h = 0
        for x in parts[i : i + k]:
            h = (h * winnowing.BASE + x) % winnowing.MODULUS
        grams.append((h, i))
    out = []
    for i in range(max(1, len(grams) - w + 1)):
        best = min(grams[i : i + w], key=lambda g: (g[0], -g[1]))
        if best not in out:
            out.append(best)
    return out


@pytest.mark.parametrize("ids", ["unique", "repeated"])
def test_winnowing(spark, docs, awkward, unique, ids, monkeypatch):
    monkeypatch.setattr(winnowing, "ROWS", 4)
    df, rows = unique if ids == "unique" else (docs, awkward)
    known = sorted({r[0] for r in rows if r[0] is not None})
    text = {i: min((r[1] or "") for r in rows if r[0] == i) for i in known}
    want = []
    jaccard = lambda a, b: 1.0 if not a | b else len(a & b) / len(a | b)
    for i, t, *_ in rows:
        t = t or ""
        after = text[known[0] if i is None else known[(known.index(i) + 1) % len(known)]]
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        a, b, c = (brute_fingerprint(x) for x in (t, edited, after))
        digest = lambda fp: hashlib.md5(" ".join(str(h * 2**32 + winnowing.LAST - p) for h, p in fp).encode()).hexdigest()
        s = [{h for h, _ in x} for x in (a, b, c)]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), digest(a), digest(b), jaccard(s[0], s[1]), jaccard(s[0], s[2])))
    got = [tuple(r) for r in winnowing.winnow(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert winnowing.winnow(empty(spark)).count() == 0


def test_positions_and_guarantee(spark):
    rnd = random.Random(2)
    words = [f"v{i}" for i in range(50)]
    shared = document(rnd, winnowing.K + winnowing.W - 1, words)
    rows = [(i, f"{document(rnd, 20, words)} {shared} {document(rnd, 9, words)}") for i in range(8)]
    fp = winnowing.fingerprint(F.col("text"))
    got = spark.createDataFrame(rows, "doc_id long, text string").select("text", fp.alias("f"), winnowing.hashes(fp).alias("h"), winnowing.positions(fp).alias("p")).collect()
    assert all(set(a.h) & set(b.h) for a in got for b in got)
    assert all(r.p == [p for _, p in brute_fingerprint(r.text)] for r in got)


# --- 8 -------------------------------------------------------------------------------


def test_deep_and_long_pages_take_linear_memory():
    import tracemalloc

    peaks = []
    for n in (10_000, 40_000):
        page = "".join(f'<div class="c{"abcdefghij"[i % 10]}x">' for i in range(n)) + "text" + "<p>end</i></section>" * 500
        tracemalloc.start()
        found = html_blocks.blocks(page)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert [b.text for b in found] == ["text"] + ["end"] * 500
    assert peaks[1] < 6 * peaks[0] and peaks[1] < 50e6
    body = "<p>" + "word " * 20 + "</p>"
    page = f"<body><nav><a href=x>menu</a></nav><article><h1>title of it</h1>{body * 100_000}</article></body>"  # 10 MB
    assert len(html_crf.default_field().extract(page)) > 9e6


def test_formulas_and_noscript_are_text():
    found = html_blocks.blocks("<article><p>Let <math><mi>x</mi><mo>&lt;</mo></math> be</p><noscript><p>told</p></noscript><svg><text>no</text></svg><object>shown</object></article>")
    assert [b.text for b in found] == ["Let x< be", "told", "shown"]


def test_blocks_of_broken_markup():
    page = "<div><p>one <b>two<br>three<p>four &amp; five&nbsp;six</div><script>x='<p>no</p>'</script>seven<!-- eight --><ul><li>nine<li>ten</ul><p title='a>b'>eleven"
    assert [b.text for b in html_blocks.blocks(page)] == ["one two three", "four & five six", "seven", "nine", "ten", "eleven"]
    assert html_blocks.blocks(None) == html_blocks.blocks("") == html_blocks.blocks("<p> </p>") == []
    for junk in ("<", "</", "<a", "<p <p <p", "<!--", "<script>", "&#0;&#x110000;", "</p></div>x", "<a href='" * 50):
        html_blocks.blocks(junk)


def test_field_on_held_out_pages():
    field = html_crf.default_field()
    right = total = 0
    for page, labels in html_crf.labelled_pages(150, 99):
        got = field.decode(page)
        right, total = right + sum(a == b for a, b in zip(got, labels)), total + len(labels)
    assert right / total > 0.97


def test_extraction(spark):
    page = """<html><head><title>t</title></head><body><header>Site</header><nav><ul><li><a href=/>Home</a></ul></nav><div class="cookie-notice">We use cookies.</div>
    <article><h1>A  title</h1><p>First &lt;paragraph&gt;.<div class="ad">Buy now</div><p>Second <i>one</i>.</article>
    <aside><h3>Related</h3><p>Other story.</p></aside><section class="comments"><p class="comment">I disagree.</p></section><form><label>Name</label><button>Send</button></form><footer>&copy; 2020</footer></body></html>"""
    df = spark.createDataFrame([(1, "u", page, "x"), (2, None, None, "x"), (3, "u", "", "x"), (1, "u", page, "x")], "page_id long, url string, html string, text string")
    got = sorted(tuple(r) for r in html_crf.extract(df).select("page_id", "text", "n_chars").collect())
    want = "A title First <paragraph>. Second one."
    assert got == [(1, want, len(want)), (1, want, len(want)), (2, "", 0), (3, "", 0)]
    assert html_crf.extract(df.limit(0)).count() == 0


# --- 9 -------------------------------------------------------------------------------


def brute_simhash(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    runs = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hs = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids, fps, radius=3):
    part = list(range(len(fps)))

    def find(i):
        while part[i] != i:
            i = part[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                part[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(ids))]


def test_simhash_components(spark, docs, awkward):
    got = sorted(map(tuple, simhash.simhash_components(docs).collect()), key=str)
    fps = [brute_simhash(r[1]) for r in awkward]
    parts = brute_components([r[0] for r in awkward], fps)
    assert got == sorted(((r[0], f"{f:016x}", c) for r, f, c in zip(awkward, fps, parts)), key=str)
    assert simhash.simhash_components(empty(spark)).count() == 0


@pytest.mark.parametrize("hot", [4096, 3])
def test_links_have_the_components_of_all_pairs(spark, hot, monkeypatch):
    monkeypatch.setattr(simhash, "HOT", hot)
    rnd = random.Random(5)
    fps = {rnd.getrandbits(64) for _ in range(40)}
    for f in list(fps)[:15]:
        for _ in range(6):
            for _ in range(rnd.randint(1, 4)):
                f ^= 1 << rnd.randrange(64)
            fps.add(f)
    fps = [int(np.uint64(f).view(np.int64)) for f in fps]
    scratch = Scratch(spark, "t")
    pairs = [(r.u, r.v) for r in simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), scratch).collect()]
    assert all((u ^ v).bit_count() <= 3 or ((u ^ v) & (2**64 - 1)).bit_count() <= 3 for u, v in pairs)
    whole = [f & (2**64 - 1) for f in fps]
    want = brute_components(fps, whole)
    from neolake.llm.graph import connected_components

    got = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "u long, v long"), scratch).collect()}
    assert {f: got.get(f, f) for f in fps} == dict(zip(fps, want))


def test_near_copies_go(spark):
    rnd = random.Random(7)
    words = [f"t{i}" for i in range(2000)]
    rows = [(i, document(rnd, 200, words), "x") for i in range(30)]
    for i in range(30, 42):
        t = rows[i - 30][1].split()
        t[rnd.randrange(200)] = "changed"
        rows.append((i, " ".join(t), "x"))
    rows += [(50, rows[3][1].upper(), "x"), (51, None, "x"), (52, "", "x"), (None, rows[0][1], "x"), (None, None, "x"), (1, rows[1][1], "x")]
    kept = [r.doc_id for r in simhash.near_dedup(spark.createDataFrame(rows, "doc_id long, text string, fp0 string")).collect()]
    assert sorted(kept, key=str) == sorted([*range(30), 51, None, None], key=str)


def near_pairs_by_hand(rows, similarity=0.8):
    """Component of every document, from all pairs of five-word shingle sets."""
    sets = {}
    for i, t in rows:
        w = t.lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    part = {i: i for i in sets}
    for i in sets:
        for j in sets:
            if i < j and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]) and part[i] != part[j]:
                low, high = sorted((part[i], part[j]))
                part = {k: low if v == high else v for k, v in part.items()}
    return {(i, c) for i, c in part.items() if i != c}


def test_parity_bits_never_part_close_sets():
    rnd = np.random.default_rng(4)
    for _ in range(300):
        n = int(rnd.integers(1, 300))
        a = rnd.integers(0, 1 << 63, n).astype(np.uint64)
        k = int(rnd.integers(0, n + 1))
        b = np.unique(np.r_[a[k:], rnd.integers(0, 1 << 63, int(rnd.integers(0, 200))).astype(np.uint64)])
        a = np.unique(a)
        x, y = (v.as_py() for v in simhash._parities(np.r_[a, b], np.array([len(a), len(b)])))
        assert simhash._far_in_bits(x, y) <= len(np.setxor1d(a, b))


def test_near_dedup_of_repeated_ids_and_empty_tables(spark):
    schema = "doc_id long, text string, head long"
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(500)]
    a, b = document(rnd, 40, words), document(rnd, 40, words)
    rows = [(1, a, 1), (1, b, 2), (1, a, 3), (2, b, 4), (3, None, 5), (3, "", 6), (None, a, 7), (None, a, 8)]
    got = sorted(((r.doc_id, r.text) for r in simhash.near_dedup(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == sorted([(1, a), (1, b), (3, None), (None, a), (None, a)], key=str)
    none = spark.createDataFrame([], schema)
    assert simhash.near_dedup(none).count() == 0 and language.keep_identified(none.withColumn("lang", F.lit("x"))).count() == 0


def test_near_copies_behind_a_failed_link(spark):
    rnd = random.Random(3)
    sentences = [document(rnd, 6, [f"w{i}" for i in range(900)]).split() for _ in range(40)]
    original = [w for s in sentences for w in s]
    rnd.shuffle(sentences)
    swapped = original[:]
    swapped[100], swapped[101] = swapped[101], swapped[100]
    # the same words in another order, so one fingerprint for all; the least id is a copy of none
    rows = [(1, " ".join(w for s in sentences for w in sorted(s))), (2, " ".join(original)), (3, " ".join(swapped))]
    got = {tuple(r) for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == near_pairs_by_hand(rows) == {(3, 2)}


def test_near_copies_of_every_kind_of_edit(spark):
    rnd = random.Random(11)
    words = [f"t{i}" for i in range(3000)]
    rows = []
    for k in range(24):
        t = document(rnd, 300, words).split()
        n = rnd.randrange(15, 62)  # Jaccard from 0.8 to 0.95
        other = document(rnd, n, words).split()
        at = rnd.randrange(200)
        m = n // 2
        edits = [t + other, other + t, t[:-n], t[:at] + t[at + n :], t[:at] + other + t[at:], t[:at] + other[:m] + t[at + m :]]
        rows += [(10 * k, " ".join(t)), (10 * k + 1, " ".join(edits[k % 6]))]
    line = document(rnd, 60, words)
    rows += [(1000 + i, line + " " + document(rnd, 12, words)) for i in range(30)]  # a passage that many have, half of it and more, without being copies
    rows += [(1990, rows[-1][1] + " more")]
    got = {tuple(r) for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = near_pairs_by_hand(rows)
    assert got == want and len(want) >= 20


def complements(n):
    """The Thue-Morse text of n letters and its complement: equal under polynomial hashes modulo a power of two."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_regular_long_texts_are_told_apart(spark):
    from neolake.llm._common import name_hashes, span_hashes, utf8
    import pyarrow as pa

    for n in (1024, 4096):
        a, b = complements(n)
        data, off = utf8(pa.array([a, b, a]))
        assert n == 1024 or len(set(span_hashes(data, off[:-1], off[1:]).tolist())) <= 2
        h = name_hashes(data, off[:-1], off[1:])
        assert h[0] == h[2] != h[1]
        encode = token_output.Encoder(token_output.default_vocabulary())
        ids, at = encode(pa.array([a, b]))
        assert [ids[i:j].tolist() for i, j in zip(at, at[1:])] == [encode.t.encode(x, add_special_tokens=False).ids for x in (a, b)]
    texts = [x for n in (1024, 4096) for x in complements(n)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in suffix_dedup.remove_repeats(df).collect()}
    assert got == {i: sum(brute_positions(texts)[i]) for i in range(len(texts))}
    found = decontaminate.leaks(df, spark.createDataFrame([(7, texts[0])], "item_id long, text string")).collect()
    assert {r.doc_id for r in found} == {0}


def brute_positions(texts, n=suffix_dedup.LENGTH):
    """For each text, 1 for each byte under a string that an earlier text has."""
    seen, out = set(), []
    for t in (x.encode() for x in texts):
        starts = [i for i in range(len(t) - n + 1) if t[i : i + n] in seen]
        gone = [0] * len(t)
        for i in starts:
            gone[i : i + n] = [1] * n
        out.append(gone)
        seen.update(t[i : i + n] for i in range(len(t) - n + 1))
    return out


# --- 10 ------------------------------------------------------------------------------


def test_rans_round_trip_and_checkpoints():
    rnd = np.random.default_rng(0)
    for n, size in ((0, 5), (1, 1), (7, 3), (5000, 1), (300_000, 2000)):
        ids = np.minimum(rnd.geometric(0.02, n), size).astype(np.uint32)
        table = rans.Table.of_counts(*(np.unique(ids, return_counts=True) if n else (np.zeros(0, np.int64), np.zeros(0, np.int64))))
        block = rans.encode(ids, table)
        assert np.array_equal(rans.decode(block, table), ids)
        steps = -(-n // block["lanes"]) if n else 0
        if steps > rans.CHECKPOINT:
            assert np.array_equal(rans.decode(block, table, rans.CHECKPOINT), ids[rans.CHECKPOINT * block["lanes"] :])
            broken = block | {"payload": block["payload"][:-4] + b"\1\2\3\4"}
            with pytest.raises(Exception):  # noqa: B017
                rans.decode(broken, table)


def test_tokens_round_trip(spark, docs, awkward, unique):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(token_output.default_vocabulary())
    df, rows = unique
    path = Scratch(spark, "t").root
    token_output.write_tokens(df, path)
    got = sorted(map(tuple, token_output.read_tokens(spark, path).collect()))
    want, start = [], 0
    for i, text, *_ in sorted(rows, key=lambda r: r[0]):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, token_output.END]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    path = Scratch(spark, "t").root
    token_output.write_tokens(docs, path)
    back = token_output.read_tokens(spark, path, keep_ids=True).orderBy("start").collect()
    assert len(back) == len(awkward) and back[0].doc_id is None and all(b.start == a.start + a.n_tokens for a, b in zip(back, back[1:]))
    path = Scratch(spark, "t").root
    token_output.write_tokens(empty(spark), path)
    assert token_output.read_tokens(spark, path).count() == 0


def test_pieces_give_the_ids_of_whole_texts():
    import pyarrow as pa
    from tokenizers import Tokenizer

    t, encode = Tokenizer.from_file(token_output.default_vocabulary()), token_output.Encoder(token_output.default_vocabulary())
    rnd = random.Random(1)
    alphabet = [" ", "  ", "\n", "\t", "a", "B", "é", "1", "23", ".", "'s", "'ll", " ", "<|endoftext|>", " ", "　", "中", "🙂", "", "\x1f", "_", " ", "\u0085"]
    for _ in range(400):
        texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 25))) for _ in range(3)]
        ids, off = encode(pa.array(texts))
        assert [ids[i:j].tolist() for i, j in zip(off, off[1:])] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_long_items_leak_off_the_passage_grid(spark):
    rnd = random.Random(5)
    words = [f"q{i}" for i in range(5000)]
    items = [(i, document(rnd, 250, words)) for i in range(80)]
    docs = [(i, document(rnd, 8, words) + " " + t + " " + document(rnd, 20, words)) for i, t in items]
    docs += [(1000 + i, document(rnd, 150, words)) for i in range(200)]
    got = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [(i, i) for i in range(80)]


def test_mix_keeps_rows_without_an_id(spark):
    rows = [(None, "a b c", "x"), (None, "d e f", "x"), (None, "g h i j", "y"), (1, "k l", "x"), (2, "m n o", None), (None, "p q r", None), (None, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = sum(r.taken for r in mixing.mix(docs).collect())
    got = mixing.mix_documents(docs).collect()
    assert sum(len(r.text.split()) for r in got) == want
    times = lambda rows: sorted((str(r.doc_id), str(r.source), len(r.text.split())) for r in rows)
    each = [(str(r.doc_id), str(r.source), r["size"]) for r in mixing.mix(docs).collect() if r["size"] for _ in range(r.taken // r["size"])]
    assert times(got) == sorted(each) and any(r.doc_id is None for r in got)


def test_blocks_of_one_part_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_output, "BLOCK_IDS", 40)
    rows = [(None, [i] * 20 + [2]) for i in range(30)] + [(7, [100 + i, 2]) for i in range(90)] + [(9, [5, 2])]
    tokens = spark.createDataFrame([(d, bytearray(np.array(x, "<u4").tobytes()), 0) for d, x in rows], "doc_id long, ids binary, part int")
    both, sevens = tokens.coalesce(1), tokens.where("doc_id = 7").coalesce(1)
    token_output._encode_files(both.union(sevens).union(both), str(tmp_path / "x"))  # tasks whose blocks begin with the same ids
    got = token_output.read_tokens(spark, str(tmp_path / "x"), keep_ids=True).collect()
    want = [*rows, *[r for r in rows if r[0] == 7], *rows]
    assert len(got) == len(want) and sorted((r.doc_id is not None, r.doc_id or 0, r.ids) for r in got) == sorted((d is not None, d or 0, np.array(x, "<u4").tobytes()) for d, x in want)
    starts = sorted((r.start, r.n_tokens) for r in got)
    assert [s for s, _ in starts] == [sum(n for _, n in starts[:i]) for i in range(len(starts))]
