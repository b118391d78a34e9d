"""The methods themselves against plain versions: retrieval, the classifier's training, n-gram models, decoding."""

from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pyarrow as pa

from neolake.llm import decontaminate, html_crf, language, quality
from neolake.llm._common import name_hashes, utf8


def text(rnd, n, words):
    return " ".join(rnd.choice(words) for _ in range(n))


def test_leaks_equal_all_pairs(spark):
    """Every document against every item, without any search before the comparison."""
    rnd = random.Random(12)
    words = ["the", "of", "and"] * 40 + [f"w{i}" for i in range(900)]
    items = [(i, text(rnd, 30 + 9 * i, words) + ". " + text(rnd, 5, words) + ".") for i in range(8)]
    rows = []
    for d in range(90):
        body = text(rnd, rnd.randint(5, 300), words)
        if d % 3 == 0:  # a copy, maybe with words changed, left out or added
            w = items[d % 8][1].split()
            for _ in range(rnd.choice([0, 0, 2, 5, 9, 15])):
                k = rnd.randrange(len(w))
                w[k : k + 1] = rnd.choice([[], [rnd.choice(words)], [w[k], rnd.choice(words)]])
            body = " ".join([text(rnd, rnd.randint(0, 40), words), *w, body])
        rows.append((d, body))
    rows += [(90, None), (91, ""), (92, rows[0][1]), (93, " ".join(["filler"] * 20_000) + " " + items[3][1])]
    held = decontaminate.Items(items)
    want = set()
    for d, body in rows:
        ids = decontaminate.lookup(decontaminate.word_hashes(pa.array([body], pa.string()))[0], held.vocabulary)
        for k, item in enumerate(held.words):
            m = len(item)
            for s in range(0, len(ids), decontaminate.HALF):
                part = ids[max(0, s - m) : s + 2 * decontaminate.HALF + m]
                if not (part >= 0).any():
                    continue
                share = decontaminate.lcs(item, part) / m
                if share >= decontaminate.LCS or share >= decontaminate.LCS_WITH_ANSWER and decontaminate.contains(part, held.answers[k]):
                    want.add((d, k))
                    break
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got <= want and len(got) >= 0.9 * len(want) and {(93, 3)} <= got and len(want) > 20


def test_training_equals_a_plain_loop(monkeypatch):
    rnd = random.Random(5)
    words = {y: [f"{a}{y}{b}" for a in "bcdfg" for b in "aeiou"] for y in "xyz"}
    rows = []
    for i in range(60):
        y = "xyz"[i % 3]
        at, v = language._vector(text(rnd, 12, words[y]), np.ones(language.DIM))
        rows.append((i % 3, at.astype(np.int32), v))
    w, bias, temperature = language._train(rows, 3)
    z, n = {}, {}
    weight = lambda i, k: 0.0 if abs(z.get((i, k), 0.0)) <= language.L1 else -(z[i, k] - math.copysign(language.L1, z[i, k])) / ((language.BETA + math.sqrt(n.get((i, k), 0.0))) / language.ALPHA + language.L2)
    for _ in range(language.EPOCHS):
        for y, at, v in rows[: len(rows) * 4 // 5]:
            x = [*zip(at.tolist(), v.tolist()), (language.DIM, 1.0)]
            own = {(i, k): weight(i, k) for i, _ in x for k in range(3)}
            s = [sum(own[i, k] * value for i, value in x) for k in range(3)]
            e = [math.exp(a - max(s)) for a in s]
            for k in range(3):
                p = e[k] / sum(e) - (k == y)
                for i, value in x:
                    g, before = value * p, n.get((i, k), 0.0)
                    z[i, k] = z.get((i, k), 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / language.ALPHA * own[i, k]
                    n[i, k] = before + g * g
    seen = sorted({i for i, _ in z if i < language.DIM})
    plain = np.array([[weight(i, k) for k in range(3)] for i in seen])
    assert np.allclose(w[seen], plain, atol=1e-3) and np.allclose(bias, [weight(language.DIM, k) for k in range(3)], atol=1e-3)
    zeros = (w[seen] == 0).mean()
    monkeypatch.setattr(language, "L1", 0.5)
    sparser = (language._train(rows, 3)[0][seen] == 0).mean()
    assert zeros > 0.1 and sparser > 2 * zeros and temperature > 0  # the penalty leaves weights out
    other = np.setdiff1d(np.arange(language.DIM), seen)
    assert not w[other].any()


def test_language_of_very_long_and_repeated_rows(spark):
    rnd = random.Random(6)
    words = {"aa": ["kala", "mara", "sata"], "bb": ["zudu", "gubu", "luru"]}
    rows = [(i, text(rnd, 20, words[y]), y) for i, y in enumerate(["aa", "bb"] * 40)]
    rows += [(100, text(rnd, 150_000, words["bb"]), None), (101, rows[0][1], None), (101, rows[0][1], None), (102, None, "aa"), (103, "1 2 3", None), (0, rows[0][1], "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.predict(docs.drop("lang"), language.fit(docs)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert by[100][0] == "bb" and by[101][0] == "aa" and by[102] == ("und", 0.0) and by[103] == ("und", 0.0)
    many = spark.createDataFrame([(i, f"{chr(97 + i % 26)}{chr(97 + i // 26)}" * 9, f"l{i}") for i in range(300)], "doc_id long, text string, lang string")
    assert len(language.fit(many).languages) > 200  # as many languages as there are


def test_weights_equal_plain_counts(spark):
    rnd = random.Random(7)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, text(rnd, rnd.randint(1, 40), words).upper() if i % 5 == 0 else text(rnd, rnd.randint(1, 40), words)) for i in range(50)] + [(50, None), (51, ""), (3, "w1 w1 w2")]
    labels = [(i, int(i % 3 == 0)) for i in range(50)]

    def grams(t):
        w = (t or "").lower().split()
        h = [int(x) for x in name_hashes(*_spans(w))] if w else []
        mix = lambda x: int(quality.mix64(np.array([x % (1 << 64)], np.uint64))[0])
        return [x % quality.DIM for x in h] + [mix(a * 3 + b * 0x9E3779B97F4A7C15) % quality.DIM for a, b in itertools.pairwise(h)]

    good = {i for i, q in labels if q}
    raw, target = np.zeros(quality.DIM), np.zeros(quality.DIM)
    for i, t in rows:
        for b in grams(t):
            raw[b] += 1
            target[b] += i in good
    logs = lambda x: np.log((x + 1) / (x.sum() + quality.DIM))
    ratio = logs(target) - logs(raw)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    fitted = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert np.allclose(fitted, ratio)
    got = sorted((r.doc_id, round(r.log_weight, 9)) for r in quality.log_weights(docs, fitted).collect())
    assert got == sorted((i, round(float(sum(ratio[b] for b in grams(t))), 9)) for i, t in rows)


def _spans(words):
    data, off = utf8(pa.array(words))
    return data, off[:-1], off[1:]


def test_decoding_equals_all_labellings():
    field = html_crf.default_field()
    (m00, m01), (m10, m11), (s0, s1) = field.move
    move, start = ((m00, m01), (m10, m11)), (s0, s1)
    for found, _ in html_crf.labelled_pages(40, seed=77):
        page = found[:9]
        if not page:
            continue
        own = [tuple(a + b for a, b in zip(field._score(html_crf.features(b, html_crf.is_marked(page))), field._score(html_crf.shape(b)))) for b in page]
        total = lambda y: start[y[0]] + sum(own[k][v] for k, v in enumerate(y)) + sum(move[a][b] for a, b in itertools.pairwise(y))  # noqa: B023, E731
        best = max(itertools.product((0, 1), repeat=len(page)), key=total)
        assert math.isclose(total(tuple(field.decode(page))), total(best))
