"""Posting lists, phrases and centroid lists against brute force, with every odd case."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest

from pagemill.llm import centroid_lists, phrase_growth, posting_lists

VECTORS = "vec_id long, embedding array<float>, label int, distance string, band int"


def made(seed, n, width=64, bunches=6, spread=1.0):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(bunches, width))
    x = middle[rng.integers(0, bunches, n)] + spread * rng.normal(size=(n, width))
    return x.astype(np.float32)


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    def write(rows, schema):
        path = str(tmp_path_factory.mktemp("v") / "t")
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
        return spark.read.parquet(path)

    return write


ODD_VECTORS = [
    None, [], [0.0] * 64, [0.0, None] + [1.0] * 62, [float("nan")] + [1.0] * 63, [float("inf")] + [1.0] * 63, [1.0] * 63, [1.0] * 65, [-0.0] * 63 + [1.0], [0.0] * 63 + [1.0],
    [3e4] * 64, [-3e4] * 64, [1e-30] * 64,
]


def odd_rows(n=700, copies=90):
    rows = [(i, x, 0, "clash", 1) for i, x in enumerate(made(1, n).tolist())]
    rows += [(n + i, x, 0, "clash", 1) for i, x in enumerate(ODD_VECTORS)]
    rows += [(10_000 + i, rows[3][1], None, None, None) for i in range(copies)]  # one very common vector
    rows += [rows[20], rows[20], (40, rows[41][1], 1, "x", 1), (None, rows[5][1], 1, "x", 1), (None, rows[6][1], 1, "x", 1), (-20, rows[9][1], 1, "x", 1)]
    return rows


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def all_nearest(rows, count):
    """Per query row, the nearest others: (id, score)."""
    distinct = sorted({(i, tuple(np.float32(x) + np.float32(0) for x in v)) for i, v, *_ in rows if i is not None and usable(v)}, key=lambda r: r[0])
    width = max(len(v) for _, v in distinct)
    x = np.zeros((len(distinct), width))
    for k, (_, v) in enumerate(distinct):
        x[k, : len(v)] = v
    out = collections.defaultdict(list)
    for k, (i, _) in enumerate(distinct):
        if i % 20 == 0:
            score = np.cumsum(x[k] * x, axis=1)[:, -1]
            order = sorted((j for j in range(len(distinct)) if j != k), key=lambda j: (-score[j], distinct[j][0]))
            out[i].append([(distinct[j][0], score[j]) for j in order[:count]])
    return out


def answers(df):
    out = collections.defaultdict(list)
    for r in df.collect():
        out[r.query_id].append((r["rank"], r.vec_id, r.score))
    return out


def recall(got, want):
    hits = total = 0
    for i, lists in want.items():
        wanted = collections.Counter(j for one in lists for j, _ in one)
        found = collections.Counter(j for _, j, _ in got.get(i, []))
        hits, total = hits + sum((wanted & found).values()), total + sum(wanted.values())
    return hits / total


def test_posting_lists_when_all_are_read(table):
    rows = odd_rows()
    got, want = answers(posting_lists.nearest(table(rows, VECTORS), ratio=float("inf"))), all_nearest(rows, 20)
    assert set(got) == set(want)
    for i, lists in want.items():
        if len(lists) == 1:
            assert [(j, s) for _, j, s in sorted(got[i])] == lists[0], i
            assert sorted(r for r, _, _ in got[i]) == list(range(1, 21))
    assert recall(got, want) == 1


def test_posting_lists_find_what_is_near(table):
    for rows in (odd_rows(), [(i, x, 0, None, None) for i, x in enumerate((made(2, 1500) * np.geomspace(0.2, 9, 1500)[:, None]).tolist())]):
        got, want = answers(posting_lists.nearest(table(rows, VECTORS))), all_nearest(rows, 20)
        assert set(got) == set(want) and recall(got, want) > 0.9
        for i, lists in all_nearest(rows, len(rows)).items():
            assert len(lists) > 1 or {(j, s) for _, j, s in got[i]} <= set(lists[0])


def test_posting_lists_of_few_and_of_none(table):
    few = [(20 * i, x, 0, None, None) for i, x in enumerate(made(3, 7, 4).tolist())]
    got, want = answers(posting_lists.nearest(table(few, VECTORS))), all_nearest(few, 20)
    assert {i: [(j, s) for _, j, s in sorted(v)] for i, v in got.items()} == {i: v[0] for i, v in want.items()}
    for rows in ([], [(0, None, 0, None, None)], [(20, [1.0, 2.0], 0, None, None)]):
        result = posting_lists.nearest(table(rows, VECTORS))
        assert result.columns == ["query_id", "rank", "vec_id", "score"] and result.count() == 0


def test_points_enter_all_blocks_once(spark, table, monkeypatch):
    monkeypatch.setattr(posting_lists, "BLOCK", 16)
    rows = odd_rows(300)
    got, want = answers(posting_lists.nearest(table(rows, VECTORS), ratio=float("inf"))), all_nearest(rows, 20)
    assert recall(got, want) == 1


def plain_clusters(rows, k=16, rounds=3, dimensions=64, scale=64):
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v, *_ in rows if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        groups = collections.defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        centroids = [[sum(x) // len(groups[n]) for x in zip(*groups[n])] if n in groups else c for n, c in enumerate(centroids)]
    placed = [(i, *nearest(v)[::-1]) for i, v in kept]
    sums = collections.Counter()
    for _, c, d in placed:
        sums[c] += d
    fits = lambda x: x if x is not None and x < 2**63 else None
    unknown = {c for _, c, d in placed if fits(d) is None}
    text = lambda c: hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()
    whole = None if unknown else fits(sum(sums.values()))
    return sorted(((i, c, fits(d), None if c in unknown else fits(sums[c]), whole, text(c)) for i, c, d in placed), key=repr)


@pytest.mark.parametrize("case", ["odd", "huge", "few", "none", "ties"])
def test_centroid_lists(table, case):
    rows = {
        "odd": odd_rows(), "huge": odd_rows(60, 3) + [(900, [1e12] * 64, 0, None, None), (901, [-2e30] + [1.0] * 63, 0, None, None), (902, [3e38] * 64, 0, None, None)],
        "few": odd_rows()[:5], "none": [r for r in odd_rows() if not usable(r[1])][:3], "ties": [(i, [float(i % 3)] * 64, 0, None, None) for i in range(200)],
    }[case]
    rows = [r for r in rows if case != "none" or r[1] is None or len(r[1]) != 64]
    got = centroid_lists.clustered(table(rows, VECTORS)).drop("centroid")
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_clusters(rows)


def test_the_walk_ends_early_and_keeps_ties():
    rng = np.random.default_rng(4)
    centroids = (100 * rng.normal(size=(40, 3))).astype(np.int64)
    centroids[7] = centroids[3]
    lists = centroid_lists.SortedLists(centroids.tolist())
    x = np.r_[(100 * rng.normal(size=(500, 3))).astype(np.int64), centroids]
    number, far = lists.nearest(x)
    every = ((x[:, None, :] - centroids) ** 2).sum(axis=2)
    assert (far == every.min(axis=1)).all() and (number == every.argmin(axis=1)).all()
    wide = lists.nearest(x.astype(object))
    assert (wide[0] == number).all() and (wide[1] == far).all()


def plain_phrases(rows, least=10, top=2000, swallowed=50):
    counts, total = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in candidates.items():
            cuts = [(1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            if len(p) == 2 and any(len(q) == 3 and p in (q[:2], q[1:]) and 100 * b >= swallowed * a for q, b in candidates.items()):
                continue
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, rank, p.decode(), -a, l, r, total[lang], -s) for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


DOCS = "doc_id long, text string, lang string, words string, phrase string, n long"


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(8)
    names = ["a", "b", "C", "d", "e", "f", "g", "Éa", "漢字", "x\x00y", "\xa0", "h", "i"]
    weights = [2 ** (k % 5) for k in range(len(names))]

    def text(n):
        out = []
        for _ in range(n):
            out.append(rng.choices(names, weights)[0])
            if rng.random() < 0.3:
                out += rng.choice([["New", "york", "City"], ["of", "the"], ["in", "the", "end"], ["very", "very"]])
            out.append(rng.choice([" "] * 12 + ["  ", "\t", ". ", ",", "\n", " \x0b ", "\r\n", "?!"]))
        return "".join(x if x.strip() == "" or x in ". ,?!" else x + " " for x in out)

    rows = [(i, text(rng.randint(0, 120)), ["en", "de", None, "und", "", "ZZ"][i % 6] if i % 5 else "en", "clash", "clash", 1) for i in range(150)]
    return rows + [(1, None, "en", None, None, None), (2, "", None, None, None, None), (3, " \t ", "fr", None, None, None), (None, text(4000), "en", None, None, None), rows[5], rows[5], rows[5]]


@pytest.mark.parametrize("top, least, first", [(2000, 10, 2), (12, 2, 1), (1, 2, 1)])
def test_phrases(table, prose, top, least, first):
    got = phrase_growth.phrases(table(prose, DOCS), top=top, least=least, first=first)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == plain_phrases(prose, least, top)


def test_phrases_in_parts_and_with_shared_bits(table, prose):
    got = phrase_growth.phrases(table(prose, DOCS), top=5, least=3, words=50, split=64, bits=6)
    assert sorted(tuple(r) for r in got.collect()) == plain_phrases(prose, 3, 5)


def test_phrases_of_no_text(table):
    for rows in ([], [(1, None, "en", None, None, None), (2, "  ", None, None, None, None), (3, "one two", "en", None, None, None)]):
        assert phrase_growth.phrases(table(rows, DOCS)).collect() == []
