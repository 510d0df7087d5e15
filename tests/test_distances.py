"""Walks whose rounds double: least depths, cycles, and rounds that grow with the logarithm of the way."""

from pagemill.operators import chains


def test_a_long_walk_takes_few_rounds(spark, monkeypatch):
    written = []
    cut = chains.cut_lineage
    monkeypatch.setattr(chains, "cut_lineage", lambda df: written.append(1) or cut(df))
    step = spark.createDataFrame([(f"p{i}", f"p{i + 1}") for i in range(40)], "at string, target string")
    rows = {(r["root"], r["at"]): r["depth"] for r in chains.reached(spark.createDataFrame([("p0",), ("p39",), ("x",)], "title string"), step).collect()}
    assert rows == {**{("p0", f"p{i}"): i for i in range(41)}, ("p39", "p39"): 0, ("p39", "p40"): 1, ("x", "x"): 0}
    assert len(written) < 20


def test_least_depths_in_a_graph_with_cycles(spark):
    edges = [(i, j) for i in range(23) for j in ((i * 7 + 1) % 23, (i * 5 + 3) % 23) if (i + j) % 4]
    want = {}
    for root in range(23):
        seen, depth, newest = {root: 0}, 0, [root]
        while newest:
            depth += 1
            newest = sorted({b for a, b in edges if a in newest} - set(seen))
            seen.update({n: depth for n in newest})
        want |= {(f"p{root}", f"p{n}"): d for n, d in seen.items()}
    step = spark.createDataFrame([(f"p{a}", f"p{b}") for a, b in edges], "at string, target string").distinct()
    got = chains.reached(spark.createDataFrame([(f"p{i}",) for i in range(23)], "title string"), step).collect()
    assert len(got) == len(want) and {(r["root"], r["at"]): r["depth"] for r in got} == want
