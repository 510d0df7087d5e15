"""References of chains: titles before display names, by one join."""

from pagemill.operators import chains

ROWS = [("g", "a", "Show", "b"), ("g", "b", "Show", "Show"), ("g", "c", "a", "a"), ("g", "d", "Only", None), ("h", "e", None, "a"), ("h", None, "N", "Only"), (None, "x", "x", "x"), ("g", "f", "z", "Only")]


def test_one_lookup_for_a_reference(spark):
    records = spark.createDataFrame(ROWS, "grp string, title string, display string, next string")
    found = chains.resolve_reference(records, "next", "to")
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    got = sorted(((r.grp, r.title, r.to, r.to_ambiguous) for r in found.collect()), key=str)
    assert got == sorted([("g", "a", "b", False), ("g", "b", None, True), ("g", "c", "a", False), ("g", "d", None, False), ("h", "e", None, False), ("h", None, None, False), (None, "x", None, False),
                          ("g", "f", "d", False)], key=str)
