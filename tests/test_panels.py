"""Cases worked out by hand for the panel operators."""

from tallyframe.operators import panels


def test_category_needs_an_item_of_no_or_the_expected_domain(spark):
    hits = spark.createDataFrame([("q", "A1", "p1"), ("q", "A2", "p1"), ("q", "B1", "p2"), ("q", "B1", "p3"), ("q", "C1", "p4"), ("z", "X", "p5")], "q string, m string, p string")
    domains = spark.createDataFrame([("p1", "other"), ("p2", "other"), ("p3", "own")], "p string, domain string")
    got = {r.q: tuple(r)[1:] for r in panels.category_completeness(hits, "q", "m", "p", {"a": "A", "b": "B", "c": "C", "d": "D"}, domains, "own", "b").collect()}
    assert got == {"q": ("2/4", 2, 4, 1.0), "z": ("0/4", 0, 0, 0.0)}


def test_dominant_lineage_takes_the_first_of_equals(spark):
    votes = spark.createDataFrame([("p", "B", "x"), ("p", "A", "y"), ("p", "A", "y"), ("p", "B", "x"), ("p", "A", "z")], "p string, d string, o string")
    assert [tuple(r) for r in panels.dominant_lineage(votes, ["p"], ["d", "o"]).collect()] == [("p", "A", "y", 2)]


def test_ranked_subjects_are_unique_and_ties_go_by_name(spark):
    hits = spark.createDataFrame([("g", "b", 5), ("g", "a", 5), ("g", "a", 1), ("g", "c", 9)], "g string, s string, score int")
    assert [(r.s, r.place) for r in panels.ranked_subjects(hits, ["g"], "s", "score", 2).orderBy("place").collect()] == [("c", 1), ("a", 2)]


def test_aliases_need_exactly_one_label_with_evidence(spark):
    rows = [("a", "t", True), ("b", "t", False), ("c", "t", False), ("d", "u", True), ("e", "u", True), ("f", "u", False), ("g", "v", False)]
    labels = spark.createDataFrame(rows, "id string, tax string, active boolean")
    assert sorted(tuple(r) for r in panels.taxonomy_aliases(labels, "id", "tax", "active").collect()) == [("b", "a"), ("c", "a")]
