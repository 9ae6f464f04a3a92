"""Label classes and near matches against plain Python on random labels."""

import random

import pytest

from listingmart.operators import classes as CL
from listingmart.operators import similarity as SM
from listingmart.operators import standardise as SD


def _components(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    groups = {}
    for x in list(root):
        groups.setdefault(find(x), []).append(x)
    return {x: min(g) for g in groups.values() for x in g}


@pytest.mark.parametrize("shape", ["random", "chain", "star"])
def test_components(spark, shape):
    rnd = random.Random(3)
    pairs = {"random": [(f"n{rnd.randrange(40)}", f"n{rnd.randrange(40)}") for _ in range(30)],
             "chain": [(f"c{(i * 37) % 101:03}", f"c{((i + 1) * 37) % 101:03}") for i in range(99)],
             "star": [("hub", f"s{i}") for i in range(50)]}[shape]
    got = {r.label: r.root for r in CL.components(spark.createDataFrame(pairs, "a string, b string"), "a", "b").collect()}
    assert got == _components(pairs)


def test_a_mapping_with_one_target_a_label(spark):
    a = spark.createDataFrame([("Achat, Vente",), ("Vente, Stock, Achat",), ("Banque, Audit",), ("Seul",)], "v string")
    b = spark.createDataFrame([("Vente, Achat, RH",), ("Stock, Vente",), ("Audit, Banque",)], "v string")
    pairs = SD.standardise_values(a, "v", b, "v")["pairs"]
    cl = CL.label_classes(pairs, "source_a", "source_b")
    got = {r.old_value: r.new_value for r in CL.class_mapping(cl).collect()}
    one, two = "Achat, RH, Stock, Vente", "Audit, Banque"
    assert got == {"Achat, Vente": one, "Vente, Stock, Achat": one, "Vente, Achat, RH": one, "Stock, Vente": one, "Banque, Audit": two}
    assert all(got.get(x, x) == x for x in got.values())  # map(map(x)) = map(x)
    review = {r.label: r.targets for r in CL.ambiguous_labels(cl).collect()}
    assert review and set(review) <= set(got) and min(review.values()) == 2
    rows = spark.createDataFrame([("Achat, Vente", 1), ("Achat, Vente", 2), ("Seul", 3), (None, 4)], "label string, _old_value int")
    out = CL.apply_mapping(rows, "label", CL.class_mapping(cl))
    assert out.columns == rows.columns
    assert sorted((r._old_value, r.label) for r in out.collect()) == [(1, one), (2, one), (3, "Seul"), (4, None)]


def test_no_pairs(spark):
    none = spark.createDataFrame([], "source_a string, source_b string, union_str string")
    assert CL.class_mapping(CL.label_classes(none, "source_a", "source_b")).count() == 0


def _grams(s, q):
    s = "#" * (q - 1) + s.lower() + "#" * (q - 1)
    return {s[i:i + q] for i in range(len(s) - q + 1)}


@pytest.mark.parametrize("least, q", [(60, 3), (35, 2), (100, 3), (90, 3)])
def test_near_matches_equal_all_pairs(spark, least, q):
    rnd = random.Random(least)
    words = ["Réseau", "Réseaux", "Achat", "Achats", "Vente", "RH", "Telecom", "Télécom", "Informatique"]

    def label():
        x = " ".join(rnd.sample(words, rnd.randint(1, 3)))
        return x if rnd.random() < 0.5 else x[:rnd.randint(1, len(x))]
    a, b = [label() for _ in range(60)] + [None, "", "x"], [label() for _ in range(60)] + [None, "", "X"]
    got = SM.near_matches(spark.createDataFrame([(x,) for x in a], "v string"), "v",
                          spark.createDataFrame([(x,) for x in b], "w string"), "w", least, q)
    rows = sorted(tuple(r) for r in got.collect())
    want = []
    for x in set(a) - {None, ""}:
        for y in set(b) - {None, "", x}:
            g, h = _grams(x, q), _grams(y, q)
            if 100 * len(g & h) >= least * len(g | h):
                want.append((x, y, len(g & h), len(g | h)))
    assert rows == sorted(want) and (rows or least > 60)


def test_near_matches_join_on_grams_only(spark):
    a = spark.createDataFrame([("Réseau",)], "v string")
    plan = SM.near_matches(a, "v", a.withColumnRenamed("v", "w"), "w")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
