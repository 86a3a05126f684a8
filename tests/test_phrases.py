"""Near-identical phrases against brute force."""
import random
import re

from oreleaf.operators import consolidation as C, phrases as P, responses as R
from oreleaf.schemas import USECASE


def words(phrase):
    found = dict.fromkeys(re.sub(r"[^\w\s]+", " ", phrase.lower()).split())
    return frozenset(w for w in found if w not in P.FILLERS) or frozenset(found)


def brute(phrases, similar=P.SIMILAR):
    """The first phrase of each class, in order: classes are the components over similar pairs."""
    classes = list(range(len(phrases)))
    for i, a in enumerate(phrases):
        for j, b in enumerate(phrases[:i]):
            x, y = words(a), words(b)
            if x == y or len(x & y) >= similar * len(x | y):
                old, new = classes[i], classes[j]
                classes = [new if c == old else c for c in classes]
    return [p for i, p in enumerate(phrases) if classes[i] not in classes[:i]]


def united(spark, per_material):
    rows = [(paper, i, material, [p]) for (paper, material), said in per_material.items() for i, p in enumerate(said)]
    flat = spark.createDataFrame(rows, "paper_id string, row_idx int, material string, said array<string>")
    record = R.nest(lambda path, kind: {"material_id": "material", "use_cases": "said"}.get(
        path, f"cast({'array()' if kind.typeName() == 'array' else 'NULL'} AS {kind.simpleString()})"), USECASE)
    got = C.consolidate(flat.selectExpr("paper_id", "row_idx", f"{record} AS record"), USECASE)
    return {(r["paper_id"], r["record"]["material_id"]): (r["n_variants"], r["record"]["use_cases"]) for r in got.collect()}


def test_same_words_in_another_order(spark):
    said = ["CO2 capture", "capture of CO2", "Capture of the CO2.", "CO2 storage", "of the", "The of", "!!", "catalyst for CO2 capture"]
    assert united(spark, {("p", "a"): said}) == {("p", "a"): (8, ["CO2 capture", "CO2 storage", "of the", "!!", "catalyst for CO2 capture"])}


def test_links_make_classes_and_stay_within_their_material(spark):
    chain = ["a1 b2 c3 d4 e5 f6", "a1 b2 c3 d4 e5 f6 g7", "a1 b2 c3 d4 e5 f6 g7 h8"]
    got = united(spark, {("p", "a"): chain, ("p", "b"): [chain[0], chain[2]], ("q", "a"): [chain[1]]})
    assert got == {("p", "a"): (3, chain[:1]), ("p", "b"): (2, [chain[0], chain[2]]), ("q", "a"): (1, [chain[1]])}


def test_random_phrases_against_brute_force(spark):
    r = random.Random(8)
    given = {}
    for k in range(40):
        base = [f"{r.choice('abcdefghij') * r.randint(1, 9)}{i}" for i in range(9)]
        given[f"p{k % 4}", f"m{k}"] = [" ".join(r.sample(base, r.randint(4, 9)) + r.sample(["of", "the", "in"], r.randint(0, 2))) for _ in range(r.randint(1, 40))]
    got = united(spark, given)
    assert got == {key: (len(said), brute(said)) for key, said in given.items()}
    assert any(len(v[1]) < len(set(given[k])) for k, v in got.items())


def test_a_record_without_items(spark):
    assert united(spark, {("p", "a"): [None]})["p", "a"] == (1, [])
