"""Product identity against the rule taken one candidate at a time."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from tillweave.plans.identity import resolve_identity

SCHEMA = (
    "product_work_key string, first_seen_date date, recipe_number_clean string, product_name_selected string,"
    " alternative_names array<string>, product_group_final string"
)


def sequential(candidates):
    order = sorted(candidates, key=lambda c: (c[1] is None, c[1] or dt.date.min, c[2] is None, c[0]))
    shown, out = {}, {}
    for work_key, _, recipe, name, others, group in order:
        selected = name.strip().lower() if name else None
        if recipe is not None:
            product, kind = f"RECIPE_{recipe}", "RECIPE"
        elif selected and (group, selected) in shown:
            product, kind = shown[group, selected], "NAME_MATCH"
        else:
            product, kind = f"TEMP_{work_key}", "TEMPORARY"
        out[work_key] = (product, kind)
        for one in {selected, *(x.strip().lower() for x in others or [])} - {None, ""}:
            shown.setdefault((group, one), product)
    return out


def run(spark, candidates, parts=3):
    frame = spark.createDataFrame(candidates, SCHEMA).repartition(parts)
    rows = resolve_identity(frame).collect()
    return {r["product_work_key"]: (r["product_business_key"], r["product_identity_type"]) for r in rows}


DAY = dt.date(2026, 3, 1)
CASES = [
    [("k1", DAY, "7", "x", [], "G"), ("k2", DAY, None, "x", [], "G")],
    [("k1", DAY, "7", "x", [], "G"), ("k2", DAY, None, "x", [], "H")],
    [("k1", DAY, None, "x", [], None), ("k2", DAY, None, "x", [], None)],
    [("k1", DAY, None, "x", [], "G"), ("k2", DAY, None, "x", ["y"], "G"), ("k3", DAY, None, "y", [], "G")],
    [("k1", DAY, None, None, [], "G"), ("k2", DAY, None, None, [], "G")],
    [("k1", DAY, None, "x", [], "G"), ("k2", dt.date(2026, 3, 2), "7", "x", [], "G")],
    [("k1", None, None, "x", [], "G"), ("k2", DAY, None, "X ", [], "G")],
]


@pytest.mark.parametrize("case", CASES)
def test_hand_made_cases(spark, case):
    assert run(spark, case) == sequential(case)


@pytest.mark.parametrize("seed", range(3))
def test_random_candidates(spark, seed):
    rng = random.Random(seed)
    names = [f"n{i}" for i in range(12)] + [None]
    candidates = []
    for i in range(120):
        day = None if rng.random() < 0.05 else DAY + dt.timedelta(rng.randint(0, 9))
        recipe = str(i) if rng.random() < 0.15 else None
        others = [rng.choice(names[:-1]) for _ in range(rng.randint(0, 2))]
        candidates.append((f"k{rng.random():.9f}", day, recipe, rng.choice(names), others, rng.choice(["G", "H", None])))
    want = sequential(candidates)
    assert run(spark, candidates) == want
    rng.shuffle(candidates)
    assert run(spark, candidates, 7) == want
