from __future__ import annotations

import hashlib
import random
from collections import defaultdict
from math import floor

import pytest

from tillweave.llm.source_mix import emit, mix

WEIGHTS = (5, 2, 1)


def aims(sizes):
    """Targets by source, shared round by round."""
    names = sorted(x for x in sizes if x is not None) + [None] * (None in sizes)
    weight = {name: WEIGHTS[i % 3] for i, name in enumerate(names)}
    closed, total = set(), sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[x] for x in closed)
        share = sum(weight[x] for x in names if x not in closed)
        unit = left / share if share else 0.0
        above = {x for x in names if x not in closed and unit * weight[x] > 3 * sizes[x]}
        if not above:
            return {x: float(3 * sizes[x] if x in closed else unit * weight[x]) for x in names}
        closed |= above


def brute(rows, seed=1):
    sized = [(key, source, len((text or "").split())) for key, text, source in rows]
    sizes = defaultdict(int)
    for _, source, size in sized:
        sizes[source] += size
    target, out = aims(sizes), []
    for source in sizes:
        number = lambda x, digits: int(hashlib.md5(x.encode()).hexdigest()[:digits], 16)
        row = sorted(
            ((size, number("" if key is None else str(key), 15), key is None, key) for key, s, size in sized if s == source),
            key=lambda x: (x[0], x[1], x[2], x[3] or 0),
        )
        rate = target[source] / sizes[source] if sizes[source] else 0.0
        start = number(f"{seed}" + ("" if source is None else f":{source}"), 4) / 65536
        for i, (size, _, _, key) in enumerate(row):
            copies = floor((i + 1) * rate + start) - floor(i * rate + start)
            out.append((key, source, size, sizes[source], target[source], copies, copies * size))
    return out


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def made(spark, rows):
    return spark.createDataFrame([(*r, "x", 0) for r in rows], "doc_id long, text string, source string, size string, copies int")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    of = ["big"] * 60 + ["mid"] * 25 + ["small"] * 3 + ["é", "Z", None, None, "empty"]
    text = lambda s: "" if s == "empty" else None if rng.random() < 0.05 else " a\t" * rng.choice([1, 4, 4, 4, 20, 300])
    return [(i, text(s), s) for i, s in enumerate(rng.choices(of, k=1500))]


def test_as_by_brute_force_and_the_same_on_any_layout(spark, rows):
    expected = sorted(brute(rows), key=str)
    assert rows_of(mix(made(spark, rows))) == expected
    # many ranges, and another order of the rows
    assert rows_of(mix(made(spark, rows[::-1]).repartition(7), rows_per_range=40)) == expected


def test_sources_come_near_their_targets(spark, rows):
    taken, most, target = defaultdict(int), defaultdict(int), {}
    for _, source, size, source_size, aim, copies, n in mix(made(spark, rows)).collect():
        taken[source] += n
        most[source] = max(most[source], size)
        target[source] = aim
        assert 0 <= copies <= 3 and aim <= 3 * source_size
    assert all(abs(taken[s] - target[s]) <= most[s] for s in target)
    assert sum(target.values()) == pytest.approx(sum(len((t or "").split()) for _, t, _ in rows))
    assert target["empty"] == 0 and target["small"] > 0


def test_hot_source_of_equal_rows_fills_all_ranges(spark):
    rows = [(1, "one two", "s")] * 900 + [(2, "three", "t")] * 100
    out = mix(made(spark, rows), rows_per_range=50)
    assert rows_of(out) == sorted(brute(rows), key=str)


def test_empty_and_wordless_tables(spark):
    assert mix(made(spark, [(1, "a", "s")]).where("false")).count() == 0
    assert rows_of(mix(made(spark, [(1, None, "s"), (None, " ", None)]))) == sorted(
        [(1, "s", 0, 0, 0.0, 0, 0), (None, None, 0, 0, 0.0, 0, 0)], key=str
    )


def test_very_long_text_is_counted_whole(spark):
    rows = [(1, "word " * 1_500_000, "s"), (2, "w " * 10, "s"), (3, "a b", "t")]
    assert rows_of(mix(made(spark, rows))) == sorted(brute(rows), key=str)


def test_emitted_copies_are_those_counted(spark, rows):
    table = made(spark, rows)
    counts = {r["doc_id"]: r["copies"] for r in mix(table.withColumnRenamed("doc_id", "row"), key="row").toDF(
        "doc_id", "source", "size", "source_size", "target", "copies", "taken").collect()}
    assert sum(counts.values()) > 0
    out = emit(table)
    assert out.columns == ["doc", "copy"] and out.select("doc.*").columns == table.columns
    held = defaultdict(list)
    for r in out.select("doc.doc_id", "doc.source", "copy").collect():
        held[r["doc_id"]].append(r["copy"])
    assert all(sorted(x) == list(range(1, len(x) + 1)) and len(x) <= 3 for x in held.values())
    # The same number of copies in all, up to one for each source: the order among equal sizes differs.
    assert abs(sum(map(len, held.values())) - sum(counts.values())) <= 7
