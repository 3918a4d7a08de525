from __future__ import annotations

import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillweave.llm import context_mixing as cm

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) + [None]


def base(texts, learned):
    counts = Counter(t for i, x in enumerate(texts) if learned(i) for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    out = []
    for x in texts:
        have = tokens(x)
        score = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in have)
        out.append((len(have), sum(counts[t] > 0 for t in have), n, score))
    return out


def sample(n=300):
    rng = random.Random(7)
    vocabulary = [rng.choice(["The", "ing", "é", "tion"]) + str(i) for i in range(60)]
    follow = {w: rng.choices(vocabulary, k=3) for w in vocabulary}
    texts = [None, "", " \n", "unheard WORDS here", "z" * 3000, "The0 " * 4000]
    for _ in range(n):
        word, out = rng.choice(vocabulary), []
        for _ in range(rng.randint(1, 120)):
            out.append(word + rng.choice(["", "", "", "", "x"]))
            word = rng.choice(follow[word]) if rng.random() < 0.9 else rng.choice(vocabulary)
        texts.append(" ".join(out))
    return texts + [texts[9]] * 3


def test_codes_are_complete():
    code = cm.huffman([5, 1, 1, 9, 0, 3])
    assert sum(2.0**-x for x in code.size.tolist()) == 1
    bits, paths, nodes = code.packed & 1, code.packed >> 1 & 15, code.packed >> 33
    codes = {tuple(bits[b : b + s].tolist()) for b, s in zip(code.begin, code.size, strict=True)}
    assert len(codes) == 6 and nodes.max() < 5 and set(paths.tolist()) <= set(range(1, 16))


def a_plan(coder, learned, buckets=1, salts=None):
    """A plan whose counts of decisions alone are those of (symbol, n)."""
    code, symbols = cm.byte_code(coder), len(coder.code.size)
    first = np.zeros((2, symbols + cm._BYTE_NODES), np.float32)
    for symbol, n in learned:
        step = code.packed[code.begin[symbol] : code.begin[symbol] + code.size[symbol]]
        first[step & 1, step >> 33] += n
    size = len(coder.hashes) + 2 + (1 << 16)
    return cm.Plan(coder, code, first, np.ones(size, np.int64) if salts is None else salts, buckets)


def grams_of(rows):
    """Grams of (before, earlier, symbol, doc, times) without escaped words among the contexts."""
    columns = [np.array(x, np.int64) for x in zip(*rows, strict=True)]
    none = np.zeros(len(rows), np.uint64)
    return cm.Grams(columns[0], none, columns[1], none, *columns[2:])


def costs_of(plan, grams, model):
    """The sums of each text, through the tasks of the job."""
    dealt = cm._dealt(plan, grams, 0, cm._LEARNED, None)
    order = np.argsort(dealt.column(0).to_numpy(), kind="stable")
    out = Counter()
    for batch in cm._coster(lambda: plan, lambda: model)(iter([dealt.take(order)])):
        for doc, cost in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            out[doc] += cost
    return out


def by_hand(plan, grams, model):
    """Cost of each row by going through its decisions one by one over dictionaries of counts."""
    steps_of = lambda s: plan.code.packed[plan.code.begin[s] : plan.code.begin[s] + plan.code.size[s]].tolist()
    one, two = Counter(), Counter()
    rows = list(zip(*(x.tolist() for x in (grams.before, grams.earlier, grams.symbol, grams.doc, grams.times)), strict=True))
    for before, earlier, symbol, _, times in rows:
        for step in steps_of(symbol):
            one[before, step >> 33, step & 1] += times
            two[before, earlier, step >> 33, step & 1] += times
    level = lambda seen: (seen > 0) + (seen > 2) + (seen > 9)
    out = Counter()
    for before, earlier, symbol, doc, times in rows:
        for step in steps_of(symbol):
            node, bit = step >> 33, step & 1
            pairs = [tuple(plan.first[:, node].tolist()), (one[before, node, 0], one[before, node, 1])]
            pairs.append((two[before, earlier, node, 0], two[before, earlier, node, 1]))
            gate = ((symbol >= plan.symbols) * 4 + level(sum(pairs[1]))) * 4 + level(sum(pairs[2]))
            odds = sum(float(w) * math.log((b + 0.4) / (a + 0.4)) for w, (a, b) in zip(model.weights[gate], pairs, strict=True))
            odds = max(-14.0, min(14.0, odds))
            place = max(0, min(cm._STEPS - 1, round(odds * 2) + cm._STEPS // 2))
            p = (1 / (1 + math.exp(-odds)) + float(model.after[gate, place])) / 2
            p = max(1e-6, min(1 - 1e-6, p))
            out[doc] += times * math.log10(p if bit else 1 - p)
    return out


def a_coder():
    return cm.make_coder(np.array([3, 9, 27], np.uint64), np.array([5, 2, 1]), 10, 2)


def taught_model(rng):
    """Some weights and refinement, as if learned."""
    weights = [[rng.uniform(0.1, 0.9) for _ in range(cm._INPUTS)] for _ in range(cm._GATES)]
    after = [[[rng.randint(0, 90), rng.randint(0, 90)] for _ in range(cm._STEPS)] for _ in range(cm._GATES)]
    return cm.make_model(np.array(weights), np.array(after, float))


@pytest.mark.parametrize("buckets", [1, 5])
def test_costs_are_those_of_a_plain_scorer(buckets):
    coder, rng = a_coder(), random.Random(5)
    n, rows = len(coder.hashes), []
    for _ in range(400):
        rows.append((rng.choice([0, 1, 2, n + 1]), rng.choice([0, 1, n + 1]), rng.randrange(5), rng.randrange(6), rng.choice([1, 1, 3])))
    for _ in range(200):
        low = rng.choice([0, 65, 66])
        rows.append((n + 2 + low, n + 2 + rng.choice([0, 70]), 5 + (low << 8 | rng.choice([65, 66, 32])), rng.randrange(6), 1))
    plan, grams, model = a_plan(coder, [(0, 5), (1, 2), (2, 1), (3, 2), (4, 2)], buckets), grams_of(rows), taught_model(rng)
    found, want = costs_of(plan, grams, model), by_hand(plan, grams, model)
    assert set(found) == set(want) == set(range(6))
    for doc, cost in want.items():
        assert found[doc] == pytest.approx(cost, rel=1e-4)


def test_probabilities_of_all_next_symbols_add_up_to_one():
    coder, rng = a_coder(), random.Random(2)
    n, rows = len(coder.hashes), []
    # After every context each word, the escape and the end; bytes after every context of bytes likewise. Each row is
    # a text, seen some times or (learned from elsewhere) never: its cost is that of one symbol.
    contexts = [(before, earlier) for before in (0, 2, n + 1) for earlier in (0, 1, 2, n + 1)]
    symbols = [(b, e, s) for b, e in contexts for s in range(5)]
    symbols += [(n + 2 + last, n + 2, 5 + (last << 8 | byte)) for last in (0, 65) for byte in range(256)]
    seen = [rng.choice([0, 0, 1, 4, 60]) for _ in symbols]
    learned = grams_of([(*s, 0, k) for s, k in zip(symbols, seen, strict=True) if k])
    asked = grams_of([(*s, doc, 1) for doc, s in enumerate(symbols)])
    plan, model = a_plan(coder, [(0, 5), (1, 2), (4, 2)]), taught_model(rng)
    batches = [cm._dealt(plan, learned, -1, cm._LEARNED, None), cm._dealt(plan, asked, 0, cm._HELD, None)]
    cost = {}
    for batch in cm._coster(lambda: plan, lambda: model)(iter(batches)):
        cost.update(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True))
    for at in range(0, len(contexts) * 5, 5):
        assert sum(10 ** cost[at + k] for k in range(5)) == pytest.approx(1, abs=1e-4)
    for at in (len(contexts) * 5, len(contexts) * 5 + 256):
        assert sum(10 ** cost[at + k] for k in range(256)) == pytest.approx(1, abs=1e-3)


def test_payloads_return_what_was_packed():
    rng = random.Random(8)
    words = [rng.getrandbits(63) for _ in range(5)]
    codes = np.array([rng.randrange(5) for _ in range(999)], np.int64)
    own = np.array([rng.choice(words) for _ in range(999)], np.uint64) * (codes == 3)
    big = np.array([rng.getrandbits(24) for _ in range(999)], np.int64)
    grams = cm.Grams(codes, own, codes[::-1], own[::-1], big % (1 << 17), big, np.array([rng.getrandbits(38) for _ in range(999)]))
    back = cm.unpack(cm.pack(grams, 3), 3)
    for name, column in vars(grams).items():
        assert np.array_equal(getattr(back, name), column), name


@pytest.mark.parametrize("vocabulary", [8, 1000])
def test_base_scores_and_a_model_that_beats_them(docs, vocabulary):
    texts = sample()
    frame = docs(texts).repartition(2)
    rows = cm.score_texts(frame, training=F.col("doc_id") % 5 != 1, vocabulary=vocabulary).collect()
    found = {r["doc_id"]: r for r in rows}
    want = base(texts, lambda i: i % 5 != 1)
    assert len(rows) == len(texts)
    for i, (n, known, total, score) in enumerate(want):
        r = found[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(score, rel=1e-9, abs=1e-9)
        assert r["score"] < 0 and r["n_bytes"] == len((texts[i] or "").encode())
        assert r["bits_per_byte"] == pytest.approx(-r["score"] / math.log10(2) / max(r["n_bytes"], 1))
    held = [i for i in range(6, len(texts)) if i % 5 == 1]
    if vocabulary == 1000:
        assert sum(found[i]["score"] for i in held) > sum(want[i][3] for i in held)


def test_repeated_rows_and_empty_tables(docs):
    rows = cm.score_texts(docs(["a b", "a b", "c"], [1, 1, None])).collect()
    by = sorted((r["doc_id"] or 0, r["n_known"], round(r["base_score"], 9), r["score"]) for r in rows)
    assert len(by) == 3 and by[1] == by[2]
    assert cm.score_texts(docs([])).count() == 0
    none = cm.score_texts(docs(["a"]), training=F.lit(False)).first()
    assert (none["train_tokens"], none["n_known"], none["base_score"]) == (0, 0, 0) and none["score"] < 0


def test_taught_scores_are_the_same_on_any_layout(spark, docs, monkeypatch):
    texts, scores = sample(60), []
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts, shuffled in ((1, 2), (5, 16)):
            spark.conf.set("spark.sql.shuffle.partitions", shuffled)
            frame = docs(texts).repartition(parts)
            rows = cm.score_texts(frame, training=F.col("doc_id") % 5 != 1, vocabulary=8).collect()
            scores.append({r["doc_id"]: r["score"] for r in rows})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    assert scores[0] == pytest.approx(scores[1], rel=1e-9)


def test_salts_and_buckets_change_no_score(docs, monkeypatch):
    texts, scores = sample(40), []
    # The same model for all, as salts change which rows weights are learned from together.
    costs, model = cm._coster, taught_model(random.Random(4))
    monkeypatch.setattr(cm, "_coster", lambda plan, _: costs(plan, lambda: model))
    for group, bucket, chunk in ((1 << 16, 1 << 19, 1 << 15), (7, 300, 20)):
        monkeypatch.setattr(cm, "_GROUP_ROWS", group)
        monkeypatch.setattr(cm, "_BUCKET_ROWS", bucket)
        monkeypatch.setattr(cm, "_CHUNK_ROWS", chunk)
        rows = cm.score_texts(docs(texts), training=F.col("doc_id") % 5 != 1, vocabulary=8).collect()
        scores.append({r["doc_id"]: r["score"] for r in rows})
    assert scores[0] == pytest.approx(scores[1], rel=1e-6)


def test_weights_are_learned_from_a_bounded_number_of_rows():
    assert cm.taught_share(1_000, 1_000) == cm._EVERY
    rng, coder = random.Random(6), a_coder()
    n = len(coder.hashes)
    grams = grams_of([(n + 2 + k, n + 2, 5 + (k & 255) * 256, 0, 1) for k in range(20_000)])
    grams.before_word = np.array([rng.getrandbits(63) for _ in range(20_000)], np.uint64)
    plan = a_plan(coder, [], 9)
    few = cm._dealt(plan, grams, 0, cm._LEARNED, cm.taught_share(20_000, 1_000))
    assert few.column(0).to_pylist() == [0]
    assert 800 <= len(cm.unpack(few.column(3)[0].as_py(), n).doc) <= 1_200
    whole = cm._dealt(plan, grams, 0, cm._LEARNED, None)
    assert sorted(whole.column(0).to_pylist()) == list(range(9))
    assert sum(len(cm.unpack(x.as_py(), n).doc) for x in whole.column(3)) == 20_000


def test_a_word_of_training_is_spelled_once_and_a_new_one_costs_its_letters(spark, docs):
    words = spark.createDataFrame([(1, 7, b"ab"), (2, 1, b"b"), (3, 0, b"c")], "token long, n long, word binary")
    found = {r["gram"]: r["n"] for r in words.select("n", "word").mapInArrow(cm._byte_counts, "gram long, n long").groupBy("gram").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    gram = lambda before, earlier, byte: before << 24 | earlier << 8 | byte
    a, b, c = b"abc"
    want = {gram(0, 0, a): 1, gram(a, 0, b): 1, gram(b | a << 8, 0, 32): 1, gram(0, 0, b): 1, gram(b, 0, 32): 1, gram(0, 0, c): 0, gram(c, 0, 32): 0}
    assert found == want
    texts = ["north south east west"] * 6 + ["north qj", "north " + "qj" * 40]
    rows = {r["doc_id"]: r["score"] for r in cm.score_texts(docs(texts), training=F.col("doc_id") < 6).collect()}
    assert rows[0] > rows[6] > rows[7]


@pytest.mark.parametrize("buckets", [1, 4])
def test_every_training_occurrence_teaches_the_weights_of_its_bucket(monkeypatch, buckets):
    coder, rng, given = a_coder(), random.Random(3), []
    contexts = [(rng.choice([0, 1, 2, 4]), rng.choice([0, 1, 2, 4])) for _ in range(500)]
    learned = grams_of([(*c, rng.randrange(5), 0, rng.choice([1, 2, 7])) for c in contexts])
    asked = grams_of([(*c, rng.randrange(5), 1, 1) for c in contexts])
    plan = a_plan(coder, [(s, 200) for s in range(5)], buckets)
    fitted = cm.fitted
    monkeypatch.setattr(cm, "fitted", lambda cells: given.append(cells.sum()) or fitted(cells))
    dealt = [r for kind, g in ((cm._LEARNED, learned), (cm._HELD, asked)) for r in cm._dealt(plan, g, 0, kind, None).to_pylist()]
    dealt.sort(key=lambda r: r["bucket"])
    batch = cm._rows([r["bucket"] for r in dealt], 0, 0, [r["payload"] for r in dealt])
    kinds = cm.pa.array([r["kind"] for r in dealt], cm.pa.int32())
    batch = batch.set_column(2, "kind", kinds)
    costs = [x for out in cm._coster(lambda: plan, lambda: None)(iter([batch])) for x in out.column(2).to_pylist()]
    assert len(given) == len({r["bucket"] for r in dealt}) and all(x < 0 for x in costs)
    assert sum(given) == (plan.code.size[learned.symbol] * learned.times).sum()


def test_fitted_weights_are_the_likeliest():
    rng = np.random.default_rng(1)
    steps = rng.integers(8, 25, (3, 200_000))
    x, want = steps / 2 - 8, np.array([0.2, 0.5, 0.4])
    bit = rng.random(200_000) < 1 / (1 + np.exp(-want @ x))
    cell = (((5 * cm._STEPS + steps[0]) * cm._STEPS + steps[1]) * cm._STEPS + steps[2]) * 2 + bit
    model = cm.fitted(np.bincount(cell, minlength=cm._GATES * cm._LEVEL).astype(float))
    assert model.weights[5] == pytest.approx(want, abs=0.02)
    assert model.weights[6] == pytest.approx([0.6, 0.3, 0.3])
    assert model.after[5, 22] == pytest.approx(1 / (1 + math.exp(-3)), abs=0.02)


def test_a_bucket_is_costed_in_bounded_memory():
    rng, coder = np.random.default_rng(4), cm.make_coder(np.arange(1, 4001, dtype=np.uint64), np.arange(4000, 0, -1), 9_000_000, 100)
    size, none = 200_000, np.zeros(200_000, np.uint64)
    before, earlier, symbol = (rng.integers(0, 4000, size) for _ in range(3))
    plan = a_plan(coder, [(s, 100) for s in range(4002)])
    batches = []
    for piece in range(20):  # each of some texts
        some = slice(piece * 10_000, piece * 10_000 + 10_000)
        grams = cm.Grams(before[some], none[some], earlier[some] % 7, none[some], symbol[some], np.arange(10_000) // 20, np.ones(10_000, np.int64))
        batches.append(cm._dealt(plan, grams, piece, cm._LEARNED, None))
    tracemalloc.start()
    try:
        rows = sum(out.num_rows for out in cm._coster(lambda: plan, lambda: None)(iter(batches)))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 20 * 500
    assert peak < 480 * size


def test_tasks_that_cost_buckets_are_given_small_batches(spark, docs, monkeypatch):
    name, seen, stage = "spark.sql.execution.arrow.maxBytesPerBatch", {}, cm.stage
    monkeypatch.setattr(cm, "stage", lambda df, label: seen.update({label: spark.conf.get(name)}) or stage(df, label))
    before = spark.conf.get(name)
    assert cm.score_texts(docs(sample(9))).count() == 18
    assert int(seen["lm_costs"].removesuffix("b")) == cm._BATCH_BYTES <= 8 << 20 and spark.conf.get(name) == before
    rows = spark.range(0, 64, 1, 1).selectExpr("repeat('x', 100000) AS payload")
    with cm.small_batches(spark, 1 << 20):
        sizes = rows.mapInArrow(lambda batches: (cm.pa.RecordBatch.from_arrays([cm.pa.array([b.num_rows])], ["n"]) for b in batches), "n long").collect()
    assert max(r["n"] for r in sizes) <= 11


def test_words_are_counted_in_training_and_kept_with_their_bytes(spark, monkeypatch):
    monkeypatch.setattr(cm, "_COUNTED_ROWS", 1)
    texts = [(True, "One two one"), (True, None), (False, "two new"), (True, "")]
    frame = spark.createDataFrame(texts, "learned boolean, text string").coalesce(1)
    found = {None if r["token"] == int(cm._END.view(np.int64)) else bytes(r["word"]): r["n"] for r in cm.token_table(frame).collect()}
    assert found == {b"one": 2, b"two": 1, b"new": 0, None: 3}
