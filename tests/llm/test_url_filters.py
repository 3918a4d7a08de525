from __future__ import annotations

import datetime as dt
import random

from tillweave.llm.url_filters import judge_urls

DAY = dt.date(2024, 1, 1)
ENTRY = "kind string, pattern string, action string, day date"
CAPTURE = "page_id long, url string, day date, kind string"


def brute(captures, entries):
    rank = {"remove": 0, "allow": 1, "block": 2}
    out = []
    for page, url, day, _ in captures:
        host, best = None, None
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = rest.split("/")[0].split("?")[0].split("#")[0].split("@")[-1].split(":")[0].lower().rstrip(".") or None
        if host and day:
            path = [x for x in rest.split("?")[0].split("#")[0].split("/")[1:] if x]
            labels = host.split(".")
            asked = [("domain", ".".join(labels[-i:]), i) for i in range(1, len(labels) + 1)]
            asked += [("host", host, 999)] + [("prefix", "/".join([host, *path[:d]]), 1000 + d) for d in range(1, len(path) + 1)]
            for kind, pattern, weight in asked:
                held = [(e[3], rank[e[2]], e[2]) for e in entries if None not in e and e[:2] == (kind, pattern) and e[3] <= day]
                if held and max(held)[2] != "remove" and (best is None or weight > best[0]):
                    best = (weight, max(held)[2], kind, pattern, max(held)[0])
        out.append((page, host, day, *(best[1:] if best else (None,) * 4)))
    return out


def test_equals_brute_force(spark):
    rng = random.Random(1)
    day = lambda: DAY + dt.timedelta(rng.randint(0, 20))
    hosts = ["a.example.com", "b.a.example.com", "example.com", "x.org", "hot.org"]
    captures = [(0, None, DAY, ""), (1, "no url", DAY, ""), (2, "http://", DAY, ""), (3, "https://A.Example.com", None, ""),
                (4, "ftp://u:p@X.org.:8/q?x=/a/b", DAY, ""), (5, "http://x.org/" + "s/" * 3000, day(), "")]
    for i in range(300):
        path = "/".join(rng.choice(["q", "r", ""]) for _ in range(rng.randint(0, 4)))
        captures.append((i // 2 + 9, f"https://{rng.choice(hosts + ['hot.org'] * 5)}/{path}{rng.choice(['', '?a=1', '#t'])}", day(), "k"))
    entries = [("host", None, "block", DAY), ("host", "x.org", None, DAY), ("host", "x.org", "block", None)]
    for _ in range(120):
        host = rng.choice(hosts)
        kind = rng.choice(["domain", "host", "prefix"])
        pattern = host + "/" + rng.choice(["q", "q/r", "r/q/q"]) if kind == "prefix" else rng.choice([host, "com"] if kind == "domain" else [host])
        entries.append((kind, pattern, rng.choice(["block", "allow", "remove"]), day()))
    entries += entries[:20]
    frame = spark.createDataFrame(captures, CAPTURE).repartition(3)
    found = judge_urls(frame, spark.createDataFrame(entries, ENTRY)).collect()
    order = lambda rows: sorted(map(repr, map(tuple, rows)))
    want = brute(captures, entries)
    assert order(found) == order(want) and 50 < sum(x[3] is not None for x in want) < 300


def test_empty_tables_and_plan_without_python(spark):
    captures = spark.createDataFrame([(1, "http://a.b/c", DAY, "k")], CAPTURE)
    none = spark.createDataFrame([], ENTRY)
    assert [tuple(r) for r in judge_urls(captures, none).collect()] == [(1, "a.b", DAY, None, None, None, None)]
    assert judge_urls(captures.limit(0), none).count() == 0
    plan = judge_urls(captures, none)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
