"""Flows against brute force, and what a mixture promises."""

import itertools
import os
import random
import time

import pytest

from siftmill.llm import mixing
from siftmill.llm.mixing import largest_total, make_plan, mix, route
from siftmill.llm.tokens import default_vocabulary, tokenizer

needs_vocabulary = pytest.mark.skipif(not os.path.exists(default_vocabulary()), reason="no vocabulary here")


def best_by_trying(patterns, quotas, uses):
    """The largest flow and its least cost, by trying all amounts."""
    arcs = [(p, r, s) for p, (sources, _) in enumerate(patterns) for s in sources if s in uses for r in range(1, min(uses[n] for n in sources if n in uses) + 1)]
    best = (0, 0)
    for amounts in itertools.product(range(3), repeat=len(arcs)):
        flow = dict(zip(arcs, amounts, strict=True))
        if all(sum(v for (p, r, _), v in flow.items() if (p, r) == (i, k)) <= t for i, (_, t) in enumerate(patterns) for k in range(1, 4)) and all(sum(v for (_, _, s), v in flow.items() if s == n) <= q for n, q in quotas.items()):
            total, cost = sum(amounts), sum((r - 1) * v for (_, r, _), v in flow.items())
            best = max(best, (total, -cost))
    return best


@pytest.mark.parametrize("seed", range(6))
def test_flow_is_largest_and_cheapest(seed):
    chance = random.Random(seed)
    patterns = [(("a",), chance.randint(0, 2)), (("a", "b"), chance.randint(1, 2)), (("b", "c"), chance.randint(0, 2))]
    quotas = {s: chance.randint(0, 4) for s in "abc"}
    uses = {"a": chance.randint(1, 2), "b": chance.randint(1, 2), "c": 1}
    flow = route(patterns, quotas, uses)
    assert (sum(flow.values()), -sum((r - 1) * v for (_, r, _), v in flow.items())) == best_by_trying(patterns, quotas, uses)


def test_largest_total():
    patterns = [(("a",), 1000), (("b",), 100), (("a", "b"), 50)]
    assert largest_total(patterns, {"a": 0.5, "b": 0.5}, {"a": 1, "b": 2}) in range(498, 503)  # quotas are whole tokens
    assert largest_total(patterns, {}, {}) == 0
    assert make_plan([], {"a": (0.5, 1)}).quotas == {}


def inputs(spark, seed=1, n=600):
    chance = random.Random(seed)
    words = "pose site dock ligand affinity shard batch round model score".split()
    texts = [" ".join(chance.choice(words) for _ in range(chance.randint(1, 30))) for _ in range(n)]
    rows = [(i, chance.choice(texts), chance.choice("aaaaaabbc"), "x", 0) for i in range(2 * n)]
    rows += [(-1, None, "a", "x", 0), (-2, "", "a", "x", 0), (-3, " \t", "b", "x", 0), (-4, "no source", None, "x", 0), (-5, "other", "z", "x", 0), (-6, "only c " * 3000, "c", "x", 0)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string, uses string, tokens int")
    targets = spark.createDataFrame([("a", 0.2, 1), ("b", 0.3, 2), ("c", 0.4, 3), ("gone", 0.1, 5), ("z", None, 1), (None, 0.5, 1), ("a", 0.1, 4)], "source string, target_share double, max_repeats int")
    return documents, targets


@needs_vocabulary
def test_shares_and_repeats(spark):
    documents, targets = inputs(spark)
    made = mix(documents, targets)
    report = {r.source: r for r in made.report.collect()}
    chosen = made.chosen.collect()
    texts = {r.doc_id: (r.text, r.source) for r in documents.collect()}
    size = tokenizer(default_vocabulary()).encode
    assert set(report) == {"a", "b", "c", "gone"} and report["gone"].tokens == 0
    for s, share in (("a", 2 / 9), ("b", 3 / 9), ("c", 4 / 9)):
        mine = [r for r in chosen if r.source == s]
        assert abs(report[s].share - share) < 1e-9 and report[s].tokens == sum(r.uses * r.tokens for r in mine)
        assert all(1 <= r.uses <= {"a": 1, "b": 2, "c": 3}[s] and texts[r.doc_id][1] == s and len(size([texts[r.doc_id][0]])[0]) == r.tokens for r in mine)
        longest = max((r.tokens for r in mine), default=0)
        assert longest and abs(report[s].tokens - report[s].quota) <= max(0.01 * report[s].quota, 3)
    used, allowed = {}, {}
    for text, source in texts.values():
        if source in "abc" if source else False:
            allowed[text] = min(allowed.get(text, 9), {"a": 1, "b": 2, "c": 3}[source])
    for r in chosen:
        used[texts[r.doc_id][0]] = used.get(texts[r.doc_id][0], 0) + r.uses
    assert all(n <= allowed[t] for t, n in used.items())
    assert abs(sum(r.actual_share for r in report.values()) - 1) < 1e-9


@needs_vocabulary
def test_same_whatever_the_layout(spark):
    documents, targets = inputs(spark)
    results = {tuple(sorted(tuple(r) for r in mix(documents.repartition(n), targets, total=3000).chosen.collect())) for n in (1, 5)}
    assert len(results) == 1
    assert tuple(sorted(tuple(r) for r in mix(documents, targets, seed=2, total=3000).chosen.collect())) not in results


@needs_vocabulary
def test_more_than_there_is(spark, monkeypatch):
    documents, targets = inputs(spark, n=50)
    report = {r.source: r for r in mix(documents, targets, total=10**7).report.collect()}
    assert report["c"].most_uses == 3 and report["a"].most_uses == 1 and report["a"].tokens < report["a"].quota
    monkeypatch.setattr(mixing, "MOST_PATTERNS", 2)
    assert mix(documents, targets).report.count() == 4


@needs_vocabulary
def test_empty(spark):
    documents, targets = inputs(spark, n=5)
    for d, t in ((documents.limit(0), targets), (documents, targets.limit(0))):
        made = mix(d, t)
        assert made.chosen.count() == 0 and made.total == 0
        assert all(r.tokens == 0 and r.actual_share == 0 for r in made.report.collect())


@needs_vocabulary
def test_rare_patterns_keep_their_sources(spark, monkeypatch):
    """With more patterns than a small cap, no text exceeds any of its sources' repeats, and the total is the same."""
    chance = random.Random(5)
    sources, limits = "abcdefgh", [3, 1, 4, 2, 1, 3, 2, 4]
    texts = [f"text {i} " + "dock " * chance.randint(1, 20) for i in range(400)]
    rows = [(100 * i + j, t, s) for i, t in enumerate(texts) for j, s in enumerate(chance.sample(sources, chance.randint(1, 5)))]
    rows += [(10**6 + i, f"more {i} dock", "bh"[i % 2]) for i in range(40)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string")
    targets = spark.createDataFrame(list(zip(sources, [1 / 8] * 8, limits)), "source string, target_share double, max_repeats int")
    text, at = {d: t for d, t, _ in rows}, {}
    for _, t, s in rows:
        at.setdefault(t, set()).add(s)
    assert len({frozenset(x) for x in at.values()}) > 100
    whole = mix(documents, targets)
    monkeypatch.setattr(mixing, "MOST_PATTERNS", 4)
    made = mix(documents, targets)
    used = {}
    chosen = sorted(tuple(r[c] for c in ("doc_id", "source", "uses", "tokens")) for r in made.chosen.collect())
    for d, s, n, _ in chosen:
        assert s in at[text[d]]
        used[text[d]] = used.get(text[d], 0) + n
    allowed = dict(zip(sources, limits))
    assert all(n <= min(allowed[s] for s in at[t]) for t, n in used.items())
    assert made.total == whole.total > 0 and chosen == sorted(tuple(r[c] for c in ("doc_id", "source", "uses", "tokens")) for r in whole.chosen.collect())
    # The total is what a linear bound allows: no set of sources gets more than the texts that touch it can give.
    size = tokenizer(default_vocabulary()).encode
    tokens = {t: len(size([t])[0]) for t in at}
    bound = min(
        sum(tokens[t] * min(allowed[s] for s in x) for t, x in at.items() if x & set(some)) * 8 // n
        for n in range(1, 9) for some in itertools.combinations(sources, n)
    )
    assert bound - 8 <= made.total <= bound


def test_uses_have_no_bound():
    """A small source is used as often as its target allows, and as evenly as it can be."""
    patterns = [(("a",), 100_000), (("a", "b"), 7), (("b",), 10)]
    assert largest_total(patterns, {"a": 0.9, "b": 0.1}, {"a": 1, "b": 1_000}) in range(100_060, 100_080)
    assert largest_total(patterns, {"a": 0.9, "b": 0.1}, {"a": 1, "b": 2_000_000_000}) in range(111_100, 111_120)
    flow = route(patterns, {"a": 0, "b": 10_000}, {"a": 400, "b": 1_000})
    sent = [sum(n for (p, _, _), n in flow.items() if p == i) for i in range(3)]
    assert sent == [0, 7 * 400, 10_000 - 7 * 400] and max(r for p, r, _ in flow if p == 2) == 720


@needs_vocabulary
def test_more_than_64_uses(spark):
    documents = spark.createDataFrame([(1, "rare text " * 3, "b")] + [(i + 2, f"dock {i} " + "pose " * 40, "a") for i in range(200)], "doc_id long, text string, source string")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 5_000)], "source string, target_share double, max_repeats int")
    report = {r.source: r for r in mix(documents, targets).report.collect()}
    assert report["b"].max_repeats == 5_000 and report["b"].most_uses > 1_000
    assert abs(report["b"].tokens - report["a"].tokens) < 100


def test_many_patterns_and_uses():
    """The plan for 5,000 sets of sources of which texts may be used a hundred times."""
    chance = random.Random(7)
    sources = [f"s{i:02}" for i in range(30)]
    patterns = [(tuple(sorted(chance.sample(sources, chance.randint(1, 6)))), chance.randint(1, 10_000)) for _ in range(5000)]
    began = time.monotonic()
    plan = make_plan(patterns, {s: ((i + 1) / 465, 100) for i, s in enumerate(sources)})
    assert time.monotonic() - began < 60
    sent = plan.intervals.group_by("source").aggregate([])
    assert sent.num_rows == 30 and sum(plan.quotas.values()) > 100 * 10_000
    got = dict.fromkeys(sources, 0)
    for source, low, high in zip(*(plan.intervals[c].to_pylist() for c in ("source", "low", "high")), strict=True):
        got[source] += high - low
    assert got == plan.quotas


@needs_vocabulary
def test_stretched(spark):
    documents, targets = inputs(spark)
    once, twice = mix(documents, targets), mix(documents, targets, stretch=2.0)
    assert abs(twice.total - 2 * once.total) <= 8
    report = {r.source: r for r in twice.report.collect()}
    assert max(r.most_uses for r in report.values()) > 1 and any(r.tokens < r.quota for r in report.values())
    assert all(r.most_uses <= r.max_repeats for r in report.values())
