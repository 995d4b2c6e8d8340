"""Mixing sources to target weights (problem 8).

A text may lie in several sources. Texts are summed by the set of sources they lie in, their pattern, and a
flow routes the tokens of patterns to the quotas of sources. The r-th use of a text costs r - 1, so a flow of
least cost repeats as little as it can. Costs lie on the arcs that leave the origin alone, hence augmenting a
largest flow use by use, cheap arcs first, gives a flow of least cost.
"""

from __future__ import annotations

import json
from collections import deque
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize
from .tokens import token_counts

#: Patterns up to which their intervals are broadcast; those of more are shuffled. The result is the same.
MOST_PATTERNS = 4_096
#: Hash ranges of a pattern in which texts are ordered one by one.
RANGES = 1_024
#: Size classes for each doubling of tokens, and texts of a class that are offered to close the gap of a source.
CLASSES, OFFERED = 4, 8


class Flow:
    """Largest flow of least cost from patterns to the quotas of sources.

    What the residual graph allows between two sources is summed over patterns, so paths lead over sources
    alone, and all patterns of a step are moved at once. `sent[s]` are the tokens of each pattern that go to
    source s, all its uses together, at most its weight times its cap.
    """

    def __init__(self, member: np.ndarray, weights: np.ndarray, caps: np.ndarray, quotas: np.ndarray) -> None:
        self.member, self.weights, self.quotas = member, weights, quotas
        most = int(quotas.sum())
        self.caps = np.minimum(caps, most // np.maximum(weights, 1) + 1)  # no pattern has more than all quotas
        self.sent = np.zeros(member.shape, np.int64)
        self.load = np.zeros(len(weights), np.int64)

    def short(self) -> int:
        return int(self.quotas.sum() - self.load.sum())

    def _moves(self, s: int) -> np.ndarray:
        """Of each source, whether a pattern that goes to s may go there as well."""
        return self.member[:, self.sent[s] > 0].any(axis=1)

    def fill(self, bound: np.ndarray) -> None:
        """Augments along shortest paths until nothing more reaches a quota with loads of at most `bound`."""
        k = len(self.quotas)
        moves = [self._moves(s) for s in range(k)]
        slack = self.quotas - self.sent.sum(axis=1)
        spare = bound - self.load
        while True:
            open_ = self.member[:, spare > 0].any(axis=1)
            came = {s: -1 for s in range(k) if open_[s]}
            queue, end = deque(came), -1
            while queue and end < 0:
                s = queue.popleft()
                if slack[s] > 0:
                    end = s
                for t in np.flatnonzero(moves[s]).tolist():
                    if t not in came:
                        came[t] = s
                        queue.append(t)
            if end < 0:
                return
            path = [end]
            while came[path[-1]] >= 0:
                path.append(came[path[-1]])
            first = path[-1]
            steps = list(zip(path[1:], path, strict=False))  # the last step comes first, so each moves what was there before
            amount = min(int(slack[end]), int(spare[self.member[first]].sum()), *(int(self.sent[s][self.member[t]].sum()) for s, t in steps))
            for s, t in steps:
                moved = _first(np.where(self.member[t], self.sent[s], 0), amount)
                self.sent[s] -= moved
                self.sent[t] += moved
            added = _first(np.where(self.member[first], spare, 0), amount)
            self.sent[first] += added
            self.load += added
            spare -= added
            slack[end] -= amount
            for s in path:
                moves[s] = self._moves(s)

    def fill_up(self) -> None:
        """A largest flow, whatever it costs."""
        self.fill(self.caps * self.weights)

    def fill_evenly(self) -> None:
        """A largest flow of least cost, use by use.

        A pattern that a largest flow of some use leaves short can't get more by further uses, as no path leads
        on from it. While all others are full, several uses are added at once.
        """
        rising = (self.weights > 0) & (self.caps > 0)
        level, step = 0, 1
        while rising.any() and self.short():
            bound = np.where(rising, np.minimum(self.caps, level + step) * self.weights, self.load)
            kept = (self.sent.copy(), self.load.copy()) if step > 1 else None
            self.fill(bound)
            full = self.load == bound
            if kept and not full.all():
                self.sent, self.load = kept
                step //= 2
                continue
            level += step
            rising &= full & (self.caps > level)
            step = 2 * step if full.all() else 1

    def lacking(self) -> np.ndarray:
        """Sources from which a path leads to a quota that isn't met: after a largest flow, no more can be sent to all of them."""
        moves = np.array([self._moves(s) for s in range(len(self.quotas))]).reshape(len(self.quotas), len(self.quotas))
        found = self.quotas > self.sent.sum(axis=1)
        while True:
            more = found | (moves & found).any(axis=1)
            if (more == found).all():
                return found
            found = more


def _first(there: np.ndarray, amount: int) -> np.ndarray:
    """The first `amount` of what is there."""
    return np.clip(amount - (np.cumsum(there) - there), 0, there)


def _arrays(patterns: list[tuple[tuple[str, ...], int]], uses: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Which pattern has which source, in order of names, and the tokens of the patterns."""
    member = np.array([[s in sources for sources, _ in patterns] for s in sorted(uses)], bool).reshape(len(uses), len(patterns))
    return member, np.array([t for _, t in patterns], np.int64)


def _caps(member: np.ndarray, uses: dict[str, int]) -> np.ndarray:
    """A text has no more uses than any of its sources allows."""
    caps = np.full(member.shape[1], max(uses.values(), default=0), np.int64)
    for s, inside in zip(sorted(uses), member, strict=True):
        caps[inside] = np.minimum(caps[inside], uses[s])
    caps[~member.any(axis=0)] = 0
    return caps


def _spread(flow: Flow) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The flow as intervals of what each pattern sends, its uses one after the other: pattern, source, low, high."""
    ends = np.cumsum(flow.sent, axis=0)
    p, s = np.nonzero(flow.sent.T)
    return p, s, ends[s, p] - flow.sent[s, p], ends[s, p]


def route(patterns: list[tuple[tuple[str, ...], int]], quotas: dict[str, int], uses: dict[str, int]) -> dict[tuple[int, int, str], int]:
    """Tokens that flow from (pattern, use) to each source: at most a pattern's tokens a use, at most a source's quota.

    A text has no more uses than any of its sources allows.
    """
    uses = {s: uses[s] for s in quotas}
    names = sorted(quotas)
    member, weights = _arrays(patterns, uses)
    flow = Flow(member, weights, _caps(member, uses), np.array([quotas[s] for s in names], np.int64))
    flow.fill_evenly()
    found: dict[tuple[int, int, str], int] = {}
    for p, s, low, high in zip(*(x.tolist() for x in _spread(flow)), strict=True):
        w = patterns[p][1]
        for r in range(low // w, (high - 1) // w + 1):
            found[p, r + 1, names[s]] = min(high, (r + 1) * w) - max(low, r * w)
    return found


def largest_total(patterns: list[tuple[tuple[str, ...], int]], shares: dict[str, float], uses: dict[str, int]) -> int:
    """The most tokens a mixture can have in which every source has its share."""
    uses = {s: uses[s] for s in shares}
    member, weights = _arrays(patterns, uses)
    return _largest(member, weights, _caps(member, uses), shares)


def _largest(member: np.ndarray, weights: np.ndarray, caps: np.ndarray, shares: dict[str, float]) -> int:
    """Lowers the total to what the sources that lack tokens can have together, until none lacks any."""
    if not shares:
        return 0
    parts = np.array([shares[s] for s in sorted(shares)])
    levels = np.unique(caps).tolist()

    def total(inside: np.ndarray) -> int:
        touched = member[inside].any(axis=0)
        return min(int(sum(c * int(weights[touched & (caps == c)].sum()) for c in levels) / parts[inside].sum()), 2**62)

    size = min(total(np.arange(len(parts)) == i) for i in range(len(parts)))
    while size > 0:
        flow = Flow(member, weights, caps, (parts * size).astype(np.int64))
        flow.fill_up()
        if not flow.short():
            break
        size = min(size - 1, total(flow.lacking()))
    return max(size, 0)


@dataclass
class Plan:
    """Shares of the sources that have texts, their quotas, and the flow as intervals of what each pattern sends.

    An interval has the pattern, its tokens, the source, and where it begins and ends; uses follow each other.
    """

    shares: dict[str, float]
    quotas: dict[str, int]
    intervals: pa.Table


def _key(sources: Column | str) -> Column:
    return F.to_json(sources)


@dataclass
class Mixture:
    """`chosen`: `doc_id, source, uses, tokens`; `report`: one row for each source with a target."""

    chosen: DataFrame
    report: DataFrame
    total: int


def mix(
    documents: DataFrame, targets: DataFrame, seed: int = 1000, total: int | None = None, vocabulary: str | None = None, stretch: float = 1.0
) -> Mixture:
    """A mixture of `documents` (`doc_id, text, source`) by `targets` (`source, target_share, max_repeats`).

    Sizes are tokens. Without `total` the mixture is as large as it can be with every source that has texts at
    its share of the whole; shares of sources without texts are spread over the others in proportion. With a
    larger `total`, or with `stretch` times that largest size, sources that can't fill their quota fall short,
    and the report says so. Equal texts are one text, which can serve any of its sources, but is used no more
    often than each of them allows. Which texts are used, and how often, follows from `seed` and the texts
    alone, not from the layout. The flow is rounded to whole texts, and what that leaves is closed by single
    uses, so that a quota which the flow meets is met to within the smallest text at hand. A chosen row names
    the smallest `doc_id` of the text in the source.

    Null, empty and blank texts, null sources and sources without target take no part. Null, zero or
    negative shares are no target; a null `max_repeats` is 1, and below 1 the source isn't used. A source listed twice has its largest share and its smallest number of repeats.
    Empty tables give an empty mixture. To the driver goes one sum for each pattern that occurs, whatever
    their number; each of them keeps all its sources.
    """
    spark = documents.sparkSession
    goal = (
        targets.where((F.col("target_share") > 0) & F.col("source").isNotNull() & ~F.isnan(F.col("target_share").cast("double")))
        .groupBy("source").agg(F.max(F.col("target_share").cast("double")).alias("target_share"), F.min(F.coalesce("max_repeats", F.lit(1))).alias("max_repeats"))
    )
    goals = {r["source"]: r for r in goal.collect()}  # one row for each source of the mixture
    usable = F.create_map(*[x for s in sorted(goals) for x in (F.lit(s), F.lit(True))]) if goals else F.lit(None).cast("map<string,boolean>")
    docs = documents.select("doc_id", "text", "source").where(F.col("text").isNotNull() & F.col("text").rlike(r"\S") & F.element_at(usable, F.col("source")))
    sized = docs.select("doc_id", "source", F.sha2("text", 256).alias("text_key"), token_counts("text", vocabulary).alias("tokens"))
    inside = sized.groupBy("text_key", "source").agg(F.min("doc_id").alias("doc_id"), F.max("tokens").alias("tokens"))
    texts = materialize(
        inside.groupBy("text_key").agg(F.sort_array(F.collect_list(F.struct("source", "doc_id"))).alias("places"), F.max("tokens").alias("tokens"))
        .select("text_key", "tokens", "places", F.col("places.source").alias("pattern")).where("tokens > 0"),
        "mix-texts",
    )
    sums = texts.groupBy("pattern").agg(F.sum("tokens").alias("tokens")).orderBy(_key("pattern"))
    names = sorted(goals)
    summed = sums.select("tokens", *[F.array_contains("pattern", s).alias(f"s{i}") for i, s in enumerate(names)]).toArrow()
    member = np.array([summed[f"s{i}"].to_numpy() for i in range(len(names))], bool).reshape(len(names), summed.num_rows)
    plan = _plan(names, member, summed["tokens"].to_numpy(), {s: (r["target_share"], r["max_repeats"]) for s, r in goals.items()}, total, stretch)

    # Where the middle of each text lies among those of its pattern, in seeded order: ranges of hashes first, then inside of a range.
    order = F.md5(F.concat(F.lit(f"{seed}:"), "text_key"))
    placed = texts.select("text_key", "pattern", "places", "tokens", order.alias("h")).withColumn("range", (F.conv(F.substring("h", 1, 8), 16, 10).cast("long") % RANGES).cast("int"))
    ranges = placed.groupBy("pattern", "range").agg(F.sum("tokens").alias("n"))
    before = Window.partitionBy("pattern").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("pattern", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("pattern", "range").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    at = (
        placed.withColumn("inside", F.coalesce(F.sum("tokens").over(within), F.lit(0))).join(starts, ["pattern", "range"])
        .select("text_key", "h", _key("pattern").alias("pattern"), "places", "tokens", F.expr("start + inside + tokens div 2").alias("at"))
    )
    intervals = spark.createDataFrame(plan.intervals)
    if member.shape[1] <= MOST_PATTERNS:
        intervals = F.broadcast(intervals)
    # Use r of a text lies r times the pattern's tokens behind its first; those in the interval count.
    uses = F.expr("(high - 1 - at + whole) div whole - (low - 1 - at + whole) div whole")
    picked = at.join(intervals, "pattern").withColumn("uses", uses).where("uses > 0").select("text_key", "h", "places", "tokens", "source", "uses")
    picked = materialize(picked, "picked-texts")
    gaps = {s: q for s, q in plan.quotas.items()}
    for r in picked.groupBy("source").agg(F.sum(F.col("uses") * F.col("tokens")).alias("n")).collect():  # one row for each source
        gaps[r["source"]] -= r["n"]
    caps = {s: int(r["max_repeats"]) for s, r in goals.items()}
    closing = _closing(texts, picked, {s: g for s, g in gaps.items() if g}, caps, order)
    whole_use = picked.select("text_key", "places", "tokens", "source", "uses").unionByName(closing)
    place = F.filter("places", lambda p: p["source"] == F.col("source"))[0]["doc_id"]
    chosen = whole_use.select(place.alias("doc_id"), "source", "tokens", "uses").groupBy("doc_id", "source").agg(F.sum("uses").alias("uses"), F.max("tokens").alias("tokens"))
    chosen = materialize(chosen.where("uses > 0"), "mixture")
    got = chosen.groupBy("source").agg(F.sum(F.col("uses") * F.col("tokens")).alias("tokens"), F.count(F.lit(1)).alias("texts"), F.max("uses").alias("most_uses"))
    share = spark.createDataFrame([(s, x, plan.quotas[s]) for s, x in plan.shares.items()], "source string, share double, quota long")
    whole = Window.partitionBy()  # one row for each source of the mixture
    report = (
        goal.join(share, "source", "left").join(got, "source", "left")
        .select("source", "target_share", F.col("max_repeats").cast("long").alias("max_repeats"), F.coalesce("share", F.lit(0.0)).alias("share"), F.coalesce("quota", F.lit(0)).alias("quota"),
                F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("texts", F.lit(0)).alias("texts"), F.coalesce("most_uses", F.lit(0)).alias("most_uses"))
        .withColumn("actual_share", F.coalesce(F.try_divide(F.col("tokens"), F.sum("tokens").over(whole)), F.lit(0.0)))
    )
    return Mixture(chosen, report, sum(plan.quotas.values()))


def _fitting(rows: list[tuple[int, int]], left: int) -> tuple[list[int], int]:
    """Of rows (size, number) in falling order: those that fit what is left, one after the other, and how far they miss it."""
    taken, rest = [], []
    for n, i in rows:
        if n <= left:
            taken.append(i)
            left -= n
        else:
            rest.append((n, i))
    if rest and rest[-1][0] - left < left:  # the smallest of the others, if that comes nearer
        taken.append(rest[-1][1])
        left = abs(rest[-1][0] - left)
    return taken, left


def _closing(texts: DataFrame, picked: DataFrame, gaps: dict[str, int], caps: dict[str, int], order: Column) -> DataFrame:
    """Single uses to add (1) or to take away (-1), `text_key, places, tokens, source, uses`, that bring each source to its quota.

    The flow is cut into whole texts by rounding, which leaves a gap in each source. It is closed by texts from
    the largest that fits it down to the smallest; what is too much goes in the same way, or by a larger text
    for which others come in. Offered are the first OFFERED texts of every size class, in seeded order, so no
    more than some hundred texts of a source are looked at, whatever its size. Uses are added where every
    source of a text allows one more, and an added text is offered to one of its sources only.
    """
    spark, schema = texts.sparkSession, "text_key string, places array<struct<source: string, doc_id: long>>, tokens long, source string, uses long"
    if not gaps:
        return spark.createDataFrame([], schema)
    gap = F.create_map(*[F.lit(x) for item in sorted(gaps.items()) for x in item])
    cap = F.create_map(*[F.lit(x) for item in sorted(caps.items()) for x in item])
    fields = ["text_key", "places", "tokens", "source", "h"]
    less = picked.where(F.element_at(gap, F.col("source")) < 0).select(*fields, F.lit(-1).cast("long").alias("uses"))
    used = picked.groupBy("text_key").agg(F.sum("uses").alias("used"))
    short = F.filter("pattern", lambda s: F.element_at(gap, s).isNotNull())
    spare = (
        texts.withColumn("short", short).where(F.size("short") > 0).withColumn("h", order).join(used, "text_key", "left")
        .where(F.coalesce("used", F.lit(0)) < F.array_min(F.transform("pattern", lambda s: F.element_at(cap, s))))
        .withColumn("source", F.element_at("short", (F.pmod(F.xxhash64("text_key"), F.size("short")) + 1).cast("int"))).select(*fields, F.lit(1).cast("long").alias("uses"))
    )
    by_size = Window.partitionBy("source", "uses", "size").orderBy("h")
    offered = (
        less.unionByName(spare).withColumn("size", F.floor(F.log2("tokens") * CLASSES).cast("int"))
        .withColumn("n", F.row_number().over(by_size)).where(F.col("n") <= OFFERED)
        .select("text_key", "places", F.col("tokens").cast("long").alias("tokens"), "source", "h", "uses", F.element_at(gap, F.col("source")).alias("gap"))
    )

    def close(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["tokens"].to_pylist(), table["h"].to_pylist(), range(len(table)), table["uses"].to_pylist(), strict=True), key=lambda r: (-r[0], r[1]))
        more, fewer = [(n, i) for n, _, i, uses in rows if uses > 0], [(n, i) for n, _, i, uses in rows if uses < 0]
        gap = table["gap"][0].as_py()
        if gap > 0:
            taken, _ = _fitting(more, gap)
        else:
            taken, left = _fitting(fewer, -gap)
            larger = [(n, i) for n, i in fewer if n >= -gap]
            if larger:  # one that is too large, and others in its place
                n, i = larger[-1]
                instead, rest = _fitting(more, n + gap)
                if rest < left:
                    taken = [i, *instead]
        found = table.take(pa.array(taken, pa.int64()))
        return pa.table([found[c] for c in ("text_key", "places", "tokens", "source", "uses")], names=["text_key", "places", "tokens", "source", "uses"])

    return offered.groupBy("source").applyInArrow(close, schema)


def make_plan(patterns: list[tuple[tuple[str, ...], int]], goals: dict[str, tuple[float, int]], total: int | None = None) -> Plan:
    """Shares, quotas and intervals of a mixture; see mix()."""
    names = sorted({*goals, *(s for sources, _ in patterns for s in sources)})
    member, weights = _arrays(patterns, dict.fromkeys(names, 0))
    return _plan(names, member, weights, goals, total)


def _plan(names: list[str], member: np.ndarray, weights: np.ndarray, goals: dict[str, tuple[float, int]], total: int | None, stretch: float = 1.0) -> Plan:
    uses = {s: n for s, (_, n) in goals.items() if n >= 1}
    present = [i for i, s in enumerate(names) if s in uses and weights[member[i]].any()]
    uses = {names[i]: uses[names[i]] for i in present}
    whole = sum(goals[s][0] for s in uses)
    shares = {s: goals[s][0] / whole for s in sorted(uses)}
    fit = member[present]
    caps = _caps(fit, uses)
    size = int(_largest(fit, weights, caps, shares) * stretch) if total is None else total
    quotas = {s: int(x * size) for s, x in shares.items()}
    flow = Flow(fit, weights, caps, np.array([quotas[s] for s in sorted(uses)], np.int64))
    flow.fill_evenly()
    p, s, low, high = _spread(flow)
    keys = pa.array([_json(tuple(names[i] for i in np.flatnonzero(member[:, j]))) for j in np.unique(p)], pa.string())
    intervals = pa.table(
        {
            "pattern": keys.take(pa.array(np.searchsorted(np.unique(p), p))),
            "source": pa.array(sorted(uses), pa.string()).take(pa.array(s)),
            "whole": pa.array(weights[p], pa.int64()),
            "low": pa.array(low, pa.int64()),
            "high": pa.array(high, pa.int64()),
        }
    )
    return Plan(shares, quotas, intervals)


def _json(sources: tuple[str, ...]) -> str:
    return json.dumps(list(sources), ensure_ascii=False, separators=(",", ":"))
