"""Mixing sources to target weights by Pfair scheduling; rows pass through DataFrame
functions only.

A source's rows, in id order, form blocks of ``block_rows``; one block is served
per slot. A source of weight ``w`` among active weights of sum ``W`` has block
``j`` released at slot ``floor(j W / w)`` with deadline ``ceil((j + 1) W / w)``; in
each slot the released block with the earliest deadline is served. One server and
full load make every deadline hold, so after any number of slots ``t`` a source
has been served ``t w / W`` blocks give or take less than one. Weights are whole
numbers, so the schedule repeats every ``W`` slots and one period says it all:
a block's slot follows from its number by division, for all rows at once. When
a source runs out a new phase starts with the remaining weights; every row is
served exactly once.

Rows get their number within the source from one sort over the whole cluster
(range partitions of source and id, so a source of a third of all rows spreads
over many tasks), counts per partition and a prefix sum over the partitions.

Defined results: null and empty sources are one source; sources without a target
weigh ``default_weight``; targets without rows are ignored; null ids come first;
rows that share an id are all served, in the order of the hash of their other
columns; an empty table gives no rows; other columns of any type are passed
through, whatever their names but the six that are added (``PLACED``). Sources and
weights are not bounded: the plan is made on the driver in time and space in
proportion to the phases' weight sums, and joined by its size.
"""

from __future__ import annotations

import heapq
import json
from bisect import bisect_left
from collections.abc import Callable
from itertools import compress

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import fresh, quoted, small_side, stage

PLACED = ("__mix_phase", "__mix_block", "__mix_release", "__mix_deadline", "__mix_slot", "__mix_place")

PLAN = ("array<struct<source:string,phases:array<struct<"
        "phase:int,first:bigint,last:bigint,weight:bigint,period:bigint,start:bigint,slots:array<bigint>>>>>")


def serve_period(weights: list[int], left: list[int] | None = None) -> list[list[int]]:
    """The slots of one period that each source (by place in ``weights``) is served
    in: earliest deadline first. Source ``i``'s ``k``-th block is released at ``k * W div
    weights[i]`` and due at ``((k + 1) * W)`` over its weight, rounded up; ties go to the
    first source. One heap of released blocks: time in proportion to ``W`` but for a
    logarithm. It ends early when a source has no blocks ``left``."""
    total = sum(weights)
    slots: list[list[int]] = [[] for _ in weights]
    ready = [(-(-total // w), i) for i, w in enumerate(weights)]
    heapq.heapify(ready)
    later: dict[int, list[int]] = {}
    for t in range(total):
        for i in later.pop(t, ()):
            heapq.heappush(ready, (-(-(len(slots[i]) + 1) * total // weights[i]), i))
        i = heapq.heappop(ready)[1]
        slots[i].append(t)
        k = len(slots[i])
        if left is not None and k == left[i]:
            break
        if k < weights[i]:
            later.setdefault(max(t + 1, k * total // weights[i]), []).append(i)
    return slots


def _phase(weights: list[int], left: list[int]) -> tuple[int, list[int], Callable[[int], list[int]]]:
    """One phase: its length, the blocks each source takes, and its slots by place.
    Sources of one weight take turns, which needs no simulation."""
    n = len(left)
    if min(weights) == max(weights):
        fewest = min(left)
        last = left.index(fewest)
        took = [fewest] * (last + 1) + [fewest - 1] * (n - last - 1)
        return (fewest - 1) * n + last + 1, took, lambda i: [i + r * n for r in range(min(weights[0], left[i]))]
    slots = serve_period(weights, left)
    period = sum(weights)
    if sum(map(len, slots)) < period or any(len(s) == k for s, k in zip(slots, left, strict=True)):
        return sum(map(len, slots)), [len(s) for s in slots], slots.__getitem__
    length = min((k - 1) // w * period + s[(k - 1) % w] + 1 for k, w, s in zip(left, weights, slots, strict=True))
    took = [length // period * w + bisect_left(s, length % period) for w, s in zip(weights, slots, strict=True)]
    return length, took, slots.__getitem__


def plan(blocks: dict[str, int], weights: dict[str, int]) -> list[dict]:
    """Each source's phases; sizes depend on sources and weights, not on rows. A
    phase ends when a source runs out."""
    names = sorted(s for s, n in blocks.items() if n)
    left, own = [blocks[s] for s in names], [weights[s] for s in names]
    out: dict[str, list] = {s: [] for s in names}
    start = phase = 0
    while names:
        length, took, slots = _phase(own, left)
        period = sum(own)
        for i in compress(range(len(took)), took):
            n = took[i]
            first = blocks[names[i]] - left[i]
            out[names[i]].append({"phase": phase, "first": first, "last": first + n, "weight": own[i], "period": period,
                                  "start": start, "slots": slots(i)})
            left[i] -= n
        if 0 in left:
            keep = [i for i, n in enumerate(left) if n]
            names, left, own = [names[i] for i in keep], [left[i] for i in keep], [own[i] for i in keep]
        start, phase = start + length, phase + 1
    return [{"source": s, "phases": p} for s, p in out.items() if p]


def interleave(docs: DataFrame, weights: dict[str, int], default_weight: int = 1, block_rows: int = 16,
               id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """``docs`` with ``__mix_phase``, ``__mix_block`` (number within the source),
    ``__mix_release`` and ``__mix_deadline`` (slots), ``__mix_slot`` and ``__mix_place``
    (within the block). (slot, place) is the mixed order; it has no ties."""
    spark = docs.sparkSession
    name, row_id, tie, at = fresh(docs, "__mix_source", "__mix_id", "__mix_tie", "__mix_at")
    part, n, least, base, phases, number, p, j = (f"{name}_{x}" for x in ("part", "n", "least", "base", "phases", "row", "p", "j"))
    block, place = fresh(docs, "__mix_block", "__mix_place")
    columns = [quoted(c) for c in docs.columns]
    # map columns have no hash of their own
    rest = [F.to_json(F.struct(quoted(c))) if "map<" in t else quoted(c) for c, t in docs.dtypes if c not in (id_col, source_col)]
    keyed = docs.select(*columns, F.coalesce(quoted(source_col).cast("string"), F.lit("")).alias(name),
                        quoted(id_col).cast("bigint").alias(row_id), (F.xxhash64(*rest) if rest else F.lit(0)).alias(tie))
    order = [name, row_id, tie]
    rows = keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop(row_id, tie)
    rows = stage(rows.withColumn(at, F.monotonically_increasing_id()), "mix-rows")

    parts = F.shiftright(at, 33)
    sizes = stage(rows.groupBy(parts.alias(part), name).agg(F.count(F.lit(1)).alias(n), F.min(at).alias(least)), "mix-sizes")
    counts = {r[name]: r["all"] for r in sizes.groupBy(name).agg(F.sum(n).alias("all")).collect()}  # one row per source
    own = {s: int(weights.get(s, default_weight)) for s in counts}
    if any(w < 1 for w in own.values()):
        raise ValueError("weights: whole numbers from 1")
    planned = plan({s: -(-k // block_rows) for s, k in counts.items()}, own)
    # a source's rows before this partition; partitions are in source and id order
    before = Window.partitionBy(name).orderBy(part)
    bases = small_side(sizes.select(name, part, least, (F.sum(n).over(before) - F.col(n)).alias(base)), "mix-bases")
    schedule = (spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(planned)), PLAN)).alias("s"))
                .select(F.col("s.source").alias(name), F.col("s.phases").alias(phases)))
    schedule = small_side(schedule, "mix-plan")
    out = (rows.withColumn(part, parts).join(bases, [name, part]).withColumn(number, F.col(base) + F.col(at) - F.col(least))
           .withColumns({block: F.floor(F.col(number) / block_rows), place: F.col(number) % block_rows})
           .join(schedule, name))
    here = F.element_at(F.filter(phases, lambda x: (x["first"] <= F.col(block)) & (F.col(block) < x["last"])), 1)
    out = out.withColumn(p, here).withColumn(j, F.col(block) - F.col(f"{p}.first"))
    return out.select(
        *columns, F.col(f"{p}.phase").alias("__mix_phase"), F.col(block).alias("__mix_block"),
        F.expr(f"{p}.start + {j} * {p}.period div {p}.weight").alias("__mix_release"),
        F.expr(f"{p}.start + (({j} + 1) * {p}.period + {p}.weight - 1) div {p}.weight").alias("__mix_deadline"),
        F.expr(f"{p}.start + {j} div {p}.weight * {p}.period + {p}.slots[cast({j} % {p}.weight as int)]").alias("__mix_slot"),
        F.col(place).alias("__mix_place"))


def mixed(docs: DataFrame, weights: dict[str, int], **options) -> DataFrame:
    """``docs`` in mixed order: ascending over partitions and within them."""
    hidden = [c for c in docs.columns if c.lower() in PLACED]
    if hidden:
        raise ValueError(f"reserved column names: {hidden}")
    out = interleave(docs, weights, **options)
    out = out.repartitionByRange("__mix_slot", "__mix_place").sortWithinPartitions("__mix_slot", "__mix_place")
    return out.select(*[quoted(c) for c in docs.columns])
