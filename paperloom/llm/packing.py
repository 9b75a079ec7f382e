"""Problem 8: filling containers of fixed capacity with documents, sized in tokens.

Method. Bin packing by the Martello-Toth reduction and best fit, both on the histogram of sizes: all items of one
size are interchangeable, and no histogram has more rows than the capacity, however many documents there are.

1. An item larger than the capacity is cut into full containers and a rest; nothing else is ever cut.
2. Reduction. For the largest size left, the feasible sets that hold it are compared. A set that dominates all others
   (every other set's rest fits into the place of its own rest) is fixed for good, for as many containers as there are
   equal items. The rules are those for sets of at most three items.
3. What no rule can fix is packed best fit, largest sizes first, container groups of equal residual space at a time.

The plan is a short list of intervals: "the items of size s with the ranks lo..hi go to the containers from c on, q in
each". A set is fixed at once for as many containers as its sizes allow, which uses up one of them, so the number of intervals depends on
the number of sizes and not on that of the items. Ranks are given to the items by a two-level count (block of the id hash, then rank in
the block), and an item finds its interval by a join on its size and its run of :data:`RUN` ranks, so that a size shared by a third
of all documents is no single task and no item looks at more intervals than its run has.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: An interval: size, first rank, number of items, first container, items in each container.
Interval = tuple[int, int, int, int, int]

#: Ranks that are looked up together.
RUN = 256
#: Histogram and plan have a few rows a size, and a capacity has as many sizes; a greater one is an error.
MAX_CAPACITY = 1 << 22


class _Sizes:
    """A multiset of sizes with the neighbours that the reduction asks for."""

    def __init__(self, histogram: dict[int, int]):
        self.n = {s: c for s, c in histogram.items() if c > 0}
        self.keys = sorted(self.n)

    def take(self, s: int, k: int) -> None:
        self.n[s] -= k
        if not self.n[s]:
            del self.n[s]
            self.keys.pop(bisect_left(self.keys, s))

    def smallest(self, k: int) -> list[int]:
        out: list[int] = []
        for s in self.keys:
            out += [s] * min(self.n[s], k - len(out))
            if len(out) == k:
                break
        return out

    def largest_to(self, most: int) -> int | None:
        i = bisect_left(self.keys, most + 1)
        return self.keys[i - 1] if i else None

    def above(self, s: int, k: int) -> list[int]:
        """The ``k`` smallest items larger than ``s``."""
        out: list[int] = []
        for x in self.keys[bisect_left(self.keys, s + 1) :]:
            out += [x] * min(self.n[x], k - len(out))
            if len(out) == k:
                break
        return out

    def best_pair(self, most: int) -> tuple[int, int] | None:
        """The pair with the largest sum of at most ``most``, the larger one first."""
        best, lo, hi = None, 0, len(self.keys) - 1
        while lo <= hi:
            a, b = self.keys[lo], self.keys[hi]
            if a + b > most or (lo == hi and self.n[a] < 2):
                hi -= 1
                continue
            if best is None or a + b > sum(best):
                best = (b, a)
            lo += 1
        return best


def plan(histogram: dict[int, int], capacity: int, reduce: bool = True, at_once: bool = True) -> tuple[list[Interval], dict[str, int]]:
    """The intervals for items of 1..capacity tokens, and counts of what the two steps did.

    Containers are numbered from 0. ``histogram`` maps a size to its number of items. Without ``at_once`` a set is fixed for one container at a
    time, which takes as many steps as there are containers.
    """
    used: Counter[int] = Counter()
    out: list[Interval] = []
    containers = 0
    stats = {"reduced": 0, "best_fit": 0}

    last: dict[int, int] = {}  # where a size's latest interval stands in ``out``

    def put(s: int, k: int, first: int, each: int = 1) -> None:
        at = last.get(s)
        if at is not None:
            _, lo, n, c, q = out[at]
            if q == each and n % q == 0 and c + n // q == first:  # goes on where that one ends
                out[at] = (s, lo, n + k, c, q)
                used[s] += k
                return
        last[s] = len(out)
        out.append((s, used[s], k, first, each))
        used[s] += k

    def fix(parts: list[int], k: int) -> None:
        nonlocal containers
        for s, q in Counter(parts).items():
            put(s, k * q, containers, q)
            items.take(s, k * q)
        containers += k
        stats["reduced"] += k

    items = _Sizes(histogram)
    left: dict[int, int] = {}
    while items.keys:
        j = items.keys[-1]
        if not reduce:
            left[j] = items.n[j]
            items.take(j, left[j])
            continue
        many = items.n[j]
        room = capacity - j
        items.take(j, 1)  # the others
        few = items.smallest(3)
        k = sum(1 for i in range(len(few)) if sum(few[: i + 1]) <= room)
        chosen: list[int] | None = None
        if k == 0:
            chosen = [j]
        else:
            star = items.largest_to(room)
            if k == 1 or star == room:
                chosen = [j, star]
            elif k == 2:
                pair = items.best_pair(room)
                if pair is None or star >= sum(pair):
                    chosen = [j, star]
                elif star == pair[0]:
                    over = items.above(pair[1], 2)
                    if len(over) < 2 or sum(over) > room:
                        chosen = [j, *pair]
        items.n[j] = items.n.get(j, 0) + 1
        if items.n[j] == 1:
            insort(items.keys, j)
        if chosen is None:
            left[j] = many
            items.take(j, many)
            continue
        need = Counter(chosen)
        times = min(items.n[s] // q for s, q in need.items())
        times = times if at_once else min(times, 1)
        # taking a set away leaves only larger rests than before among the other items, so the rule that chose it holds until one of its
        # sizes is used up
        if not times:
            left[j] = many
            items.take(j, many)
            continue
        fix(chosen, times)

    # best fit: groups of containers with equal residual space, [residual, first container, number]
    space: list[int] = []
    groups: dict[int, list[tuple[int, int]]] = {}

    def offer(r: int, first: int, k: int) -> None:
        if r > 0 and k > 0:
            if r not in groups:
                groups[r] = []
                insort(space, r)
            groups[r].append((first, k))

    for s in sorted(left, reverse=True):
        todo = left[s]
        while todo:
            i = bisect_left(space, s)
            if i < len(space):
                r = space[i]
                first, k = groups[r].pop()
                if not groups[r]:
                    del groups[r]
                    space.pop(i)
            else:
                r, q = capacity, capacity // s
                k, first = -(-todo // q), containers
                containers += k
                stats["best_fit"] += k
            q = r // s
            full = min(k, todo // q)
            if full:
                put(s, full * q, first, q)
                todo -= full * q
                offer(r - q * s, first, full)
            if full < k and todo and todo < q:
                put(s, todo, first + full, todo)
                offer(r - todo * s, first + full, 1)
                todo = 0
                full += 1
            offer(r, first + full, k - full)
    stats["containers"] = containers
    return out, stats


def pack(items: DataFrame, specs: DataFrame, id_col: str = "doc_id", size_col: str = "n_tokens", blocks: int = 32) -> DataFrame:
    """(spec_id, container_id, id, part_no, n_tokens): every item in a container of each capacity.

    ``items``: one row an item with its size; ``specs``: spec_id, capacity. ``part_no`` is 0 for a whole item and 1, 2,
    ... for the parts of one that exceeds the capacity; the parts add up to the item. Containers are numbered from 1.

    Defined cases: an item of size 0, null or below takes no space and lies in the reserved container 0; a repeated row of one id
    counts once; two rows of one id with different sizes count as the larger one; a null id is an id like others; a null
    capacity or one below 1 gives no rows, one above :data:`MAX_CAPACITY` is an error; empty tables give an empty result; other columns are ignored.

    The histogram that reaches the driver has at most ``capacity`` rows a spec (:data:`MAX_CAPACITY`), however large the data. Items are
    ranked within (size, block of the id hash) and blocks are added up, without a window over a whole size.
    """
    spark = items.sparkSession
    from paperloom.tables import materialise

    items = items.groupBy(F.col(id_col).alias("__id")).agg(F.greatest(F.coalesce(F.max(F.col(size_col).cast("long")), F.lit(0)), F.lit(0)).alias("__size"))
    items = materialise(items.withColumn("__block", F.pmod(F.xxhash64("__id"), F.lit(blocks)).cast("int")), "sizes")
    wanted = [(r[0], int(r[1])) for r in specs.select("spec_id", "capacity").distinct().collect() if r[1] is not None and r[1] >= 1]
    if any(c > MAX_CAPACITY for _, c in wanted):
        raise ValueError(f"a capacity exceeds {MAX_CAPACITY}")
    spec_type = specs.schema["spec_id"].dataType
    pair = F.struct(F.lit(None).cast(spec_type).alias("spec_id"), F.lit(None).cast("long").alias("__cap"))
    each_spec = F.array(*[F.struct(F.lit(s).cast(spec_type).alias("spec_id"), F.lit(c).cast("long").alias("__cap")) for s, c in wanted]) if wanted else F.slice(F.array(pair), 1, 0)

    # one row a part; only the rest of an item needs a place
    parts = items.select("*", F.explode(each_spec).alias("__spec")).select("*", "__spec.spec_id", "__spec.__cap").select("spec_id", "__cap", "__id", "__block", "__size", (F.col("__size") % F.col("__cap")).alias("__rest"), F.floor(F.col("__size") / F.col("__cap")).alias("__full"))
    counts = parts.groupBy("spec_id", "__cap", "__rest", "__block").agg(F.count("*").alias("n"), F.sum("__full").alias("full"))
    by_block = Window.partitionBy("spec_id", "__rest").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        "spec_id", "__rest", "__block",
        F.coalesce(F.sum("n").over(by_block), F.lit(0)).alias("__before"),
        F.coalesce(F.sum("full").over(by_block), F.lit(0)).alias("__full_before"),
    )
    rows = counts.groupBy("spec_id", "__cap", "__rest").agg(F.sum("n").alias("n"), F.sum("full").alias("full")).collect()  # at most capacity rows a spec

    histograms: dict[tuple, dict[int, int]] = {}
    fulls: Counter = Counter()
    bases: dict[tuple, int] = {}
    for r in sorted(rows, key=lambda r: (str(r["spec_id"]), r["__rest"])):
        key = (r["spec_id"], r["__cap"])
        h = histograms.setdefault(key, {})
        if r["__rest"]:
            h[r["__rest"]] = r["n"]
        bases[(r["spec_id"], r["__rest"])] = fulls[key]
        fulls[key] += r["full"]
    intervals = [(spec, s, lo, lo + k, first + fulls[(spec, cap)], each) for (spec, cap), h in histograms.items() for s, lo, k, first, each in plan(h, cap)[0]]
    long_ = lambda *names: [T.StructField(n, T.LongType()) for n in names]
    key = T.StructField("spec_id", spec_type)
    steps = spark.createDataFrame(intervals, T.StructType([key, *long_("__rest", "lo", "hi", "first", "each")]))
    steps = steps.withColumn("__run", F.explode(F.sequence(F.floor(F.col("lo") / RUN), F.floor((F.col("hi") - 1) / RUN))))
    base = spark.createDataFrame([(*k, b) for k, b in bases.items()], T.StructType([key, *long_("__rest", "__base")]))

    order = Window.partitionBy("spec_id", "__rest", "__block").orderBy("__id")
    ranked = (
        parts.withColumn("__in_block", F.row_number().over(order) - 1)
        .withColumn("__full_in_block", F.sum("__full").over(order.rowsBetween(Window.unboundedPreceding, -1)))
        .join(before.join(base, ["spec_id", "__rest"]), ["spec_id", "__rest", "__block"])
        .withColumn("__rank", F.col("__in_block") + F.col("__before"))
        .withColumn("__run", F.floor(F.col("__rank") / RUN))
    )
    # an item that fills its containers has no rest and no interval
    on = [ranked[c] == steps[c] for c in ("spec_id", "__rest", "__run")]
    ranked = ranked.join(steps, [*on, ranked["__rank"] >= steps["lo"], ranked["__rank"] < steps["hi"]], "left").drop(steps["spec_id"], steps["__rest"], steps["__run"])
    mine = {n: F.col(n) for n in ("lo", "first", "each")}
    rest_row = F.struct(
        F.when(F.col("__rest") == 0, F.lit(0)).otherwise(mine["first"] + F.floor((F.col("__rank") - mine["lo"]) / mine["each"]) + 1).cast("long").alias("container_id"),
        F.when(F.col("__full") > 0, F.col("__full") + 1).otherwise(F.lit(0)).cast("int").alias("part_no"),
        F.col("__rest").alias("n_tokens"),
    )
    full_from = F.col("__base") + F.col("__full_before") + F.coalesce(F.col("__full_in_block"), F.lit(0))
    full_rows = F.when(
        F.col("__full") > 0,
        F.transform(
            F.sequence(F.lit(1), F.col("__full")),
            lambda i: F.struct((full_from + i).cast("long").alias("container_id"), F.when((F.col("__full") == 1) & (F.col("__rest") == 0), F.lit(0)).otherwise(i).cast("int").alias("part_no"), F.col("__cap").alias("n_tokens")),
        ),
    )
    has_rest = (F.col("__rest") > 0) | (F.col("__full") == 0)
    both = F.concat(F.coalesce(full_rows, F.array().cast("array<struct<container_id:bigint,part_no:int,n_tokens:bigint>>")), F.when(has_rest, F.array(rest_row)).otherwise(F.array().cast("array<struct<container_id:bigint,part_no:int,n_tokens:bigint>>")))
    return ranked.select("spec_id", F.col("__id").alias(id_col), F.explode(both).alias("p")).select("spec_id", "p.container_id", id_col, "p.part_no", "p.n_tokens")
