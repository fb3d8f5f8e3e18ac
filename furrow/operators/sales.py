"""Sales rules documented outside the source system's code (§2.16):
palletisation, container spaces and spillover, price resolution,
allocation reconciliation, lock-preserving rebuilds, ASN cartons and
all-or-nothing buyer-part resolution.

Palletisation is greedy (fill a pallet to its maximum, top off across pack
dates), but without special quantities the sequence only depends on the
running case count: a fulfilment occupying cases [s, s+q) of its group
lands on pallets floor(s/max) .. floor((s+q-1)/max). Whole groups are shuffled
once, by zone (a scope's range of groups), in which they are counted, laid out
and numbered. In zones too large for one task the running count is a two-level
prefix sum (inside a time bucket, plus the totals of earlier buckets from a
small per-bucket table), so even a group holding a third of all rows is spread
over many tasks; the fan-out is bounded by the pallets a fulfilment spans.
Groups with special quantities (a fresh pallet is
force-closed early) are packed line by line; of a large one each pack date is
a block, and a prefix over the blocks' transitions gives the pallet and the
cases held with which a block starts, so that its blocks are packed in parallel.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from furrow.operators._order import window_order
from furrow import session
from furrow.session import ship_package, written_table


# Cases taken on a fresh pallet that is then closed, by remaining cases.
BALANCED_SPLIT = {84: 60, 78: 60, 72: 54}
# Rows of a group with special quantities above which its pack dates are packed in parallel.
BLOCK_ROWS = 100_000
# Deliveries that are not palletised, container spaces in the order of overflow, pallet prefixes.
LOCAL_DELIVERY = ("Farm", "Local Delivery")
CONTAINER_SPACES = (("cucumber", 18), ("lettuce", 18), ("box_truck", 10))
PALLET_PREFIX = {"cucumber": "CP", "lettuce": "LP", "box_truck": "BP"}


def running_total(df: DataFrame, by, order, value: str, bucket: str, out: str = "cum_before") -> DataFrame:
    """Sum of ``value`` over earlier rows of the same group in ``order``
    (exclusive prefix sum). Rows are windowed per (group, ``bucket``) and
    carried across buckets through a small per-(group, bucket) table, so
    ``bucket`` must not fall along the order. The input is read twice: pass a
    written table if it is costly."""
    keys = list(by)
    w_in = Window.partitionBy(*keys, bucket).orderBy(*window_order(order)).rowsBetween(Window.unboundedPreceding, -1)
    inside = df.withColumn("_in", F.coalesce(F.sum(value).over(w_in), F.lit(0)))
    totals = df.groupBy(*keys, bucket).agg(F.sum(value).alias("_bt"))
    wb = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, bucket, F.coalesce(F.sum("_bt").over(wb), F.lit(0)).alias("_off"))
    same = [inside[k].eqNullSafe(offsets[k]) for k in (*keys, bucket)]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    return inside.join(offsets, cond, "left").select(*[inside[c] for c in df.columns], (F.col("_in") + F.coalesce("_off", F.lit(0))).alias(out))


class Packing:
    """Fills pallets with a group's lines in order: a pallet takes up to
    ``max_cases``; a fresh one opened with exactly a special quantity
    remaining takes its split and is closed."""

    def __init__(self, split=None, pallet: int = 0, held: int = 0):
        self.split, self.pallet, self.held = split or {}, pallet, held

    def take(self, quantity: int, max_cases: int):
        """(pallet, cases) of one line."""
        if max_cases < 1:
            raise ValueError("a pallet takes at least one case")
        left = quantity
        while left > 0:
            if self.held >= max_cases:  # the maximum has fallen
                self.pallet, self.held = self.pallet + 1, 0
            forced = self.held == 0 and left in self.split
            cases = min(self.split[left] if forced else left, max_cases - self.held)
            yield self.pallet, cases
            left, self.held = left - cases, self.held + cases
            if forced or self.held >= max_cases:
                self.pallet, self.held = self.pallet + 1, 0


def transition(lines, most: int, split=None) -> tuple[np.ndarray, np.ndarray]:
    """What a block of lines (quantity, max_cases) does to a pallet that holds 0 .. most - 1 cases when the block starts:
    (pallets opened, cases held) afterwards for each. Blocks compose by look-up: held[held_before]."""
    held, pallets = np.arange(most, dtype=np.int64), np.zeros(most, np.int64)
    sizes = np.array(sorted(split or {}), np.int64)
    taken = np.array([split[x] for x in sizes], np.int64) if split else sizes
    for quantity, max_cases in lines:
        left = np.full(most, quantity, np.int64)
        while (open_ := np.flatnonzero(left > 0)).size:
            h, x = held[open_], left[open_]
            over = h >= max_cases
            pallets[open_] += over
            h = np.where(over, 0, h)
            at = np.minimum(np.searchsorted(sizes, x), max(len(sizes) - 1, 0))
            forced = (h == 0) & (sizes[at] == x) if len(sizes) else np.zeros(len(x), bool)
            cases = np.minimum(np.where(forced, taken[at], x) if len(sizes) else x, max_cases - h)
            h += cases
            full = forced | (h >= max_cases)
            pallets[open_] += full
            held[open_] = np.where(full, 0, h)
            left[open_] = x - cases
    return pallets, held


def palletize(fulfilments: DataFrame, scope, group, pack_date: str, qty: str, max_cases: str, full_cases: str, stackable: str,
              order_tail=(), family: str = "family", number_bucket=None, special: str | None = None, fob: str | None = None,
              customer: str = "customer", first_index=None, block_rows: int = BLOCK_ROWS, number: bool = True,
              labels: bool = False) -> tuple[DataFrame, DataFrame]:
    """Expand fulfilments into pallets. Returns (pallets, allocations).

    Rows whose ``fob`` is a local delivery are left out, and so are rows
    without a maximum of at least one case: they get no pallet and no
    allocation, which ``allocation_reconcile`` reports. Pallets are filled
    to ``max_cases`` walking pack dates oldest first (crossing
    ``full_cases`` does not close a pallet); groups flagged ``special`` use
    the balanced split, those with more than ``block_rows`` rows in a
    block per pack date. A closed pallet is 'Full' when it reaches
    ``full_cases``, else 'Stackable' for groups flagged ``stackable`` and
    'Shareable' otherwise. Shareable pallets are numbered per scope and
    customer ('7_01'), the others per scope and container family ('CP01').
    ``first_index``: column with the first pallet index of the row's group
    (after pallets that are kept). ``number_bucket`` is a range of the groups
    that rises with them: all groups of a scope and range are packed and
    numbered in one task after a single shuffle, unless they have more than
    ``block_rows`` rows. Without ``number`` pallets get no number; with
    ``labels`` each allocation has the label of its pallet. Rows with equal
    order columns must be interchangeable. The input is read more than once."""
    keys = [*scope, *group]
    order = [pack_date, *order_tail]
    f = fulfilments.where((F.col(qty) > 0) & (F.col(max_cases) >= 1))
    if fob is not None:
        f = f.where(~F.coalesce(F.col(fob).isin(*LOCAL_DELIVERY), F.lit(False)))
    f = f.withColumn("_first", F.lit(0).cast("long") if first_index is None else F.coalesce(F.col(first_index), F.lit(0).cast("long")))
    f = f.withColumn("_bucket", F.date_trunc("month", F.col(pack_date)))
    zone = keys
    if number_bucket is not None:
        f, zone = f.withColumn("_zone", number_bucket), [*scope, "_zone"]
    sizes = written_table(f.groupBy(*zone).agg(F.count(F.lit(1)).alias("_rows")), "zones")
    total, most = sizes.agg(F.sum("_rows"), F.max("_rows")).first()
    parts = max(int(f.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(total or 0) // session.ROWS_PER_TASK))
    large = sizes.where(F.col("_rows") > block_rows).select(*zone)
    span = F.sequence(F.call_function("div", F.col("cum_before"), F.col(max_cases)),
                      F.call_function("div", F.col("cum_before") + F.col(qty) - 1, F.col(max_cases)))

    def laid_out(rows: DataFrame, whole: bool) -> DataFrame:
        """Allocations of zones that are whole in a task, or of large ones."""
        none = F.lit(None).cast("long")
        lines = rows if special is None else rows.where(~F.coalesce(F.col(special), F.lit(False)))
        lines = lines.withColumns({"_at": none, "_took": none})
        if not whole:
            lines = running_total(lines, keys, order, qty, "_bucket")
        if special is not None:
            if whole:
                packed = _packed_line_by_line(rows.where(F.col(special)).repartition(parts, *zone), keys, keys, order, qty, max_cases, placed=True)
            else:
                packed = _packed(rows.where(F.col(special)), keys, order, qty, max_cases, block_rows)
            packed = packed.withColumnsRenamed({"pallet_index": "_at", "allocated_quantity": "_took"})
            lines = lines.unionByName(packed, allowMissingColumns=True)
        if whole:
            count = Window.partitionBy(*dict.fromkeys([*zone, *keys])).orderBy(*window_order(order)).rowsBetween(Window.unboundedPreceding, -1)
            counted = F.coalesce(F.sum(F.when(F.col("_at").isNull(), F.col(qty))).over(count), F.lit(0))
            lines = lines.repartition(parts, *zone).withColumn("cum_before", counted)
        at = F.when(F.col("_at").isNull(), span).otherwise(F.array("_at"))
        out = lines.withColumn("pallet_index", F.explode(at))
        lo = F.greatest(F.col("cum_before"), F.col("pallet_index") * F.col(max_cases))
        hi = F.least(F.col("cum_before") + F.col(qty), (F.col("pallet_index") + 1) * F.col(max_cases))
        out = out.withColumn("allocated_quantity", F.coalesce("_took", (hi - lo).cast("long")))
        return out.withColumn("pallet_index", F.col("pallet_index") + F.col("_first")).drop("cum_before", "_at", "_took", "_bucket", "_first")

    def label(cases, full, stack):
        return F.when(cases >= full, "Full").when(stack == 1, "Stackable").otherwise("Shareable")

    def pallets_of(alloc: DataFrame) -> DataFrame:
        pallets = alloc.groupBy(*dict.fromkeys([*zone, *keys]), "pallet_index").agg(
            F.sum("allocated_quantity").alias("cases"), F.max(max_cases).alias("max_cases"), F.max(full_cases).alias("full_cases"),
            F.max(F.col(stackable).cast("int")).alias("_stack"), F.min(family).alias(family))
        return pallets.withColumn("label", label(F.col("cases"), F.col("full_cases"), F.col("_stack"))).drop("_stack")

    def with_label(alloc: DataFrame) -> DataFrame:
        pallet = Window.partitionBy(*dict.fromkeys([*zone, *keys]), "pallet_index")
        return alloc.withColumn("label", label(F.sum("allocated_quantity").over(pallet), F.max(full_cases).over(pallet),
                                               F.max(F.col(stackable).cast("int")).over(pallet)))

    if (most or 0) <= block_rows:
        runs = [laid_out(f, True)]
    else:
        hot = _same(f, large, zone)
        runs = [laid_out(f.join(large, hot, "left_anti"), True), laid_out(f.join(large, hot, "left_semi"), False)]
    pallets = reduce(DataFrame.unionByName, map(pallets_of, runs))
    alloc = reduce(DataFrame.unionByName, map(with_label, runs) if labels else runs).drop("_zone")
    if not number:
        return pallets.drop("_zone"), alloc
    prefix = F.when(F.col("label") == "Shareable", F.concat(F.col(customer).cast("string"), F.lit("_")))
    for name, short in PALLET_PREFIX.items():
        prefix = prefix.when(F.col(family) == name, short)
    pallets = pallets.withColumn("_prefix", prefix.otherwise(PALLET_PREFIX["box_truck"]))
    pallets = _numbered(pallets, [*scope, "_prefix"], [*group, "pallet_index"], None if number_bucket is None else F.col("_zone"), "_num").drop("_zone")
    text = F.lpad(F.col("_num").cast("string"), F.greatest(F.lit(2), F.length(F.col("_num").cast("string"))), F.lit("0"))
    return pallets.withColumn("pallet_number", F.concat("_prefix", text)).drop("_num", "_prefix"), alloc


def _numbered(df: DataFrame, by, order, bucket, out: str) -> DataFrame:
    """Row numbers per ``by``. With ``bucket`` the rows and their numbers inside it are written; the counts of earlier buckets,
    which are few, are added when they are read."""
    if bucket is None:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*by).orderBy(*window_order(order))))
    inside = F.row_number().over(Window.partitionBy(*by, "_b").orderBy(*window_order(order)))
    d = written_table(df.withColumn("_b", bucket).withColumn("_in", inside), "numbered")
    earlier = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = d.groupBy(*by, "_b").agg(F.max("_in").alias("_n"))
    offsets = counts.select(*by, "_b", F.sum("_n").over(earlier).alias("_before")).where(F.col("_before") > 0)
    offsets = written_table(offsets, "earlier")  # its measured size decides whether it is broadcast
    return d.join(offsets, _same(d, offsets, [*by, "_b"]), "left").select(
        *[d[c] for c in df.columns], (F.col("_in") + F.coalesce("_before", F.lit(0))).alias(out))


def _same(left: DataFrame, right: DataFrame, keys):
    return reduce(lambda x, y: x & y, [left[k].eqNullSafe(right[k]) for k in keys])


def _packed(f: DataFrame, keys, order, qty: str, max_cases: str, block_rows: int) -> DataFrame:
    """Allocations of the groups with special quantities."""
    sizes = f.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.max(max_cases).alias("_most"))
    large = written_table(sizes.where(F.col("_rows") > block_rows).select(*keys, "_most"), "large-groups")
    if large.isEmpty():
        return _packed_line_by_line(f, keys, keys, order, qty, max_cases)
    small = f.join(large, _same(f, large, keys), "left_anti")
    small = _packed_line_by_line(small, keys, keys, order, qty, max_cases)
    hot = f.join(large, _same(f, large, keys)).select(f["*"], large["_most"])
    starts = _block_starts(hot, keys, order, qty, max_cases)
    hot = hot.join(starts, _same(hot, starts, [*keys, order[0]])).select(f["*"], starts["_pallet0"], starts["_held0"])
    hot = _packed_line_by_line(hot, [*keys, order[0]], keys, order, qty, max_cases, ("_pallet0", "_held0")).drop("_pallet0", "_held0")
    return small.unionByName(hot)


def _block_starts(hot: DataFrame, keys, order, qty: str, max_cases: str) -> DataFrame:
    """(keys, pack date, _pallet0, _held0): where each block of a group starts. The transitions of the blocks are found
    in parallel; one row per block is then walked in order."""
    ship_package(hot.sparkSession)
    block = [*keys, order[0]]
    names = [*block, qty, max_cases, "_most"]
    cols = hot.select(*dict.fromkeys([*names, *order]))
    places = [cols.columns.index(c) for c in names]
    n_keys, n_block = len(keys), len(block)

    def transitions(batches):
        group, lines, most = None, [], 0

        def row():
            pallets, held = transition(lines, most, BALANCED_SPLIT)
            return [*group, pallets.tolist(), held.tolist()]

        for batch in batches:
            out = []
            for *key, q, m, top in zip(*[batch.column(i).to_pylist() for i in places]):
                if key != group:
                    if lines:
                        out.append(row())
                    group, lines, most = key, [], top
                lines.append((q, m))
            yield pa.RecordBatch.from_pylist([dict(zip(fields, r)) for r in out], schema=arrow)
        if lines:
            yield pa.RecordBatch.from_pylist([dict(zip(fields, row()))], schema=arrow)

    key_fields = [hot.schema[c] for c in block]
    schema = T.StructType([*key_fields, T.StructField("_pallets", T.ArrayType(T.LongType())), T.StructField("_after", T.ArrayType(T.LongType()))])
    arrow, fields = to_arrow_schema(schema), schema.names
    found = written_table(cols.repartition(*block).sortWithinPartitions(*block, *window_order(order)).mapInArrow(transitions, schema), "transitions")

    def walk(batches):
        group, pallet, held = None, 0, 0
        for batch in batches:
            pallets, holds = [], []
            for *key, opened, after in zip(*[batch.column(i).to_pylist() for i in (*range(n_keys), n_block, n_block + 1)]):
                if key != group:
                    group, pallet, held = key, 0, 0
                pallets.append(pallet)
                holds.append(held)
                pallet, held = pallet + opened[held], after[held]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(n_block)], pa.array(pallets, pa.int64()), pa.array(holds, pa.int64())],
                                             names=[*block, "_pallet0", "_held0"])

    out = T.StructType([*key_fields, T.StructField("_pallet0", T.LongType()), T.StructField("_held0", T.LongType())])
    walked = found.repartition(*keys).sortWithinPartitions(*keys, *window_order(order[:1])).mapInArrow(walk, out)
    return written_table(walked, "block-starts")


def _packed_line_by_line(f: DataFrame, block, keys, order, qty: str, max_cases: str, start=None, placed: bool = False) -> DataFrame:
    """Allocations with special quantities: the rows of a partition stream by in block order (a block is a whole group, or
    one of its parts with the state to ``start`` from), and only the open pallet is held. ``placed``: each block is in one
    partition already."""
    ship_package(f.sparkSession)
    names = f.columns
    read = [*block, qty, max_cases, *(start or ())]

    def pack(batches):
        group, state = None, None
        for batch in batches:
            rows, pallets, cases = [], [], []
            columns = [batch.column(names.index(c)).to_pylist() for c in read]
            for i, values in enumerate(zip(*columns)):
                key, (q, most, *at) = values[:len(block)], values[len(block):]
                if state is None or key != group:
                    group, state = key, Packing(BALANCED_SPLIT, *at)
                for pallet, n in state.take(q, most):
                    rows.append(i)
                    pallets.append(pallet)
                    cases.append(n)
            taken = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(pallets, pa.int64()), pa.array(cases, pa.int64())],
                                             names=[*names, "pallet_index", "allocated_quantity"])

    schema = T.StructType([*f.schema.fields, T.StructField("pallet_index", T.LongType()), T.StructField("allocated_quantity", T.LongType())])
    return (f if placed else f.repartition(*block)).sortWithinPartitions(*block, *window_order(order)).mapInArrow(pack, schema)


def stack_spaces(pallets: DataFrame, scope, order, spaces=CONTAINER_SPACES, label: str = "label", family: str = "family",
                 bucket=None) -> DataFrame:
    """Non-Full pallets get a space of their own container family, in sort
    order; ``spaces`` is (container, capacity) in the order of overflow. The
    pallets with the highest numbers beyond a capacity move on to the open
    spaces of the later containers (first family first), whole: one
    pallet_number is one row. No space is given twice: pallets beyond all
    open spaces have no container and no space. With ``bucket`` (not falling
    along ``order``) numbers are computed per (scope, bucket) plus the
    counts of earlier buckets."""
    names = [n for n, _ in spaces]
    nf = pallets.where(F.col(label) != "Full")
    x = _numbered(nf, [*scope, family], order, bucket, "_seq")
    counts = nf.groupBy(*scope).agg(*[F.count(F.when(F.col(family) == n, 1)).alias(f"_n_{n}") for n in names])
    x = x.join(written_table(counts, "occupied"), list(scope))  # a row a scope: the pallets are not shuffled by so few keys
    zero = F.lit(0).cast("long")

    def own(i):
        return F.least(F.col(f"_n_{names[i]}"), F.lit(spaces[i][1]))

    def over(i):
        return F.greatest(F.col(f"_n_{names[i]}") - F.lit(spaces[i][1]), zero)

    def open_(i):
        return F.lit(spaces[i][1]) - own(i)

    at = F.when(F.lit(False), F.struct(F.lit("").alias("container"), zero.alias("space")))
    for i, (name, capacity) in enumerate(spaces):
        here = F.col(family) == name
        at = at.when(here & (F.col("_seq") <= capacity), F.struct(F.lit(name).alias("container"), F.col("_seq").cast("long").alias("space")))
        # place in the queue of all overflow, then along the open spaces of the containers
        queue = F.col("_seq") - capacity
        for j in range(i):
            queue = queue + over(j)
        before = zero
        for j in range(len(spaces)):
            fits = here & (queue > before) & (queue <= before + open_(j)) & (F.lit(j) > i)
            at = at.when(fits, F.struct(F.lit(names[j]).alias("container"), (own(j) + queue - before).cast("long").alias("space")))
            before = before + open_(j)
    out = x.withColumn("_at", at)
    return out.select(*pallets.columns, F.col("_at.space").alias("container_space_number"), F.col("_at.container").alias("container"),
                      F.coalesce(F.col("_at.container") != F.col(family), F.lit(True)).alias("is_spillover"))


def price_resolution(lines: DataFrame, prices: DataFrame, line_keys, product: str, customer: str, group: str, date: str,
                     p_product: str = "product", p_customer: str = "customer_id", p_group: str = "group_id",
                     p_from: str = "effective_from", p_to: str = "effective_to", p_price: str = "price") -> DataFrame:
    """Most specific price valid on the line date: customer, else customer
    group, else the default row; within a tier the latest effective_from (of
    equal ones the greatest price). ``line_keys`` is the natural key of a line;
    lines that repeat it each get the price.

    A line asks in three scopes: (product, customer), (product, group) and
    (product). The different (scope, date) questions meet only the prices of
    their own scope and are answered once each; the answers are written and
    joined back on scope and date, so a product that holds a third of all lines is
    spread over its dates, and no line meets the prices of another customer. The
    lines are read three times: pass a written table if they are costly."""
    p = prices.select(
        F.col(p_product).alias("_p"),
        F.when(F.col(p_customer).isNotNull(), 3).when(F.col(p_group).isNotNull(), 2).otherwise(1).alias("_tier"),
        F.coalesce(F.col(p_customer).cast("string"), F.col(p_group).cast("string"), F.lit("")).alias("_who"),
        F.col(p_from).alias("_f"), F.col(p_to).alias("_t"), F.col(p_price).alias("_price"))
    tiers = {3: ("customer", F.col(customer).cast("string")), 2: ("group", F.col(group).cast("string")), 1: ("default", F.lit(""))}
    scope = {t: F.struct(F.lit(t).alias("_tier"), who.alias("_who")) for t, (_, who) in tiers.items()}
    ask = [F.col(product).alias("_p"), F.col(date).cast("date").alias("_d")]
    # groups with prices are few: only their questions are shuffled
    groups = written_table(p.where(F.col("_tier") == 2).select("_tier", "_who").distinct(), "price-groups")
    grouped = lines.select(*ask, scope[2].alias("_s")).select("_p", "_d", "_s.*").join(groups, ["_tier", "_who"], "left_semi")
    asked = lines.select(*ask, F.explode(F.array(scope[3], scope[1])).alias("_s")).select("_p", "_d", "_s.*").where(F.col("_who").isNotNull())
    asked = asked.unionByName(grouped).distinct()
    in_time = (F.col("_d") >= F.col("_f")) & (F.col("_t").isNull() | (F.col("_d") <= F.col("_t")))
    won = asked.join(p, ["_p", "_tier", "_who"]).where(in_time).groupBy("_p", "_tier", "_who", "_d") \
        .agg(F.max(F.struct("_f", "_price")).alias("_best"))
    won = written_table(won.select("_p", "_tier", "_who", "_d", "_best._price"), "prices")
    out = lines.withColumns({"_price": F.lit(None).cast(won.schema["_price"].dataType), "_by": F.lit(None).cast("int")})
    for t, (_, who) in tiers.items():
        w = won.where(F.col("_tier") == t).select("_p", "_who", "_d", F.col("_price").alias("_offer"), F.lit(t).alias("_hit"))
        out = out.join(w, (out[product] == w["_p"]) & (who == w["_who"]) & (out[date].cast("date") == w["_d"]), "left").select(
            *[out[c] for c in lines.columns], F.when(F.col("_by").isNull(), F.col("_offer")).otherwise(F.col("_price")).alias("_price"),
            F.coalesce("_by", "_hit").alias("_by"))
    name = F.lit(None).cast("string")
    for t in sorted(tiers):
        name = F.when(F.col("_by") == t, F.lit(tiers[t][0])).otherwise(name)
    return out.select(*[out[c] for c in lines.columns], F.col("_price").alias("price_per_case"), name.alias("price_tier"))


def allocation_reconcile(alloc: DataFrame, fulfilments: DataFrame, key, allocated: str, fulfilled: str) -> DataFrame:
    """Per fulfilment: allocated sum vs fulfilled quantity -> ok / mismatch."""
    a = alloc.groupBy(*key).agg(F.sum(allocated).alias("allocated"))
    j = fulfilments.select(*key, F.col(fulfilled).alias("fulfilled")).join(a, list(key), "left")
    return j.withColumn("allocated", F.coalesce("allocated", F.lit(0))).withColumn(
        "status", F.when(F.col("allocated") == F.col("fulfilled"), "ok").otherwise("mismatch"))


def lock_preserving_refresh(old_pallets: DataFrame, old_alloc: DataFrame, fulfilments: DataFrame, lock: str, pallet_keys, line_keys,
                            qty: str, rebuild) -> DataFrame:
    """Pallets after a rebuild: locked ones stay with what they hold; the
    cases of each fulfilment that no locked pallet holds are palletised
    anew by ``rebuild(rest)``, where ``rest`` has ``_first`` (the index after
    the group's last locked pallet). Allocations may have ``lock`` themselves;
    else it is looked up."""
    group = list(pallet_keys[:-1])
    locked = old_pallets.where(F.col(lock))
    kept = old_alloc.where(F.col(lock)) if lock in old_alloc.columns else old_alloc.join(locked.select(*pallet_keys), list(pallet_keys), "left_semi")
    held = kept.groupBy(*line_keys).agg(F.sum("allocated_quantity").alias("_held"))
    after = locked.groupBy(*group).agg((F.max(pallet_keys[-1]) + 1).alias("_first"))
    rest = fulfilments.join(held, list(line_keys), "left").withColumn(qty, F.col(qty) - F.coalesce("_held", F.lit(0))).drop("_held")
    fresh = rebuild(rest.join(after, group, "left"))
    return locked.unionByName(fresh.withColumn(lock, F.lit(False)).select(*locked.columns))


def asn_cartons(alloc: DataFrame, keys, cases: str, per_carton: int, lot: str) -> DataFrame:
    """One row per carton of an allocation (ceil(cases / per_carton)), each
    carrying the allocation's lot; carton numbers are 1..n per allocation."""
    n = F.ceil(F.col(cases) / F.lit(per_carton)).cast("int")
    return alloc.where(F.col(cases) > 0).select(*keys, lot, F.explode(F.sequence(F.lit(1), n)).alias("carton_number"))


def buyer_part_resolution(lines: DataFrame, parts_map: DataFrame, order_key: str, buyer_part: str, map_key: str, product: str):
    """All-or-nothing order parse: map buyer part numbers; an order with
    any unmapped line is rejected whole. Returns (accepted, rejected)."""
    m = parts_map.groupBy(F.col(map_key).alias(buyer_part)).agg(F.min(product).alias("_product"))
    j = lines.join(m, buyer_part, "left")
    bad = j.groupBy(order_key).agg(F.max(F.col("_product").isNull().cast("int")).alias("_bad"))
    j = j.join(bad, order_key, "left")
    accepted = j.where(F.col("_bad") == 0).withColumnRenamed("_product", product).drop("_bad")
    rejected = j.where(F.col("_bad") == 1).select(order_key).distinct().withColumn("reason", F.lit("unmapped buyer part"))
    return accepted, rejected
