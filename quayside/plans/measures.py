"""The metric set: nineteen measures evaluated over the star, and its calculated columns.

``evaluate`` reads the order fact once. A day table says which cells a day
counts for: as current amount, as amount of the previous period, or of the
previous year. Days that count for the same cells in the same roles form one
span; order rows are summed per span first, and only these sums are handed to
the cells of their span. Comparing periods needs no second scan, no self join,
and no copy of an order row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.conditional import blank_to, not_blank_aware, switch_true
from quayside.functions.dates import booked_date, days_between, short_date
from quayside.functions.numbers import growth, growth_label, money
from quayside.operators.bitmaps import counted, member_bitmaps, number_members, rollup_bitmaps
from quayside.operators.calendar import DATE, HIERARCHY, calendar_parts, date_dimension, date_range
from quayside.operators.star import count_related, path_between, require_unique
from quayside.operators.summarise import DEFAULT_SUMMARIES, Agg, pre_aggregate
from quayside.plans.model import RELATIONSHIPS

Tables = Mapping[str, DataFrame]

FACT = "Order"
CUSTOMER = "IndividualCustomer"
DATE_TABLE = "Date"
MONTH = "_BookedMonth"  # first day of the month, by which a materialised fact is cut into folders

# The comparison year is 365 days, and the customer labels.
YEAR_DAYS = 365
REPEAT_LABEL = "Repeat customers"
NEW_LABEL = "New customers"

CUSTOMER_MEASURES = ["_CountRepeatCustomers", "_CountNewCustomers", "_CountCustomersWithOrders"]
CUSTOMER_FLAG_MEASURE = "Multiple Orders"


# ---- calculated columns ------------------------------------------------------


def add_orderbookeddate(orders: DataFrame) -> DataFrame:
    return orders.withColumn("_OrderBookedDate", booked_date("OrderBookedDate"))


def add_hasmultipleorders(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """True for more than one order, false for one, blank for none; over all orders, whatever is filtered."""
    counted = count_related(customers, orders, "CustomerId", "CustomerId", "_orders")
    flag = switch_true([(F.col("_orders") > 1, True), (F.col("_orders") == 1, False)])
    return counted.withColumn("_HasMultipleOrders", flag).drop("_orders")


def add_repeatornewcustomer(customers: DataFrame) -> DataFrame:
    flag = F.col("_HasMultipleOrders")
    return customers.withColumn(
        "_RepeatOrNewCustomer", switch_true([(flag.isNull(), None), (flag, REPEAT_LABEL), (~flag, NEW_LABEL)])
    )


# ---- date context ------------------------------------------------------------


def days_in_range(first: Column | str, last: Column | str) -> Column:
    """Days from first to last, both counted."""
    return days_between(first, last) + 1


def shift_period(days: DataFrame, shift: Column | int, known: DataFrame, out: str = "_day") -> DataFrame:
    """The days ``shift`` days earlier, as far as the calendar knows them."""
    by = F.lit(shift) if isinstance(shift, int) else shift
    moved = days.withColumn(out, F.date_sub(F.col(DATE), by.cast("int")))
    dates = known.select(F.col(DATE).alias("_known"))
    return moved.join(dates, moved[out] == dates["_known"], "left_semi")


def date_range_label(first: Column | str, last: Column | str) -> Column:
    """``M/d/yyyy - M/d/yyyy``, blank when either side is."""
    return F.concat(short_date(first), F.lit(" - "), short_date(last))


def day_roles(
    bounds: DataFrame,
    by: Sequence[str],
    roles: Sequence[str],
    date_from: str | None = None,
    date_to: str | None = None,
) -> DataFrame:
    """Which cell a day counts for, and as what.

    ``bounds`` is the one row (lo, hi) of a calendar, which has no gaps. The
    result has one row per (cell, day, role) with the first and last day of the
    cell: at most three rows per calendar day, so it may be broadcast. The
    length of the previous period is that of each cell.
    """
    first, last = F.col("lo"), F.col("hi")
    if date_from is not None:
        first = F.greatest(first, F.lit(date_from).cast("date"))
    if date_to is not None:
        last = F.least(last, F.lit(date_to).cast("date"))
    names = [_tag(f"{DATE_TABLE}.{c}") for c in by]
    days = bounds.where(first <= last).select(
        "lo", "hi", first.alias("_lo"), last.alias("_hi"), F.explode(F.sequence(first, last)).alias(DATE)
    )
    if by:
        cell = Window.partitionBy(*names)
        days = calendar_parts(days).withColumns({name: F.col(c) for c, name in zip(by, names, strict=True)})
        days = days.withColumns({"_lo": F.min(DATE).over(cell), "_hi": F.max(DATE).over(cell)})
    length = days_in_range("_lo", "_hi")
    day = {
        "cur": F.col(DATE),
        "prev": F.date_sub(F.col(DATE), length),
        "year": F.date_sub(F.col(DATE), F.lit(YEAR_DAYS)),
    }
    used = F.array(*[F.struct(F.lit(r).alias("_role"), day[r].alias("_day")) for r in roles])
    result = days.select(*names, "_lo", "_hi", "lo", "hi", F.explode(used).alias("_use")).select(
        *names, "_lo", "_hi", "lo", "hi", "_use.*"
    )
    # days outside the calendar vanish
    result = result.where(F.col("_day").between(F.col("lo"), F.col("hi"))).drop("lo", "hi")
    if date_from is None and date_to is None:
        # orders without a date belong to the blank cell
        blank = bounds.sparkSession.range(1).select(F.lit("cur").alias("_role"))
        result = result.unionByName(blank, allowMissingColumns=True)
    return result


def day_spans(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``_day``, ``_span``) and (``_span``, the columns of ``cells`` but ``_day``).

    Days with the same uses form a span, named by its first day. Both frames are no longer than ``cells``, whatever the
    facts; month cells with all three roles make about four spans a month. The day that is null is a span of its own.
    """
    uses = [c for c in cells.columns if c != "_day"]
    per_day = cells.groupBy("_day").agg(F.array_sort(F.collect_set(F.struct(*uses))).alias("_uses"))
    first = F.coalesce(F.unix_date(F.min("_day")), F.lit(-(2**31)))
    spans = per_day.groupBy("_uses").agg(first.alias("_span"), F.collect_set("_day").alias("_days"))
    known = F.when(F.size("_days") > 0, F.col("_days")).otherwise(F.array(F.lit(None).cast("date")))
    days = spans.select("_span", F.explode(known).alias("_day"))
    return days, spans.select("_span", F.inline("_uses"))


# ---- star context ------------------------------------------------------------


def _tag(name: str) -> str:
    """Working column name of an attribute: dots would read as nested fields."""
    return name.replace(".", "@")


def _split(name: str) -> tuple[str, str]:
    table, _, column = name.partition(".")
    if not column:
        raise ValueError(f"write attributes as Table.Column, not {name!r}")
    return table, column


def labels(tables: Tables, start: str, goal: str, columns: Sequence[str]) -> tuple[str, DataFrame]:
    """The key column of ``start`` and a frame (``_fk``, columns of ``goal``) to join on it.

    A path that fans out gives several labels per key, each once. Elsewhere a key
    that repeats would count facts twice, so it fails with an error.
    """
    steps = path_between(RELATIONSHIPS, start, goal)
    head, *rest = steps
    frame = tables[head.end_table].withColumn("_fk", F.col(head.end_column))
    for step in rest:
        nxt = tables[step.end_table]
        inner = nxt.select([F.col(c).alias(f"_n_{c}") for c in nxt.columns])
        frame = frame.select("_fk", F.col(step.start_column).alias("_hop")).join(
            inner, F.col("_hop") == F.col(f"_n_{step.end_column}"), "left"
        )
        frame = frame.select("_fk", *[F.col(f"_n_{c}").alias(c) for c in nxt.columns])
    frame = frame.where(F.col("_fk").isNotNull()).select(
        "_fk", *[F.col(c).alias(_tag(f"{goal}.{c}")) for c in columns]
    )
    several = any(s.fans_out for s in steps)
    return head.start_column, frame.distinct() if several else require_unique(frame, "_fk", goal)


def _label(df: DataFrame, tables: Tables, start: str, by: Sequence[str]) -> DataFrame:
    """Add the grouping columns of ``by`` (Table.Column names) to the rows of ``start``."""
    groups: dict[str, list[str]] = {}
    for name in by:
        table, column = _split(name)
        groups.setdefault(table, []).append(column)
    for table, columns in groups.items():
        if table == start:
            df = df.select("*", *[F.col(c).alias(_tag(f"{table}.{c}")) for c in columns])
            continue
        key, side = labels(tables, start, table, columns)
        df = df.join(side, df[key] == side["_fk"], "left").drop("_fk")
    return df


def _among(value: Column, wanted: Sequence[Any]) -> Column:
    filled = [w for w in wanted if w is not None]
    found = F.coalesce(value.isin(filled), F.lit(False)) if filled else F.lit(False)
    return found | value.isNull() if len(filled) < len(wanted) else found


def _restrict(df: DataFrame, tables: Tables, start: str, where: Mapping[str, Any]) -> DataFrame:
    """Keep the rows of ``start`` that filters on related tables reach. A wanted None is the blank member."""
    for name, wanted in where.items():
        table, column = _split(name)
        values = list(wanted) if isinstance(wanted, (list, tuple, set)) else [wanted]
        if table == start:
            df = df.where(_among(F.col(column), values))
            continue
        key, side = labels(tables, start, table, [column])
        hit = _among(F.col(_tag(name)), values)
        if None in values:  # rows without a partner are blank as well
            hits = side.groupBy("_fk").agg(F.max(hit).alias("_hit"))
            df = df.join(hits, df[key] == hits["_fk"], "left").where(F.coalesce("_hit", F.lit(True))).drop("_fk", "_hit")
        else:
            keys = side.where(hit).select("_fk").distinct()
            df = df.join(keys, df[key] == keys["_fk"], "left_semi")
    return df


def _through_orders(name: str) -> bool:
    """Does an attribute reach customers only by way of their orders?"""
    table, _ = _split(name)
    if table in (CUSTOMER,):
        return False
    if table in (FACT, DATE_TABLE):
        return True
    return any(step.end_table == FACT for step in path_between(RELATIONSHIPS, CUSTOMER, table))


# ---- measures ----------------------------------------------------------------


def _role(role: str) -> Column:
    return F.col("_role") == role


def _total(role: str) -> Column:
    return F.sum(F.when(_role(role), F.col("OrderTotalAmount__s"))).cast("double")


def _mean(column: str, role: str) -> Column:
    return Agg("avg", column).merged(column, _role(role))


def _totals() -> dict[str, Agg]:
    """What is summed per span of days. A mean's state holds the sum as well."""
    return {"OrderTotalAmount": Agg("avg", money("OrderTotalAmount")), "NumberOfOrderLines": Agg("avg", "NumberOfOrderLines")}


def _order_measures() -> dict[str, tuple[list[str], Column | None, Column | None]]:
    """name -> (roles read, aggregate, expression over other aggregates)."""
    lines, amount = "NumberOfOrderLines", "OrderTotalAmount"
    c = F.col
    return {
        "_AvgOrderTotalAmount": (["cur"], _mean(amount, "cur"), None),
        "_AvgBasketSize": (["cur"], _mean(lines, "cur"), None),
        "_DateRangeLabel": (["cur"], None, date_range_label("_lo", "_hi")),
        "_OrderTotalAmount": (["cur"], _total("cur"), None),
        "_OrderTotalAmountPrevPeriod": (["cur", "prev"], _total("prev"), None),
        "_DaysInDateRangeFilter": (["cur"], None, days_in_range("_lo", "_hi")),
        "_OrderTotalAmountGrowth": (
            ["cur", "prev"], None, growth(c("_OrderTotalAmount"), c("_OrderTotalAmountPrevPeriod"))
        ),
        "_AvgOrderTotalAmountPrevPeriod": (["cur", "prev"], _mean(amount, "prev"), None),
        "_AvgOrderTotalAmountGrowth": (
            ["cur", "prev"], None, growth(c("_AvgOrderTotalAmount"), c("_AvgOrderTotalAmountPrevPeriod"))
        ),
        "_OrderTotalAmountPrevYear": (["cur", "year"], _total("year"), None),
        "_AvgBasketSizePrevPeriod": (["cur", "prev"], _mean(lines, "prev"), None),
        "_AvgBasketSizeGrowth": (["cur", "prev"], None, growth(c("_AvgBasketSize"), c("_AvgBasketSizePrevPeriod"))),
    }


# Measures that read another column than the amount.
READS = {"_AvgBasketSize": "NumberOfOrderLines", "_AvgBasketSizePrevPeriod": "NumberOfOrderLines"}

# Label measures and the ratio each one shows.
GROWTH_LABELS = {
    "_OrderTotalAmountGrowthLabel": "_OrderTotalAmountGrowth",
    "_AvgOrderTotalAmountGrowthLabel": "_AvgOrderTotalAmountGrowth",
    "_AvgBasketSizeGrowthLabel": "_AvgBasketSizeGrowth",
}

# The aggregates behind each ratio.
GROWTH_INPUTS = {
    "_OrderTotalAmountGrowth": ["_OrderTotalAmount", "_OrderTotalAmountPrevPeriod"],
    "_AvgOrderTotalAmountGrowth": ["_AvgOrderTotalAmount", "_AvgOrderTotalAmountPrevPeriod"],
    "_AvgBasketSizeGrowth": ["_AvgBasketSize", "_AvgBasketSizePrevPeriod"],
}

# Measures shown as 0 where they would be blank.
ZERO_WHEN_BLANK = ["_OrderTotalAmount", *CUSTOMER_MEASURES]


def measure_names() -> list[str]:
    return [*_order_measures(), *GROWTH_LABELS, *CUSTOMER_MEASURES, CUSTOMER_FLAG_MEASURE]


def evaluate(
    tables: Tables,
    measures: Sequence[str],
    by: Sequence[str] = (),
    where: Mapping[str, Any] | None = None,
    date_from: str | None = None,
    date_to: str | None = None,
) -> DataFrame:
    """Measures per cell of ``by`` (``Table.Column`` names, dates as ``Date.Year`` and so on).

    ``where`` filters related tables by value, ``date_from`` and ``date_to``
    select days of the Date table. Cells with no row in any period are left
    out, except that grouping by dates alone shows every selected cell.
    """
    where = dict(where or {})
    unknown = [m for m in measures if m not in measure_names()]
    if unknown:
        raise ValueError(f"unknown measures {unknown}")
    order_side = [m for m in measures if m not in (*CUSTOMER_MEASURES, CUSTOMER_FLAG_MEASURE)]
    frames = []
    context = (by, where, date_from, date_to)
    if order_side:
        frames.append(_evaluate_orders(tables, order_side, *context))
    if CUSTOMER_FLAG_MEASURE in measures:
        frames.append(_evaluate_multiple(tables, *context))
    if any(m in CUSTOMER_MEASURES for m in measures):
        frames.append(_evaluate_customers(tables, *context))
    result = frames[0]
    if len(frames) > 1:
        for other in frames[1:]:
            result = result.unionByName(other, allowMissingColumns=True)
        made = [c for c in result.columns if c not in map(_tag, by)]
        result = result.groupBy(*map(_tag, by)).agg(*[F.max(m).alias(m) for m in made])
    shown = [blank_to(m) if m in ZERO_WHEN_BLANK else F.col(m) for m in measures]
    return result.select(
        *[F.col(_tag(b)).alias(_split(b)[1]) for b in by],
        *[column.alias(name) for column, name in zip(shown, measures, strict=True)],
    )


def _bounds(tables: Tables) -> DataFrame:
    """First and last day of the Date table, which spans the orders unless one is given."""
    if DATE_TABLE in tables:
        return date_range(tables[DATE_TABLE], DATE)
    return date_range(tables[FACT], "OrderBookedDate")


def _in_window(orders: DataFrame, roles: Sequence[str], date_from: str | None, date_to: str | None) -> DataFrame:
    """Orders that selected dates and the periods they are compared with can reach, as a filter the scan can use."""
    if date_from is None or date_to is None:
        return orders
    first, last = (dt.date.fromisoformat(d) for d in (date_from, date_to))
    starts = {"cur": first, "prev": first - ((last - first) + dt.timedelta(days=1)), "year": first - dt.timedelta(days=YEAR_DAYS)}
    start = min(starts[r] for r in roles)
    booked = F.col("OrderBookedDate")
    orders = orders.where((booked >= F.lit(start)) & (booked < F.lit(last + dt.timedelta(days=1))))
    if MONTH in orders.columns:
        orders = orders.where(F.col(MONTH).between(F.lit(start.replace(day=1)), F.lit(last)))
    return orders


def _order_rows(
    tables: Tables,
    by: Sequence[str],
    where: Mapping[str, Any],
    date_from: str | None,
    date_to: str | None,
    roles: Sequence[str] = ("cur",),
    bounds: bool = False,
) -> DataFrame:
    """Order rows in their cells, with ``_role`` and, where dates matter, the bounds of the cell."""
    orders = _restrict(add_orderbookeddate(_in_window(tables[FACT], roles, date_from, date_to)), tables, FACT, where)
    dates = [_split(b)[1] for b in by if _split(b)[0] == DATE_TABLE]
    others = [b for b in by if _split(b)[0] != DATE_TABLE]
    rows = _label(orders, tables, FACT, others)
    bounded = date_from is not None or date_to is not None
    if not (dates or bounded or bounds or list(roles) != ["cur"]):
        return rows.withColumn("_role", F.lit("cur"))
    cells = day_roles(_bounds(tables), dates, roles, date_from, date_to)
    day, known = rows["_OrderBookedDate"], cells["_day"]
    rows = rows.join(cells, day == known if bounded else day.eqNullSafe(known)).drop("_day")
    if not others:
        # cells without orders still show
        empty = cells.where((F.col("_role") == "cur") & F.col("_day").isNotNull()).drop("_day").distinct()
        rows = rows.unionByName(empty, allowMissingColumns=True)
    return rows


def _order_totals(
    tables: Tables,
    by: Sequence[str],
    where: Mapping[str, Any],
    date_from: str | None,
    date_to: str | None,
    roles: Sequence[str],
    bounds: bool,
    columns: Sequence[str],
) -> DataFrame:
    """Sums of order rows per cell, span of days and role: what ``_order_rows`` gives, summed before it is handed out."""
    orders = _restrict(add_orderbookeddate(_in_window(tables[FACT], roles, date_from, date_to)), tables, FACT, where)
    dates = [_split(b)[1] for b in by if _split(b)[0] == DATE_TABLE]
    others = [b for b in by if _split(b)[0] != DATE_TABLE]
    rows = _label(orders, tables, FACT, others)
    totals = {c: agg for c, agg in _totals().items() if c in columns}
    bounded = date_from is not None or date_to is not None
    if not (dates or bounded or bounds or list(roles) != ["cur"]):
        return pre_aggregate(rows, list(map(_tag, others)), totals).withColumn("_role", F.lit("cur"))
    cells = day_roles(_bounds(tables), dates, roles, date_from, date_to)
    days, uses = day_spans(cells)
    day, known = rows["_OrderBookedDate"], days["_day"]
    rows = rows.join(days, day == known if bounded else day.eqNullSafe(known))
    keys = [*map(_tag, others), "_span"]
    summed = (pre_aggregate(rows, keys, totals) if totals else rows.select(*keys).distinct()).join(uses, "_span").drop("_span")
    if not others:
        # cells without orders still show
        empty = cells.where((F.col("_role") == "cur") & F.col("_day").isNotNull()).drop("_day").distinct()
        summed = summed.unionByName(empty, allowMissingColumns=True)
    return summed


def _evaluate_orders(tables: Tables, measures: Sequence[str], by, where, date_from, date_to) -> DataFrame:
    known = _order_measures()
    ratios = [GROWTH_LABELS.get(m, m) for m in measures]
    needed = list(dict.fromkeys(i for m in ratios for i in (*GROWTH_INPUTS.get(m, []), m)))
    roles = [r for r in ("cur", "prev", "year") if any(r in known[m][0] for m in needed)]
    bounds = any(m in ("_DateRangeLabel", "_DaysInDateRangeFilter") for m in needed)
    columns = [c for c in _totals() if any(known[m][1] is not None and READS.get(m, "OrderTotalAmount") == c for m in needed)]
    rows = _order_totals(tables, by, where, date_from, date_to, roles, bounds, columns)
    aggregates = [known[m][1].alias(m) for m in needed if known[m][1] is not None]
    if bounds:
        aggregates += [F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi")]
    cells = rows.groupBy(*map(_tag, by)).agg(*aggregates)
    cells = cells.select("*", *[known[m][2].alias(m) for m in needed if known[m][2] is not None])
    shown = [growth_label(GROWTH_LABELS[m]).alias(m) for m in measures if m in GROWTH_LABELS]
    return cells.select("*", *shown).select(*map(_tag, by), *measures)


def _evaluate_multiple(tables: Tables, by, where, date_from, date_to) -> DataFrame:
    """Does the cell hold orders of more than one customer? It counts customers, not orders."""
    rows = _order_rows(tables, by, where, date_from, date_to).where(F.col("OrderId").isNotNull())
    groups = list(map(_tag, by))
    customers = rows.select(*groups, "CustomerId").distinct().groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"))
    flag = switch_true([(F.col("_n") > 1, True), (F.col("_n") == 1, False)])
    return customers.select(*groups, flag.alias(CUSTOMER_FLAG_MEASURE))


def _evaluate_customers(tables: Tables, by, where, date_from, date_to) -> DataFrame:
    """Distinct customers by their order flag. The flag looks at all orders; the cell may not."""
    customers = tables[CUSTOMER]
    if "_HasMultipleOrders" not in customers.columns:
        customers = add_hasmultipleorders(customers, tables[FACT])
    own_by = [b for b in by if not _through_orders(b)]
    order_by = [b for b in by if _through_orders(b)]
    own_where = {k: v for k, v in where.items() if not _through_orders(k)}
    order_where = {k: v for k, v in where.items() if _through_orders(k)}
    rows = _label(_restrict(customers, tables, CUSTOMER, own_where), tables, CUSTOMER, own_by)
    if order_by or order_where or date_from is not None or date_to is not None:
        seen = (
            _order_rows(tables, order_by, order_where, date_from, date_to)
            .select(*map(_tag, order_by), F.col("CustomerId").alias("_buyer"))
            .distinct()
        )
        rows = rows.join(seen, rows["CustomerId"] == seen["_buyer"])
    groups = list(map(_tag, by))
    flag = F.col("_HasMultipleOrders")
    return (
        rows.select(*groups, "CustomerId", "_HasMultipleOrders")
        .distinct()
        .groupBy(*groups)
        .agg(
            F.count_if(flag).alias("_CountRepeatCustomers"),
            F.count_if(not_blank_aware(flag)).alias("_CountNewCustomers"),
            F.count_if(flag.isNotNull()).alias("_CountCustomersWithOrders"),
        )
    )


def customers_rollup(
    tables: Tables, levels: Sequence[str] = HIERARCHY, where: Mapping[str, Any] | None = None
) -> DataFrame:
    """Customers with orders, repeat and new ones, per Year, Quarter, Month and Day, per each coarser level, and in all.

    One scan of the orders gives a bitmap of customers per day; every other level is or-ed from these. A row's ``level``
    is the number of date columns that are set by grouping. Orders without a date form a group of their own at each
    level; orders whose customer is unknown count for nothing.
    """
    customers = tables[CUSTOMER]
    if "_HasMultipleOrders" not in customers.columns:
        customers = add_hasmultipleorders(customers, tables[FACT])
    flags = customers.where(F.col("_HasMultipleOrders").isNotNull()).select("CustomerId", F.col("_HasMultipleOrders").alias("_flag"))
    known = number_members(flags, "CustomerId").withColumnRenamed("CustomerId", "_id").join(flags, F.col("_id") == F.col("CustomerId"))
    known = known.select("_id", "_number", "_flag")
    orders = _restrict(add_orderbookeddate(tables[FACT]), tables, FACT, dict(where or {}))
    rows = orders.select("CustomerId", F.col("_OrderBookedDate").alias(DATE)).join(known, F.col("CustomerId") == F.col("_id"))
    daily = member_bitmaps(rows, [DATE, "_flag"])
    cells = rollup_bitmaps(calendar_parts(daily), levels, ["_flag"])
    bits = F.col("_bits")
    return cells.groupBy(*levels, F.col("_level").alias("level")).agg(
        counted(F.when(F.col("_flag"), bits)).alias("_CountRepeatCustomers"),
        counted(F.when(~F.col("_flag"), bits)).alias("_CountNewCustomers"),
        counted(bits).alias("_CountCustomersWithOrders"),
    )


# ---- several facts -----------------------------------------------------------


def summaries(tables: Tables, columns: Sequence[str], by: Sequence[str], where: Mapping[str, Any] | None = None) -> DataFrame:
    """Default summaries of columns of several facts (``Table.Column``) by attributes of related tables.

    Each fact is summed at the grain of the foreign keys that lead to the attributes, then labelled, then summed per
    label: a fact row never meets a label. An attribute that no filter path reaches from a fact does not divide it: the
    fact's value is repeated for each of its values, as the model does. A filter that does not reach a fact leaves it
    alone likewise. Rows are the groups of the facts that all attributes reach; at least one must be, else it fails.
    """
    where = dict(where or {})
    tables = _with_dates(tables, [*by, *where])
    wanted: dict[str, list[str]] = {}
    for name in columns:
        table, column = _split(name)
        if column not in DEFAULT_SUMMARIES.get(table, {}):
            raise ValueError(f"{name} has no default summary")
        wanted.setdefault(table, []).append(column)
    reached = {fact: [b for b in by if _reaches(fact, b)] for fact in wanted}
    whole = [fact for fact in wanted if len(reached[fact]) == len(by)]
    if not whole:
        raise ValueError(f"no fact of {sorted(wanted)} is reached by all of {list(by)}")
    frames = {}
    for fact, names in wanted.items():
        aggs = {c: Agg(DEFAULT_SUMMARIES[fact][c], money(c) if tables[fact].schema[c].dataType.typeName() == "double" else c) for c in names}
        rows = _restrict(tables[fact], tables, fact, {k: v for k, v in where.items() if _reaches(fact, k)})
        labelled = _label(_at_key_grain(rows, fact, reached[fact], aggs), tables, fact, reached[fact])
        merged = [agg.merged(c).alias(f"{fact}.{c}") for c, agg in aggs.items()]
        frames[fact] = labelled.groupBy(*map(_tag, reached[fact])).agg(*merged)
    keys = list(map(_tag, by))
    spine = frames[whole[0]].select(*keys)
    for fact in whole[1:]:
        spine = spine.unionByName(frames[fact].select(*keys))
    result = spine.distinct() if len(whole) > 1 else spine
    for fact, frame in frames.items():
        held = [f"{fact}.{c}" for c in wanted[fact]]
        shared = list(map(_tag, reached[fact]))
        # one struct key, so that a blank label is a label; without shared keys the frame is a single row
        side = frame.select(F.struct(F.lit(1).alias("_one"), *shared).alias("_side"), *[F.col(f"`{c}`") for c in held])
        side = side if shared else F.broadcast(side)
        result = result.join(side, F.struct(F.lit(1).alias("_one"), *shared) == F.col("_side"), "left").drop("_side")
    return result.select(*[F.col(k).alias(_split(b)[1]) for k, b in zip(keys, by, strict=True)], *[F.col(f"`{c}`").alias(_split(c)[1]) for c in columns])


def _with_dates(tables: Tables, names: Sequence[str]) -> Tables:
    """The tables with booked days on the orders and, if it is asked for and not given, the Date table they span."""
    if not any(_split(n)[0] == DATE_TABLE for n in names):
        return tables
    orders = add_orderbookeddate(tables[FACT])
    dates = tables[DATE_TABLE] if DATE_TABLE in tables else date_dimension(orders, "OrderBookedDate")
    names = {*tables, *getattr(tables, "makers", {})}
    return {**{n: tables[n] for n in names}, FACT: orders, DATE_TABLE: dates}


def _reaches(fact: str, name: str) -> bool:
    """Does a filter on the attribute reach the fact?"""
    table, _ = _split(name)
    try:
        return table == fact or bool(path_between(RELATIONSHIPS, fact, table))
    except ValueError:
        return False


def _at_key_grain(rows: DataFrame, fact: str, by: Sequence[str], aggs: Mapping[str, Agg]) -> DataFrame:
    """The fact summed per combination of the columns that lead to the attributes."""
    keys = []
    for name in by:
        table, column = _split(name)
        keys.append(column if table == fact else path_between(RELATIONSHIPS, fact, table)[0].start_column)
    return pre_aggregate(rows, list(dict.fromkeys(keys)), aggs)
