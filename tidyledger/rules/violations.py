"""Violations of each rule as (rule_id, record_key, issue_description).

Rules that look at one row of a table are evaluated together: one scan of the table, one lookup per parent
table, and one column per rule holding its message or NULL. Only rows with a message are expanded.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyledger.functions import numbers, wide
from tidyledger.functions.contact import is_valid_email, normalize_email
from tidyledger.functions.geography import standardize_country, standardize_state
from tidyledger.functions.text import message, same_word, strip
from tidyledger.functions.timestamps import is_blank, parse_timestamp
from tidyledger.operators.dedup import key_losers
from tidyledger.operators.lookups import known_keys, lookup, own_exchange
from tidyledger.operators.rows import places_before, repeat_rows
from tidyledger.rules.staging import Staging
from tidyledger.schemas import SOURCE_ROW

# The texts of all messages in this module.

VIOLATION_COLUMNS = ("rule_id", "record_key", "issue_description")


def _expand(df: DataFrame, key: str, issues: Mapping[str, Column]) -> DataFrame:
    """One output row per rule whose message is not NULL.

    Messages are filtered after they are expanded: a filter on them any earlier would be pushed towards the
    scan and evaluate every parsing expression a second time.
    """
    messages = df.select(F.col(key).alias("record_key"), *[m.alias(r) for r, m in issues.items()])
    pairs = F.array(*[F.struct(F.lit(r).alias("rule_id"), F.col(r).alias("issue_description")) for r in issues])
    return (
        messages.select("record_key", F.inline(pairs))
        .filter(F.col("issue_description").isNotNull())
        .select(*VIOLATION_COLUMNS)
    )


def _chosen(issues: Mapping[str, Column], wanted: Collection[str]) -> dict[str, Column]:
    return {rule: text for rule, text in issues.items() if rule in wanted}


def _only(rule_id: str, key: Column, text: Column) -> list[Column]:
    return [F.lit(rule_id).alias("rule_id"), key.alias("record_key"), text.alias("issue_description")]


# --- customers -------------------------------------------------------------------------------------------


def _email_issue() -> Column:
    raw = F.col("email")
    return F.when(
        normalize_email(raw).isNull(), message("customer_id={id}: email is missing.", id="customer_id")
    ).when(
        ~is_valid_email(raw),
        message("customer_id={id}: email '{raw}' failed syntactic validation.", id="customer_id", raw="email"),
    )


def _geography_issue() -> Column:
    # NULL when nothing is wrong, so concat_ws leaves the part out.
    parts = [
        F.when(
            strip(F.col(name)) != F.col(f"standard_{name}"),
            message(name + " '{raw}' standardized to '{std}'", raw=name, std=f"standard_{name}"),
        )
        for name in ("country", "state")
    ]
    detail = F.concat_ws("; ", *parts)
    return F.when(detail != "", F.concat(message("customer_id={id}: ", id="customer_id"), detail, F.lit(".")))


def customer_rows(stg: Staging, wanted: Collection[str]) -> DataFrame:
    """DQ002 and DQ003: both need nothing but the row."""
    typed = stg.customers.withColumns(
        {
            "standard_country": standardize_country(F.col("country")),
            "standard_state": standardize_state(F.col("state")),
        }
    )
    issues = {"DQ002": _email_issue(), "DQ003": _geography_issue()}
    return _expand(typed, "customer_id", _chosen(issues, wanted))


def customer_duplicates(stg: Staging) -> DataFrame:
    """DQ001: every row after the first of its customer_id."""
    losers = key_losers(stg.customers.select("customer_id", "email", SOURCE_ROW), ["customer_id"])
    text = message(
        "Duplicate customer_id={id}; this row (email={email}) was dropped in favour of the canonical first occurrence.",
        id="customer_id",
        email="email",
    )
    return losers.select(
        F.lit("DQ001").alias("rule_id"), F.col("customer_id").alias("record_key"), text.alias("issue_description")
    )


# --- orders ----------------------------------------------------------------------------------------------


def order_duplicates(stg: Staging) -> DataFrame:
    """DQ004 by counting: the message depends on the order_id alone, so no row has to be found again.

    Of an order_id's n rows in g distinct contents, n - g are identical repeats and g - 1 are collisions.
    """
    per_id = stg.order_contents.groupBy("order_id").agg(F.sum("copies").alias("n"), F.count(F.lit(1)).alias("g"))
    identical = message("Duplicate order_id={id}; identical row was dropped (no information lost).", id="order_id")
    collision = message(
        "Duplicate order_id={id}; later occurrence with different attributes was dropped in favour of the "
        "canonical first row.",
        id="order_id",
    )
    kinds = F.array(
        F.struct(identical.alias("issue_description"), (F.col("n") - F.col("g")).alias("times")),
        F.struct(collision.alias("issue_description"), (F.col("g") - 1).alias("times")),
    )
    counted = per_id.filter(F.col("n") > 1).select(F.col("order_id").alias("record_key"), F.inline(kinds))
    rows = repeat_rows(counted, "times")
    return rows.select(F.lit("DQ004").alias("rule_id"), "record_key", "issue_description")


def prices(products: DataFrame) -> DataFrame:
    """One price text per product_id: the first row's, should an id repeat."""
    return lookup(
        products, "product_id", F.min_by("unit_price", SOURCE_ROW).alias("unit_price"), F.lit(True).alias("product_known")
    )


def _unknown_reference(owner: str, key: str, column: str, known: str, table: str) -> Column:
    """Messages of a reference that is NULL or finds nothing; ``known`` is NULL after an unmatched lookup."""
    missing = message(f"{owner}={{id}}: {column} is missing.", id=key)
    unknown = message(f"{owner}={{id}}: {column} '{{ref}}' not found in {table}.", id=key, ref=column)
    return F.when(F.col(column).isNull(), missing).when(F.col(known).isNull(), unknown)


def _quantity_issue() -> Column:
    """A whole number with no room in the rules is a number all the same, and positive unless it has a minus sign."""
    bad = "order_id={id}: completed-order quantity "
    missing = message(bad + "is missing.", id="order_id")
    not_whole = message(bad + "'{raw}' is not a valid integer.", id="order_id", raw="quantity")
    not_positive = message(bad + "{qty} is not positive.", id="order_id", qty="qty")
    negative = F.concat(message(bad, id="order_id"), numbers.digits(F.col("quantity")), F.lit(" is not positive."))
    issue = (
        F.when(F.col("quantity").isNull(), missing)
        .when(F.col("qty") <= 0, not_positive)
        .when(F.col("qty").isNull() & ~F.col("oversized"), not_whole)
        .when(F.col("oversized") & numbers.digits(F.col("quantity")).startswith("-"), negative)
    )
    return F.when(same_word(F.col("order_status"), "completed"), issue)


_TOTAL_TEXT = wide.sql_let(wide.sql_minus("x.total", "x.product"), "d", f"""if({wide.sql_apart('d')}, concat(
  'order_id=', coalesce(x.order_id, '<missing>'), ': order_total=', {numbers.sql_digits('x.order_total')}, ' vs quantity*unit_price=',
  {wide.sql_text('x.product', numbers.sql_decimals('x.unit_price'))}, ' (diff=',
  {wide.sql_text('d', f"greatest({numbers.sql_decimals('x.order_total')}, {numbers.sql_decimals('x.unit_price')})")}, ').'), null)""")


def _total_issue() -> Column:
    """Compared as working decimals where they hold all three numbers; the rest, and what is told, in limbs."""
    total, price, quantity = F.col("order_total"), F.col("unit_price"), F.col("quantity")
    product = wide.times(F.coalesce(F.col("qty"), numbers.large_whole(quantity)), numbers.limbs(price))
    cells = F.struct("order_id", "order_total", "unit_price", numbers.limbs(total).alias("total"), product.alias("product"))
    beyond = numbers.is_beyond(total) | numbers.is_beyond(price) | F.col("oversized")
    told = wide.let(cells, f"x -> if(x.total is null or x.product is null, null, {_TOTAL_TEXT})")
    return F.when(beyond | numbers.disagree(F.col("total"), F.col("calculated")), told)


def order_rows(stg: Staging, wanted: Collection[str]) -> DataFrame:
    """DQ005 to DQ008 over every physical order row, with only the lookups the wanted rules need."""
    df = stg.orders.select("order_id", "customer_id", "product_id", "quantity", "order_status", "order_total")
    if "DQ005" in wanted:
        df = df.join(known_keys(stg.customers, "customer_id", "customer_known"), "customer_id", "left")
    if {"DQ006", "DQ008"} & set(wanted):
        df = df.join(prices(stg.products), "product_id", "left")
    # Parsed once here; the rules refer to each number several times.
    df = df.withColumns(
        {
            "qty": numbers.to_whole(F.col("quantity")),
            "oversized": numbers.is_oversized_whole(F.col("quantity")),
            "total": numbers.to_decimal(F.col("order_total")),
        }
    )
    if "DQ008" in wanted:
        df = df.withColumn("calculated", numbers.times(F.col("qty"), numbers.to_decimal(F.col("unit_price"))))
    issues = {
        "DQ005": _unknown_reference("order_id", "order_id", "customer_id", "customer_known", "customers"),
        "DQ006": _unknown_reference("order_id", "order_id", "product_id", "product_known", "products"),
        "DQ007": _quantity_issue(),
        "DQ008": _total_issue(),
    }
    return _expand(df, "order_id", _chosen(issues, wanted))


# --- payments --------------------------------------------------------------------------------------------


def completed_totals(orders: DataFrame) -> DataFrame:
    """Order rows with ``total``, the limbs of a completed row's total, or NULL."""
    total = F.when(same_word(F.col("order_status"), "completed"), numbers.limbs(F.col("order_total")))
    return orders.withColumn("total", total)


def known_orders(stg: Staging) -> DataFrame:
    """One row per order_id: that it is known, and its lowest and highest completed total with their texts.

    Two totals of fixed size stand for all of them: a payment that agrees with both agrees with every one between.
    """
    text, total = F.col("order_total").alias("text"), F.col("total")
    lowest = F.min(F.when(total.isNotNull(), F.struct(total.alias("total"), text)))
    highest = F.min(F.when(total.isNotNull(), F.struct(wide.negative(total).alias("total"), text)))
    rows = completed_totals(stg.orders.select("order_id", "order_status", "order_total"))
    ends = lookup(rows, "order_id", lowest.alias("low"), highest.alias("high"), F.lit(True).alias("order_known"))
    high = F.struct(wide.negative(F.col("high.total")).alias("total"), F.col("high.text").alias("text"))
    return ends.select("order_id", "order_known", "low", high.alias("high"))


def _difference(payment: str, amount: str, text: str, difference: str) -> str:
    """What DQ010 says of a settled payment and a total of its order, as SQL."""
    places = f"greatest({numbers.sql_decimals(amount)}, {numbers.sql_decimals(text)})"
    return (
        f"concat('payment_id=', coalesce({payment}, '<missing>'), ': settled payment ', {numbers.sql_digits(amount)}, "
        f"' != completed order total ', {numbers.sql_digits(text)}, ' (diff=', {wide.sql_text(difference, places)}, ').')"
    )


#: The total that differs most; the highest, if the lowest differs alike.
_FARTHEST = wide.sql_let(
    f"named_struct('low', {wide.sql_minus('x.low.total', 'x.paid')}, 'high', {wide.sql_minus('x.high.total', 'x.paid')})", "d",
    wide.sql_let(
        f"if({wide.sql_magnitude('d.high')} >= {wide.sql_magnitude('d.low')}, "
        "named_struct('by', d.high, 'text', x.high.text), named_struct('by', d.low, 'text', x.low.text))", "e",
        _difference("x.payment_id", "x.amount", "e.text", "e.by"),
    ),
)


def _payment_issue() -> Column:
    amount, low, high = F.col("amount"), F.col("low"), F.col("high")
    outside = (low["total"] < numbers.limbs(amount, -numbers.TOLERANCE)) | (high["total"] > numbers.limbs(amount, numbers.TOLERANCE))
    cells = F.struct("payment_id", "amount", "low", "high", numbers.limbs(amount).alias("paid"))
    return F.when(same_word(F.col("payment_status"), "settled") & outside, wide.let(cells, f"x -> {_FARTHEST}"))


def payment_rows(stg: Staging, wanted: Collection[str]) -> DataFrame:
    """DQ009 and DQ010 from one left join of payments to orders.

    A settled payment that disagrees with some completed row of its order disagrees with the lowest or the highest total.
    It gives one exception; ``disagreeing_totals`` lists every total.
    """
    orders = known_orders(stg) if "DQ010" in wanted else known_keys(stg.orders, "order_id", "order_known")
    payments = stg.payments.select("payment_id", "order_id", "payment_status", "amount")
    joined = payments.join(orders, "order_id", "left")
    orphan = message(
        "Orphan payment: order_id={order} not found in orders (payment_id={id}).", order="order_id", id="payment_id"
    )
    missing = message("payment_id={id}: payment order_id is missing.", id="payment_id")
    issues = {"DQ009": F.when(F.col("order_id").isNull(), missing).when(F.col("order_known").isNull(), orphan)}
    if "DQ010" in wanted:
        issues["DQ010"] = _payment_issue()
    return _expand(joined, "payment_id", _chosen(issues, wanted))


#: Distinct totals of an order id that one row holds; an id with more has several rows.
TOTALS = 4096


def total_runs(orders: DataFrame, most: int = TOTALS) -> DataFrame:
    """(order_id, totals): the distinct completed totals of every order id, sorted, with the number of rows of each.

    An id of more than ``most`` totals is dealt to several rows by a hash of the total, so a placeholder id that holds a
    third of the table is no single array.
    """
    rows = completed_totals(orders.select("order_id", "order_status", "order_total"))
    kept = rows.filter(F.col("order_id").isNotNull() & F.col("total").isNotNull())
    distinct = kept.groupBy("order_id", "total", F.col("order_total").alias("text")).agg(F.count(F.lit(1)).alias("rows"))
    sizes = distinct.groupBy("order_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most)
    runs = sizes.select("order_id", F.ceil(F.col("n") / most).cast("int").alias("runs"))
    dealt = distinct.join(runs, "order_id", "left").withColumn(
        "run", F.when(F.col("runs").isNotNull(), F.pmod(F.xxhash64("total", "text"), "runs")).otherwise(F.lit(0))
    )
    listed = F.sort_array(F.collect_list(F.struct("total", "text", "rows")))
    return dealt.groupBy("order_id", "run").agg(listed.alias("totals")).select(own_exchange("order_id"), "totals")


def disagreeing_totals(stg: Staging) -> DataFrame:
    """(payment_id, order_id, order_total, issue_description): one row per settled payment and completed order row, identical
    repeats aside, whose amounts differ by more than the tolerance.

    A payment looks up, in each sorted run of its order's totals, where those that agree begin and end, and takes what lies
    outside; totals that agree are never paired with it.
    """
    status = F.col("payment_status")
    paid = stg.payments.select(
        "payment_id", "order_id", "amount", numbers.limbs(F.col("amount")).alias("paid"),
        numbers.limbs(F.col("amount"), -numbers.TOLERANCE).alias("least"), numbers.limbs(F.col("amount"), numbers.TOLERANCE).alias("most"),
    ).filter(same_word(status, "settled") & F.col("paid").isNotNull())
    met = paid.join(total_runs(stg.kept_orders), "order_id")
    first = places_before("totals", lambda t: t["total"] < F.col("least"))
    last = places_before("totals", lambda t: t["total"] <= F.col("most"))
    bounded = met.select("*", first.alias("first"), last.alias("last"))
    size = F.size("totals")
    outside = F.concat(F.slice("totals", F.lit(1), F.col("first")), F.slice("totals", F.col("last") + 1, size - F.col("last")))
    told = wide.sql_let(wide.sql_minus("x.t.total", "x.paid"), "d", _difference("x.payment_id", "x.amount", "x.t.text", "d"))
    pairs = bounded.select("payment_id", "order_id", "amount", "paid", F.explode(outside).alias("t")).select(
        "payment_id", "order_id", F.col("t.text").alias("order_total"), F.col("t.rows").alias("rows"),
        wide.let(F.struct("payment_id", "amount", "paid", "t"), f"x -> {told}").alias("issue_description"),
    )
    return pairs.select(
        "payment_id", "order_id", "order_total", "issue_description", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("copy")
    ).drop("copy")


# --- support tickets -------------------------------------------------------------------------------------


def ticket_rows(stg: Staging, wanted: Collection[str]) -> DataFrame:
    """DQ011 and DQ012."""
    df = stg.support_tickets.select("ticket_id", "customer_id", "created_ts")
    if "DQ012" in wanted:
        df = df.join(known_keys(stg.customers, "customer_id", "customer_known"), "customer_id", "left")
    created = F.col("created_ts")
    issues = {
        "DQ011": F.when(
            is_blank(created), message("ticket_id={id}: created_ts is missing.", id="ticket_id")
        ).when(
            parse_timestamp(created).isNull(),
            message("ticket_id={id}: created_ts failed to parse: '{raw}'.", id="ticket_id", raw="created_ts"),
        ),
        "DQ012": _unknown_reference("ticket_id", "ticket_id", "customer_id", "customer_known", "customers"),
    }
    return _expand(df, "ticket_id", _chosen(issues, wanted))
