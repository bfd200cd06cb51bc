"""The seller dimension: overwritten, or with history."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyline.functions.times import date_literal

# A change in one of these opens a new version; a change in the others is a correction that
# overwrites every version. Which is which is a business decision, hence arguments below.
HISTORY_COLUMNS = ("category", "city", "state")
OVERWRITE_COLUMNS = ("seller_name", "gstin", "contact_email")
ATTRIBUTES = ("seller_name", "category", "city", "state", "gstin", "contact_email")

# A seller's first version opens here, so that every order finds one; validity ends are
# exclusive and the running version ends at END_OF_TIME.
BEGINNING = date(1900, 1, 1)
END_OF_TIME = date(9999, 12, 31)


def current_sellers(latest: DataFrame) -> DataFrame:
    """The overwritten dimension: the newest snapshot, without its date."""
    return latest.select("seller_id", *ATTRIBUTES)


def orders_with_current_seller(orders: DataFrame, sellers: DataFrame) -> DataFrame:
    """Each order with its seller's category of today, NULL if the seller is gone.

    No hint: the planner broadcasts the dimension when its size allows and otherwise sorts
    and merges, splitting a seller that holds too many of the orders.
    """
    category = sellers.select(
        F.col("seller_id").alias("dim_seller_id"), F.col("category").alias("seller_category")
    )
    joined = orders.join(category, F.col("seller_id") == F.col("dim_seller_id"), "left")
    return _order_columns(joined)


def _order_columns(joined: DataFrame) -> DataFrame:
    return joined.select(
        "order_id",
        "order_date",
        "seller_id",
        "seller_category",
        "customer_id",
        "sku",
        "amount_paise",
        "status",
    )


def open_history(snapshot: DataFrame) -> DataFrame:
    """The first snapshot as a dimension with history: one open version per seller."""
    return snapshot.select(
        "seller_id",
        *ATTRIBUTES,
        date_literal(BEGINNING).alias("valid_from"),
        date_literal(END_OF_TIME).alias("valid_to"),
        F.lit(True).alias("is_current"),
        F.col("snapshot_date").alias("last_snapshot"),
    )


def apply_snapshot(
    history: DataFrame, snapshot: DataFrame, history_columns: tuple[str, ...] = HISTORY_COLUMNS
) -> DataFrame:
    """Fold a snapshot into the dimension with one full outer join.

    Sellers missing from the snapshot keep their version. ``last_snapshot`` is the newest
    snapshot that named the seller: an older one, late or applied again, changes nothing for it,
    and neither does the same one a second time.
    """
    overwritten = [name for name in ATTRIBUTES if name not in history_columns]
    old, new = history.alias("old"), snapshot.alias("new")
    in_old = F.col("old.seller_id").isNotNull()
    not_older = F.col("new.snapshot_date") >= F.col("old.last_snapshot")
    in_new = F.col("new.seller_id").isNotNull() & F.coalesce(not_older, F.lit(True))
    moved = F.lit(False)
    for name in history_columns:
        moved = moved | ~F.col(f"old.{name}").eqNullSafe(F.col(f"new.{name}"))
    opens = (
        in_old
        & in_new
        & F.col("old.is_current")
        & (F.col("new.snapshot_date") > F.col("old.valid_from"))
        & moved
    )

    def version(attributes: dict[str, Column], start: Column, end: Column, current: Column) -> Column:
        return F.struct(
            F.coalesce("old.seller_id", "new.seller_id").alias("seller_id"),
            *(attributes[name].alias(name) for name in ATTRIBUTES),
            start.alias("valid_from"),
            end.alias("valid_to"),
            current.alias("is_current"),
            F.greatest("old.last_snapshot", "new.snapshot_date").alias("last_snapshot"),
        )

    fresh = {name: F.col(f"new.{name}") for name in ATTRIBUTES}
    kept = {name: F.col(f"old.{name}") for name in ATTRIBUTES}
    for name in overwritten:
        kept[name] = F.when(in_new, fresh[name]).otherwise(kept[name])
    started = F.col("new.snapshot_date")
    unchanged = version(kept, F.col("old.valid_from"), F.col("old.valid_to"), F.col("old.is_current"))
    closed = version(kept, F.col("old.valid_from"), started, F.lit(False))
    opened = version(fresh, started, date_literal(END_OF_TIME), F.lit(True))
    first = version(fresh, date_literal(BEGINNING), date_literal(END_OF_TIME), F.lit(True))
    versions = (
        F.when(~in_old, F.array(first))
        .when(opens, F.array(closed, opened))
        .otherwise(F.array(unchanged))
    )
    joined = old.join(new, F.col("old.seller_id") == F.col("new.seller_id"), "full")
    return joined.select(F.explode(versions).alias("v")).select("v.*")


def history_of(snapshots: DataFrame, history_columns: tuple[str, ...] = HISTORY_COLUMNS) -> DataFrame:
    """The dimension with history over any number of stacked snapshots, in whatever order they came.

    One shuffle by seller: a seller's rows in the order of their dates fall into runs of equal history
    columns, and each run is a version. An export that lies between two others splits the version it
    falls into if it says something else. The remaining columns are those of the last export that names the
    seller. Rows that repeat a seller and date count once, the greatest of them (nulls least); rows
    without a seller or date are left out.
    """
    named = snapshots.where(F.col("seller_id").isNotNull() & F.col("snapshot_date").isNotNull())
    once = named.groupBy("seller_id", "snapshot_date").agg(F.max(F.struct(*ATTRIBUTES)).alias("a")).select("seller_id", "snapshot_date", "a.*")
    dated = Window.partitionBy("seller_id").orderBy("snapshot_date")
    whole = dated.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    opens = F.row_number().over(dated) == 1
    for name in history_columns:
        opens = opens | ~F.col(name).eqNullSafe(F.lag(name).over(dated))
    overwritten = {name: F.last(name).over(whole) for name in ATTRIBUTES if name not in history_columns}
    marked = once.select(
        "seller_id", "snapshot_date", *(overwritten.get(name, F.col(name)).alias(name) for name in ATTRIBUTES),
        opens.alias("opens"), (F.row_number().over(dated) == 1).alias("is_first"), F.max("snapshot_date").over(whole).alias("last_snapshot"),
    )
    following = F.lead("snapshot_date").over(dated)
    return marked.where("opens").select(
        "seller_id",
        *ATTRIBUTES,
        F.when(F.col("is_first"), date_literal(BEGINNING)).otherwise(F.col("snapshot_date")).alias("valid_from"),
        F.coalesce(following, date_literal(END_OF_TIME)).alias("valid_to"),
        following.isNull().alias("is_current"),
        "last_snapshot",
    )


def orders_as_of(orders: DataFrame, history: DataFrame) -> DataFrame:
    """Each order with the category its seller had on the order date.

    An equality on the seller plus a range that is disjoint per seller, so an order meets at
    most one version and the join never multiplies rows.
    """
    versions = history.select(
        F.col("seller_id").alias("dim_seller_id"),
        F.col("category").alias("seller_category"),
        "valid_from",
        "valid_to",
    )
    on_date = (
        (F.col("seller_id") == F.col("dim_seller_id"))
        & (F.col("order_date") >= F.col("valid_from"))
        & (F.col("order_date") < F.col("valid_to"))
    )
    return _order_columns(orders.join(versions, on_date, "left"))


def seller_changes(earlier: DataFrame, later: DataFrame) -> DataFrame:
    """One row per seller and changed attribute, and one per seller that came or went."""
    old, new = earlier.alias("old"), later.alias("new")
    came = F.col("old.seller_id").isNull()
    went = F.col("new.seller_id").isNull()

    def change(kind: str, name: str | None, before: Column, after: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("change"),
            F.lit(name).cast("string").alias("column_name"),
            before.alias("old_value"),
            after.alias("new_value"),
        )

    absent = F.lit(None).cast("string")
    per_column = [
        F.when(
            ~F.col(f"old.{name}").eqNullSafe(F.col(f"new.{name}")),
            change("changed", name, F.col(f"old.{name}"), F.col(f"new.{name}")),
        )
        for name in ATTRIBUTES
    ]
    changes = (
        F.when(came, F.array(change("added", None, absent, absent)))
        .when(went, F.array(change("removed", None, absent, absent)))
        .otherwise(F.array_compact(F.array(*per_column)))
    )
    return old.join(new, F.col("old.seller_id") == F.col("new.seller_id"), "full").select(
        F.coalesce("old.seller_id", "new.seller_id").alias("seller_id"), F.inline(changes)
    )
