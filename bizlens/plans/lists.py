"""Jobs over delimited id lists held in text columns (recipes, exclusions,
extras): standard ingredients, most common extra / exclusion, item labels,
ingredient lists and totals, menu extension.

The menu (products, recipes, toppings) is what a kitchen has: each of its tables
is one row, a map from id to name or recipe, that a job looks up. A short label is
said from an item's own lists, and the items are neither shuffled nor read twice.
What takes a whole recipe is worked out once per distinct (product, exclusions,
extras) and joined back, or weighted by the number of items. No cross product is
built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizlens.functions.text import id_list
from bizlens.operators.ranking import keep_rank_one
from bizlens.sources.dimensions import literal_table

COMBINATION = ["pizza_id", "exclusions", "extras"]


def _ids(c: str | Column) -> Column:
    return F.coalesce(F.array_distinct(id_list(c)), F.array().cast("array<int>"))


def _by_id(menu: DataFrame, key: str, value: str) -> Column:
    """A table of the menu as one map, a scalar subquery (as a column of its own before it is used in a
    function of arrays); of a repeated id the first value."""
    entries = F.collect_list(F.struct(F.col(key).cast("int").alias("k"), F.col(value).alias("v")))
    known = menu.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias(value))
    return F.coalesce(known.agg(F.map_from_entries(entries)).scalar(), F.create_map().cast("map<int,string>"))


def _name(names: Column, key: Column) -> Column:
    return F.try_element_at(names, key.cast("int"))


def _named(ids: Column) -> Column:
    """The names of the ids by the column ``_known``, those without one left out."""
    return F.filter(F.transform(ids, lambda i: _name(F.col("_known"), i)), lambda n: n.isNotNull())


def _text(names: Column) -> Column:
    """NULL if there are none."""
    return F.when(F.size(names) > 0, F.array_join(names, ", "))


def standard_ingredients(recipes: DataFrame, names: DataFrame, toppings: DataFrame,
                         orders: DataFrame | None = None) -> DataFrame:
    """Recipe of each product, names ordered by topping id.

    With ``orders`` the recipes are limited to products that were ordered.
    """
    r = recipes
    if orders is not None:
        r = r.filter(F.array_contains(orders.agg(F.collect_set("pizza_id")).scalar(), F.col("pizza_id")))
    listed = _text(_named(F.sort_array(id_list("toppings"))))
    out = r.withColumn("_known", _by_id(toppings, "topping_id", "topping_name")).select(_name(_by_id(names, "pizza_id", "pizza_name"), F.col("pizza_id")).alias("pizza_name"),
                   listed.alias("ingredients"))
    return out.filter("pizza_name IS NOT NULL AND ingredients IS NOT NULL")


def top_listed(orders: DataFrame, toppings: DataFrame, column: str, out: str) -> DataFrame:
    """Most frequent id of a list column (ties kept): counts per id first
    (partial aggregation), names attached to the handful of counts after."""
    ids = orders.filter(F.col(column).isNotNull()).select(F.explode(id_list(column)).alias("topping_id"))
    counts = ids.groupBy("topping_id").agg(F.count(F.lit(1)).alias("_n"))
    named = counts.join(toppings, "topping_id").groupBy(F.col("topping_name").alias(out)).agg(
        F.sum("_n").cast("bigint").alias("number_of_pizzas"))
    return keep_rank_one(named, "number_of_pizzas")


def top_extra(orders: DataFrame, toppings: DataFrame) -> DataFrame:
    return top_listed(orders, toppings, "extras", "extra_toppings")


def top_exclusion(orders: DataFrame, toppings: DataFrame) -> DataFrame:
    return top_listed(orders, toppings, "exclusions", "exclusion_toppings")


def _combinations(orders: DataFrame) -> DataFrame:
    """The distinct (product, exclusions, extras) with the number of items."""
    return orders.groupBy(*COMBINATION).agg(F.count(F.lit(1)).alias("_items"))


def _listed(combos: DataFrame, lists: dict[str, Column], mark: bool = False) -> DataFrame:
    """One row per combination and id: (combination, topping_id, one flag per
    list that says whether it holds the id); with ``mark`` every combination
    also has a row with a NULL id."""
    rows = combos.select("*", *[e.alias(f"_{n}") for n, e in lists.items()])
    every = F.array_distinct(F.concat(*[F.col(f"_{n}") for n in lists]))
    if mark:
        every = F.concat(every, F.array(F.lit(None).cast("int")))
    rows = rows.select("*", F.explode(every).alias("topping_id"))
    flags = [F.array_contains(f"_{n}", F.col("topping_id")).alias(n) for n in lists]
    return rows.select(*combos.columns, "topping_id", *flags)


def order_item_label(orders: DataFrame, names: DataFrame, toppings: DataFrame) -> DataFrame:
    """``<name> - Exclude a, b - Extra c, d`` per item; NULL parts are skipped,
    so a plain item keeps its trailing blank, as written."""

    def part(mark: str, column: str) -> Column:
        return F.concat(F.lit(mark), _text(_named(F.sort_array(_ids(column)))))

    label = F.concat_ws("", _name(_by_id(names, "pizza_id", "pizza_name"), F.col("pizza_id")), F.lit(" "),
                        part("- Exclude ", "exclusions"), part(" - Extra ", "extras"))
    return orders.withColumn("_known", _by_id(toppings, "topping_id", "topping_name")).select(
        "order_id", "line_number", label.alias("pizza_with_toppings"))


def _attached(orders: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """``column`` of the combination's row joined to every item (NULL matches NULL)."""
    right = labels.select(*[F.col(c).alias(f"_{c}") for c in COMBINATION], column)
    same = [orders[c].eqNullSafe(F.col(f"_{c}")) for c in COMBINATION]
    return orders.join(right, same[0] & same[1] & same[2]).select("order_id", "line_number", column)


def order_ingredient_list(orders: DataFrame, names: DataFrame, recipes: DataFrame,
                          toppings: DataFrame) -> DataFrame:
    """``<name>: a, 2xb, ...`` per item, labels sorted as strings.

    ``2x`` marks a topping that is in the recipe (not excluded) *and* an
    extra; an excluded topping that is also an extra appears once, unmarked.
    Items left with no topping have no row.
    """
    combos = _combinations(orders).drop("_items").join(recipes, "pizza_id").join(names, "pizza_id")
    kept = F.array_except(_ids("toppings"), _ids("exclusions"))
    listed = _listed(combos, {"kept": kept, "extra": _ids("extras")}).join(toppings, "topping_id")
    label = F.when(F.col("kept") & F.col("extra"), F.concat(F.lit("2x"), F.col("topping_name"))).otherwise(
        F.col("topping_name"))
    text = F.array_join(F.sort_array(F.collect_list(label)), ", ")
    out = listed.groupBy(*COMBINATION, "pizza_name").agg(text.alias("_l")).select(
        *COMBINATION, F.concat(F.col("pizza_name"), F.lit(": "), F.col("_l")).alias("ingredient_list"))
    return _attached(orders, out, "ingredient_list")


def ingredient_totals(orders: DataFrame, deliveries: DataFrame, recipes: DataFrame,
                      toppings: DataFrame) -> DataFrame:
    """Toppings used over delivered items: recipe (minus exclusions) + extras.

    Every topping has a row (none if nothing was delivered); one that no
    delivered item has in its recipe or exclusions totals NULL, as written.
    """
    done = deliveries.filter(F.col("pickup_time").isNotNull() & F.col("distance").isNotNull()
                             & F.col("duration").isNotNull()).select("order_id")
    combos = _combinations(orders.join(done, "order_id", "left_semi")).withColumn(
        "toppings", _name(_by_id(recipes, "pizza_id", "toppings"), F.col("pizza_id"))).filter("toppings IS NOT NULL")
    lists = {"recipe": _ids("toppings"), "excluded": _ids("exclusions"), "extra": _ids("extras")}
    listed = _listed(combos, lists, mark=True)
    known = F.col("recipe") | F.col("excluded")
    used = F.when(F.col("recipe") & ~F.col("excluded"), F.col("_items")).otherwise(0)
    per = listed.groupBy("topping_id").agg(
        F.sum(F.when(known, used)).alias("kept"), F.sum(F.when(F.col("extra"), F.col("_items"))).alias("extra"))
    # a row per topping, and one without id that says that something was delivered
    totals = per.agg(F.count(F.lit(1)).alias("n"), F.map_from_entries(F.collect_list(F.when(
        F.col("topping_id").isNotNull(), F.struct("topping_id", F.struct("kept", "extra"))))).alias("by_id"))
    # a generator keeps the subquery in one place
    rows = toppings.select("*", F.explode(F.array(totals.select(F.struct("n", "by_id")).scalar())).alias("t")).filter(
        "t.n > 0 AND topping_name IS NOT NULL")
    own = F.try_element_at(F.col("t.by_id"), F.col("topping_id").cast("int"))
    per_name = rows.select("topping_name", own.alias("own")).groupBy("topping_name").agg(
        F.sum("own.kept").alias("kept"), F.sum("own.extra").alias("extra"))
    return per_name.select("topping_name", (F.col("kept") + F.coalesce("extra", F.lit(0))).cast("bigint").alias("total_ingredients"))


def extend_menu(names: DataFrame, recipes: DataFrame, orders: DataFrame, new_id: int, new_name: str) -> DataFrame:
    """Add a product whose recipe is every topping used by any ordered item
    (recipe, extra or exclusion), appended to both dimensions, then
    names LEFT JOIN recipes. The new recipe is one text: a set of ids, gathered
    per task first, no larger than the menu's toppings."""
    combos = orders.select(*COMBINATION).distinct().withColumn(
        "toppings", _name(_by_id(recipes, "pizza_id", "toppings"), F.col("pizza_id"))).filter("toppings IS NOT NULL")
    used = combos.select(F.explode(F.array_union(F.array_union(_ids("toppings"), _ids("extras")), _ids("exclusions"))).alias("t"))
    recipe = used.agg(F.array_join(F.sort_array(F.collect_set("t")), ", ").alias("toppings")).select(
        F.lit(new_id).cast("int").alias("pizza_id"), "toppings")
    added = literal_table(names.sparkSession, [(new_id, new_name)], [("pizza_id", "INT"), ("pizza_name", "STRING")])
    new_names = names.unionByName(added)
    new_recipes = recipes.unionByName(recipe)
    return new_names.join(new_recipes, "pizza_id", "left").select("pizza_id", "pizza_name", "toppings")
