"""Which table is made from which: the dependency graph of the warehouse, as DataFrame plans."""

from collections.abc import Callable, Collection, Iterator, Mapping

from pyspark.sql import DataFrame

from retailoom.operators import derive, dims, facts, quality, reports, rollups, sales, states, summaries


# raw tables with a day of their own: the calendar covers them all
RAW_DAY = {
    "ods_orders": "order_time",
    "ods_promotion": "date",
    "ods_traffic": "date",
    "ods_inventory": "date",
    "ods_product_traffic": "date",
}

DIMENSIONS: dict[str, Callable[["Star"], DataFrame]] = {
    "dim_date": lambda s: dims.dim_date_over([(s[name], day) for name, day in RAW_DAY.items()]),
    "dim_user": lambda s: dims.dim_user(s["ods_users"], s.earlier("dim_user")),
    "dim_product": lambda s: dims.dim_product(s["ods_products"], s.earlier("dim_product")),
    "dim_store": lambda s: dims.dim_store(s["ods_stores"], s.earlier("dim_store")),
}

# dimensions with a key that is numbered here, and the raw tables they are made from
DIMENSION_SOURCE = {"dim_user": "ods_users", "dim_product": "ods_products", "dim_store": "ods_stores"}

FACTS: dict[str, Callable[["Star"], DataFrame]] = {
    "fact_order": lambda s: facts.fact_order(s["ods_orders"], s["dim_user"], s["dim_store"]),
    "fact_order_detail": lambda s: facts.fact_order_detail(
        s["ods_order_details"], s["fact_order"], s["dim_product"], products_first=True
    ),
    "fact_promotion": lambda s: facts.fact_promotion(s["ods_promotion"], s["dim_store"], s["dim_product"]),
    "fact_traffic": lambda s: facts.fact_traffic(s["ods_traffic"], s["dim_store"]),
    "fact_inventory": lambda s: facts.fact_inventory(s["ods_inventory"], s["dim_product"], s["dim_store"]),
    "sales": lambda s: sales.completed_sales(s["fact_order_detail"]),
}

# facts of a few days: the orders cut the lines first
SOME_DAYS: dict[str, Callable[["Star"], DataFrame]] = {
    "fact_order_detail": lambda s: facts.fact_order_detail(s["ods_order_details"], s["fact_order"], s["dim_product"]),
}

# tables with a date_key, made date by date
DAILY: dict[str, Callable[["Star"], DataFrame]] = {
    "trade_order_1d": lambda s: rollups.trade_order_1d(s["fact_order"]),
    "trade_product_1d": lambda s: rollups.trade_product_1d(s["sales"]),
    "store_daily": lambda s: rollups.store_daily(s["fact_order"]),
    "promotion_daily": lambda s: rollups.promotion_daily(s["fact_promotion"]),
    "traffic_daily": lambda s: rollups.traffic_daily(s["fact_traffic"], s["fact_order"]),
    "sales_daily": lambda s: summaries.sales_daily(s["fact_order"]),
    "product_daily": lambda s: summaries.product_daily(s["sales"]),
    "category_daily": lambda s: summaries.category_daily(s["sales"], s["dim_product"]),
    "user_daily": lambda s: summaries.user_daily(s["fact_order"]),
    "sales_summary": lambda s: summaries.sales_summary(s["fact_order_detail"], s["dim_store"], s["dim_product"]),
    "promotion_summary": lambda s: summaries.promotion_summary(s["fact_promotion"], s["sales"], s["dim_product"]),
    "traffic_summary": lambda s: summaries.traffic_summary(s["fact_traffic"], s["fact_order"], s["dim_store"]),
}

# orders that wait for their user or store; a refresh takes up their days when a dimension gains keys
LATE: dict[str, Callable[["Star"], DataFrame]] = {
    "order_orphans": lambda s: facts.order_orphans(s["ods_orders"], s["dim_user"], s["dim_store"]),
}

# daily states that totals are merged from
STATES: dict[str, Callable[["Star"], DataFrame]] = {
    "order_state_1d": lambda s: states.order_state_1d(s["fact_order"]),
    "user_bitmap_1d": lambda s: states.user_bitmap_1d(s["fact_order"]),
    "user_state_1d": lambda s: states.user_state_1d(s["fact_order"]),
    "category_state_1d": lambda s: states.category_state_1d(s["sales"], s["dim_product"]),
}

TOTALS: dict[str, Callable[["Star"], DataFrame]] = {
    "dim_category": lambda s: dims.dim_category(s["dim_product"]),
    "store_total": lambda s: rollups.store_total(s["fact_order"], s["dim_store"]),
    "product_total": lambda s: rollups.product_total(s["sales"], s["dim_product"]),
    "category_total": lambda s: rollups.category_total(s["sales"], s["dim_product"]),
    "user_total": lambda s: rollups.user_total(s["fact_order"], s["dim_user"]),
    "sales_monthly": lambda s: summaries.sales_monthly(s["fact_order"]),
    "promotion_product": lambda s: summaries.promotion_product(s["fact_promotion"], s["sales"]),
    "inventory_summary": lambda s: summaries.inventory_summary(s["ods_inventory"], s["ods_products"]),
}

# totals as a refresh of dates makes them: the same rows, without reading facts of other dates
MERGED: dict[str, Callable[["Star"], DataFrame]] = {
    "store_total": lambda s: states.store_total(s["order_state_1d"], s["user_bitmap_1d"], s["dim_store"]),
    "product_total": lambda s: states.product_total(s["trade_product_1d"], s["dim_product"]),
    "category_total": lambda s: states.category_total(s["category_state_1d"]),
    "user_total": lambda s: states.user_total(s["user_state_1d"], s["dim_user"]),
    "sales_monthly": lambda s: states.sales_monthly(s["order_state_1d"], s["user_bitmap_1d"]),
}

REPORTS: dict[str, Callable[["Star"], DataFrame]] = {
    "daily_report": lambda s: reports.daily_report(s["sales"], s["fact_promotion"], s["dim_store"], s["dim_product"]),
    "platform_summary": lambda s: reports.platform_summary(s["daily_report"]),
    "store_ranking": lambda s: reports.store_ranking(s["daily_report"]),
    "traffic_report": lambda s: reports.traffic_report(
        s["paid_traffic_by_channel"], s["natural_traffic_by_channel"], s["spu_sales"]
    ),
    "monthly_trend": lambda s: summaries.monthly_trend(s["sales_monthly"]),
    "platform_report": lambda s: summaries.platform_report(s["fact_order"]),
    "top_products": lambda s: summaries.top_products(s["product_total"]),
    "category_analysis": lambda s: summaries.category_analysis(s["sales"], s["dim_product"]),
    "user_level_analysis": lambda s: summaries.user_level_analysis(s["user_total"]),
    "store_leaderboard": lambda s: summaries.store_leaderboard(s["store_total"]),
}

# parts of the reports, and frames that are looked at but not stored
PARTS: dict[str, Callable[["Star"], DataFrame]] = {
    "promo_cost_by_sku": lambda s: reports.promo_cost_by_sku(s["fact_promotion"]),
    "daily_report_sales": lambda s: reports.daily_report_sales(s["daily_report"]),
    "daily_report_promo_only": lambda s: reports.daily_report_promo_only(s["daily_report"]),
    "paid_traffic_by_channel": lambda s: reports.paid_traffic_by_channel(
        s["fact_promotion"], s["dim_store"], s["dim_product"]
    ),
    "natural_traffic_by_channel": lambda s: reports.natural_traffic_by_channel(
        s["ods_product_traffic"], s["dim_store"], s["dim_product"]
    ),
    "spu_sales": lambda s: reports.spu_sales(s["sales"], s["dim_store"], s["dim_product"]),
    "order_wide": lambda s: summaries.order_wide(
        s["ods_orders"], s["ods_order_details"], s["ods_users"], s["ods_stores"], s["ods_products"]
    ),
    "detail_wide": lambda s: summaries.detail_wide(s["ods_order_details"], s["ods_products"]),
}

DERIVED: dict[str, Callable[["Star"], DataFrame]] = {
    "split_paid": lambda s: derive.split_paid(s["traffic_log"]),
    "split_natural": lambda s: derive.split_natural(s["traffic_log"]),
    "store_traffic_rollup": lambda s: derive.store_traffic_rollup(s["traffic_log"]),
    "sku_store_daily_clicks": lambda s: derive.sku_store_daily_clicks(s["traffic_log"]),
    "initial_inventory": lambda s: derive.initial_inventory(s["ods_products"], s["ods_users"]),
    "product_stats": lambda s: derive.product_stats(s["ods_products"]),
    "order_line_rollup": lambda s: derive.order_line_rollup(
        s["ods_order_details"], s["ods_orders"], s["ods_products"]
    ),
}

PLANS = DIMENSIONS | FACTS | DAILY | TOTALS | REPORTS | PARTS | DERIVED


class Star(Mapping[str, DataFrame]):
    """Tables of the warehouse by name, built from the raw tables when first asked for.

    ``settle(name, plan)`` may store a table and return it as stored; without it everything is one lazy
    plan. ``given`` are tables to use as they are. ``earlier`` are dimensions of the run before, whose
    keys are kept. ``plans`` are other ways to make tables than those of this module.
    """

    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        settle: Callable[[str, DataFrame], DataFrame] | None = None,
        given: Mapping[str, DataFrame] | None = None,
        earlier: Mapping[str, DataFrame] | None = None,
        plans: Mapping[str, Callable[["Star"], DataFrame]] | None = None,
    ):
        self.raw = raw
        self._plans = PLANS | LATE | STATES | dict(plans or {})
        self._settle = settle or (lambda name, plan: plan)
        self._given = given or {}
        self._done: dict[str, DataFrame] = {}
        self._earlier = earlier or {}

    def plan(self, name: str) -> DataFrame:
        """How the table is computed from the tables before it."""
        return self._plans[name](self)

    def earlier(self, name: str) -> DataFrame | None:
        return self._earlier.get(name)

    def __getitem__(self, name: str) -> DataFrame:
        if name in self.raw:
            return self.raw[name]
        if name in self._given:
            return self._given[name]
        if name not in self._done:
            self._done[name] = self._settle(name, self.plan(name))
        return self._done[name]

    def passing_on(self, names: Collection[str]) -> "Star":
        """These tables, of which ``names`` are not stored but passed on as plans to what is made from them.

        What this star has made already is taken as it is, and so are tables that are made from none of ``names``.
        """
        return _Passing(self, names)

    def __iter__(self) -> Iterator[str]:
        return iter(PLANS)

    def __len__(self) -> int:
        return len(PLANS)

    def metrics(self, files: Mapping[str, DataFrame] | None = None) -> DataFrame:
        """Metrics of all layers; ``files`` are the raw frames as read from CSV, if that layer is to be there."""
        layers = [
            quality.raw_metrics("ODS", self["ods_orders"], self["ods_promotion"], self["ods_order_details"]),
            quality.dwd_metrics(self["fact_order"], self["fact_order_detail"], self["fact_promotion"]),
            quality.dws_metrics(self["sales_daily"], self["trade_product_1d"], self["promotion_daily"]),
            quality.ads_metrics(self["daily_report"]),
        ]
        if files is not None:
            layers.insert(0, quality.raw_metrics("CSV", files["ods_orders"], files["ods_promotion"]))
        return quality.layer_metrics(*layers)


class _Passing(Star):
    def __init__(self, star: Star, names: Collection[str]):
        super().__init__(star.raw)
        self._plans = star._plans
        self._star = star
        self._names = names

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names or name in self._star._done:
            return self._star[name]
        if name not in self._done:
            self._done[name] = self.raw.plan(name) if name in self.raw else self.plan(name)
        return self._done[name]
