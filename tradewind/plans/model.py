"""The whole model over one set of extracts, every table a lazy DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import cached_property

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.dates import mixed_date
from tradewind.operators import rfm
from tradewind.operators.anomaly import group_zscore, iqr_fence, weekday_baseline
from tradewind.operators.calendar import fill_days, fill_forward_then_back
from tradewind.operators.stl import poisson_residuals
from tradewind.plans import clean, dims, facts, marts
from tradewind.plans.staging import stage
from tradewind.scale import materialize
from tradewind.sources.schemas import CATEGORIES, COUNTRY_CODES

LOW_ROAS_Z = -1.5
AT_ONCE = 3  # held tables that are written side by side
ALL = "ALL"  # the series over all countries

# Tables the dashboards and the export read, in export order.
EXPORTED = (
    "dim_customer", "dim_product", "dim_country", "dim_date", "fct_orders", "fct_order_items", "fct_returns",
    "fct_marketing_spend", "monthly_revenue_kpis", "customer_ltv", "cohort_retention", "product_performance",
    "marketing_roi", "returns_analysis",
)

# Marts and analysis tables that are published sorted.
SORTED = {
    "monthly_revenue_kpis": ("country_code", "month"),
    "cohort_retention": ("cohort_month", "months_since_first_order"),
    "marketing_roi": ("country_code", "month", "channel"),
    "returns_analysis": ("month", "return_reason"),
    "revenue_anomalies": ("date",),
    "daily_revenue_with_flags": ("date",),
    "underperforming_marketing_spend": ("z_roas", "country_code", "month", "channel"),
    "anomaly_feed": ("date",),
}


class Model:
    """Cleaned, staged, dimensional and analytic tables by name.

    ``read`` gives a raw extract (or the country seed under ``country``). Nothing
    runs until a table is used, and a query only plans the tables it touches.
    ``hold`` names staged tables to write once to scratch, for callers that read
    them in several marts; ``prepare`` writes them all. ``calendar`` gives the first and last day of the model's calendar;
    without it the calendar covers every day that orders, returns or spend name.
    """

    def __init__(self, read: Callable[[str], DataFrame], countries: Sequence[str] = COUNTRY_CODES,
                 categories: Sequence[str] = CATEGORIES, hold: Sequence[str] = (),
                 calendar: tuple[date, date] | None = None):
        self._read, self._countries, self._categories, self._hold = read, countries, categories, set(hold)
        self._limits = calendar
        self._staged: dict[tuple[str, bool], DataFrame] = {}

    @property
    def parameters(self) -> tuple:
        """What the tables depend on beside the extracts."""
        return tuple(self._countries), tuple(self._categories), self._limits

    @classmethod
    def over(cls, extracts: Mapping[str, DataFrame], **kw) -> Model:
        return cls(extracts.__getitem__, **kw)

    def raw(self, name: str) -> DataFrame:
        return self._read(name)

    def clean(self, name: str) -> DataFrame:
        raw = self.raw(name)
        return {
            "customers": lambda: clean.clean_customers(raw, self._countries),
            "products": lambda: clean.clean_products(raw, self._categories),
            "orders": lambda: clean.clean_orders(raw),
            "order_items": lambda: clean.clean_items(raw),
            "payments": lambda: clean.clean_payments(raw),
            "returns": lambda: clean.clean_returns(raw),
            "marketing_spend": lambda: clean.clean_spend(raw),
            "exchange_rates": lambda: clean.clean_rates(raw),
        }[name]()

    def staged(self, name: str) -> DataFrame:
        held = name in self._hold
        if (name, held) not in self._staged:
            df = stage(self.clean(name), name)
            if name == "exchange_rates":
                df = self._filled(df)
            self._staged[name, held] = materialize(df, name) if held else df
        return self._staged[name, held]

    def prepare(self) -> Model:
        """Write the held tables side by side, so that the short steps of one don't leave the cores idle; returns the model."""
        raw = {name: self.raw(name) for name in sorted(self._hold)}  # looked up before the threads start
        with ThreadPoolExecutor(AT_ONCE) as pool:
            for job in [pool.submit(inheritable_thread_target(df.sparkSession)(self.staged), name) for name, df in raw.items()]:
                job.result()
        return self

    @cached_property
    def calendar(self) -> DataFrame:
        """One row (lo, hi), written once. Dates of orders and returns are read from the raw rows: the limits need no de-duplication."""
        if self._limits:
            lo, hi = (F.lit(d).cast("date") for d in self._limits)
            return self.raw("country").agg(lo.alias("lo"), hi.alias("hi"))
        days = (self.raw("orders").select(mixed_date(F.col("order_date")).alias("d"))
                .unionByName(self.raw("returns").select(mixed_date(F.col("return_date")).alias("d")))
                .unionByName(self.staged("marketing_spend").select(F.col("date").alias("d"))))
        return materialize(days.agg(F.min("d").alias("lo"), F.max("d").alias("hi")), "calendar")

    def _filled(self, rates: DataFrame) -> DataFrame:
        """A rate for every currency and day of the calendar, and of the rates' own days: the last one known, or the first."""
        rates = materialize(rates, "rates")  # read three times: days, keys, values
        ends = rates.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
        start = F.least(self.calendar.select("lo").scalar(), ends.select("lo").scalar())
        end = F.greatest(self.calendar.select("hi").scalar(), ends.select("hi").scalar())
        return fill_forward_then_back(rates, start, end).select("date", "currency_code", "rate_to_eur")

    def _lookup(self, name: str) -> DataFrame:
        """A staged table that facts look values up in, written once.

        Its stored size is then known exactly: Catalyst broadcasts it while it is
        under the threshold and shuffles the join beyond, instead of guessing
        from the sizes of everything it was derived from.
        """
        self._hold.add(name)
        return self.staged(name)

    @cached_property
    def dim_country(self) -> DataFrame:
        return self.raw("country")

    @cached_property
    def dim_customer(self) -> DataFrame:
        return dims.dim_customer(self.staged("customers"), self.dim_country)

    @cached_property
    def dim_product(self) -> DataFrame:
        return dims.dim_product(self._lookup("products"))

    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.dim_date(self.calendar)

    @cached_property
    def fct_orders(self) -> DataFrame:
        return facts.fct_orders(self.staged("orders"), self.staged("order_items"), self.staged("payments"),
                                self._lookup("exchange_rates"))

    @cached_property
    def fct_order_items(self) -> DataFrame:
        return facts.fct_order_items(self.staged("order_items"), self._lookup("products"))

    @cached_property
    def fct_returns(self) -> DataFrame:
        return facts.fct_returns(self.staged("returns"), self.staged("orders"))

    @cached_property
    def fct_marketing_spend(self) -> DataFrame:
        return facts.fct_marketing_spend(self.staged("marketing_spend"))

    # The marts read staged orders rather than fct_orders: they need none of its joined columns,
    # and a left join to unique keys neither adds nor removes rows.

    @cached_property
    def monthly_revenue_kpis(self) -> DataFrame:
        return marts.monthly_revenue_kpis(self.staged("orders"))

    @cached_property
    def customer_ltv(self) -> DataFrame:
        return marts.customer_ltv(self.dim_customer, self.staged("orders"))

    @cached_property
    def cohort_retention(self) -> DataFrame:
        return marts.cohort_retention(self.staged("orders"))

    @cached_property
    def product_performance(self) -> DataFrame:
        return marts.product_performance(self.dim_product, self.staged("order_items"), self.staged("returns"))

    @cached_property
    def product_performance_nofanout(self) -> DataFrame:
        return marts.product_performance(self.dim_product, self.staged("order_items"), self.staged("returns"), False)

    @cached_property
    def marketing_roi(self) -> DataFrame:
        return marts.marketing_roi(self.staged("marketing_spend"), self.staged("orders"))

    @cached_property
    def returns_analysis(self) -> DataFrame:
        return marts.returns_analysis(self.fct_returns)

    @cached_property
    def daily_revenue(self) -> DataFrame:
        return marts.daily_revenue(self.staged("orders"))

    @cached_property
    def dense_daily(self) -> DataFrame:
        """Daily revenue with silent days as zeros; one row per day, written once because
        the fill reads the aggregate for its bounds and its values."""
        return fill_days(materialize(self.daily_revenue, "daily"), ["net_revenue_eur", "orders_count"])

    @cached_property
    def weekday_flags(self) -> DataFrame:
        return weekday_baseline(iqr_fence(self.dense_daily).drop("q1", "q3"))

    @cached_property
    def revenue_anomalies(self) -> DataFrame:
        return self.weekday_flags.where("is_anomaly")

    @cached_property
    def stl_flags(self) -> DataFrame:
        """The decomposition of every country's daily series, and of all countries together (country_code ALL)."""
        known = self.staged("orders").where("country_code is not null")
        daily = fill_days(materialize(marts.daily_revenue(known, ["country_code"]), "daily_by_country"),
                          ["net_revenue_eur", "orders_count"], by=["country_code"])
        total = self.dense_daily.withColumn("country_code", F.lit(ALL))
        return poisson_residuals(daily.unionByName(total), by=["country_code"])

    @cached_property
    def rfm_scores(self) -> DataFrame:
        return rfm.rfm_scores(self.customer_ltv)

    @cached_property
    def rfm_segments(self) -> DataFrame:
        return rfm.rfm_segments(self.rfm_scores)

    @cached_property
    def rfm_summary(self) -> DataFrame:
        return rfm.rfm_summary(self.rfm_segments)

    @cached_property
    def roas_zscores(self) -> DataFrame:
        """Return on spend of country, month and channel rows, as z-score within the channel."""
        seen = self.marketing_roi.where("net_revenue_eur is not null").select(
            "country_code", "month", "channel", "spend_eur", "net_revenue_eur", "blended_roas")
        return group_zscore(seen, "blended_roas", "channel", "z_roas")

    @cached_property
    def low_roas(self) -> DataFrame:
        """Rows whose return is unusually low for the channel."""
        return self.roas_zscores.where(F.col("z_roas") < LOW_ROAS_Z)

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)
