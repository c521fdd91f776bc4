"""Ratios, discounting, balances and probabilities on columns; undefined results are null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pe(price: Column, eps: Column) -> Column:
    """Price to earnings; null unless earnings are positive (FN-M1, FIL-24)."""
    return F.when(eps > 0, F.try_divide(price, eps))


def pb(price: Column, book: Column) -> Column:
    return F.when(book > 0, F.try_divide(price, book))


def ps(value: Column, sales: Column) -> Column:
    return F.when(sales > 0, F.try_divide(value, sales))


def discounted(cash: Column, rate: Column, years: Column) -> Column:
    """One payment's present value; sum it over a group (FN-M2, FN-M11)."""
    return cash / F.pow(1 + rate, years)


def perpetuity(fcf: Column, wacc: Column, growth: Column | None = None) -> Column:
    """FCF / WACC, or FCF (1 + g) / (WACC - g); null unless WACC exceeds g and 0 (FN-M3)."""
    g = F.lit(0.0) if growth is None else growth
    return F.when((wacc > g) & (wacc > 0), fcf * (1 + g) / (wacc - g))


def two_stage(fcf: Column, wacc: Column, high: Column, years: int, low: Column) -> Column:
    """``years`` of high growth, then constant growth (FN-M3; the stages are our choice)."""
    total = F.lit(0.0)
    for t in range(1, years + 1):
        total = total + fcf * F.pow(1 + high, F.lit(t)) / F.pow(1 + wacc, F.lit(t))
    return F.when(wacc > low, total + perpetuity(fcf * F.pow(1 + high, F.lit(years)), wacc, low) / F.pow(1 + wacc, F.lit(years)))


def revenue(people: Column, penetration: Column, per_head: Column, price: Column) -> Column:
    return people * penetration * per_head * price


def profit(sales: Column, margin: Column, fixed: Column) -> Column:
    """Revenue times margin less fixed cost (FN-M4)."""
    return sales * margin - fixed


def runway(cash: Column, yearly_loss: Column) -> Column:
    """Years that the cash lasts; null without a loss (FN-M5)."""
    return F.when(yearly_loss > 0, F.try_divide(cash, yearly_loss))


def share(part: Column, whole: Column) -> Column:
    """A share such as cash flow to profit, chain share, cost share, value per area, conversion or defects (FN-M6, FN-M7, FN-M9)."""
    return F.try_divide(part, whole)


def payback(cost: Column, yearly_gain: Column) -> Column:
    return F.when(yearly_gain > 0, F.try_divide(cost, yearly_gain))


def leveraged(equity_return: Column, borrow_rate: Column, leverage: Column) -> Column:
    """Return on equity with borrowed money: r L - b (L - 1) (FN-M11; our choice)."""
    return equity_return * leverage - borrow_rate * (leverage - 1)


def closing_stock(opening: Column, output: Column, imports: Column, consumption: Column, exports: Column) -> Column:
    """FN-M8."""
    return opening + output + imports - consumption - exports


def spread(long: Column, short: Column) -> Column:
    """Basis, month spread, production or processing margin, expectation gap (FN-M13): spot - futures, near - far, price - cost, actual - expected."""
    return long - short


def posterior(prior: Column, hit: Column, false_alarm: Column) -> Column:
    """Bayes (FN-M10)."""
    return F.try_divide(prior * hit, prior * hit + (1 - prior) * false_alarm)


def penetration_alert(p: Column) -> Column:
    """FIL-25: above a half caution, from four fifths saturated."""
    return F.when(p >= 0.8, "saturated").when(p > 0.5, "caution").otherwise("ok")


def margin_good(gross: Column) -> Column:
    return gross > 0.25


def model_grade(upstream: Column, downstream: Column, government: Column) -> Column:
    """How many of the three sides need the company: 3 to 0 (CLS-13)."""
    return upstream.cast("int") + downstream.cast("int") + government.cast("int")


def penetration_quadrant(industry_up: Column, brand_up: Column) -> Column:
    """1 is best, 4 worst (CLS-14)."""
    return F.when(industry_up & brand_up, 1).when(industry_up, 2).when(brand_up, 3).otherwise(4)


def valuation_method(accumulates: Column) -> Column:
    """CLS-15."""
    return F.when(accumulates, "PE").otherwise("PB")


def stock_regime(stock_change: Column, demand_change: Column) -> Column:
    """Signs of the stock and demand changes (CLS-21; our choice): stock rises with demand: active build-up, against it: passive build-up; it falls with demand: active draw-down, against it: passive draw-down."""
    return (
        F.when(stock_change.isNull() | demand_change.isNull() | (stock_change == 0), F.lit(None).cast("string"))
        .when((stock_change > 0) & (demand_change > 0), "active build-up")
        .when(stock_change > 0, "passive build-up")
        .when(demand_change < 0, "active draw-down")
        .otherwise("passive draw-down")
    )


def market_state(path_change: Column, level: Column, tight: float, surplus: float) -> Column:
    """CLS-22 on a projected path: level below ``tight`` is a tight balance, above ``surplus`` a surplus; else by the change (thresholds ours)."""
    return F.when(level < tight, "tight balance").when(level > surplus, "surplus").when(path_change > 0, "building").otherwise("drawing")


def worst_case(value: Column, loss_share: Column, debt: Column) -> Column:
    """What is left if the share is lost and the debt is due (FN-M11)."""
    return value * (1 - loss_share) - debt


def value_per_area(value: Column, area: Column) -> Column:
    """Market value for each unit of planted area (FN-M7)."""
    return F.when(area > 0, F.try_divide(value, area))


def stock_to_sales(stock: Column, sales: Column) -> Column:
    """FN-M9."""
    return F.when(sales > 0, F.try_divide(stock, sales))


def production_profit(price: Column, cost: Column, by_product: Column) -> Column:
    """Price and by-products less cost (FN-M13)."""
    return price + by_product - cost


def basis(spot: Column, future: Column) -> Column:
    """FN-M13."""
    return spot - future
