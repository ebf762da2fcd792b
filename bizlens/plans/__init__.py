"""The case-study jobs: parameterised DataFrame -> DataFrame functions.

* :mod:`~bizlens.plans.loyalty` -- spend, visits, first / favourite items,
  member-period items and ranks, points.
* :mod:`~bizlens.plans.cleaning` -- dirty text to typed columns (orders,
  deliveries, weekly sales).
* :mod:`~bizlens.plans.orders` -- counts, rates, times, money, ratings table,
  delivery report.
* :mod:`~bizlens.plans.lists` -- delimited id lists: ingredients, most common
  extra / exclusion, item labels, ingredient lists and totals, menu extension.
* :mod:`~bizlens.plans.journeys` -- subscription plan histories.
* :mod:`~bizlens.plans.ledger` -- node allocations, percentiles, monthly and
  running balances, growth share, daily-calendar data allocation.
* :mod:`~bizlens.plans.periods` -- weekly sales exploration, shares and
  before / after comparisons by any dimension.
* :mod:`~bizlens.plans.funnel` -- clickstream traffic, product / category
  funnels and their questions, campaign attribution per visit.

Every job answers its question as written by default; alternative readings
are keyword arguments.
"""
