"""Forecasts per sensor. Inputs carry ``detid``, ``weekday`` (name), ``interval_s`` and ``traffic``.

A model is a table keyed by sensor: fitting all sensors is one job, scoring them is a join.
"""
