"""Spark-native batch analytics over air-traffic position data.

Every transform is a plain ``DataFrame -> DataFrame`` function without actions inside;
writes happen in :mod:`skytally.sinks` and are sequenced by :mod:`skytally.plans`.
"""
