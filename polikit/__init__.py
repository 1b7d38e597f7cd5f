"""polikit: a Spark-native motor-policy analytics library.

Raw policy feed -> bronze -> silver (clean, de-duplicated) -> gold (lifecycle, risk)
-> star schema -> KPI tables, BI reports, data-quality and profiling suites.
Every operator is a pure ``DataFrame -> DataFrame`` function with its thresholds
passed in (``PolicyRules``).
"""

from .rules import DEFAULT_RULES, PolicyRules  # noqa: F401

__version__ = "0.1.0"
