"""Daily risk scoring of website visits, written as Spark DataFrame jobs."""

from visitrisk.spec import VISIT_SPEC, FeatureSpec

__all__ = ["FeatureSpec", "VISIT_SPEC"]
