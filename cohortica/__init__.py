"""Cohort analytics on Spark: build, clean, impute, check, score and monitor patient-style cohorts."""
