"""Imports every query module so that the registry is complete."""

from sensorcast.plans import q_explore, q_features, q_jobs, q_ml, q_models, q_regularize, q_sources, q_stream  # noqa: F401
from sensorcast.plans.registry import ORACLE, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE)
