"""Imports every query module so the registry is complete."""

from kerbflow.plans import q_augment, q_batch, q_geo, q_io, q_mobility, q_stream  # noqa: F401
from kerbflow.plans.registry import ORACLE, QUERIES  # noqa: F401
