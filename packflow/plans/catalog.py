"""Imports every query module so the registry is complete."""

from packflow.plans import q_explore, q_models, q_features, q_master, q_sources, q_network, q_packs_finance, q_production  # noqa: F401
from packflow.plans.registry import REGISTRY  # noqa: F401
