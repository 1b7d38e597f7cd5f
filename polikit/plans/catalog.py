"""Import every query module so the registry is complete."""

from . import q_layers, q_quality, q_reports, q_storage  # noqa: F401
from .registry import ORACLE, QUERIES  # noqa: F401
