"""All named queries."""

from riskframe.plans import arriving, data, detectors, evaluation, learning, stored, structure  # noqa: F401
from riskframe.plans.base import ORACLES, QUERIES  # noqa: F401
