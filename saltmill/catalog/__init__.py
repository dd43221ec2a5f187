"""All registered queries; importing the package fills the registry."""

from . import aggregates, basic, files, fulltext, quality, reports, streams  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
