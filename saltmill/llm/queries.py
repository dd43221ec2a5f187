"""All corpus queries; importing this module fills the registry."""

from . import decontamination, filter_audit, language_id, license_scan, line_dedup, minhash_dedup, mixing, quality_rules, secret_scan, source_divergence, suffix_dedup, toxicity, url_filter  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
