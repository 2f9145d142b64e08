"""All queries of the subpackage; importing this module registers them."""

from __future__ import annotations

from . import bpe, conversation_repair, decontaminate, exact_dedup, filter_audit, html_text, language_id, license_scan, minhash_dedup, secret_scan, source_mix, warc, winnowing  # noqa: F401
from .common import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
