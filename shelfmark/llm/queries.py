"""All registered queries of this package and their SQL."""

from . import decontamination, kd_sharding, line_templates, lm_scoring, ngram_jaccard, periodic_runs, quality_classifier, quality_rules, secret_scan, sentencepiece_codec, suffix_dedup, token_alignment, token_packing  # noqa: F401
from .common import ORACLES, QUERIES  # noqa: F401
