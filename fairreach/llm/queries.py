"""All queries of this subpackage; the pipeline at the repository's top adds its own when it is imported."""

from fairreach.llm import collocations, decontaminate, hamming_search, language, licenses, ngram_lm, secrets, sentencepiece, simhash, tokens, toxicity, urls, whitening  # noqa: F401
from fairreach.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
