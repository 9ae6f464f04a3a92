"""The corpus queries: importing this module registers every operator's query."""

from listingmart.llm import (  # noqa: F401
    collocations, decontaminate, divergence, hmm, packing, quality_model, repair, simhash, substrings, token_counts,
    token_orc, toxicity, url_rules)
from listingmart.llm.common import ORACLE, QUERIES  # noqa: F401
