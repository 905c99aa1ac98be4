"""Registered queries of this folder, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import chat, divergence, lexical, sharding, url_filter
from .chat import op4_chat
from .decontaminate import op9_decontamination
from .divergence import op12_divergence
from .lexical import op13_lexical
from .packing import op10_packing
from .rendering import op1_rendering
from .sharding import op5_sharding
from .simhash import op8_simhash
from .suffixes import op2_suffixes
from .token_counts import op11_token_counts
from .toxicity import op7_toxicity
from .url_filter import op6_url_filter
from .vectors import op3_vectors

QUERIES = {
    f.__name__: f
    for f in (
        op1_rendering, op2_suffixes, op3_vectors, op4_chat, op5_sharding, op6_url_filter, op7_toxicity,
        op8_simhash, op9_decontamination, op10_packing, op11_token_counts, op12_divergence,
        op13_lexical,
    )
}
ORACLES: dict[str, str] = {
    "op4_chat": chat.ORACLE,
    "op5_sharding": sharding.ORACLE,
    "op6_url_filter": url_filter.ORACLE,
    "op12_divergence": divergence.ORACLE,
    "op13_lexical": lexical.ORACLE,
}
