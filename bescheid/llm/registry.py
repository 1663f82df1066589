"""The queries of this folder by name, and DuckDB SQL where SQL can express one."""

from __future__ import annotations

from . import chat, hard_negatives, merkle
from .chat import op6_chat
from .common import Query
from .embeddings import op10_embedding_dedup
from .fingerprint import op1_fingerprints
from .hard_negatives import op11_hard_negatives
from .html_text import op3_html
from .language_id import op12_language_id
from .merkle import op13_merkle
from .packing import op5_packing
from .pieces import op4_sentencepiece
from .quality import op7_quality
from .secret_scan import op8_secrets
from .simhash import op9_simhash
from .training_order import op2_training_order

QUERIES: dict[str, Query] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_training_order": op2_training_order,
    "op3_html": op3_html,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_packing": op5_packing,
    "op6_chat": op6_chat,
    "op7_quality": op7_quality,
    "op8_secrets": op8_secrets,
    "op9_simhash": op9_simhash,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_language_id": op12_language_id,
    "op13_merkle": op13_merkle,
}

SQL: dict[str, str] = {"op6_chat": chat.SQL, "op11_hard_negatives": hard_negatives.SQL, "op13_merkle": merkle.SQL}
