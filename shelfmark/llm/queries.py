"""Registry of the subpackage's queries and of the SQL twins that exist.

op8 depends on a tokenizer and op9 and op10 on a fitted model that SQL does not
express; they are tested against brute force.
"""

from __future__ import annotations

from shelfmark.llm.bpe import op8_bpe
from shelfmark.llm.embedding_dedup import OP4_SQL, op4_embedding_dedup
from shelfmark.llm.lm import op10_lm
from shelfmark.llm.minhash import OP5_SQL, op5_minhash
from shelfmark.llm.mixing import OP3_SQL, op3_mixing
from shelfmark.llm.pii import OP1_SQL, op1_pii
from shelfmark.llm.quality import op9_quality
from shelfmark.llm.sharding import OP7_SQL, op7_sharding
from shelfmark.llm.topk import OP6_SQL, op6_topk
from shelfmark.llm.warc import OP2_SQL, op2_warc

QUERIES = {
    "op1_pii": op1_pii,
    "op2_warc": op2_warc,
    "op3_mixing": op3_mixing,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_minhash": op5_minhash,
    "op6_topk": op6_topk,
    "op7_sharding": op7_sharding,
    "op8_bpe": op8_bpe,
    "op9_quality": op9_quality,
    "op10_lm": op10_lm,
}

ORACLE_SQL: dict[str, str] = {
    "op1_pii": OP1_SQL,
    "op2_warc": OP2_SQL,
    "op3_mixing": OP3_SQL,
    "op4_embedding_dedup": OP4_SQL,
    "op5_minhash": OP5_SQL,
    "op6_topk": OP6_SQL,
    "op7_sharding": OP7_SQL,
}
