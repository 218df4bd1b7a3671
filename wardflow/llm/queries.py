"""The registered queries of this subpackage and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wardflow.llm.brown import op4_brown_lm
from wardflow.llm.chat import OP10_SQL, op10_chat
from wardflow.llm.decontaminate import OP2_SQL, op2_decontaminate
from wardflow.llm.fingerprints import op1_fingerprints
from wardflow.llm.packed_ids import op9_packed_ids
from wardflow.llm.phrases import OP12_SQL, op12_phrases
from wardflow.llm.quality import op6_quality
from wardflow.llm.repeats import op8_repeats
from wardflow.llm.secrets import op3_secrets
from wardflow.llm.simhash import op7_simhash
from wardflow.llm.spelling import op13_spelling
from wardflow.llm.token_counts import op11_token_counts
from wardflow.llm.word_bpe import op5_word_bpe

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_decontaminate": op2_decontaminate,
    "op3_secrets": op3_secrets,
    "op4_brown_lm": op4_brown_lm,
    "op5_word_bpe": op5_word_bpe,
    "op6_quality": op6_quality,
    "op7_simhash": op7_simhash,
    "op8_repeats": op8_repeats,
    "op9_packed_ids": op9_packed_ids,
    "op10_chat": op10_chat,
    "op11_token_counts": op11_token_counts,
    "op12_phrases": op12_phrases,
    "op13_spelling": op13_spelling,
}
ORACLES: dict[str, str] = {
    "op2_decontaminate": OP2_SQL,
    "op10_chat": OP10_SQL,
    "op12_phrases": OP12_SQL,
}
