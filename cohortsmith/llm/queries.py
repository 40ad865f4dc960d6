"""The queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .alignment import op11_shared_cuts
from .bytepairs import op13_byte_pairs
from .cascade import OP8_SQL, op8_rule_cascade
from .mixing import OP9_SQL, op9_curriculum_mix
from .nearby import OP4_SQL, op4_chosen_path
from .passages import OP1_SQL, op1_phrase_automata
from .periods import OP12_SQL, op12_period_runs
from .pieces import op10_piece_encoding
from .preference import op6_preference_quality
from .ring import op7_bounded_ring
from .suffixes import OP5_SQL, op5_prefix_doubling
from .topk import OP2_SQL, op2_sorted_list_topk
from .toxicity import op3_string_kernel_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_phrase_automata": op1_phrase_automata,
    "op2_sorted_list_topk": op2_sorted_list_topk,
    "op3_string_kernel_toxicity": op3_string_kernel_toxicity,
    "op4_chosen_path": op4_chosen_path,
    "op5_prefix_doubling": op5_prefix_doubling,
    "op6_preference_quality": op6_preference_quality,
    "op7_bounded_ring": op7_bounded_ring,
    "op8_rule_cascade": op8_rule_cascade,
    "op9_curriculum_mix": op9_curriculum_mix,
    "op10_piece_encoding": op10_piece_encoding,
    "op11_shared_cuts": op11_shared_cuts,
    "op12_period_runs": op12_period_runs,
    "op13_byte_pairs": op13_byte_pairs,
}
ORACLE: dict[str, str] = {
    "op1_phrase_automata": OP1_SQL,
    "op2_sorted_list_topk": OP2_SQL,
    "op4_chosen_path": OP4_SQL,
    "op5_prefix_doubling": OP5_SQL,
    "op8_rule_cascade": OP8_SQL,
    "op9_curriculum_mix": OP9_SQL,
    "op12_period_runs": OP12_SQL,
}
