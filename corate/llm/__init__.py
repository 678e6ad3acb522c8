"""Operators of a training-data pipeline: mixing, archives, deduplication, decontamination and more.

``QUERIES`` and ``ORACLE`` hold the registered queries and, where SQL can express them, their SQL.
"""

import sys

from pyspark import cloudpickle

from corate.llm import bitsliced, conversation, decontam, licenses, lm, mixing, neardup, neighbours, pii, resampling, tokens, toxicity, warc

# Functions for the executors travel with their code: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUERIES = {
    "op1_mix_sources": mixing.q_op1,
    "op2_warc": warc.q_op2,
    "op3_near_duplicates": neardup.q_op3,
    "op4_decontaminate": decontam.q_op4,
    "op5_token_counts": tokens.q_op5,
    "op6_class_lm": lm.q_op6,
    "op7_personal_data": pii.q_op7,
    "op8_neighbours": neighbours.q_op8,
    "op9_toxicity": toxicity.q_op9,
    "op10_licenses": licenses.q_op10,
    "op11_conversation_repair": conversation.q_op11,
    "op12_importance_resampling": resampling.q_op12,
    "op13_bit_sliced_top_k": bitsliced.q_op13,
}
ORACLE = {"op1_mix_sources": mixing.SQL, "op2_warc": warc.SQL, "op4_decontaminate": decontam.SQL, "op10_licenses": licenses.SQL,
          "op12_importance_resampling": resampling.SQL, "op13_bit_sliced_top_k": bitsliced.SQL}
