"""The registered queries of this subpackage and the SQL of those that SQL can express."""

import corpus_pipeline

from .fertility import op3_fertility
from .jaccard import op9_jaccard
from .language import op4_language
from .likelihood import op8_likelihood
from .manifest import OP12_SQL, op12_manifest
from .merge_pieces import op11_pieces
from .mixing import op6_mixing
from .negatives import OP13_SQL, op13_negatives
from .packing import op10_packing
from .toxicity import op1_toxicity
from .suffixes import op5_suffixes
from .topk import OP7_SQL, op7_topk
from .url_rules import OP2_SQL, op2_url_filter

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_url_filter": op2_url_filter,
    "op3_fertility": op3_fertility,
    "op4_language": op4_language,
    "op5_suffixes": op5_suffixes,
    "op6_mixing": op6_mixing,
    "op7_topk": op7_topk,
    "op8_likelihood": op8_likelihood,
    "op9_jaccard": op9_jaccard,
    "op10_packing": op10_packing,
    "op11_pieces": op11_pieces,
    "op12_manifest": op12_manifest,
    "op13_negatives": op13_negatives,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {
    "op2_url_filter": OP2_SQL,
    "op7_topk": OP7_SQL,
    "op12_manifest": OP12_SQL,
    "op13_negatives": OP13_SQL,
}
