"""The registered query of each operator and, where SQL can express it, its SQL."""

from .op1_chat_format import OP1_SQL, op1_chat_format
from .op2_url_filter import op2_url_filter
from .op3_decontamination import op3_decontamination
from .op4_substring import op4_substring_dedup
from .op5_html_extraction import op5_html_extraction
from .op6_fingerprint import op6_fingerprint
from .op7_sentencepiece import op7_sentencepiece
from .op8_suffix_array import op8_suffix_array_dedup
from .op9_language_id import op9_language_id
from .op10_jaccard_join import op10_jaccard_join
from .op11_whitening import op11_whitening
from .op12_byte_bpe import op12_byte_bpe
from .op13_hard_negatives import OP13_SQL, op13_hard_negatives

QUERIES = {f.__name__: f for f in (
    op1_chat_format, op2_url_filter, op3_decontamination, op4_substring_dedup,
    op5_html_extraction, op6_fingerprint, op7_sentencepiece, op8_suffix_array_dedup,
    op9_language_id, op10_jaccard_join, op11_whitening, op12_byte_bpe,
    op13_hard_negatives,
)}

ORACLES: dict[str, str] = {"op1_chat_format": OP1_SQL, "op13_hard_negatives": OP13_SQL}
