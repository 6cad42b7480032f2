"""Queries of the corpus operators, and the SQL of those that SQL can express."""

from gleaner.llm.audio_match import op8_audio_match
from gleaner.llm.bpe import op9_bpe
from gleaner.llm.decontaminate import op4_decontaminate
from gleaner.llm.langid import op10_language_id
from gleaner.llm.license_scan import op1_license_scan
from gleaner.llm.lm_score import op6_lm_score
from gleaner.llm.secret_scan import op5_secret_scan
from gleaner.llm.simhash import op2_simhash
from gleaner.llm.token_files import op3_token_files
from gleaner.llm.url_filter import op7_url_filter

QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_simhash": op2_simhash,
    "op3_token_files": op3_token_files,
    "op4_decontaminate": op4_decontaminate,
    "op5_secret_scan": op5_secret_scan,
    "op6_lm_score": op6_lm_score,
    "op7_url_filter": op7_url_filter,
    "op8_audio_match": op8_audio_match,
    "op9_bpe": op9_bpe,
    "op10_language_id": op10_language_id,
}

ORACLE_SQL: dict[str, str] = {}
