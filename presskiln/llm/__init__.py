"""Operators of a training-data pipeline, their queries, and SQL where SQL can express them."""

from presskiln.llm import merkle, phrases
from presskiln.llm.embeddings import op10_embedding_dedup
from presskiln.llm.html_text import op8_main_text
from presskiln.llm.merkle import op12_merkle
from presskiln.llm.ngram_join import op2_ngram_join
from presskiln.llm.packing import op9_packing
from presskiln.llm.phrases import op13_phrases
from presskiln.llm.pii import op3_pii
from presskiln.llm.quality import op4_quality
from presskiln.llm.secrets import op11_secrets
from presskiln.llm.token_counts import op6_token_counts
from presskiln.llm.token_files import op1_token_files
from presskiln.llm.warc import op5_warc
from presskiln.llm.winnowing import op7_decontamination

QUERIES = {
    f.__name__: f
    for f in (
        op1_token_files, op2_ngram_join, op3_pii, op4_quality, op5_warc, op6_token_counts, op7_decontamination, op8_main_text, op9_packing,
        op10_embedding_dedup, op11_secrets, op12_merkle, op13_phrases,
    )
}
ORACLES: dict[str, str] = {"op12_merkle": merkle.ORACLE, "op13_phrases": phrases.ORACLE}
