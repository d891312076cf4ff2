"""The named queries of this subpackage and, where SQL can say the same, their SQL."""

from newsloom.llm import alignment, bm25, bpe, chat, extract, licences, lm, private_terms, quality, secret_scan, simhash, whitening, winnow

QUERIES = {
    "op1_bm25_topk": bm25.query,
    "op2_simhash": simhash.query,
    "op3_main_text": extract.query,
    "op4_quality": quality.query,
    "op5_chat_format": chat.query,
    "op6_winnowing": winnow.query,
    "op7_licences": licences.query,
    "op8_bpe": bpe.query,
    "op9_lm_scores": lm.query,
    "op10_secrets": secret_scan.query,
    "op11_token_alignment": alignment.query,
    "op12_private_terms": private_terms.query,
    "op13_whitening": whitening.query,
}

ORACLES = {
    "op1_bm25_topk": bm25.ORACLE,
    "op5_chat_format": chat.ORACLE,
    "op6_winnowing": winnow.ORACLE,
    "op10_secrets": secret_scan.ORACLE,
}
