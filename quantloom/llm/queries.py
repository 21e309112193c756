"""Registered queries of this subpackage and their SQL."""

from . import bpe, chat, decontamination, langid, licenses, minhash, packing, quality, scoring, sharding, spelling, suffixdedup, whitening

QUERIES = {
    "op1_hilbert_shards": sharding.op1_hilbert_shards,
    "op2_run_length_dedup": suffixdedup.op2_run_length_dedup,
    "op3_large_item_packing": packing.op3_large_item_packing,
    "op4_subword_langid": langid.op4_subword_langid,
    "op5_event_chat": chat.op5_event_chat,
    "op6_prefix_decontamination": decontamination.op6_prefix_decontamination,
    "op7_attention_lm": scoring.op7_attention_lm,
    "op8_rule_ledger": quality.op8_rule_ledger,
    "op9_license_sentences": licenses.op9_license_sentences,
    "op10_minhash_postings": minhash.op10_minhash_postings,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_whitening": whitening.op12_whitening,
    "op13_matrix_bpe": bpe.op13_matrix_bpe,
}
ORACLE_SQL = {
    "op5_event_chat": chat.OP5_SQL,
    "op6_prefix_decontamination": decontamination.OP6_SQL,
    "op8_rule_ledger": quality.OP8_SQL,
    "op9_license_sentences": licenses.OP9_SQL,
}
