"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from . import audio, chat, htmltext, langid, lsmdedup, mixing, neardup, pieces, quality, suffixdedup

QUERIES = {
    "op1_audio_features": audio.op1_audio_features,
    "op2_near_dedup": neardup.op2_near_dedup,
    "op3_chat_format": chat.op3_chat_format,
    "op4_language_crf": langid.op4_language_crf,
    "op5_quality_ledger": quality.op5_quality_ledger,
    "op6_suffix_dedup": suffixdedup.op6_suffix_dedup,
    "op7_lsm_dedup": lsmdedup.op7_lsm_dedup,
    "op8_pareto_mix": mixing.op8_pareto_mix,
    "op9_html_text": htmltext.op9_html_text,
    "op10_sentencepiece": pieces.op10_sentencepiece,
    "quality_ablation": quality.quality_ablation,
    "quality_everywhere": quality.quality_everywhere,
}
#: op1 has none: SQL has no filters or transforms. It is tested against plain versions.
ORACLES = {"op2_near_dedup": neardup.OP2_SQL, "op3_chat_format": chat.OP3_SQL, "op5_quality_ledger": quality.OP5_SQL, "op6_suffix_dedup": suffixdedup.OP6_SQL, "op7_lsm_dedup": lsmdedup.OP7_SQL, "op8_pareto_mix": mixing.OP8_SQL, "quality_ablation": quality.ABLATION_SQL, "quality_everywhere": quality.EVERYWHERE_SQL}
