"""The queries opN_<name> and their SQL, where SQL can express them."""

from klangwerk.llm import ann, chat, decontam, exactdup, jaccard, langid, linededup, mixing, quality, sitetree

QUERIES = {
    "op1_language_id": langid.query,
    "op2_suffix_dedup": exactdup.query,
    "op3_quality": quality.query,
    "op4_decontamination": decontam.query,
    "op5_nearest_neighbours": ann.query,
    "op6_jaccard_join": jaccard.query,
    "op7_html_extraction": sitetree.query,
    "op8_source_mixing": mixing.query,
    "op9_chat_format": chat.query,
    "op10_line_dedup": linededup.query,
}
ORACLES = {
    "op9_chat_format": chat.SQL,
    "op10_line_dedup": linededup.SQL,
}
