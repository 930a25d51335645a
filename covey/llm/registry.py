"""The queries of this package and their SQL, by name."""

from . import bpe, language, mainpage, media, mixing, neardup, pii, quality, repeats, vectors

QUERIES = {
    "op1_near_duplicates": neardup.op1_near_duplicates,
    "op2_language_id": language.op2_language_id,
    "op3_personal_data": pii.op3_personal_data,
    "op4_near_vectors": vectors.op4_near_vectors,
    "op5_media_sequences": media.op5_media_sequences,
    "op6_repeated_passages": repeats.op6_repeated_passages,
    "op7_mix_sources": mixing.op7_mix_sources,
    "op8_bpe_round_trip": bpe.op8_bpe_round_trip,
    "op9_main_text": mainpage.op9_main_text,
    "op10_site_quality": quality.op10_site_quality,
}
SQL = {
    "op1_near_duplicates": neardup.OP1_SQL,
    "op4_near_vectors": vectors.OP4_SQL,
    "op6_repeated_passages": repeats.OP6_SQL,
    "op7_mix_sources": mixing.OP7_SQL,
}
