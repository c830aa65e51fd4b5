"""The operators' queries and their SQL."""

import corpus_pipeline

from rooftop.llm import bpe, exact, extract, langid, lm, media, mix, near, shard, urls

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_media": media.op1_media,
    "op2_near_dedup": near.op2_near_dedup,
    "op3_url_filter": urls.op3_url_filter,
    "op4_lm_scores": lm.op4_lm_scores,
    "op5_kd_shards": shard.op5_kd_shards,
    "op6_bpe": bpe.op6_bpe,
    "op7_extract": extract.op7_extract,
    "op8_exact_dedup": exact.op8_exact_dedup,
    "op9_langid": langid.op9_langid,
    "op10_mix": mix.op10_mix,
}
SQL = {"op3_url_filter": urls.OP3_SQL, "op8_exact_dedup": exact.OP8_SQL}
