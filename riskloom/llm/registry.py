"""The queries of this package and their SQL."""

from riskloom.llm import (
    bpe, centroids, chat, exact_dedup, katz, language, licenses, negatives, packing, paragraphs, secrets, simhash, vectors)

QUERIES = {
    "op1_paragraph_dedup": paragraphs.op1_paragraph_dedup,
    "op2_secret_scan": secrets.op2_secret_scan,
    "op3_license_scan": licenses.op3_license_scan,
    "op4_bpe_transducer": bpe.op4_bpe_transducer,
    "op5_language_id": language.op5_language_id,
    "op6_embedding_near_dedup": vectors.op6_embedding_near_dedup,
    "op7_simhash_near_dedup": simhash.op7_simhash_near_dedup,
    "op8_best_fit_packing": packing.op8_best_fit_packing,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_chat_windows": chat.op10_chat_windows,
    "op11_centroid_clusters": centroids.op11_centroid_clusters,
    "op12_hard_negatives": negatives.op12_hard_negatives,
    "op13_katz_scores": katz.op13_katz_scores,
}

ORACLES = {
    "op3_license_scan": licenses.OP3_SQL,
    "op9_exact_dedup": exact_dedup.OP9_SQL,
    "op11_centroid_clusters": centroids.OP11_SQL,
    "op12_hard_negatives": negatives.OP12_SQL,
}
