"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from credtrail.llm.bit_whitening import op12_bit_sliced_whitening
from credtrail.llm.containment import OP8_SQL, op8_benchmark_containment
from credtrail.llm.forced_bpe import op5_bpe_forced_boundary
from credtrail.llm.kd_sharding import op10_kd_sharding
from credtrail.llm.minhash_dedup import OP6_SQL, op6_minhash_tensored
from credtrail.llm.mtree_topk import OP2_SQL, op2_mtree_topk
from credtrail.llm.pipeline import run
from credtrail.llm.ppm_language import op9_ppm_language
from credtrail.llm.prefix_trie import OP13_SQL, op13_prefix_trie
from credtrail.llm.token_files import op4_frequency_ranked_token_files
from credtrail.llm.toxicity_mil import op7_toxicity_mil
from credtrail.llm.url_rules import OP1_SQL, op1_url_digest_rules
from credtrail.llm.vp_search import op11_vp_neighbours
from credtrail.llm.zip_archives import OP3_SQL, op3_warc_zip

QUERIES = {f.__name__: f for f in (
    op1_url_digest_rules,
    op2_mtree_topk,
    op3_warc_zip,
    op4_frequency_ranked_token_files,
    op5_bpe_forced_boundary,
    op6_minhash_tensored,
    op7_toxicity_mil,
    op8_benchmark_containment,
    op9_ppm_language,
    op10_kd_sharding,
    op11_vp_neighbours,
    op12_bit_sliced_whitening,
    op13_prefix_trie,
)}


def pipeline(spark, sf_dir):
    """The five stages over ``documents``."""
    return run(spark, sf_dir)


QUERIES["pipeline"] = pipeline
#: Tokenizers (4, 5), trained models (7, 9), the recursive exact medians (10), trees that may pass over
#: neighbours (11) and eigenvectors (12) have no SQL.
ORACLE: dict[str, str] = {
    op1_url_digest_rules.__name__: OP1_SQL,
    op2_mtree_topk.__name__: OP2_SQL,
    op3_warc_zip.__name__: OP3_SQL,
    op6_minhash_tensored.__name__: OP6_SQL,
    op8_benchmark_containment.__name__: OP8_SQL,
    op13_prefix_trie.__name__: OP13_SQL,
}
