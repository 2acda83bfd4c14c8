"""Queries of the pipeline operators and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from quarry.llm import divergence, exact_dedup, mixing, warc
from quarry.llm.divergence import op11_source_divergence
from quarry.llm.exact_dedup import op2_exact_dedup
from quarry.llm.language import op4_language_id
from quarry.llm.minhash import op6_minhash_fingerprints
from quarry.llm.mixing import op3_curriculum_mix
from quarry.llm.ngram_join import op5_ngram_jaccard_join
from quarry.llm.packing import op10_best_fit_packing
from quarry.llm.quality import op9_quality_gam
from quarry.llm.sharding import op7_consistent_hash_shards
from quarry.llm.simhash import op13_simhash_near_dedup
from quarry.llm.spelling import op12_spelling_variants
from quarry.llm.toxicity import op8_toxicity_gbt
from quarry.llm.warc import op1_warc_segments

QUERIES = {f.__name__: f for f in (
    op1_warc_segments, op2_exact_dedup, op3_curriculum_mix, op4_language_id, op5_ngram_jaccard_join,
    op6_minhash_fingerprints, op7_consistent_hash_shards, op8_toxicity_gbt, op9_quality_gam, op10_best_fit_packing,
    op11_source_divergence, op12_spelling_variants, op13_simhash_near_dedup)}

ORACLE = {"op1_warc_segments": warc.ORACLE, "op2_exact_dedup": exact_dedup.ORACLE, "op3_curriculum_mix": mixing.ORACLE,
          "op11_source_divergence": divergence.ORACLE}
