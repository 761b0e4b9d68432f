"""The pipeline operators as queries over the given tables, with SQL where SQL can express them."""

from tallystream.llm.decontaminate import op10_spaced_seed_decontamination
from tallystream.llm.dialogues import op13_auction_repair
from tallystream.llm.jaccard import OP6_SQL, op6_ngram_jaccard_join
from tallystream.llm.language import op9_language_naive_bayes
from tallystream.llm.mixing import op11_cube_mixing
from tallystream.llm.packing import op4_pack_concat_cut
from tallystream.llm.periodic import op12_baier_runs
from tallystream.llm.quality import op7_pu_quality
from tallystream.llm.sharding import op3_shard_vector_packing
from tallystream.llm.substrings import OP1_SQL, op1_substring_dedup
from tallystream.llm.toxicity import op2_toxicity_ordinal
from tallystream.llm.urls import op5_url_boosted_trees
from tallystream.llm.vectors import OP8_SQL, op8_one_bit_neighbours

QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_toxicity_ordinal": op2_toxicity_ordinal,
    "op3_shard_vector_packing": op3_shard_vector_packing,
    "op4_pack_concat_cut": op4_pack_concat_cut,
    "op5_url_boosted_trees": op5_url_boosted_trees,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_pu_quality": op7_pu_quality,
    "op8_one_bit_neighbours": op8_one_bit_neighbours,
    "op9_language_naive_bayes": op9_language_naive_bayes,
    "op10_spaced_seed_decontamination": op10_spaced_seed_decontamination,
    "op11_cube_mixing": op11_cube_mixing,
    "op12_baier_runs": op12_baier_runs,
    "op13_auction_repair": op13_auction_repair,
}

ORACLES = {
    "op1_substring_dedup": OP1_SQL,
    "op6_ngram_jaccard_join": OP6_SQL,
    "op8_one_bit_neighbours": OP8_SQL,
}
