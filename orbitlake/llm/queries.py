"""The registered queries of this subpackage, one an operator, and their SQL where SQL can express them."""

from . import ann, codes, divergence, hostrules, importance, jaccard, language_model, mixing, packing, secrets, sharding, substrings, toxicity

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_resharding": sharding.op2_resharding,
    "op3_secrets": secrets.op3_secrets,
    "op4_collisions": ann.op4_collisions,
    "op5_toxicity": toxicity.op5_toxicity,
    "op7_importance": importance.op7_importance,
    "op6_hostrules": hostrules.op6_hostrules,
    "op8_mixing": mixing.op8_mixing,
    "op9_jaccard": jaccard.op9_jaccard,
    "op10_substrings": substrings.op10_substrings,
    "op11_divergence": divergence.op11_divergence,
    "op12_language_model": language_model.op12_language_model,
    "op13_codes": codes.op13_codes,
}
ORACLES = {"op3_secrets": secrets.ORACLE, "op6_hostrules": hostrules.ORACLE, "op8_mixing": mixing.ORACLE, "op9_jaccard": jaccard.ORACLE, "op10_substrings": substrings.ORACLE, "op11_divergence": divergence.ORACLE, "op13_codes": codes.ORACLE}
