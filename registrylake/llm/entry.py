"""The queries of this subpackage and their SQL."""

from __future__ import annotations


def queries() -> dict:
    from registrylake.llm.balltree import op5_ball_tree
    from registrylake.llm.brown import op1_brown_score
    from registrylake.llm.collocation import op11_collocations
    from registrylake.llm.langmix import op4_language_mixture
    from registrylake.llm.linededup import op9_line_dedup
    from registrylake.llm.packing import op6_curve_packing
    from registrylake.llm.posindex import op10_decontaminate
    from registrylake.llm.records import op3_token_records
    from registrylake.llm.resample import op12_importance
    from registrylake.llm.simhash import op8_simhash
    from registrylake.llm.suffix import op7_suffix_dedup
    from registrylake.llm.urlfilter import op13_bloom_urls
    from registrylake.llm.wrapper import op2_wrapper_text

    import corpus_pipeline

    return {"pipeline": corpus_pipeline.run} | {f.__name__: f for f in (op1_brown_score, op2_wrapper_text, op3_token_records, op4_language_mixture, op5_ball_tree, op6_curve_packing, op7_suffix_dedup, op8_simhash, op9_line_dedup, op10_decontaminate, op11_collocations, op12_importance, op13_bloom_urls)}


def oracle_sql() -> dict[str, str]:
    from registrylake.llm.balltree import OP5_SQL
    from registrylake.llm.collocation import OP11_SQL
    from registrylake.llm.linededup import OP9_SQL
    from registrylake.llm.posindex import OP10_SQL
    from registrylake.llm.resample import OP12_SQL
    from registrylake.llm.urlfilter import OP13_SQL

    import corpus_pipeline

    return {k: v for k, v in {"pipeline": corpus_pipeline.ORACLE_SQL}.items() if v} | {"op5_ball_tree": OP5_SQL, "op9_line_dedup": OP9_SQL, "op10_decontaminate": OP10_SQL, "op11_collocations": OP11_SQL, "op12_importance": OP12_SQL, "op13_bloom_urls": OP13_SQL}
