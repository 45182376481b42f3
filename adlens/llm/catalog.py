"""The queries of the llm operators and, where SQL can say it, their DuckDB SQL."""

import corpus_pipeline
from adlens.llm.op01_pack import op1_packing
from adlens.llm.op02_html import op2_html_main_text
from adlens.llm.op03_lines import op3_line_dedup
from adlens.llm.op04_decontaminate import OP4_SQL, op4_decontamination
from adlens.llm.op05_shard import op5_kd_sharding
from adlens.llm.op06_jaccard import op6_ngram_jaccard
from adlens.llm.op07_hmm import op7_hmm_scores
from adlens.llm.op08_license import op8_license_scan
from adlens.llm.op09_urls import op9_url_filters
from adlens.llm.op10_quality import op10_quality_rules
from adlens.llm.op11_ann import op11_ann_graph
from adlens.llm.op12_divergence import OP12_SQL, op12_source_divergence
from adlens.llm.op13_resample import OP13_SQL, op13_importance_resampling

QUERIES = {
    "op1_packing": op1_packing,
    "op2_html_main_text": op2_html_main_text,
    "op3_line_dedup": op3_line_dedup,
    "op4_decontamination": op4_decontamination,
    "op5_kd_sharding": op5_kd_sharding,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_hmm_scores": op7_hmm_scores,
    "op8_license_scan": op8_license_scan,
    "op9_url_filters": op9_url_filters,
    "op10_quality_rules": op10_quality_rules,
    "op11_ann_graph": op11_ann_graph,
    "op12_source_divergence": op12_source_divergence,
    "op13_importance_resampling": op13_importance_resampling,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {
    "op4_decontamination": OP4_SQL,
    "op12_source_divergence": OP12_SQL,
    "op13_importance_resampling": OP13_SQL,
}
