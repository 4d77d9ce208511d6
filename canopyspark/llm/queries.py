"""The queries of this subpackage by name, and SQL for those that SQL can express."""

from canopyspark.llm.bpe import op9_bpe
from canopyspark.llm.decontamination import op4_benchmark_decontamination
from canopyspark.llm.divergence import OP11_SQL, op11_source_divergence_audit
from canopyspark.llm.html_text import op7_html_extraction
from canopyspark.llm.license_scan import OP1_SQL, op1_license_scans
from canopyspark.llm.line_dedup import OP5_SQL, op5_line_dedup
from canopyspark.llm.ngram_join import OP10_SQL, op10_ngram_jaccard_join
from canopyspark.llm.periodic_runs import OP13_SQL, op13_periodic_run_detection
from canopyspark.llm.quality import op3_quality_rules
from canopyspark.llm.secrets import op2_secret_scans
from canopyspark.llm.token_counts import op8_token_counts
from canopyspark.llm.toxicity import op12_toxicity
from canopyspark.llm.url_filters import OP6_SQL, op6_url_filters

QUERIES = {
    "op1_license_scans": op1_license_scans,
    "op2_secret_scans": op2_secret_scans,
    "op3_quality_rules": op3_quality_rules,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_line_dedup": op5_line_dedup,
    "op6_url_filters": op6_url_filters,
    "op7_html_extraction": op7_html_extraction,
    "op8_token_counts": op8_token_counts,
    "op9_bpe": op9_bpe,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_source_divergence_audit": op11_source_divergence_audit,
    "op12_toxicity": op12_toxicity,
    "op13_periodic_run_detection": op13_periodic_run_detection,
}
ORACLES: dict[str, str] = {
    "op1_license_scans": OP1_SQL,
    "op5_line_dedup": OP5_SQL,
    "op6_url_filters": OP6_SQL,
    "op10_ngram_jaccard_join": OP10_SQL,
    "op11_source_divergence_audit": OP11_SQL,
    "op13_periodic_run_detection": OP13_SQL,
}
