"""The registered queries of the corpus operators, with DuckDB SQL where it can say them."""

from __future__ import annotations

from . import alignment, bpe, decontaminate, hostrules, license_scan, nearest, periodic_runs, quality, sharding, simhash, substring, tokens_binary, warc

QUERIES = {
    "op1_license_scan": license_scan.op1_license_scan,
    "op2_quality_classifier": quality.op2_quality_classifier,
    "op3_byte_bpe": bpe.op3_byte_bpe,
    "op4_warc_transactions": warc.op4_warc_transactions,
    "op5_benchmark_decontamination": decontaminate.op5_benchmark_decontamination,
    "op6_token_binary_output": tokens_binary.op6_token_binary_output,
    "op7_simhash_near_dedup": simhash.op7_simhash_near_dedup,
    "op8_two_pass_sharding": sharding.op8_two_pass_sharding,
    "op9_host_quality_rules": hostrules.op9_host_quality_rules,
    "op10_substring_dedup": substring.op10_substring_dedup,
    "op11_periodic_runs": periodic_runs.op11_periodic_runs,
    "op12_nearest_neighbours": nearest.op12_nearest_neighbours,
    "op13_tokenizer_alignment": alignment.op13_tokenizer_alignment,
}

ORACLE: dict[str, str] = {
    "op1_license_scan": license_scan.OP1_SQL,
    "op4_warc_transactions": warc.OP4_SQL,
    "op9_host_quality_rules": hostrules.OP9_SQL,
}
