"""Operators of a training-data pipeline, with their registered queries and SQL.  Nothing else in the library imports this."""

from quillwort.llm.alignment import op11_alignment
from quillwort.llm.decontamination import OP3_SQL, op3_decontamination
from quillwort.llm.fingerprint import op9_fingerprints
from quillwort.llm.importance import OP12_SQL, op12_importance_resampling
from quillwort.llm.license_scan import OP1_SQL, op1_license_scan
from quillwort.llm.mixing import OP4_SQL, op4_mix_sources
from quillwort.llm.packing import op13_best_fit_packing
from quillwort.llm.quality import op10_quality_classifier
from quillwort.llm.simhash import op8_simhash_near_dedup
from quillwort.llm.substring_dedup import OP6_SQL, op6_substring_dedup
from quillwort.llm.suffix_dedup import OP7_SQL, op7_suffix_dedup
from quillwort.llm.toxicity import op2_toxicity
from quillwort.llm.warc import OP5_SQL, op5_warc

QUERIES = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_toxicity, op3_decontamination, op4_mix_sources, op5_warc, op6_substring_dedup, op7_suffix_dedup,
        op8_simhash_near_dedup, op9_fingerprints, op10_quality_classifier, op11_alignment, op12_importance_resampling, op13_best_fit_packing,
    )
}
#: The other six (toxicity, SimHash, fingerprints, quality, alignment, packing) are tested against brute force and held-out rows.
ORACLE_SQL = {
    "op1_license_scan": OP1_SQL, "op3_decontamination": OP3_SQL, "op4_mix_sources": OP4_SQL, "op5_warc": OP5_SQL,
    "op6_substring_dedup": OP6_SQL, "op7_suffix_dedup": OP7_SQL, "op12_importance_resampling": OP12_SQL,
}
