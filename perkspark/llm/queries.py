"""Queries of this subpackage: name -> (spark, sf_dir) -> DataFrame, and their DuckDB SQL."""

from __future__ import annotations

from . import op4_repetition
from . import op5_tensored_minhash as op5
from . import op6_voronoi_knn as op6
from .op10_license_rules import ORACLE_SQL as LICENSE_SQL
from .op10_license_rules import op10_license_rules
from .op11_line_bloom import ORACLE_SQL as LINES_SQL
from .op11_line_bloom import op11_line_bloom
from .op12_merkle_manifest import ORACLE_SQL as MANIFEST_SQL
from .op12_merkle_manifest import op12_merkle_manifest
from .op13_feast_whitening import op13_feast_whitening
from .op1_cube_mixing import op1_cube_mixing
from .op2_quality_cnn import op2_quality_cnn
from .op3_toxicity_ftrl import op3_toxicity_ftrl
from .op4_repetition import op4_repetition_rules
from .op5_tensored_minhash import op5_tensored_minhash
from .op6_voronoi_knn import op6_voronoi_knn
from .op7_packing import op7_vector_packing
from .op8_suffix_tree import op8_suffix_tree
from .op9_secrets import op9_secrets_cnn

QUERIES = {
    "op1_cube_mixing": op1_cube_mixing,
    "op2_quality_cnn": op2_quality_cnn,
    "op3_toxicity_ftrl": op3_toxicity_ftrl,
    "op4_repetition_rules": op4_repetition_rules,
    "op5_tensored_minhash": op5_tensored_minhash,
    "op6_voronoi_knn": op6_voronoi_knn,
    "op7_vector_packing": op7_vector_packing,
    "op8_suffix_tree": op8_suffix_tree,
    "op9_secrets_cnn": op9_secrets_cnn,
    "op10_license_rules": op10_license_rules,
    "op11_line_bloom": op11_line_bloom,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_feast_whitening": op13_feast_whitening,
}

ORACLE_SQL = {
    "op5_tensored_minhash": op5.ORACLE_SQL,
    "op6_voronoi_knn": op6.ORACLE_SQL,
    "op4_repetition_rules": op4_repetition.ORACLE_SQL,
    "op10_license_rules": LICENSE_SQL,
    "op11_line_bloom": LINES_SQL,
    "op12_merkle_manifest": MANIFEST_SQL,
}
