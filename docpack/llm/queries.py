"""The queries of this subpackage by name, and DuckDB SQL for those that SQL can express."""

from docpack.llm.exact import OP4_SQL, op4_exact_dedup
from docpack.llm.lines import OP2_SQL, op2_line_dedup
from docpack.llm.mixing import OP1_SQL, op1_mixing
from docpack.llm.near import op7_near_dedup
from docpack.llm.packing import op8_packing
from docpack.llm.pii import op6_pii
from docpack.llm.pivots import op12_nearest_vectors
from docpack.llm.quality import OP5_SQL, op5_quality_rules
from docpack.llm.search import OP13_SQL, op13_ranked_search
from docpack.llm.sharding import op3_sharding
from docpack.llm.toxicity import op10_toxicity
from docpack.llm.warc import op9_warc
from docpack.llm.whitening import op11_whitening

QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_line_dedup": op2_line_dedup,
    "op3_sharding": op3_sharding,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_pii": op6_pii,
    "op7_near_dedup": op7_near_dedup,
    "op8_packing": op8_packing,
    "op9_warc": op9_warc,
    "op10_toxicity": op10_toxicity,
    "op11_whitening": op11_whitening,
    "op12_nearest_vectors": op12_nearest_vectors,
    "op13_ranked_search": op13_ranked_search,
}
SQL = {"op1_mixing": OP1_SQL, "op2_line_dedup": OP2_SQL, "op4_exact_dedup": OP4_SQL, "op5_quality_rules": OP5_SQL, "op13_ranked_search": OP13_SQL}
