"""The registered queries of this subpackage and their SQL."""

from quillgraph.llm.langid import op6_langid
from quillgraph.llm.mixing import OP5_SQL, op5_mixing
from quillgraph.llm.packing import op8_packing
from quillgraph.llm.quality import op9_quality
from quillgraph.llm.sharding import op4_sharding
from quillgraph.llm.simhash import op3_simhash
from quillgraph.llm.spotsigs import OP2_SQL, PAIRS_SQL, op2_spotsigs, spotsig_pairs
from quillgraph.llm.suffix import op1_suffix_dedup
from quillgraph.llm.topk import OP10_SQL, op10_exact_topk
from quillgraph.llm.warc import OP7_SQL, op7_warc

QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_spotsigs, op3_simhash, op4_sharding, op5_mixing, op6_langid, op7_warc, op8_packing, op9_quality, op10_exact_topk, spotsig_pairs)}
SQL = {"op2_spotsigs": OP2_SQL, "spotsig_pairs": PAIRS_SQL, "op5_mixing": OP5_SQL, "op7_warc": OP7_SQL, "op10_exact_topk": OP10_SQL}
