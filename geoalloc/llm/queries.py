"""The numbered queries, and their SQL where it can express them."""

from __future__ import annotations

from geoalloc.llm import op1_quotations as op1
from geoalloc.llm import op3_licences as op3
from geoalloc.llm import op5_url_filter as op5
from geoalloc.llm import op11_fill_middle as op11
from geoalloc.llm.op2_quality import op2_quality
from geoalloc.llm.op4_mixing import op4_mixing
from geoalloc.llm.op6_packing import op6_pack_documents
from geoalloc.llm.op7_jaccard_join import op7_jaccard_join
from geoalloc.llm.op8_product_quantisation import op8_product_quantisation
from geoalloc.llm.op9_winnowing import op9_winnowing
from geoalloc.llm.op10_separators import op10_separators
from geoalloc.llm.op12_whitening import op12_whitening
from geoalloc.llm.op13_secrets import op13_secrets

QUERIES = {f.__name__: f for f in (
    op1.op1_quotations, op2_quality, op3.op3_licences, op4_mixing, op5.op5_url_filter, op6_pack_documents, op7_jaccard_join,
    op8_product_quantisation, op9_winnowing, op10_separators, op11.op11_fill_middle, op12_whitening, op13_secrets)}
ORACLE = {"op1_quotations": op1.SQL, "op3_licences": op3.SQL, "op5_url_filter": op5.SQL, "op11_fill_middle": op11.SQL}
