"""Queries and SQL of this subpackage."""

from .chat import OP1_SQL, op1_chat
from .decontaminate import op8_decontaminate
from .kneser_ney import op6_kneser_ney
from .langid import op11_language
from .licenses import op4_licenses
from .mixing import op2_mixing
from .periodic import op12_periodic
from .pii import op9_pii
from .quality import op5_quality
from .resample import op13_resample
from .simhash import op3_simhash
from .syncmers import op10_syncmers
from .toxicity import op7_toxicity

QUERIES = {f.__name__: f for f in (op1_chat, op2_mixing, op3_simhash, op4_licenses, op5_quality, op6_kneser_ney, op7_toxicity, op8_decontaminate, op9_pii, op10_syncmers, op11_language, op12_periodic, op13_resample)}
ORACLE = {"op1_chat": OP1_SQL}
