"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from . import line_dedup, warc
from .line_dedup import op5_line_dedup
from .media import op2_media
from .mixing import op4_mixing
from .packing import op10_packing
from .quality_model import op9_quality_model
from .quality_rules import op3_quality_rules
from .simhash import op8_simhash
from .suffix_dedup import op7_suffix_dedup
from .token_codes import op1_token_codes
from .warc import op6_warc

QUERIES = {f.__name__: f for f in (op1_token_codes, op2_media, op3_quality_rules, op4_mixing, op5_line_dedup, op6_warc, op7_suffix_dedup, op8_simhash, op9_quality_model, op10_packing)}
SQL: dict[str, str] = {"op5_line_dedup": line_dedup.SQL, "op6_warc": warc.SQL}
